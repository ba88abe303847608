"""Ids of whole texts against the library's own, on texts that try the splitting rules."""

import random

import pyarrow as pa
import pytest

from skeinworks.llm import tokens

SIGNS = "aBcé'sİ́क़ﬁΩ…ß.,;!?\"()-<|>endoftext 0123½漢字ﾞ😀̀가 \n\t  DÀ''re'LL "


@pytest.mark.parametrize("literal", [False, True])
def test_ids_of_odd_texts(literal):
    r = random.Random(3)
    texts = ["".join(r.choices(SIGNS, k=r.randrange(60))) for _ in range(3000)]
    texts += ["", "<|endoftext|> a<|endoftext|>b, It's we'll. don't 'quoted' end's. café, naïve!! x<|startoftext|>", "ends. " * 9000]
    whole = tokens.tokenizer(tokens.vocabulary(), literal)
    want = [whole.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = tokens.Encoder(tokens.vocabulary(), literal)
    for _ in range(2):  # the second time all units are known
        ids, ends = encoder.encode(pa.array(texts, pa.large_string()))
        assert [ids[a:z].tolist() for a, z in zip(ends[:-1], ends[1:], strict=True)] == want


def test_accented_words_skip_the_splitting_rules():
    units = ["abc", "leé", "Äx", "ouéaieuxlepa", "漢字", "éa", "aक़", "aİ", "a1", ""]
    assert tokens._of_letters(pa.array(units, pa.large_string())).tolist() == [True] * 5 + [False] * 5


@pytest.mark.parametrize("most", [5, 60, 500])
def test_ids_while_units_are_forgotten(monkeypatch, most):
    monkeypatch.setattr(tokens, "REMEMBERED", most)
    r = random.Random(most)
    whole, encoder = tokens.tokenizer(tokens.vocabulary(), False), tokens.Encoder(tokens.vocabulary())
    words = ["".join(r.choices("abÉéß", k=r.randrange(1, 4))) + r.choice(["", "", ".", "!?", "'s", "1"]) for _ in range(400)]
    for _ in range(30):
        texts = [" ".join(r.choices(words[:20], k=5) + r.choices(words, k=5)) for _ in range(4)]
        ids, ends = encoder.encode(pa.array(texts, pa.large_string()))
        assert [ids[a:z].tolist() for a, z in zip(ends[:-1], ends[1:], strict=True)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(encoder.known) <= most + 81 and len(encoder.ends) == len(encoder.known) + 1 == len(encoder.met) + 1
