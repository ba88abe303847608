"""Hits against an alignment of every text with every item."""

import random

import numpy as np
import pyarrow as pa
import pytest

from skeinworks.llm import decontamination as dc
from skeinworks.llm._common import strings

WORDS = [f"w{i}" for i in range(300)]


def tables(spark):
    r = random.Random(9)
    prose = lambda n: r.choices(WORDS, k=n)
    items = [prose(r.choice((4, 12, 40, 90))) for _ in range(14)]
    common = prose(25)  # an item that a third of all texts hold
    items.append(common)
    rows = [(None, "no id"), (400, None), (401, ""), (402, " ".join(common)), (402, " ".join(common)), (403, " ".join(prose(4000) + items[0] + prose(3000)))]
    for i in range(120):
        text = prose(r.randrange(5, 120))
        if i % 3 == 0:
            text[2:2] = common
        if i % 4 == 1:
            own = list(r.choice(items))
            for _ in range(len(own) // r.choice((5, 9, 30))):  # words changed, dropped or put in
                at = r.randrange(len(own))
                own[at : at + r.choice((0, 1))] = r.choice(([], ["other"]))
            text[1:1] = [w.upper() + "," for w in own]
        rows.append((i, " ".join(text)))
    docs = spark.createDataFrame([(a, b, 1, "x") for a, b in rows], "doc_id long, text string, item long, seed string").repartition(4)
    bench = spark.createDataFrame([(i, " ".join(x), 5) for i, x in enumerate(items)] + [(3, " ".join(items[3]), 5), (90, None, 5), (91, "too short", 5), (92, "", 5)], "item_id long, text string, texts long")
    return rows, items, docs, bench


def brute(rows, items):
    out = []
    for i, t in rows:
        _, h = dc.plain_words(strings(pa.array([t], pa.string())))
        for j, x in enumerate(items):
            _, w = dc.plain_words(strings(pa.array([" ".join(x)])))
            grams = {tuple(h[k : k + 3]) for k in range(len(h) - 2)}
            score = dc.smith_waterman(w, h)[0] / (2 * len(w))
            if score >= 0.5 and any(tuple(w[k : k + 3]) in grams for k in range(len(w) - 2)):
                out.append((i, j, round(score, 6)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [32 << 20, 700])
def test_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(dc, "ITEM_BYTES", block)
    rows, items, docs, bench = tables(spark)
    want = brute(rows, items)
    assert len(want) > 60 and any(s < 1 for _, _, s in want)
    got = dc.contaminated(docs, bench)
    assert sorted(((r.doc_id, r.item_id, r.score) for r in got.collect()), key=str) == want
    clean = dc.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns
    bad = {i for i, _, _ in want}
    assert sorted((str(r.doc_id), str(r.text)) for r in clean.collect()) == sorted((str(i), str(t)) for i, t in rows if i not in bad)


def test_empty_tables(spark):
    _, _, docs, bench = tables(spark)
    assert dc.contaminated(docs.limit(0), bench).count() == 0 and dc.contaminated(docs, bench.limit(0)).count() == 0
    assert dc.drop_contaminated(docs, bench.limit(0)).count() == docs.count()


def test_ties_keep_the_first_end():
    assert dc.smith_waterman(np.array([1, 2]), np.array([1, 2, 9, 1, 2])) == (4, 2, 2)
