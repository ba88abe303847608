"""The learned operators recomputed plainly: likelihood ratio, Kneser-Ney, the network's gradients; and personal data by its definitions."""

import hashlib
import math
import random
import re
import struct
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F

from skeinworks.llm import lm_score, pii, quality_net, quality_rules
from skeinworks.llm._common import strings

R = random.Random(21)
WORDS = [f"w{i}" for i in range(40)]


def plain_score(train, texts):
    """Interpolated modified Kneser-Ney over pairs of words, one text after the other, and the probability of each word behind each context."""
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", t.lower()), "</s>"]
    pairs = Counter()
    for t in train:
        w = ["<s>", *split(t)]
        pairs.update(zip(w, w[1:], strict=False))

    def discounts(counts):
        n = [sum(c == i for c in counts) for i in (1, 2, 3, 4)]
        y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
        return [0.0] + [min(i + 1.0, max(0.05, i + 1 - (i + 2) * y * n[i + 1] / n[i])) if n[i] else 0.5 for i in range(3)]

    cont = Counter(w for _, w in pairs)
    d, e = discounts(list(pairs.values())), discounts(list(cont.values()))
    total = Counter()
    kinds = {}
    for (v, _), c in pairs.items():
        total[v] += c
        kinds.setdefault(v, Counter())[min(c, 3)] += 1
    more = sum(e[min(c, 3)] for c in cont.values()) / len(pairs)

    def p(w, v):
        low = max(cont[w] - e[min(cont[w], 3)], 0) / len(pairs) + more / (len(cont) + 1)
        if not total[v]:
            return low
        c = pairs[v, w]
        return max(c - d[min(c, 3)], 0) / total[v] + sum(d[i] * kinds[v][i] for i in (1, 2, 3)) / total[v] * low

    scores = []
    for t in texts:
        w = ["<s>", *split(t)]
        scores.append(sum(math.log10(p(b, a)) for a, b in zip(w, w[1:], strict=False)))
    return scores, p, list(cont), list(total)


@pytest.mark.parametrize("hot", [1e-4, 0.02])
def test_kneser_ney(spark, monkeypatch, hot):
    monkeypatch.setattr(lm_score, "HOT_SHARE", hot)
    monkeypatch.setattr(lm_score, "BUCKET_BYTES", 200)
    weights = [1 / (i + 1) for i in range(40)]
    texts = [" ".join(R.choices(WORDS, weights, k=R.randrange(0, 30))) for _ in range(200)] + ["never Seen W1 words", ""]
    held = lambda i: i % 7 == 2 or i >= 200
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, word string, bucket int").repartition(3)
    got = {r.doc_id: r for r in lm_score.score(docs, (F.col("doc_id") % 7 == 2) | (F.col("doc_id") >= 200)).collect()}
    want, p, vocabulary, contexts = plain_score([t for i, t in enumerate(texts) if not held(i)], texts)
    for i, w in enumerate(want):
        assert got[i].score == pytest.approx(w, abs=1e-9)
    for v in [*contexts[:10], "<s>", "unseen"]:
        assert sum(p(w, v) for w in vocabulary) + p("unseen", v) == pytest.approx(1.0)


def test_likelihood_ratio(spark):
    texts = [" ".join(R.choices(WORDS[:20] if i % 2 else WORDS[20:], k=60)) + ("! ?" if i % 3 else " 12,5") for i in range(60)] + ["", "word"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    good = [i for i in range(60) if i % 2]
    buckets = quality_rules.BUCKETS

    def signed(x):
        return x - (1 << 64) if x >> 63 else x

    def cells(t):
        h = [signed(xxhash.xxh64_intdigest(g.encode(), 42)) for g in re.findall(r"[^\W_]+|[^\sA-Za-z0-9]+", t)]
        number = lambda x, seed: xxhash.xxh64_intdigest(struct.pack("<q", x), seed)
        return [x % buckets for x in h] + [signed(number(b, number(a, 42))) % buckets for a, b in zip(h, h[1:], strict=False)]

    raw, target = Counter(c for t in texts for c in cells(t)), Counter(c for i in good for c in cells(texts[i]))
    n_raw, n_target = sum(raw.values()), sum(target.values())
    add = n_target * quality_rules.SMOOTH / buckets + 1e-6
    weight = lambda c: math.log((target[c] + add) / (n_target + add * buckets)) - math.log((raw[c] + add) / (n_raw + add * buckets))
    got = {r.doc_id: r for r in quality_rules.rules(docs, docs.where(F.col("doc_id").isin(good))).collect()}
    for i, t in enumerate(texts):
        c = cells(t)
        want = sum(map(weight, c)) / len(c) if c else 0.0
        assert got[i].llr == pytest.approx(want, abs=2e-9)
        assert got[i].kept == (not got[i].base_failed and got[i].llr >= quality_rules.THRESHOLD)
    assert all(got[i].kept == (i % 2 == 1) for i in range(60))


def test_gradients():
    net = quality_net.Net(3)
    r = np.random.default_rng(2)
    texts = [bytes(r.integers(32, 127, n, dtype=np.uint8)) for n in (10, 300, 700, 1, 260)]
    sizes = np.array([len(t) for t in texts])
    rows, first = quality_net.chunked(b"".join(texts), np.cumsum(sizes) - sizes, sizes)
    assert np.diff(first).tolist() == [1, 2, 3, 1, 2]
    y = np.array([1, 0, 1, 0, 1], np.float32)
    net.p = {k: x.astype(np.float64) for k, x in net.p.items()}

    def loss():
        z = net.logits(rows, first)
        return float(np.mean(np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - z * y))

    g = net.gradients(rows, first, y)
    for name, x in net.p.items():
        flat, grad = x.reshape(-1), g[name].reshape(-1)
        for at in np.argsort(-np.abs(grad))[:6]:
            was = flat[at]
            flat[at] = was + 1e-5
            up = loss()
            flat[at] = was - 1e-5
            down = loss()
            flat[at] = was
            assert grad[at] == pytest.approx((up - down) / 2e-5, rel=2e-3, abs=1e-6), name


def test_held_out_quality(spark):
    sf = "/root/testdata/sf0.01"
    got = quality_net.op9_byte_cnn(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    good, bad = [r.score for r in held if r.quality == 1], [r.score for r in held if r.quality == 0]
    auc = sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad))
    assert auc > 0.95
    assert all(r.predicted == (r.score >= 0.3) for r in got)
    assert sum(r.predicted == 0 for r in held if r.quality == 0) >= 0.6 * len(bad) and sum(r.predicted for r in held if r.quality == 1) >= 0.9 * len(good)


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def spans_by_definition(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    ok = {
        "email": lambda s: True, "ip": lambda s: all(int(p) <= 255 for p in s.split(".")),
        "card": lambda s: 16 <= len(digits(s)) <= 19 and luhn(digits(s)), "phone": lambda s: 8 <= len(digits(s)) <= 15,
    }
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }
    return [(k, *m.span()) for k, p in patterns.items() for m in re.finditer(p, t) if ok[k](m[0])]


def test_personal_data(spark):
    made = ["4111 1111 1111 1111", "4111-1111-1111-1112", "+49 30 1234567", "10.0.0.1", "1.2.3.4.5.6.7.8.9", "256.1.1.1", "a.b@c.de.", "x@y", "٣", "1" * 16, "é@b.c"]
    texts = ["".join(R.choices("0123456789.+ -()@ab", k=R.randrange(80))) for _ in range(3000)]
    texts += [" ".join(R.choices(made, k=6)) for _ in range(300)] + ["".join(R.choices(made, k=6)) for _ in range(300)]
    for t in texts:
        assert [(k, a, z) for k, a, z, _ in pii.find(t)] == spans_by_definition(t)
    rows = [(i, t) for i, t in enumerate(texts[-40:])] + [(None, None), (100, "")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, own int, found string")
    for r in pii.spans(docs).collect():
        t = dict(rows)[r.doc_id] or ""
        assert r.base_sha256 == hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z in spans_by_definition(t)).encode()).hexdigest()
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(rows)


def test_tokens_of_a_later_slice():
    """A batch is cut into slices, whose texts do not begin at the buffer's start."""
    texts = pa.array(["One two THREE " * 500, "Four  five\tsix", "", "SEVEN éÈ ten " * 300])
    for at in range(len(texts)):
        part, want = strings(texts[at:]), texts[at:].to_pylist()
        codes, where, _, _ = lm_score._tokens(part)
        assert np.diff(where).tolist() == [len(t.split()) + 1 for t in want] and len(codes) == where[-1]
        assert pc.ascii_lower(part).to_pylist() == [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in want]
