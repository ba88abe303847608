"""Sampled segmentations against all segmentations of small texts, and a plain A* search."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from skeinworks.llm import piece_sampling as ps


def everything(v, unit):
    """All segmentations of a unit as ids, with their weights."""
    known = {p: i for i, p in enumerate(v.pieces) if not (p.startswith("<") and p.endswith(">"))}
    out = [([], 0.0, unit)]
    done = []
    while out:
        ids, w, rest = out.pop()
        if not rest:
            done.append((tuple(ids), w))
            continue
        some = [n for n in range(1, len(rest) + 1) if rest[:n] in known]
        out += [([*ids, known[rest[:n]]], w + v.weight[known[rest[:n]]], rest[n:]) for n in some]
        if 1 not in some:
            out.append(([*ids, *(v.byte[b] for b in rest[0].encode())], w + v.weight[-1], rest[1:]))
    return done


def drawn(texts, keys, k):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts), pa.array(keys, pa.int64())], names=["doc_id", "text", "key"])
    out = pa.Table.from_batches(list(ps._sampler(None, k, True)(iter([batch])))).to_pylist()
    return sorted(out, key=lambda r: (r["doc_id"], r["sample"]))


@pytest.mark.parametrize("text", ["able", "on é", "no万"])
def test_law_of_small_texts(text):
    v, n, k = ps.vocabulary(), 6000, 2
    whole = [((), 0.0)]
    for unit in ps.units(text):
        whole = [(a + b, w + x) for a, w in whole for b, x in everything(v, unit)]
    top = max(w for _, w in whole)
    total = sum(math.exp(w - top) for _, w in whole)
    p = {ids: math.exp(w - top) / total for ids, w in whole}
    rows = drawn([text] * n, np.random.default_rng(4).integers(0, 2**62, n), k)
    pairs = Counter()
    estimate = 0.0
    for a, b in zip(rows[::2], rows[1::2], strict=True):
        assert a["doc_id"] == b["doc_id"] and a["ids"] != b["ids"] and a["perturbed"] > b["perturbed"] and a["decodes"] and b["decodes"]
        for r in (a, b):
            assert abs(math.log(p[tuple(r["ids"])]) - r["log_prob"]) < 1e-6
            estimate += p[tuple(r["ids"])] / r["inclusion"]
        pairs[tuple(a["ids"]), tuple(b["ids"])] += 1
    for i, pi in p.items():
        for j, pj in p.items():
            if i != j:
                want = pi * pj / max(1 - pi, 1e-300)
                assert abs(pairs[i, j] / n - want) < 5 * math.sqrt(want / n) + 3 / n
    assert abs(estimate / n - 1) < 0.05


def test_every_segmentation_is_found():
    v = ps.vocabulary()
    for text in ("a", "ab", "the", "x y", "", "zq万"):
        whole = [()]
        for unit in ps.units(text):
            whole = [a + b for a in whole for b, _ in everything(v, unit)]
        for k in (1, 3, len(whole), len(whole) + 5):
            rows = drawn([text], [7], k)
            assert len({tuple(r["ids"]) for r in rows}) == len(rows) == min(k, len(whole))
            assert [r["sample"] for r in rows] == list(range(len(rows)))
            if k >= len(whole):
                assert {tuple(r["ids"]) for r in rows} == set(whole) and all(r["inclusion"] == 1 for r in rows)


def test_a_text_does_not_depend_on_its_batch():
    texts = ["the first text", "", "zwei  Wörter\n万", "long " * 300, "the first text", "▁marked ▁"]
    together = drawn(texts, range(6), 4)
    apart = [r | {"doc_id": i} for i, t in enumerate(texts) for r in drawn([t], [i], 4)]
    assert together == apart
    assert all(r["decodes"] for r in together)


def test_query_returns_the_segmentations(spark, tmp_path):
    v, texts = ps.vocabulary(), {1: "the first text", 2: "", 3: None, 4: "zwei  Wörter\n万", 5: "long " * 300}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = ps.op7_gumbel_top_k(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in rows) == {1: 2, 2: 1, 3: 1, 4: 2, 5: 2}
    for r in rows:
        ids = np.array(r.ids, np.int64)
        assert len(ids) == r.n_pieces and zlib.crc32(ids.astype("<u4").tobytes()) == r.ids_crc32
        assert v.decode(ids).tobytes().decode()[1:] == (texts[r.doc_id] or "")
