"""The pipeline over small tables, stage by stage, against plain versions of what each stage decides."""

import random

import pytest

import corpus_pipeline
from skeinworks.llm import pii, piece_sampling, quality_net

R = random.Random(31)
WORDS = [f"word{i}" for i in range(250)]
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(n):
    return " ".join(R.choices(WORDS, k=n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    items = [(i, prose(30)) for i in range(4)]
    texts = [prose(R.randrange(40, 90)) for _ in range(60)]
    texts += [f"{prose(20)} {t} {prose(20)}" for _, t in items] + ["#$% !! 0x0 " * R.randrange(5, 30) for _ in range(30)]
    for t in texts[:10]:
        w = t.split()
        w[20] = "changed"
        texts += [t, " ".join(w)]
    texts += [f"mail one{i % 3}@site.org about Project{i % 3} {prose(40)}" for i in range(9)]
    texts += [None, "", prose(20_000), "a"]
    rows = [(i, t, "en", "web", None if t is None else len(t)) for i, t in enumerate(texts)] + [(None, prose(50), "en", "web", 1), (3, prose(45), "en", "web", 2)]
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame([(i, 0 if "#$%" in (t or "") else 1, 0) for i, t in enumerate(texts) if i % 2], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), items


def stage(spark, path, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, path)


def test_stages(spark, folder):
    path, items = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    rows = lambda d: sorted(map(tuple, d.collect()), key=str)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontamination", "pii", "pieces"]

    good = stage(spark, path, "quality", docs)
    scores = quality_net.score(docs, quality_net.fitted(spark, path))
    assert good.columns == docs.columns and good.count() == scores.where("predicted = 1").count()
    kept = rows(good)
    assert not any("#$%" in (r[1] or "") for r in kept) and sum(r[1] is not None and "word" in r[1] for r in kept) >= 0.9 * sum("word" in (r[1] or "") for r in rows(docs))

    one = stage(spark, path, "near_dedup", good)
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (r[1] or "").split()) else set() for r in kept]
    root = list(range(len(kept)))

    def top(x):
        return x if root[x] == x else top(root[x])

    for i in range(len(kept)):
        for j in range(i):
            if (kept[i][1] or "") == (kept[j][1] or "") or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) > 0:
                root[top(i)] = top(j)
    classes = {}
    for i, r in enumerate(kept):
        classes.setdefault(top(i), []).append(r)
    left = rows(one)
    assert one.columns == docs.columns and len(left) == len(classes)
    for members in classes.values():
        mine = [r for r in left if r in members]
        assert len(mine) == 1 and mine[0][0] == min((m[0] for m in members if m[0] is not None), default=None)

    clean = stage(spark, path, "decontamination", one)
    assert rows(clean) == [r for r in left if not any(t in (r[1] or "") for _, t in items)]

    private = stage(spark, path, "pii", clean)
    assert private.columns == docs.columns and private.schema == docs.schema
    found = {(r.doc_id, r.base_sha256): r for r in pii.spans(clean).collect()}
    assert any(r.base for r in found.values())
    texts = {r[1] for r in rows(private)}
    assert not any("@site.org" in (t or "") for t in texts) and any("[EMAIL]" in (t or "") for t in texts)
    assert private.count() == clean.count() and all(r[4] is None or r[1] is None or r[4] == len(r[1]) for r in rows(private) if r[0] not in (None, 3))

    pieces = stage(spark, path, "pieces", private).collect()
    v = piece_sampling.vocabulary()
    import numpy as np

    by_id = {r[0]: r[1] or "" for r in rows(private) if r[0] not in (None, 3)}
    for r in pieces:
        assert r.decodes
        if r.doc_id in by_id:
            assert v.decode(np.array(r.ids, np.int64)).tobytes().decode()[1:] == by_id[r.doc_id]
    assert {r.doc_id for r in pieces} == {r[0] for r in rows(private)}


def test_run(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, f in corpus_pipeline.STAGES:
        docs = f(spark, docs, path)
    key = lambda r: (str(r.doc_id), r.sample, r.ids_crc32)
    assert sorted(map(key, corpus_pipeline.run(spark, path).collect())) == sorted(map(key, docs.collect()))


def test_empty_tables(spark, tmp_path):
    for name, schema in (("documents", DOCS), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_rewritten_in_pieces():
    """Texts are rewritten a part of a large batch at a time, in order, nulls and other columns as they were."""
    import pyarrow as pa

    texts = [None if i % 7 == 0 else f"{i} " + "x" * 20_000 for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(300)), pa.array(texts), pa.array([[{"kind": "ip", "start": 0, "stop": 1}] if t else None for t in texts])], names=["doc_id", "body", "found"])
    out = list(pii._rewriter("body", ["doc_id", "body"], None, "found")(iter([batch])))
    assert max(b.nbytes for b in out) <= 2 * pii.REWRITE_BYTES
    assert pa.Table.from_batches(out).to_pydict() == {"doc_id": list(range(300)), "body": [t and "[IP]" + t[1:] for t in texts]}
