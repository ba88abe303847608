"""Queries over tables beyond the sizes at which they once stopped short."""

import random

import duckdb
import numpy as np

from skeinworks.functions import vectors as V
from skeinworks.llm import expressible, pii
from skeinworks.operators import canonical, clusters, threads
from skeinworks.plans import procedures  # noqa: F401  registers its queries
from skeinworks.plans import queries as plans


def test_media_of_all_pages(spark, tmp_path):
    """Pages whose numbers lie beyond the clock's ten hours."""
    rows = [(i, f"https://Site.example/{i % 9}", "") for i in [*range(10), *range(32_395, 32_405), *range(90_000, 90_010)]]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    got = plans.QUERIES["process_media_casts"](spark, str(tmp_path)).select("id", "media_status", "n_media").collect()
    assert sorted(map(tuple, got)) == sorted(duck.sql(f"SELECT id, media_status, n_media FROM ({plans.ORACLE['process_media_casts']})").fetchall())


def test_personal_counts_of_one_scan(spark, tmp_path, monkeypatch):
    """The counts need the patterns only, not the terms that disclose what they find."""
    rows = [(1, "a.b@c.org and 10.0.0.1, 10.0.0.256"), (1, "card 4111 1111 1111 1111, +44 (20) 7946-0958"), (2, None), (3, ""), (None, "x@y.zz x@y.zz"), (4, "none")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    want = sorted(pii.op6_disclosure(spark, str(tmp_path)).select("doc_id", "n_email", "n_ip", "n_card", "n_phone").collect(), key=repr)
    monkeypatch.setattr(pii, "spans", None)
    got = sorted(expressible.personal_counts(spark, str(tmp_path)).collect(), key=repr)
    assert got == want and sum(r.n_email for r in got) == 3


def test_nearest_of_blocks_and_ties(spark, monkeypatch):
    """Every query with a single task's rows bounded: files and groups of queries smaller than the table, equal rows, empty vectors of zeros."""
    monkeypatch.setattr(V, "FILE_ROWS", 50)
    monkeypatch.setattr(V, "TASK_QUERIES", 30)
    monkeypatch.setattr(V, "PAIRS", 64)
    r = np.random.default_rng(4)
    x = r.normal(size=(240, 8)).round(1)
    x[60:100], x[200:220], x[5] = x[60], x[7], 0
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>").repartition(3)
    got = {(g.q_id, g["rank"]): g.id for g in V.nearest(df, "id", "v", df, 6, block=11).collect()}
    unit = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)
    for q in range(240):
        d = (1 - np.einsum("ij,j->i", unit, unit[q])).round(12)
        d[q] = np.inf
        assert [got[q, j] for j in range(1, 7)] == np.lexsort((np.arange(240), d))[:6].tolist()


def test_supported_without_texts(spark):
    """The posts that hydrated() gives a text, found from hashes alone: no text column is there."""
    r = random.Random(3)
    rows = [(i, r.randrange(12), f"text {i}", [r.randrange(130) for _ in range(r.randrange(3))], [], [], []) for i in range(120)] + [(200, 1, "t", None, [], [], [])]
    posts = spark.createDataFrame(rows, "hash long, fid long, text string, quotes array<long>, mentions array<long>, positions array<int>, urls array<string>")
    profiles = spark.createDataFrame([(i, f"u{i}") for i in range(10)], "fid long, username string")
    for seeds in (posts.select("hash"), posts.where("hash % 9 = 0").select("hash")):
        want = sorted(x.hash for x in threads.hydrated(posts, profiles, seeds).collect())
        assert sorted(x.hash for x in threads.supported(posts.select("hash", "fid", "quotes"), profiles, seeds).collect()) == want and want


def test_density_beyond_the_matrix(monkeypatch):
    """More rows than are held as a matrix: a spanning tree of the same distances, and the same clusters but for rows that ties leave open."""
    r = np.random.default_rng(2)
    x = np.concatenate([c + r.normal(0, 0.2, (60, 5)) for c in r.normal(0, 3, (4, 5))] + [r.normal(0, 6, (20, 5))])
    made = lambda metric: clusters._spanning_tree(clusters._reach(x, 2, metric), len(x))[:, 2]
    for metric, leaves in (("cosine", True), ("euclidean", False)):
        monkeypatch.setattr(clusters, "MOST", 5000)
        tree, want = made(metric), clusters.density_labels(x, 20, 2, metric, leaves)
        monkeypatch.setattr(clusters, "MOST", 100)
        monkeypatch.setattr(clusters, "HELD", 1000)
        got = clusters.density_labels(x, 20, 2, metric, leaves)
        assert np.allclose(made(metric), tree, rtol=0, atol=1e-9) and (got == want).mean() > 0.97 and want.max() >= 2


def test_near_texts_meet_and_others_seldom(spark):
    """Signatures that differ in as many places as near texts may, spread as badly as can be, share a key; those alike by six places in ten rarely."""
    r = np.random.default_rng(6)
    base = r.integers(0, 1 << 40, 128)
    rows = [("a", base.tolist(), 100), ("b", base.tolist(), 30)]
    for i, (n, length, m) in enumerate([(6, 100, 7), (12, 30, 13)] * 20):
        v = base.copy()
        v[[128 * j // m for j in range(m)][1:] if i < 2 else r.choice(128, n, False)] += 1
        rows.append((f"near{i}", v.tolist(), length))
    far = [np.where(r.random(128) < 0.6, base, r.integers(0, 1 << 40, 128)) for _ in range(200)]
    rows += [(f"far{i}", v.tolist(), 1000) for i, v in enumerate(far)]
    signed = spark.createDataFrame(rows, "node string, signature array<long>, n int").where("node <> 'b'")
    keys = {}
    for x in canonical.meeting(signed).collect():
        keys.setdefault(x.node, set()).add(x.band)
    assert all(keys["a"] & keys[k] for k in keys if k.startswith("near"))
    long_ = {}
    for x in canonical.meeting(signed.where("n > 60")).collect():
        long_.setdefault(x.node, set()).add(x.band)
    assert sum(bool(long_["a"] & long_[f"far{i}"]) for i in range(200)) < 5


def test_sizes_need_no_texts(spark, monkeypatch):
    """The sizes of threads are counted without their texts; a large thread has its root's text all the same."""
    seen, sizes = [], threads.thread_sizes
    monkeypatch.setattr(threads, "thread_sizes", lambda posts: seen.append(posts.where("text IS NOT NULL").count()) or sizes(posts))
    rows = [(i, None if i == 1 else 1, 1, 1, f"text number {i} of this thread", [], [], [], []) for i in range(1, 6)]
    posts = spark.createDataFrame(rows, "hash long, parent_hash long, root_hash long, fid long, text string, quotes array<long>, mentions array<long>, positions array<int>, urls array<string>")
    reactions, labels = spark.createDataFrame([], "fid long, target_hash long, reaction_type int"), spark.createDataFrame([], "target_fid long, label_type string, label_value string")
    made = threads.build(posts, reactions, labels, spark.createDataFrame([(1, "ann")], "fid long, username string"), large=4).collect()
    assert seen == [0] and [m.blob for m in made] == ["@ann: text number 1 of this thread\n\n(thread too large: 5 replies)"]
