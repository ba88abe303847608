"""Streams that run to their end, and clusters of points whose groups are plain."""

import datetime
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from skeinworks.functions import tokens
from skeinworks.functions import vectors as V
from skeinworks.operators import canonical, clusters
from skeinworks.functions import text as T
from skeinworks.streaming import posts


def test_posts_stream(spark, tmp_path):
    day = datetime.datetime(2024, 1, 1)
    rows = [(i, None if i % 3 == 0 else 0, i if i % 3 == 0 else 0, day + datetime.timedelta(hours=i)) for i in range(40)]
    schema = "hash long, parent_hash long, root_hash long, ts timestamp_ntz"
    listener = posts.Progress()
    spark.streams.addListener(listener)
    step = posts.into_parquet(f"{tmp_path}/out")
    for part in (rows[:25], rows[20:]):  # five come twice
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        posts.drain(posts.classified(stream, "30 hours"), step, f"{tmp_path}/check")
    spark.streams.removeListener(listener)
    got = spark.read.parquet(*[f"{tmp_path}/out/{d}" for d in os.listdir(f"{tmp_path}/out")]).collect()
    assert sorted((r.hash, r.threads_status) for r in got) == [(i, 2 if i % 3 == 0 else 1) for i in range(40)]
    assert listener.total == 45 and listener.summary(90)["rows_per_second"] > 0 and listener.summary(90)["minutes_left"] > 0


def test_daily_counts(spark, tmp_path):
    rows = [(datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=i), "view" if i % 2 else "click") for i in range(24 * 4)]
    events = spark.createDataFrame(rows, "ts timestamp_ntz, event_type string")
    events.write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(events.schema).parquet(f"{tmp_path}/in")
    posts.drain(posts.daily_counts(stream), posts.into_parquet(f"{tmp_path}/out"), f"{tmp_path}/check")
    closed = spark.read.parquet(*[f"{tmp_path}/out/{d}" for d in os.listdir(f"{tmp_path}/out")])
    want = {(r.day, r.event_type, r.n) for r in posts.daily_counts(events).collect()}
    got = {(r.day, r.event_type, r.n) for r in closed.collect()}
    assert len(want) == 8 and got == {w for w in want if w[0] < datetime.datetime(2024, 1, 4)}
    old = posts.settled(events.withColumn("ts", F.col("ts").cast("timestamp")), F.lit("2024-01-02 00:00:00").cast("timestamp"))
    assert old.count() == 18


def test_serve(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/in")
    query = posts.serve(spark.readStream.schema("id long").parquet(f"{tmp_path}/in"), posts.into_parquet(f"{tmp_path}/out"), f"{tmp_path}/check", "1 second")
    query.processAllAvailable()
    query.stop()
    assert spark.read.parquet(f"{tmp_path}/out/batch=0").count() == 3


@pytest.fixture(scope="module")
def blobs(spark):
    r = np.random.default_rng(5)
    centres = np.array([[10, 0, 0], [0, 10, 0], [0, 0, 10]])
    rows = [(i, (centres[i % 3] + r.normal(0, 0.3, 3)).tolist()) for i in range(120)]
    rows += [(200 + i, r.uniform(3, 4, 3).tolist()) for i in range(4)]
    return spark.createDataFrame(rows, "id long, v array<double>")


def test_kmeans_and_silhouette(blobs):
    three = blobs.where("id < 200")
    got = clusters.kmeans(three.withColumn("features", F.lit(1)), "v", 3)
    assert got.columns == ["id", "v", "features", "cluster"] and got.groupBy("cluster").count().where("count = 40").count() == 3
    assert clusters.silhouette(got, "v") > 0.9
    assert all(len(r.xy) == 2 for r in clusters.plane(three, "v").collect())


def test_density(blobs, spark, tmp_path):
    for metric, leaves in (("cosine", True), ("euclidean", False)):
        got = {r.id: r.cluster for r in clusters.density(blobs, "id", "v", 20, 3, metric, leaves).collect()}
        groups = {frozenset(i for i in got if got[i] == c) for c in set(got.values()) - {-1}}
        assert {frozenset(x for x in g if x < 200) for g in groups} == {frozenset(range(k, 120, 3)) for k in range(3)}
    assert {r.cluster for r in clusters.density(blobs.limit(5), "id", "v").collect()} == {-1} and clusters.density(blobs.limit(0), "id", "v").count() == 0
    table = clusters.sweep(blobs, "id", "v", (10, 30), (2, 5))
    assert table.count() == 4 and {r.clusters for r in table.collect()} == {3}
    clusters.write_sweep(table, f"{tmp_path}/sweep")
    assert spark.read.option("header", True).csv(f"{tmp_path}/sweep").count() == 4
    report = clusters.cluster_report(spark.createDataFrame([(0,), (0,), (-1,), (1,)], "cluster int")).collect()
    assert {(r.cluster, r.n, r.noise) for r in report} == {(0, 2, 25.0), (-1, 1, 25.0), (1, 1, 25.0)}


def test_communities(blobs):
    got = {r.node: r.community for r in clusters.communities(clusters.neighbour_graph(blobs.where("id < 200"), "id", "v", 10)).collect()}
    assert len(got) == 120 and all(len({got[i] for i in range(k, 120, 3)}) <= 4 for k in range(3))
    assert not {got[i] for i in range(0, 120, 3)} & {got[i] for i in range(1, 120, 3)}


@pytest.mark.parametrize("metric", ["cosine", "hamming"])
def test_nearest(spark, metric):
    r = np.random.default_rng(3)
    x = r.normal(size=(300, 16)).round(2)
    x[7] = x[3]
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(300)] + [(999, None)], "id long, v array<double>").repartition(5)
    got = V.nearest(df, "id", "v", df.where("id % 10 = 3"), 4, metric, block=7).collect()
    for q in range(3, 300, 10):
        d = ((x > 0) != (x[q] > 0)).sum(1).astype(float) if metric == "hamming" else 1 - x @ x[q] / np.linalg.norm(x, axis=1) / np.linalg.norm(x[q])
        d[q] = np.inf
        want = np.lexsort((np.arange(300), d.round(9)))[:4]
        assert [r_.id for r_ in sorted((g for g in got if g.q_id == q), key=lambda g: g.rank)] == want.tolist()


def test_cluster_files(spark, tmp_path):
    rows = spark.createDataFrame([(i % 2 - (i > 90) * 5, i, f"text {i}") for i in range(100)], "c int, i int, t string")
    table = clusters.samples(rows, "c", "i", "t", 3)
    assert clusters.write_samples(table, "c", f"file://{tmp_path}/s") == ["cluster_0_size_46.txt", "cluster_1_size_45.txt"]
    rule = "\n\n--------------------\n\n"
    assert (tmp_path / "s" / "cluster_1_size_45.txt").read_text() == rule.join(f"text {i}" for i in (1, 3, 5))


def test_token_counts(spark):
    tokens.register(spark)
    got = spark.sql("SELECT token_count('hello world'), token_count(''), token_count(NULL), token_count('<|endoftext|>') > 1").first()
    assert list(got) == [2, 0, None, True]
    totals = tokens.total_tokens(spark.createDataFrame([("one two.",), (None,), ("",)], "blob string"), count=tokens.bpe_count()).first()
    assert (totals.n_rows, totals.n_tokens, totals.mean_tokens) == (3, 3, 1.0)


@pytest.mark.parametrize("block", [512, 7])
def test_canonicals(spark, monkeypatch, block):
    """Against leaders found one text after the other, in one block and in many."""
    monkeypatch.setattr(canonical, "BLOCK", block)
    r = np.random.default_rng(8)
    base = [" ".join(f"w{x}" for x in r.integers(0, 900, 60)) for _ in range(12)]
    texts = ["Hello world, this is thread one", "@amy: hello WORLD this is thread one!!", None, "", "..."]
    for _ in range(150):
        w = base[r.integers(12)].split()
        for _ in range(r.integers(0, 4)):
            w[r.integers(60)] = f"x{r.integers(5)}"
        texts.append(" ".join(w))
    docs = spark.createDataFrame([(i, (i * 37) % 311, t) for i, t in enumerate(texts)], "hash long, ts long, text string")
    norm = docs.select("hash", "ts", T.normalise(F.col("text")).alias("norm"))
    sig = canonical.signatures(norm.select(F.col("hash").alias("node"), "norm"))
    signed = {x.node: np.array(x.signature) for x in sig.collect()}
    banded: dict = {}
    for x in canonical.bands(sig, 0.9).collect():
        banded.setdefault(x.node, set()).add(x.band)
    want, leaders, exact = {}, [], {}
    for x in sorted(norm.collect(), key=lambda x: (x.ts, x.hash)):
        if x.norm in exact:
            want[x.hash] = exact[x.norm]
            continue
        need = 0.95 if len(x.norm) > 60 else 0.90
        found = next((c for c in leaders if banded[c] & banded[x.hash] and (signed[c] == signed[x.hash]).mean() >= need), None)
        want[x.hash] = exact[x.norm] = x.hash if found is None else found
        if found is None:
            leaders.append(x.hash)
    got = canonical.canonicals(docs)
    assert {x.hash: x.canonical_hash for x in got.collect()} == want and len(set(want.values())) < 150
    report = canonical.report(got).first()
    assert report.n_total == len(texts) and report.n_unique == len(set(want.values()))
