"""Canonical threads: MinHash bands for candidates, then leaders in order of time.

A text's canonical is the earliest earlier canonical whose signature is similar enough, or itself. Texts alike after
normalisation are one node. Rounds settle all nodes whose earlier neighbours are settled; each round is a few joins.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import cut

PERMS = 128
#: Nodes of a band that one part holds, about; two parts are compared in one task.
BLOCK = 512
#: Shares of equal places from which a text is near an earlier one: of texts of more than SHORT characters, and of others.
LONG_NEED, SHORT_NEED, SHORT = 0.95, 0.90, 60


def banding(threshold: float) -> tuple[int, int]:
    return (16, 8) if threshold >= 0.9 else (21, 6) if threshold >= 0.8 else (32, 4)


def shingle_ids(text: str) -> np.ndarray:
    """A number for each distinct three-character shingle; of shorter texts, for each word and the text."""
    if len(text) < 3:
        return np.array(sorted({int.from_bytes(w.encode(), "little") | 1 << 63 for w in [*text.split(), text]}), np.uint64)
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    return np.unique(c[:-2] | c[1:-1] << np.uint64(21) | c[2:] << np.uint64(42))


def signatures(docs: DataFrame, perms: int = PERMS) -> DataFrame:
    """node, signature (perms longs) of node, norm."""
    r = np.random.default_rng(11)
    a, b = r.integers(1, 2**61, perms, dtype=np.uint64) | np.uint64(1), r.integers(0, 2**61, perms, dtype=np.uint64)

    def sign_one(text: str) -> np.ndarray:
        x = shingle_ids(text)
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(32)
        return ((x[:, None] * a + b) >> np.uint64(32)).min(0).astype(np.int64)

    @F.pandas_udf("array<bigint>")
    def sign(texts: pd.Series) -> pd.Series:
        return texts.map(sign_one)

    return docs.select("node", sign("norm").alias("signature"))


def bands(signed: DataFrame, threshold: float) -> DataFrame:
    """node, band: the keys of each node's bands."""
    n, rows = banding(threshold)
    key = F.explode(F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.xxhash64(i, F.slice("signature", i * rows + 1, rows))))
    return signed.select("node", key.alias("band"))


def meeting(signed: DataFrame) -> DataFrame:
    """node, band: keys of which any two near nodes share one. signed: node, signature, n. A pair that may differ in k places agrees on one of
    k + 1 stretches of the signature whole. For texts that are not short these are stretches of 18 places, which unlike texts seldom share; the
    shorter stretches for short texts count only where one of these has them. Near texts share a band of any banding() too."""

    def keys(need: float):
        n = PERMS - int(np.ceil(need * PERMS)) + 1
        ends = [PERMS * i // n for i in range(n + 1)]
        return F.explode(F.array(*[F.xxhash64(F.lit(n), F.lit(i), F.slice("signature", a + 1, b - a)) for i, (a, b) in enumerate(zip(ends, ends[1:], strict=False))])).alias("band")

    fine = signed.select("node", "n", keys(SHORT_NEED))
    of_short = fine.where(F.col("n") <= SHORT).select("band")
    return signed.select("node", keys(LONG_NEED)).unionAll(fine.join(of_short, "band", "left_semi").select("node", "band"))


def agreement(a, b):
    """The share of equal places of two signatures."""
    return F.size(F.filter(F.zip_with(a, b, lambda p, q: p == q), lambda e: e)) / F.size(a)


def _near(rows: pd.DataFrame) -> pd.DataFrame:
    """Of a cell's rows the pairs of an open node and a later one that are similar enough; across its two parts, or in its one."""
    rows = rows.sort_values(["ts", "hash"], ignore_index=True)
    sig, part = np.stack(rows["signature"].to_numpy()).astype(np.uint32), rows["part"].to_numpy()
    need, two = np.where(rows["n"].to_numpy() > SHORT, LONG_NEED, SHORT_NEED), part.min() != part.max()
    late, early = [], []
    for i in np.flatnonzero(rows["open"].to_numpy()):
        ok = np.count_nonzero(sig[i + 1 :] == sig[i], axis=1) / sig.shape[1] >= need[i + 1 :]
        hit = i + 1 + np.flatnonzero(ok & (part[i + 1 :] != part[i]) if two else ok)
        late.append(hit)
        early.append(np.full(len(hit), i))
    late, early = (np.concatenate(x) if x else np.empty(0, int) for x in (late, early))
    of = lambda at, c: rows[c].to_numpy()[at]
    return pd.DataFrame({"ts": of(late, "ts"), "hash": of(late, "hash"), "early_ts": of(early, "ts"), "early_hash": of(early, "hash")})


def _met(members: DataFrame) -> DataFrame:
    """node, early of the similar pairs whose earlier node is open. members: band, node, n, signature, open. A band's nodes are dealt into parts of
    about BLOCK, and each two parts meet in one task; pairs are compared there, and only links come out."""
    # a band without a node behind an open one has no pair, and most bands hold one node
    open_ = F.min(F.when(F.col("open"), F.col("node"))).alias("first")
    sizes = members.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), open_, F.max("node").alias("last"))
    at = members.join(sizes.where("first < last").select("band", "parts"), "band").withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    others = F.sequence(F.lit(0), F.col("parts") - 1)
    cell = F.explode(F.transform(others, lambda q: F.xxhash64("band", F.least("part", q), F.greatest("part", q)))).alias("cell")
    kinds = {f.name: f.dataType.simpleString() for f in members.schema["node"].dataType}
    schema = f"ts {kinds['ts']}, hash {kinds['hash']}, early_ts {kinds['ts']}, early_hash {kinds['hash']}"
    found = at.select(cell, "part", "node.ts", "node.hash", "n", "signature", "open").groupBy("cell").applyInPandas(_near, schema)
    return found.distinct().select(F.struct("ts", "hash").alias("node"), F.struct(F.col("early_ts").alias("ts"), F.col("early_hash").alias("hash")).alias("early"))


def canonicals(docs: DataFrame, threshold: float = 0.9) -> DataFrame:
    """hash, canonical_hash. docs: hash, ts, text. The threshold's bands leave out no near text, whichever they are; see meeting()."""
    norm = docs.select("hash", "ts", T.normalise(F.col("text")).alias("norm"))
    nodes = cut(norm.groupBy("norm").agg(F.min(F.struct("ts", "hash")).alias("node")))
    sig = cut(signatures(nodes).join(nodes.select("node", F.length("norm").alias("n")), "node"))
    banded = cut(meeting(sig))

    def similar(pairs: DataFrame) -> DataFrame:
        near = pairs.distinct().join(sig, "node").join(sig.select(F.col("node").alias("early"), F.col("signature").alias("other")), "early")
        return near.where(agreement(F.col("signature"), F.col("other")) >= F.when(F.col("n") > SHORT, LONG_NEED).otherwise(SHORT_NEED)).select("node", "early")

    # a node that comes first in all its bands is canonical; whoever is near to such a one is none, and need not be met by others
    first = banded.groupBy("band").agg(F.min("node").alias("early"), F.count("*").alias("n")).where("n > 1").select("band", "early")
    behind = cut(banded.join(first, "band").where("node <> early"))
    later = cut(behind.select("node").distinct())
    heads = behind.join(later.withColumnRenamed("node", "early"), "early", "left_anti").select("node", "early")
    told = cut(similar(heads).groupBy("node").agg(F.min("early").alias("early")))
    open_ = later.join(told, "node", "left_anti")
    members = banded.join(later, "node", "left_semi").join(open_.withColumn("open", F.lit(True)), "node", "left")
    edges = cut(_met(members.join(sig, "node").select("band", "node", "n", "signature", F.coalesce("open", F.lit(False)).alias("open"))).unionAll(told))
    waiting = edges.select("node").distinct().withColumn("open", F.lit(True))
    state = cut(nodes.select("node").join(waiting, "node", "left").select("node", F.when(F.col("open").isNull(), F.col("node")).alias("leader")))
    while not state.where("leader IS NULL").isEmpty():
        seen = edges.join(state.select(F.col("node").alias("early"), F.col("leader").alias("its")), "early")
        # the earliest canonical neighbour counts once no neighbour before it is open
        first = seen.groupBy("node").agg(F.min(F.when(F.col("its").isNull(), F.col("early"))).alias("open"), F.min(F.when(F.col("its") == F.col("early"), F.col("early"))).alias("found"))
        sure = F.col("found").isNotNull() & (F.col("open").isNull() | (F.col("found") < F.col("open")))
        told = first.select("node", F.when(sure, F.col("found")).when(F.col("open").isNull(), F.col("node")).alias("new"))
        state = cut(state.join(told, "node", "left").select("node", F.coalesce("leader", "new").alias("leader")))
    return norm.join(nodes, "norm").join(state, "node").select("hash", F.col("leader.hash").alias("canonical_hash"))


def report(result: DataFrame) -> DataFrame:
    """n_total, n_unique, n_duplicates, rate in percent."""
    counts = result.agg(F.count("*").alias("n_total"), F.count_distinct("canonical_hash").alias("n_unique"))
    twice = F.col("n_total") - F.col("n_unique")
    return counts.select("n_total", "n_unique", twice.alias("n_duplicates"), F.round(100.0 * twice / F.col("n_total"), 4).alias("rate"))


def largest(result: DataFrame, n: int) -> DataFrame:
    """canonical_hash, n, first_ts, last_ts of the n largest groups of several texts. result: canonical_hash, ts."""
    groups = result.groupBy("canonical_hash").agg(F.count("*").alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))
    return groups.where("n > 1").orderBy(F.desc("n"), "canonical_hash").limit(n)
