"""Row states without locks: deterministic claims, pure deltas, keyed merges of snapshots.

Parquet tables take no updates: a stage computes a delta, a merge writes the next snapshot. One driver claims, so rows are
ordered, not locked.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def claim(rows: DataFrame, ready: Column, order: list[Column], n: int) -> DataFrame:
    """The first n ready rows: a top-n, no global sort."""
    return rows.where(ready).orderBy(*order).limit(n)


def merge(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """base with the delta's non-null values; new keys are not added. The delta has a row a key."""
    new = delta.select(F.col(key), F.struct(*[c for c in delta.columns if c != key]).alias("delta")).alias("new")
    have = set(delta.columns) - {key}
    both = base.alias("old").join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "left")
    return both.select(*[F.coalesce(f"new.delta.{c}", f"old.{c}").alias(c) if c in have else F.col(f"old.{c}") for c in base.columns])


def merged_rows(base: DataFrame, delta: DataFrame, key: str) -> tuple[DataFrame, int, int]:
    """The merge, how many rows the delta has, and how many of base it changed: unlike numbers tell of lost or repeated keys."""
    return merge(base, delta, key), delta.count(), base.join(delta.select(key).distinct(), key, "left_semi").count()


def set_status(rows: DataFrame, keys: DataFrame, status: int, key: str = "hash", column: str = "thread_status") -> DataFrame:
    """rows, with the status of those whose key is in keys."""
    hit = keys.select(F.col(key).alias("hit")).distinct().alias("k")
    both = rows.alias("r").join(hit, F.col(f"r.{key}") == F.col("k.hit"), "left")
    new = F.when(F.col("k.hit").isNotNull(), F.lit(status).cast(rows.schema[column].dataType)).otherwise(F.col(f"r.{column}"))
    return both.select(*[new.alias(c) if c == column else F.col(f"r.{c}") for c in rows.columns])


def upsert(base: DataFrame, delta: DataFrame, key: str, version: str) -> DataFrame:
    """Of each key the row of the largest version, the delta's on ties; an aggregate, so that a hot key's rows meet as partial maxima."""
    both = base.select(F.struct(*base.columns).alias("row"), F.lit(0).alias("new")).unionAll(delta.select(F.struct(*base.columns).alias("row"), F.lit(1).alias("new")))
    return both.groupBy(F.col(f"row.{key}")).agg(F.max_by("row", F.struct(f"row.{version}", "new")).alias("row")).select("row.*")


def insert_new(base: DataFrame, delta: DataFrame, key: str) -> DataFrame:
    """base and those rows of the delta whose key it lacks, one a key; columns that the delta lacks are null."""
    new = delta.dropDuplicates([key]).join(base.select(key), key, "left_anti")
    return base.unionByName(new.select([c for c in base.columns if c in delta.columns]), allowMissingColumns=True)


def changed_labels(threads: DataFrame, labels: DataFrame) -> DataFrame:
    """hash, spam: the label's value where it differs from the thread's, null-safe."""
    value = labels.where("label_type = 'spam'").select(F.col("target_fid").alias("author_fid"), F.expr("try_cast(label_value AS INT)").alias("new"))
    return threads.join(value, "author_fid").where(~F.col("spam").eqNullSafe(F.col("new"))).select("hash", F.col("new").alias("spam"))


def settle(ok: Column, blank: Column, overloaded: Column, done: int = 3, back: int = 1, failed: int = 19) -> Column:
    """The state after a batch: blank texts and errors fail, overload goes back, the rest is done."""
    return F.when(blank, failed).when(overloaded, back).when(ok, done).otherwise(failed).cast("smallint")


def reset_stale(rows: DataFrame, claimed: int, pending: int, as_of: Column, minutes: int = 5) -> DataFrame:
    """Claims older than so many minutes are pending again."""
    stale = (F.col("status") == claimed) & (F.col("claimed_at") < as_of - F.make_dt_interval(mins=F.lit(minutes)))
    return rows.withColumn("status", F.when(stale, pending).otherwise(F.col("status")))


def run_batches(step: Callable[[int], int], max_batches: int | None = None, batch_size: int | None = None) -> Iterator[int]:
    """Calls step with the batch's number until it reports no row, fewer than batch_size (if given), or max_batches are through."""
    n = 0
    while max_batches is None or n < max_batches:
        rows = step(n)
        if rows:
            yield rows
        if not rows or (batch_size and rows < batch_size):
            return
        n += 1


def elapsed(begin: Column, end: Column) -> Column:
    """Seconds between two times, to hundredths."""
    micros = lambda c: F.unix_micros(c.cast("timestamp"))
    return F.round((micros(end) - micros(begin)) / 1_000_000, 2)


def servers_for(backlog: int) -> int:
    """Model servers for a backlog."""
    return 0 if backlog <= 0 else 1 if backlog <= 5_000 else 2 if backlog <= 10_000 else 4


def summary(rows: DataFrame, key: str, value: str, share: float = 0.95) -> DataFrame:
    """key, n, mean_value, p95, low, high. The percentile interpolates between the two rows beside it, found by their rank among distinct
    values with their numbers: no key's values meet in one task's memory."""
    from pyspark.sql import Window

    base = rows.groupBy(key).agg(F.count("*").alias("n"), F.round(F.avg(value), 6).alias("mean_value"), F.min(value).alias("low"), F.max(value).alias("high"), F.count(value).alias("some"))
    steps = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.count("*").alias("k"))
    upto = steps.withColumn("upto", F.sum("k").over(Window.partitionBy(key).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)))
    at = (F.col("some") - 1) * F.lit(share)
    both = upto.join(base.select(key, "some"), key)
    near = lambda place, name: F.min(F.when(F.col("upto") > place, F.col(value))).alias(name)
    found = both.groupBy(key).agg(near(F.floor(at), "a"), near(F.ceil(at), "b"), F.first(F.ceil(at) - at).alias("down"), F.first(at - F.floor(at)).alias("up"))
    p95 = F.when(F.col("up") == 0, F.col("a")).otherwise(F.col("down") * F.col("a") + F.col("up") * F.col("b"))
    return base.join(found, key, "left").select(key, "n", "mean_value", p95.alias("p95"), "low", "high")
