"""Ordered, sharded Parquet exports that resume."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from .shared import cut

ROWS_PER_FILE = 2_000_000
# fixed values: the columns and names of an export
COLUMNS = ("hash", "fids", "reactions", "author_fid", "ts", "tokens", "blob_ts", "blob", "blob_embedding", "blob_embedding_binary")
NAME = "threads-part-%05d.parquet"
WRITER = {"compression": "zstd", "parquet.compression.codec.zstd.level": "5", "parquet.enable.dictionary": "false", "parquet.page.size": str(1 << 20)}


def fetched(df: DataFrame, rows: int = 250_000) -> Iterator[list[Row]]:
    """The rows as lists of so many, a partition at a time on the driver: for readers that are no Spark jobs."""
    held = []
    for r in df.toLocalIterator(prefetchPartitions=True):
        held.append(r)
        if len(held) == rows:
            yield held
            held = []
    if held:
        yield held


def numbered(df: DataFrame, order: list[str], rows_per_file: int = ROWS_PER_FILE, row: str = "row", shard: str = "shard") -> DataFrame:
    """df with the columns `row` (0 on, in order) and `shard`: ranges are sorted apart, their sizes summed up, so that no task sorts all."""
    if {row, shard} & set(df.columns):
        raise ValueError(f"the table has a column {row} or {shard}; name others")
    n = max(1, df.sparkSession.sparkContext.defaultParallelism)
    # the ranges are written, for a lost executor must not deal them out anew; rows stay whole, so that no name can clash
    parts = cut(df.repartitionByRange(n, *[df[c] for c in order]).select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("r")).withColumn("part", F.spark_partition_id()))
    sizes = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    at = F.row_number().over(Window.partitionBy("part").orderBy(*[F.col(f"r.`{c}`") for c in order])) - 1
    # a row for each range
    placed = parts.withColumn("at", at).join(F.broadcast(first), "part").select("r", (F.col("first") + F.col("at")).cast("long").alias("place"))
    return placed.select("r.*", F.col("place").alias(row), F.floor(F.col("place") / rows_per_file).alias(shard))


def _names(path: str, pattern: str) -> list[str]:
    from pyarrow import fs

    files, root = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else "file://" + path)
    found = files.get_file_info(fs.FileSelector(root, allow_not_found=True))
    return sorted(f.base_name for f in found if re.fullmatch(pattern, f.base_name))


def next_shard(path: str, name: str = NAME) -> int:
    """One more than the number of the last file there."""
    head, _, end = name.partition("%05d")
    numbers = [int(n[len(head) : len(n) - len(end)]) for n in _names(path, re.escape(head) + r"\d+" + re.escape(end))]
    return max(numbers, default=-1) + 1


def export(df: DataFrame, path: str, order: list[str], rows_per_file: int = ROWS_PER_FILE, name: str = NAME, resume: bool = True) -> list[str]:
    """Writes the rows, in order, as files of rows_per_file: zstd 5, no dictionary, 1 MiB pages. With resume, files that are there count as
    written, and the rows of as many files are left out. Returns the names of the new files."""
    first = next_shard(path, name) if resume else 0
    out = cut(numbered(df, order, rows_per_file, "__row", "__shard").where(F.col("__shard") >= first))
    last = out.agg(F.max("__shard")).first()[0]
    if last is None:
        return []
    spark, tmp = df.sparkSession, f"{path.rstrip('/')}/_new"
    sorted_ = out.repartitionByRange(last - first + 1, "__shard").sortWithinPartitions("__shard", "__row").drop("__row")
    sorted_.write.mode("overwrite").options(**WRITER).partitionBy("__shard").parquet(tmp)
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = []
    for i in range(first, last + 1):
        parts = sorted(str(s.getPath()) for s in files.listStatus(jvm.Path(f"{tmp}/__shard={i}")) if s.getPath().getName().startswith("part-"))
        if len(parts) != 1:
            raise RuntimeError(f"shard {i} has {len(parts)} files")
        files.rename(jvm.Path(parts[0]), jvm.Path(f"{path}/{name % i}"))
        names.append(name % i)
    files.delete(jvm.Path(tmp), True)
    return names


def export_threads(threads: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> list[str]:
    """The threads with float vectors that are no spam, by time; resumes."""
    ready = threads.where("thread_status = 5 AND spam = 2").select(*COLUMNS)
    return export(ready, path, ["ts", "hash"], rows_per_file)


def export_pages(df: DataFrame, path: str, order: list[str], rows: int = 5_000_000) -> None:
    """The older export: the folder is emptied, then pages of so many rows are written as snappy files."""
    out = numbered(df, order, rows, "__row", "__page")
    out.repartition("__page").sortWithinPartitions("__row").drop("__row", "__page").write.mode("overwrite").option("compression", "snappy").parquet(path)


def page(df: DataFrame, order: list[str], n: int, of: int) -> DataFrame:
    """Page n of `of` rows, by row number."""
    return numbered(df, order, of, "__row", "__page").where(F.col("__page") == n).drop("__row", "__page")
