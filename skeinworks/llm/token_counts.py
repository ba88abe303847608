"""Token counts by a separator scan of flat token files.

The files hold little-endian ids of two bytes and nothing else: texts one after the other, each closed by the end-of-document
id. They are cut into blocks of BLOCK ids, read apart from each other; a vectorised search gives each block the places of its
separators. A text that runs over blocks is stitched by a prefix scan over the blocks of a file: the running maximum of the last
separator's place is where the text open at the block's start began, the running sum of separators is its number.

An empty or null text has its end only, count 1 with it. Ids after a file's last separator are a text that is not ended. Repeated
rows and ids are each counted; an empty table writes no file. Only id and text are read, so that no other column can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import tokens
from ._common import Writer, cut, gather, kept_without, new_folder, open_file, pick, strings, table

BLOCK = 1 << 20


def _writer(folder: str, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name, nth, out = f"tokens-{TaskContext.get().partitionId():06d}.bin", 0, None
        encoder = tokens.Encoder(path, literal=True)
        for b in gather(batches):
            out = out or Writer(f"{folder}/{name}")
            ids, offsets = encoder.encode(strings(b.column("text")))
            ids, _ = tokens.with_ends(ids, offsets, encoder.end_id)
            out.write(ids.astype("<u2"))
            yield pa.RecordBatch.from_arrays([pa.array([name] * b.num_rows), pa.array(np.arange(nth, nth + b.num_rows)), b.column("doc_id")], names=["file", "nth", "doc_id"])
            nth += b.num_rows
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([-1 - out.size // 2]), pa.array([None], b.column("doc_id").type)], names=["file", "nth", "doc_id"])

    return run


def write_flat(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """Writes the texts of docs (doc_id, text) to flat files; returns file, nth, doc_id: which text stands where in the order, but no place. A row with nth < 0 tells -1 - ids of its file."""
    return cut(docs.mapInArrow(_writer(folder, path), f"file string, nth bigint, doc_id {dict(docs.dtypes)['doc_id']}"))


def _searcher(folder: str, end: int, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, k in zip(b.column("file").to_pylist(), b.column("block").to_pylist(), strict=True):
                with open_file(f"{folder}/{name}") as f:
                    ids = np.frombuffer(f.read_at(2 * block, 2 * block * k), "<u2")
                at = np.flatnonzero(ids == end) + block * k
                last = pa.array([int(at[-1]) if len(at) else None], pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([k], pa.int64()), pa.array([at.tolist()], pa.list_(pa.int64())), last], names=["file", "block", "ends", "last"])

    return run


def scan(files: DataFrame, folder: str, end: int, block: int = BLOCK) -> DataFrame:
    """file, nth, start, n_tokens (with the end), ended of each text. files: file, size (ids)."""
    blocks = files.select("file", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0).cast("long"), F.ceil(F.col("size") / block) - 1))).alias("block"))
    spread = blocks.repartition("file", "block")
    found = cut(spread.mapInArrow(_searcher(folder, end, block), "file string, block bigint, ends array<bigint>, last bigint"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    stitched = found.withColumn("first", F.coalesce(F.max("last").over(before), F.lit(-1))).withColumn("nth", F.coalesce(F.sum(F.size("ends")).over(before), F.lit(0)))
    each = stitched.select("file", "nth", "first", "ends", F.posexplode("ends").alias("i", "end"))
    start = F.when(F.col("i") == 0, F.col("first")).otherwise(F.get("ends", F.col("i") - 1)) + 1
    whole = each.select("file", (F.col("nth") + F.col("i")).alias("nth"), start.alias("start"), (F.col("end") - start + 1).alias("n_tokens"), F.lit(True).alias("ended"))
    closed = found.groupBy("file").agg(F.coalesce(F.max("last") + 1, F.lit(0)).alias("start"), F.sum(F.size("ends")).alias("nth"))
    rest = files.join(closed, "file").where("size > start").select("file", "nth", "start", (F.col("size") - F.col("start")).alias("n_tokens"), F.lit(False).alias("ended"))
    return whole.union(rest)


def count_tokens(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, block: int = BLOCK) -> DataFrame:
    """doc_id, file, nth, start, n_tokens, ended of every row."""
    path = path or tokens.vocabulary()
    folder = new_folder(docs.sparkSession, "flat-tokens")
    order = write_flat(pick(docs, doc_id=id_col, text=text_col), folder, path)
    files = order.where("nth < 0").select("file", (-1 - F.col("nth")).alias("size"))
    counts = scan(files, folder, tokens.Encoder(path).end_id, block)
    return kept_without(order.where("nth >= 0").join(counts, ["file", "nth"]).select("doc_id", "file", "nth", "start", "n_tokens", "ended"), folder)


def op2_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The number of tokens of every document, with its end, and where it stands in the flat files."""
    return count_tokens(table(spark, sf_dir, "documents"))
