"""Shared helpers of the corpus operators: Arrow batching, words, hashes, shared files."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one call of a vectorised step takes at once; bounds a worker's memory.
BATCH_BYTES = 6 << 20

U64 = np.uint64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, **cols: str) -> DataFrame:
    """Only the named columns, so that nothing else in the table can clash with an operator's own names."""
    return df.select(*[F.col(f"`{src}`").alias(dst) for dst, src in cols.items()])


def give_back() -> None:
    """Returns what Arrow and the C library keep for later: workers live on between tasks, and all of an executor's count at once."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # another C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def gather(batches: Iterator[pa.RecordBatch], text: str = "text", size: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """Joins small batches and splits large ones, so that each holds about `size` bytes of text or one row."""
    try:
        yield from _gathered(batches, text, size)
    finally:
        give_back()


def _gathered(batches: Iterator[pa.RecordBatch], text: str, size: int) -> Iterator[pa.RecordBatch]:
    held: list[pa.RecordBatch] = []
    total = 0

    def flush() -> pa.RecordBatch:
        t = pa.Table.from_batches(held).combine_chunks()
        return t.to_batches()[0]

    for b in batches:
        if not b.num_rows:
            continue
        lens = pc.fill_null(pc.binary_length(b.column(b.schema.get_field_index(text))), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, at = np.cumsum(lens), 0
        while at < b.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + size - total, side="right")))
            held.append(b.slice(at, to - at))
            total += int(ends[to - 1]) - before
            at = to
            if total >= size or at < b.num_rows:
                yield flush()
                held, total = [], 0
    if held:
        yield flush()


def strings(col: pa.Array) -> pa.Array:
    """The column as strings without nulls (null: empty), its bytes from the buffer's start on: Arrow's ascii_lower garbles a slice that starts later."""
    whole = pc.fill_null(col.cast(pa.large_string()), "")
    if not len(whole):
        return whole
    _, offsets, data = whole.buffers()
    at = np.frombuffer(offsets, np.int64)[whole.offset : whole.offset + len(whole) + 1]
    if not at[0]:
        return whole
    return pa.LargeStringArray.from_buffers(len(whole), pa.py_buffer(at - at[0]), data.slice(int(at[0]), int(at[-1] - at[0])))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Words `[^\\x20\\x09-\\x0D]+` of each text: offsets by text (one more than texts), the code of each word, the distinct words."""
    lists = pc.ascii_split_whitespace(texts)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    enc = lists.flatten().dictionary_encode()
    codes, distinct = enc.indices.to_numpy(), enc.dictionary
    empty = pc.index(distinct, pa.scalar("", distinct.type)).as_py()
    if empty >= 0:
        real = codes != empty
        offsets = np.concatenate(([0], np.cumsum(real)))[offsets]
        codes = codes[real]
    return offsets - offsets[0], codes.astype(np.int64), distinct


def hashes(distinct: pa.Array, seed: int = 0) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w, seed) for w in distinct.cast(pa.large_binary()).to_pylist()), U64, len(distinct))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64 bits."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def join_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of an ordered pair of hashes."""
    return mix(a * U64(0x9E3779B97F4A7C15) + mix(b + U64(0x632BE59BD9B4E019)))


def ngrams(h: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-grams that stay inside one text, and the position at which each starts."""
    if len(h) < n:
        return np.empty(0, U64), np.empty(0, np.int64)
    out = h[: len(h) - n + 1].copy()
    for i in range(1, n):
        out = join_hash(out, h[i : len(h) - n + 1 + i])
    ok = np.ones(len(out), bool)
    for i in range(1, n):  # a text's last n-1 positions begin n-grams that cross into the next text
        at = offsets[1:-1] - i
        ok[at[(at >= 0) & (at < len(out))]] = False
    start = np.flatnonzero(ok)
    # texts shorter than n words: their windows cross even where the marks above fall outside them
    owner = np.searchsorted(offsets, start, side="right") - 1
    keep = start + n <= offsets[owner + 1]
    start = start[keep]
    return out[start], start


def spread(offsets: np.ndarray) -> np.ndarray:
    """The text to which each word belongs."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def uniform(h: np.ndarray) -> np.ndarray:
    """Floats in (0, 1) from hashes."""
    return ((h >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir; a temporary one where that is unset and the master local; else an error."""
    context = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not d:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = "file://" + os.path.join(tempfile.gettempdir(), "skeinworks-shared")
    if not context.getCheckpointDir():
        context.setCheckpointDir(d)
    return d


def cut(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder: a lost executor loses none of them."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Scratch:
    """Tables of one run, as Parquet below the shared folder: smaller than checkpoints, and deleted as soon as they are not needed."""

    def __init__(self, spark: SparkSession, kind: str):
        self.spark, self.folder, self.n = spark, new_folder(spark, kind), 0

    def put(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.folder}/{self.n}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            for path in {f.rpartition("/")[0] for f in t.inputFiles() if self.folder.rpartition("/")[2] in f}:
                self._delete(path)

    def close(self, result: DataFrame) -> DataFrame:
        """The result as a checkpoint; all tables go."""
        out = cut(result)
        self._delete(self.folder)
        return out

    def _delete(self, path: str) -> None:
        delete(self.spark, path)


def delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def kept_without(result: DataFrame, folder: str) -> DataFrame:
    """The result as a checkpoint; the folder that it was computed from goes."""
    out = cut(result)
    delete(result.sparkSession, folder)
    return out


def unused(columns: list[str], *names: str) -> list[str]:
    """Names for columns of one's own, none of which a table has."""
    out = []
    for name in names:
        while name in columns or name in out:
            name += "_"
        out.append(name)
    return out


def new_folder(spark: SparkSession, kind: str) -> str:
    """The address of a fresh folder below the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{kind}-{uuid.uuid4().hex}"


def _fs(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else "file://" + uri)


def write_file(uri: str, parts: list) -> int:
    """Writes the buffers under another name, then renames: a task that is run twice leaves one whole file."""
    fs, path = _fs(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    tmp, n = f"{path}.{uuid.uuid4().hex}", 0
    with fs.open_output_stream(tmp) as out:
        for p in parts:
            n += len(memoryview(p).cast("B")) if len(p) else 0
            out.write(p)
    fs.move(tmp, path)
    return n


def open_file(uri: str):
    fs, path = _fs(uri)
    return fs.open_input_file(path)


def array_file(uri: str, dtype) -> np.ndarray:
    """The file's array: memory-mapped where the folder is mounted, else read."""
    fs, path = _fs(uri)
    if fs.type_name == "local":
        return np.memmap(path, dtype=dtype, mode="r") if os.path.getsize(path) else np.empty(0, dtype)
    with fs.open_input_file(path) as f:
        return np.frombuffer(f.read(), dtype)


class Writer:
    """A file that takes its name only when whole: a task that is run twice leaves one whole file."""

    def __init__(self, uri: str):
        self.fs, self.path = _fs(uri)
        self.fs.create_dir(os.path.dirname(self.path), recursive=True)
        self.tmp, self.size = f"{self.path}.{uuid.uuid4().hex}", 0
        self.out = self.fs.open_output_stream(self.tmp)

    def write(self, data: bytes | np.ndarray) -> None:
        if len(data):
            view = memoryview(data).cast("B")
            self.out.write(view)
            self.size += len(view)

    def close(self) -> None:
        self.out.close()
        self.fs.move(self.tmp, self.path)
