"""Vector functions over array columns."""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import cut, delete, shared_dir


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (norm(a) * norm(b))


def normalised(a: Column) -> Column:
    return F.transform(a, lambda x: x.cast("double") / F.greatest(norm(a), F.lit(1e-12)))


def mean_pool(rows: Column, mask: Column) -> Column:
    """The mean of the rows (an array of vectors) where the mask is 1; a mask of zeros counts as 1e-9."""
    kept = F.zip_with(rows, mask, lambda v, m: F.transform(v, lambda x: x.cast("double") * m))
    zero = F.transform(F.get(kept, F.lit(0)), lambda x: F.lit(0.0))
    total = F.aggregate(kept, zero, lambda s, v: F.zip_with(s, v, lambda x, y: x + y))
    n = F.greatest(F.aggregate(mask, F.lit(0.0), lambda s, m: s + m), F.lit(1e-9))
    return F.transform(total, lambda x: x / n)


def quantise(df: DataFrame, column: str, out: str = "quantised") -> DataFrame:
    """int8 values by one scale, max |x| / 127 over all rows, kept as `scale`: one small aggregate, joined as a single row."""
    scale = df.agg((F.max(F.array_max(F.transform(column, lambda x: F.abs(x.cast("double"))))) / 127).alias("scale"))
    step = lambda x, s: F.greatest(F.lit(-128), F.least(F.lit(127), F.rint(x.cast("double") / s).cast("int"))).cast("tinyint")
    return df.crossJoin(F.broadcast(scale)).withColumn(out, F.transform(column, lambda x: step(x, F.col("scale"))))


def fidelity(original: Column, quantised: Column, scale: Column) -> Column:
    return cosine(original, F.transform(quantised, lambda x: x.cast("double") * scale))


def bit_string(values: Column) -> Column:
    """Unsigned bytes as bits, the highest first."""
    return F.array_join(F.transform(values, lambda x: F.lpad(F.bin(x.cast("long")), 8, "0")), "")


def signs(vector: Column) -> Column:
    """1 where positive, as a string of bits."""
    return F.array_join(F.transform(vector, lambda x: F.when(x > 0, "1").otherwise("0")), "")


def packed_signs(vector: Column, size: int) -> list[Column]:
    """The signs in longs of 32 bits each."""
    part = lambda k: F.aggregate(F.slice(vector, k * 32 + 1, 32), F.lit(0).cast("long"), lambda s, x: s * 2 + F.when(x > 0, 1).otherwise(0))
    return [part(k) for k in range(-(-size // 32))]


def hamming(a: list[Column], b: list[Column]) -> Column:
    out = F.lit(0)
    for x, y in zip(a, b, strict=True):
        out = out + F.bit_count(x.bitwiseXOR(y))
    return out


def packed(vector: Column) -> Column:
    """The signs as bytes, eight to a byte, the first in the highest bit."""
    return packed_bits(signs(vector))


def packed_bits(bits: Column) -> Column:
    """A string of bits, a multiple of eight long, as bytes."""
    n = (F.length(bits) / 8).cast("int")
    part = lambda i: F.lpad(F.conv(F.substring(bits, i * 8 + 1, F.lit(8)), 2, 16), 2, "0")
    return F.unhex(F.array_join(F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), part)).otherwise(F.array().cast("array<string>")), ""))


def unpacked(raw: Column) -> Column:
    """Bytes as a string of bits, the highest first."""
    digits = F.regexp_replace(F.hex(raw), "(.)", "$1,")
    return F.array_join(F.transform(F.filter(F.split(digits, ","), lambda d: d != ""), lambda d: F.lpad(F.conv(d, 16, 2), 4, "0")), "")


def checked(vector: Column, size: int) -> Column:
    """The vector; an error if it has another number of values."""
    message = F.concat(F.lit(f"a vector of {size} values was expected, not of "), F.size(vector).cast("string"))
    return F.when(vector.isNull() | (F.size(vector) == size), vector).otherwise(F.raise_error(message))


def parsed(text: Column) -> Column:
    """The vector written as [a, b, ...]."""
    return F.from_json(text, "array<float>")


def half(vector: Column) -> Column:
    """The values rounded to 16-bit floats."""
    @F.pandas_udf("array<float>")
    def rounded(rows: pd.Series) -> pd.Series:
        return rows.map(lambda v: None if v is None else np.asarray(v, np.float32).astype(np.float16).astype(np.float32))

    return rounded(vector)


def half_bytes(vector: Column) -> Column:
    """The values as 16-bit floats, little-endian."""
    @F.pandas_udf("binary")
    def written(rows: pd.Series) -> pd.Series:
        return rows.map(lambda v: None if v is None else np.asarray(v, np.float32).astype("<f2").tobytes())

    return written(vector)


#: Rows of a file of stored vectors, and queries that a task answers at once; with nearest()'s block they bound a worker's memory.
FILE_ROWS, TASK_QUERIES = 8192, 4096
#: Pairs whose distance is computed at once in full precision.
PAIRS = 1 << 18


def _matrix(batch) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("id").to_numpy()
    return ids, batch.column("v").flatten().to_numpy().reshape(len(ids), -1) if len(ids) else np.empty((0, 0))


def prepared(m: np.ndarray, metric: str) -> np.ndarray:
    """Rows of which products tell the distance: unit vectors, signs, or the rows."""
    return np.where(m > 0, 1.0, -1.0) if metric == "hamming" else m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300) if metric == "cosine" else m


def parts(batches, n: int):
    """ids and rows of a task, n at a time."""
    held, size = [], 0
    for b in batches:
        for at in range(0, b.num_rows, n):
            part = b.slice(at, n)
            if size and size + part.num_rows > n:
                yield _matrix(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                held, size = [], 0
            held.append(part)
            size += part.num_rows
    if size:
        yield _matrix(pa.Table.from_batches(held).combine_chunks().to_batches()[0])


def numbered(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(F.col(key).cast("long").alias("id"), F.transform(vector, lambda x: x.cast("double")).alias("v")).where("v IS NOT NULL")


def stored(rows: DataFrame, folder: str, metric: str) -> list[tuple[str, int]]:
    """Writes the prepared rows (id, v) below a shared folder, FILE_ROWS to a file; the files' addresses and numbers of rows."""

    def run(batches):
        import uuid

        from pyarrow import fs

        files, root = fs.FileSystem.from_uri(folder)
        for ids, m in parts(batches, FILE_ROWS):
            files.create_dir(root, recursive=True)
            name = uuid.uuid4().hex
            with files.open_output_stream(f"{root}/{name}") as out:
                out.write(memoryview(ids.astype(np.int64)).cast("B"))
                out.write(memoryview(np.ascontiguousarray(prepared(m, metric))).cast("B"))
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{name}"]), pa.array([len(ids)])], names=["file", "n"])

    return sorted((r.file, r.n) for r in rows.mapInArrow(run, "file string, n bigint").collect())


def load(file: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """ids and rows of a file."""
    from pyarrow import fs

    files, path = fs.FileSystem.from_uri(file)
    with files.open_input_file(path) as f:
        raw = f.read()
    return np.frombuffer(raw, np.int64, n), np.frombuffer(raw, np.float64, offset=8 * n).reshape(n, -1)


def dealt(ask: DataFrame) -> DataFrame:
    """The queries, dealt out so that all cores have some and no task many."""
    n = ask.count()
    return ask.repartition(max(1, min(n, max(ask.sparkSession.sparkContext.defaultParallelism, -(-n // TASK_QUERIES)))), "id")


def _products(q: np.ndarray, m: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The products of the rows q[a] and m[b], a pair's the same wherever it stands."""
    return np.concatenate([np.einsum("ij,ij->i", q[a[i : i + PAIRS]], m[b[i : i + PAIRS]]) for i in range(0, len(a), PAIRS)] or [np.empty(0)])


def _best(q_ids: np.ndarray, q: np.ndarray, files: list[tuple[str, int]], k: int, metric: str, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Distances and ids of the k nearest stored rows of each query. Products in single precision tell which pairs may count; of these the
    distances are computed in double."""
    best_d, best_i = np.full((len(q_ids), k), np.inf), np.full((len(q_ids), k), np.iinfo(np.int64).max)
    small, slack = q.astype(np.float32), 0.0 if metric == "hamming" else (q.shape[1] + 8) * 2.0**-22
    for name, n in files:
        ids, m = load(name, n)
        turned = np.ascontiguousarray(m.T, np.float32)
        for at in range(0, len(q_ids), block):
            mine = slice(at, at + block)
            s = small[mine] @ turned
            worst = best_d[mine, -1]
            # least product of a pair that may count
            least = (q.shape[1] - 2 * worst if metric == "hamming" else 1 - worst) - slack
            fresh = np.flatnonzero(np.isinf(worst))
            if len(fresh) and n > k:
                part = np.where((q_ids[mine][fresh, None] == ids) | np.isnan(s[fresh]), -np.inf, s[fresh])
                least[fresh] = np.partition(part, n - k, axis=1)[:, n - k] - 2 * slack
            a, b = np.divmod(np.flatnonzero(s >= least[:, None].astype(np.float32) - np.float32(slack)), n)
            other = q_ids[mine][a] != ids[b]
            a, b = a[other], b[other]
            if not len(a):
                continue
            d = (q.shape[1] - s[a, b].astype(np.float64)) / 2 if metric == "hamming" else 1 - _products(q[mine], m, a, b)
            better = (d < worst[a]) | ((d == worst[a]) & (ids[b] < best_i[mine, -1][a]))
            a, b, d = a[better], b[better], d[better]
            hit = np.unique(a)
            # the held and the new of each query that has any, by distance and id; the first k of each stay
            who = np.concatenate((np.repeat(hit, k), a))
            d, i = np.concatenate((best_d[mine][hit].ravel(), d)), np.concatenate((best_i[mine][hit].ravel(), ids[b]))
            order = np.lexsort((i, d, who))
            who = who[order]
            first = np.searchsorted(who, hit)
            take = order[(first[:, None] + np.arange(k)).ravel()]
            best_d[at + hit], best_i[at + hit] = d[take].reshape(-1, k), i[take].reshape(-1, k)
    return best_d, best_i


def nearest(df: DataFrame, key: str, vector: str, queries: DataFrame, k: int, metric: str = "cosine", block: int = 1024) -> DataFrame:
    """q_id, key, rank, distance: of each query its k nearest rows of df, itself left out; exact. queries: the same columns as df.

    The rows stand in files that all tasks share; a task answers TASK_QUERIES queries at a time, file by file, `block` queries to a product of
    matrices. Only k rows a query are shuffled, not pairs. metric: cosine (1 - similarity) or hamming (unlike signs). Ties go to the smaller key.
    """
    spark = df.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/nearest-{uuid.uuid4().hex}"
    folder = folder if "://" in folder or folder.startswith("file:") else "file://" + folder
    files = stored(numbered(df, key, vector), folder, metric)

    def run(batches):
        for q_ids, q in parts(batches, TASK_QUERIES):
            best_d, best_i = _best(q_ids, prepared(q, metric), files, k, metric, block)
            n, j = np.nonzero(np.isfinite(best_d))
            yield pa.RecordBatch.from_arrays([pa.array(q_ids[n]), pa.array(best_i[n, j]), pa.array(best_d[n, j])], names=["q_id", "id", "distance"])

    out = cut(dealt(numbered(queries, key, vector)).mapInArrow(run, "q_id bigint, id bigint, distance double"))
    delete(spark, folder)
    rank = F.row_number().over(Window.partitionBy("q_id").orderBy("distance", "id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("q_id", F.col("id").alias(key), "rank", "distance")
