"""Interpolated modified Kneser-Ney bigram model, counted in Spark, kept as sorted hash arrays, memory-mapped by workers.

Each task counts the word pairs of its texts and deals them out, packed, by the pair's context. Contexts that make up
HOT_SHARE or more of all tokens (1 / HOT_SHARE at most, whatever the input) are dealt out by their followers too, so that no
bucket grows with one frequent word. A bucket is merged, written as a sorted array of pair hashes and their counts, and
sends on what it knows of words: continuation counts, and for contexts the numbers of followers seen once, twice, more
often. These meet by word and become sorted word arrays. Scoring looks up a batch's distinct words and pairs.

P(w|v) = max(c(vw) - D(c(vw)), 0) / c(v) + g(v) P(w), P(w) from continuation counts in the same way over 1 / (V + 1).
A text is its words, ASCII letters in lower case, then one end; a null text is empty. With no training text, each token
has probability 1. Repeated rows and ids count as often as they stand there. An empty table yields no rows. Only id and text are
read, so that no other column can clash.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import U64, array_file, gather, hashes, join_hash, kept_without, mix, new_folder, pick, strings, table, words, write_file

START, END = U64(0x1234567890ABCDEF), U64(0xFEDCBA0987654321)
HOT_SHARE, SALTS = 1e-4, 16
#: Text bytes for which there is a bucket, and of which a task counts the pairs at once.
BUCKET_BYTES, COUNT_BYTES = 12 << 20, 16 << 20


def _tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all tokens (text by text, an end after each), their offsets by text, the context's code of each, the hash of each code. The last two codes are the end and the start."""
    offsets, codes, distinct = words(pc.ascii_lower(texts))
    k, n = len(distinct), len(offsets) - 1
    where = offsets + np.arange(n + 1)
    out = np.full(where[-1], k, np.int64)
    inner = np.ones(len(out), bool)
    inner[where[1:] - 1] = False
    out[inner] = codes
    before = np.concatenate(([k + 1], out[:-1])) if n else out
    if n:
        before[where[:-1]] = k + 1
    return out, where, before, np.concatenate((hashes(distinct), [END, START]))


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in gather(batches, size=COUNT_BYTES):
        texts = strings(b.column("text"))
        codes, _, before, h = _tokens(texts)
        n = np.bincount(before, minlength=len(h))
        top = n >= HOT_SHARE * len(codes)
        rows = [(0, len(codes)), (1, pc.sum(pc.binary_length(texts)).as_py() or 0)]
        word = np.concatenate((h[top].view(np.int64), [0, 0]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((np.full(top.sum(), 2), [r[0] for r in rows]))), pa.array(word), pa.array(np.concatenate((n[top], [r[1] for r in rows])))],
            names=["kind", "word", "n"],
        )


def _bucket(a: np.ndarray, b: np.ndarray, hot: np.ndarray, n: int) -> np.ndarray:
    at = np.minimum(np.searchsorted(hot, a), max(0, len(hot) - 1))
    salt = np.where(hot[at] == a, mix(b) % U64(SALTS) + U64(1), U64(0)) if len(hot) else np.zeros(len(a), U64)
    return (mix(a + salt * U64(0x9E3779B97F4A7C15)) % U64(n)).astype(np.int64)


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join([np.array([len(arrays), *(len(x) for x in arrays)], np.int64).tobytes(), *(x.tobytes() for x in arrays)])


def _unpack(blob, *types) -> list[np.ndarray]:
    buf = memoryview(blob)
    n = np.frombuffer(buf, np.int64, 1 + len(types))[1:]
    at, out = 8 * (1 + len(types)), []
    for k, t in zip(n, types, strict=True):
        out.append(np.frombuffer(buf, t, k, at))
        at += int(k) * np.dtype(t).itemsize
    return out


def _groups(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate(([True], sorted_[1:] != sorted_[:-1]))) if len(sorted_) else np.empty(0, np.int64)


def _pair_counter(hot: np.ndarray, n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gather(batches, size=COUNT_BYTES):
            codes, _, before, h = _tokens(strings(b.column("text")))
            pair = np.sort(before * len(h) + codes)
            first = _groups(pair)
            many = np.diff(np.append(first, len(pair))).astype(np.uint32)
            x, y = h[pair[first] // len(h)], h[pair[first] % len(h)]
            bucket = _bucket(x, y, hot, n)
            order = np.argsort(bucket, kind="stable")  # pairs of one context stay together
            x, y, many, bucket = x[order], y[order], many[order], bucket[order]
            # only buckets into which something falls: as many blobs as pairs at most, however many buckets there are
            edges = np.append(_groups(bucket), len(bucket))
            for at in range(0, len(edges) - 1, 32):
                blobs = []
                for a, z in zip(edges[at : at + 32], edges[at + 1 : at + 33], strict=False):
                    run_ = _groups(x[a:z])
                    blobs.append(_pack(x[a:z][run_], np.diff(np.append(run_, z - a)).astype(np.uint32), y[a:z], many[a:z]))
                yield pa.RecordBatch.from_arrays([pa.array(bucket[edges[at : at + 32][: len(blobs)]], pa.int32()), pa.array(blobs, pa.binary())], names=["bucket", "blob"])

    return run


def _sums(x: np.ndarray, values: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    order = np.argsort(x, kind="stable")
    first = _groups(x[order])
    return x[order][first], [np.add.reduceat(v[order], first) if len(first) else v[:0] for v in values]


def _slim(x: np.ndarray) -> np.ndarray:
    return x.astype(np.min_scalar_type(int(x.max()) if len(x) else 0))


def _merge_pairs(folder: str, n: int):
    """A bucket's pairs: merged, written, and what they tell of words, by the words' bucket (-1: counts of counts)."""

    def run(t: pa.Table) -> pa.Table:
        parts = [_unpack(x.as_buffer(), U64, np.uint32, U64, np.uint32) for x in t.column("blob")]
        k = t.column("bucket")[0].as_py()
        a = np.concatenate([np.repeat(p[0], p[1]) for p in parts])
        b, many = np.concatenate([p[2] for p in parts]), np.concatenate([p[3] for p in parts]).astype(np.int64)
        del parts
        key = join_hash(a, b)
        order = np.argsort(key, kind="stable")
        key, a, b, many = key[order], a[order], b[order], many[order]
        first = _groups(key)
        many = np.add.reduceat(many, first)
        key, a, b = key[first], a[first], b[first]
        write_file(f"{folder}/pair-{k}.key", [key])
        write_file(f"{folder}/pair-{k}.n", [_slim(many)])
        w, (cont,) = _sums(b, [np.ones(len(b), np.int64)])
        v, (total, n1, n2, n3) = _sums(a, [many, (many == 1).astype(np.int64), (many == 2).astype(np.int64), (many > 2).astype(np.int64)])
        wb, vb = (np.searchsorted(_limits(n), x, side="right") for x in (w, v))  # w and v are sorted, hence their buckets too
        to = np.unique(np.concatenate((wb, vb)))
        at_w, at_v = (np.append(np.searchsorted(x, to), len(x)) for x in (wb, vb))
        blobs = [_pack(np.array([(many == i).sum() for i in (1, 2, 3, 4)], np.int64))]
        for i in range(len(to)):
            s, z = slice(at_w[i], at_w[i + 1]), slice(at_v[i], at_v[i + 1])
            blobs.append(_pack(w[s], cont[s].astype(np.uint32), v[z], total[z], n1[z].astype(np.uint32), n2[z].astype(np.uint32), n3[z].astype(np.uint32)))
        return pa.table({"bucket": pa.array(np.concatenate(([-1], to)), pa.int32()), "blob": pa.array(blobs, pa.binary())})

    return run


def _limits(n: int) -> np.ndarray:
    return (np.arange(1, n, dtype=np.float64) / n * 2.0**64).astype(U64)


_COLUMNS = ("c", "cont", "n1", "n2", "n3")


def _merge_words(folder: str):
    def run(t: pa.Table) -> pa.Table:
        k = t.column("bucket")[0].as_py()
        if k < 0:
            stats = np.sum([_unpack(x.as_buffer(), np.int64)[0] for x in t.column("blob")], axis=0)
            return pa.table({"kind": pa.array(["pairs"]), "stats": pa.array([stats.tolist()], pa.list_(pa.int64()))})
        parts = [_unpack(x.as_buffer(), U64, np.uint32, U64, np.int64, np.uint32, np.uint32, np.uint32) for x in t.column("blob")]
        col = lambda i: np.concatenate([p[i] for p in parts]).astype(np.int64)
        w, v = (np.concatenate([p[i] for p in parts]) for i in (0, 2))
        zero = lambda x: np.zeros(len(x), np.int64)
        values = [np.concatenate((zero(w), col(3))), np.concatenate((col(1), zero(v)))] + [np.concatenate((zero(w), col(i))) for i in (4, 5, 6)]
        word, cols = _sums(np.concatenate((w, v)), values)
        write_file(f"{folder}/word-{k}.key", [word])
        for name, x in zip(_COLUMNS, cols, strict=True):
            write_file(f"{folder}/word-{k}.{name}", [_slim(x)])
        cont = cols[1]
        stats = [*((cont == i).sum() for i in (1, 2, 3, 4)), (cont > 2).sum(), cont.sum(), (word != START).sum()]
        return pa.table({"kind": pa.array(["words"]), "stats": pa.array([[int(x) for x in stats]], pa.list_(pa.int64()))})

    return run


def _discounts(n: list[int]) -> list[float]:
    """Chen and Goodman's, from the numbers of items seen once to four times; a half where these say nothing, and never nothing, so that
    unknown words keep a probability."""
    n = [float(x) for x in n]
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    return [min(i + 1.0, max(0.05, i + 1 - (i + 2) * y * n[i + 1] / n[i])) if n[i] else 0.5 for i in range(3)]


def train(docs: DataFrame, text_col: str = "text") -> dict:
    """Counts the texts of all rows and writes the model; returns what scoring needs to know of it."""
    spark = docs.sparkSession
    d = pick(docs, text=text_col)
    seen = d.mapInArrow(_frequent, "kind bigint, word bigint, n bigint").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    tokens = size = 0
    first = seen.where("kind < 2").collect()
    for r in first:
        tokens, size = (r.n, size) if r.kind == 0 else (tokens, r.n)
    # 1 / HOT_SHARE words at most
    hot = np.sort(np.array([r.word for r in seen.where((F.col("kind") == 2) & (F.col("n") >= HOT_SHARE * tokens)).collect()], np.int64).view(U64))
    n = max(16, -(-size // BUCKET_BYTES))
    folder = new_folder(spark, "kneser-ney")
    model = {"folder": folder, "n": n, "hot": hot, "tokens": tokens, "pairs": [0.0] * 3, "words": [0.0] * 3, "types": 0, "all": 0, "more": 0.0}
    if not tokens:
        return model
    pairs = d.mapInArrow(_pair_counter(hot, n), "bucket int, blob binary")
    merged = pairs.groupBy("bucket").applyInArrow(_merge_pairs(folder, n), "bucket int, blob binary")
    # a row for each of the two kinds
    each = merged.groupBy("bucket").applyInArrow(_merge_words(folder), "kind string, stats array<bigint>")
    sums = each.groupBy("kind").agg(F.array(*[F.coalesce(F.sum(F.get("stats", F.lit(i))), F.lit(0)) for i in range(7)]).alias("stats")).collect()
    stats = {r.kind: r.stats for r in sums}
    words_ = stats["words"]
    model["pairs"] = _discounts(stats["pairs"][:4])
    model["words"] = d_ = _discounts(words_[:4])
    n1, n2, _, _, n3, total, types = (float(x) for x in words_)
    return model | {"types": int(types), "all": total, "more": (d_[0] * n1 + d_[1] * n2 + d_[2] * n3) / total}


@functools.lru_cache(4096)
def _array(uri: str, size: int | None) -> np.ndarray:
    """An array file; size: its length, which tells the type of a slim one."""
    raw = array_file(uri, np.uint8)
    return raw.view(U64) if size is None else raw.view({1: np.uint8, 2: np.uint16, 4: np.uint32, 8: U64}[len(raw) // max(1, size) or 1])


def _look_up(folder: str, kind: str, bucket: np.ndarray, key: np.ndarray, columns: tuple[str, ...]) -> list[np.ndarray]:
    """The columns at the keys (0: not there), bucket by bucket and in the keys' order, so that pages are met once."""
    out = [np.zeros(len(key), np.int64) for _ in columns]
    order = np.lexsort((key, bucket))
    for part in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(order) else []:
        k = bucket[part[0]]
        try:
            there = _array(f"{folder}/{kind}-{k}.key", None)
        except FileNotFoundError:  # a bucket into which nothing fell
            continue
        at = np.searchsorted(there, key[part])
        at[at == len(there)] = 0
        hit = there[at] == key[part]
        for o, c in zip(out, columns, strict=True):
            o[part[hit]] = _array(f"{folder}/{kind}-{k}.{c}", len(there))[at[hit]]
    return out


def _scorer(m: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gather(batches):
            codes, where, before, h = _tokens(strings(b.column("text")))
            if m["tokens"]:
                c, cont, n1, n2, n3 = _look_up(m["folder"], "word", np.searchsorted(_limits(m["n"]), h, side="right"), h, _COLUMNS)
                c[-2] = m["texts"]  # ends, which are no contexts
                pair = before * len(h) + codes
                distinct, back = np.unique(pair, return_inverse=True)
                x, y = distinct // len(h), distinct % len(h)
                (both,) = _look_up(m["folder"], "pair", _bucket(h[x], h[y], m["hot"], m["n"]), join_hash(h[x], h[y]), ("n",))
                d, e = np.array([0.0, *m["pairs"]]), np.array([0.0, *m["words"]])
                low = (np.maximum(cont - e[np.minimum(cont, 3)], 0) / m["all"] + m["more"] / (m["types"] + 1))[y]
                of = np.where(x == len(h) - 2, 0, c[x])
                known = np.maximum(of, 1)
                rest = (d[1] * n1 + d[2] * n2 + d[3] * n3)[x] / known
                p = np.where(of > 0, np.maximum(both - d[np.minimum(both, 3)], 0) / known + rest * low, low)
                score = np.log10(p)[back]
                base = np.log10((c + 1.0) / (m["tokens"] + m["types"] + 1.0))[codes]
                seen = (c > 0)[codes]
            else:
                score, base, seen = (np.zeros(len(codes)) for _ in range(3))
            add = lambda v, kind: np.add.reduceat(v.astype(kind), where[:-1])  # noqa: E731  each text has its end at least
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("held_out"), pa.array(np.diff(where)), pa.array(add(seen, np.int64)), pa.array(np.full(b.num_rows, m["tokens"])), pa.array(add(base, float)), pa.array(add(score, float))],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def score(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10) of every row; the rows for which held_out is false train the model."""
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("held_out", F.coalesce(held_out, F.lit(False)))
    own = d.where("NOT held_out")
    model = train(own)
    model["texts"] = own.count() if model["tokens"] else 0
    kind = dict(d.dtypes)["doc_id"]
    scored = d.mapInArrow(_scorer(model), f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
    return kept_without(scored, model["folder"])


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log-probability of every document by a model of those that are not held out."""
    return score(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens"))
    )
