"""Byte-level convolutional network in numpy for text quality.

A text's UTF-8 bytes are cut into chunks of CHUNK bytes, each read on for STRIDE bytes into the next one, over the whole
document. Learned byte vectors pass through learned filters of 2 x STRIDE bytes, every STRIDE bytes; each filter's maximum
over a chunk goes through a hidden layer; the chunks' mean gives one probability.

Learning takes at most MAX_TEXTS labelled texts, whole (the rows of smallest hash of the id; a fixed bound of rows, so the
driver's share does not grow), EPOCHS times, or as often as MIN_STEPS batches take where labels are few. Scoring takes every byte
of every text.

Null and empty texts: one chunk of zero bytes, a score like any other. Without labels of both kinds, the score is the
share of label 1 (0.5 without labels). Repeated rows and ids are each scored; a repeated id's labels count as its smallest. An
empty table yields no rows. Only id and text are read to score, and filtering passes all columns on, so that no name can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import gather, pick, strings, table

CHUNK, STRIDE, WIDE, FILTERS, HIDDEN = 256, 4, 8, 32, 16
MAX_TEXTS, EPOCHS, MIN_STEPS, BATCH, RATE = 3000, 5, 400, 64, 0.004
CUT = 0.3
_READ = CHUNK + STRIDE


def chunked(raw: bytes | memoryview, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All chunks of the texts at these places of a buffer, as rows of bytes padded by zeros, and the first chunk of each text (one more at the end)."""
    buf = np.concatenate((np.frombuffer(raw, np.uint8), np.zeros(_READ, np.uint8)))
    many = np.maximum(1, -(-sizes // CHUNK))
    first = np.concatenate(([0], np.cumsum(many)))
    nth = np.arange(first[-1]) - np.repeat(first[:-1], many)
    at = np.repeat(starts, many) + nth * CHUNK
    left = np.repeat(sizes, many) - nth * CHUNK
    rows = np.lib.stride_tricks.sliding_window_view(buf, _READ)[at].copy()
    short = np.flatnonzero(left < _READ)
    rows[short] *= np.arange(_READ) < left[short, None]
    return rows, first


class Net:
    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        f = lambda *s: (r.standard_normal(s) / np.sqrt(s[0])).astype(np.float32)
        self.p = {"emb": f(256, WIDE) * 8, "w1": f(STRIDE * WIDE, FILTERS), "w2": f(STRIDE * WIDE, FILTERS), "b": np.zeros(FILTERS, np.float32), "u": f(FILTERS, HIDDEN), "c": np.zeros(HIDDEN, np.float32), "v": f(HIDDEN), "d": np.zeros(1, np.float32)}
        self.constant: float | None = None

    def pooled(self, rows: np.ndarray, where: bool = False):
        p = self.p
        e = p["emb"][rows].reshape(len(rows), _READ // STRIDE, STRIDE * WIDE)
        x = e[:, :-1].reshape(-1, STRIDE * WIDE) @ p["w1"]
        x += e[:, 1:].reshape(-1, STRIDE * WIDE) @ p["w2"]
        x = x.reshape(len(rows), -1, FILTERS)
        top = x.max(axis=1) + p["b"]
        return (top, x.argmax(axis=1), e) if where else top

    def logits(self, rows: np.ndarray, first: np.ndarray, step: int = 1024) -> np.ndarray:
        p = self.p
        h = np.concatenate([np.maximum(np.maximum(self.pooled(rows[i : i + step]), 0) @ p["u"] + p["c"], 0) @ p["v"] for i in range(0, len(rows), step)])
        return np.add.reduceat(h, first[:-1]) / np.diff(first) + p["d"]

    def scores(self, rows: np.ndarray, first: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(first) - 1, self.constant)
        return 1 / (1 + np.exp(-self.logits(rows, first).astype(np.float64)))

    def gradients(self, rows: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n = self.p, np.diff(first)
        top, arg, e = self.pooled(rows, where=True)
        a = np.maximum(top, 0)
        z = a @ p["u"] + p["c"]
        h = np.maximum(z, 0)
        out = np.add.reduceat(h @ p["v"], first[:-1]) / n + p["d"]
        dz = ((1 / (1 + np.exp(-out)) - y) / len(y)).astype(np.float32)
        each = np.repeat(dz / n, n).astype(np.float32)
        g = {"d": np.array([dz.sum()], np.float32), "v": h.T @ each}
        dh = each[:, None] * p["v"] * (z > 0)
        g["u"], g["c"] = a.T @ dh, dh.sum(0)
        da = (dh @ p["u"].T) * (top > 0)
        g["b"] = da.sum(0)
        k = np.arange(len(rows))[:, None]
        one, two = e[k, arg], e[k, arg + 1]  # chunks x filters x bytes of the window that won
        g["w1"], g["w2"] = np.einsum("kfi,kf->if", one, da), np.einsum("kfi,kf->if", two, da)
        de = np.zeros((256, WIDE), np.float32)
        blocks = rows.reshape(len(rows), -1, STRIDE)
        for part, w in ((blocks[k, arg], p["w1"]), (blocks[k, arg + 1], p["w2"])):
            d = (da[:, :, None] * w.T[None]).reshape(-1, WIDE)
            for j in range(WIDE):
                de[:, j] += np.bincount(part.reshape(-1), d[:, j], 256).astype(np.float32)
        return g | {"emb": de}

    def fit(self, rows: np.ndarray, first: np.ndarray, y: np.ndarray, epochs: int | None = None, seed: int = 7) -> Net:
        epochs = epochs or max(EPOCHS, -(-MIN_STEPS * BATCH // max(1, len(y))))
        if len(set(y.tolist())) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        r = np.random.default_rng(seed)
        self.p["d"][0] = np.log(y.mean() / (1 - y.mean()))
        m, s = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        t = 0
        for epoch in range(epochs):
            rate = RATE * (1 - epoch / epochs)
            order = r.permutation(len(y))
            for i in range(0, len(order), BATCH):
                part = np.sort(order[i : i + BATCH])
                take = np.concatenate([np.arange(first[j], first[j + 1]) for j in part])
                g = self.gradients(rows[take], np.concatenate(([0], np.cumsum(np.diff(first)[part]))), y[part])
                t += 1
                for k, x in self.p.items():
                    m[k] += 0.1 * (g[k] - m[k])
                    s[k] += 0.01 * (g[k] ** 2 - s[k])
                    x -= rate * (m[k] / (1 - 0.9**t)) / (np.sqrt(s[k] / (1 - 0.99**t)) + 1e-7)
        return self


def _rows(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    return chunked(memoryview(data)[at[0] : at[-1]] if data else b"", at[:-1] - at[0], np.diff(at))


def _sampler(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in gather(batches):
        rows, first = _rows(strings(b.column("text")))
        out = [rows[a:z].tobytes() for a, z in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("pick"), pa.array(out, pa.binary()), b.column("label")], names=["pick", "chunks", "label"])


def train(docs: DataFrame, labels: DataFrame) -> Net:
    """docs: doc_id, text. labels: doc_id, label (0 or 1)."""
    known = labels.where("label IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("label").alias("label"))
    # MAX_TEXTS ids at most: that is what may be broadcast
    chosen = known.withColumn("pick", F.xxhash64("doc_id")).orderBy("pick", "doc_id").limit(MAX_TEXTS)
    sample = docs.join(F.broadcast(chosen), "doc_id").select("text", "pick", "label").mapInArrow(_sampler, "pick bigint, chunks binary, label int")
    got = sample.orderBy("pick", "chunks").limit(MAX_TEXTS).collect()
    parts = [np.frombuffer(r.chunks, np.uint8).reshape(-1, _READ) for r in got]
    rows = np.concatenate(parts) if parts else np.zeros((0, _READ), np.uint8)
    first = np.concatenate(([0], np.cumsum([len(x) for x in parts]))).astype(int)
    return Net().fit(rows, first, np.array([r.label for r in got], np.float32))


def _scorer(net: Net, text_col: str, keep_from: float | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gather(batches, text_col, 4 << 20):
            score = net.scores(*_rows(strings(b.column(text_col))))
            if keep_from is None:
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(score)], names=["doc_id", "held_out", "score"])
            else:
                yield b.filter(pa.array(score >= keep_from))

    return run


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(f"`{id_col}`").cast("string")) % 5 == 0, F.lit(False))


def fitted(spark: SparkSession, sf_dir: str) -> Net:
    """The network of a folder's documents and labels; ids whose crc32 is a multiple of 5 are never learned from."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("int").alias("label")).where(~held_out())
    return train(pick(table(spark, sf_dir, "documents"), doc_id="doc_id", text="text"), labels)


def score(docs: DataFrame, net: Net, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("held_out", held_out("doc_id"))
    kind = dict(d.dtypes)["doc_id"]
    return d.mapInArrow(_scorer(net, "text"), f"doc_id {kind}, held_out boolean, score double").withColumn("predicted", F.when(F.col("score") >= CUT, 1).otherwise(0))


def keep_good(docs: DataFrame, net: Net, text_col: str = "text", cut: float = CUT) -> DataFrame:
    """The rows of docs, with all columns, that score at least the cut."""
    return docs.mapInArrow(_scorer(net, text_col, cut), docs.schema)


def op9_byte_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The score of every document by a network learned from labels that are not held out."""
    return score(table(spark, sf_dir, "documents"), fitted(spark, sf_dir))
