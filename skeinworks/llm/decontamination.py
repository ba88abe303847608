"""Benchmark decontamination: rare n-gram seeds join texts to test items, Smith-Waterman alignment scores the pairs.

Words are compared in lower case, without signs at their ends. An item's seeds are its word 3-grams that few texts of the
corpus hold, and of every WINDOW neighbouring 3-grams the rarest: an item that leaked into a third of all texts, whose
3-grams are all frequent, keeps seeds all along. What counts as rare grows with the corpus (RARE_SHARE); that only adds seeds, for
the rarest of a window always count. Texts with a seed meet the items on it, and the whole text is aligned with the whole item
(match +2, mismatch -1, gap -1 a word). The score is the best local alignment over that of a perfect copy; pairs of at
least MIN_SCORE are hits.

Two scans of the texts: the first counts the texts of each seed, the second finds the kept seeds and aligns at once, so no
text is shuffled or written. Items go to the tasks in blocks of ITEM_BYTES of text, a scan for each block.

Items of fewer than three words, null or empty texts and items: no hits. Repeated rows and ids: each row has its hits; repeated
items count once. Empty tables: no hits. Only ids and texts are read, so that no other column can clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import bloom
from ._common import U64, cut, gather, hashes, ngrams, pick, spread, strings, table, words

N, WINDOW, MIN_SCORE = 3, 4, 0.5
#: A seed is rare in at most so many texts, and this share of all texts.
RARE, RARE_SHARE = 20, 1e-5
#: Text of the items that a task holds at once, and of the documents that a step takes at once.
ITEM_BYTES, TEXT_BYTES = 32 << 20, 4 << 20
SIGNS = r"""^[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+|[\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+$"""


def plain_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets by text, and the hash of each word without its case and the signs at its ends; words of signs alone are left out."""
    offsets, codes, distinct = words(texts)
    bare = pc.replace_substring_regex(pc.utf8_lower(distinct), SIGNS, "")
    h, some = hashes(bare), pc.not_equal(bare, "").to_numpy(zero_copy_only=False)
    real = some[codes]
    return np.concatenate(([0], np.cumsum(real)))[offsets], h[codes[real]]


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in gather(batches, size=TEXT_BYTES):
        offsets, h = plain_words(strings(b.column("text")))
        g, start = ngrams(h, offsets, N)
        owner = spread(offsets)[start]
        yield pa.RecordBatch.from_arrays([pa.array(g.view(np.int64)), b.column("item").take(pa.array(owner)), pa.array(start - offsets[owner])], names=["seed", "item", "at"])


def _held(g: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each seed of each text once."""
    order = np.lexsort((g, owner))
    g, owner = g[order], owner[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (owner[1:] != owner[:-1])
    return g[new], owner[new]


def _counter(bits: bytes):
    """seed, texts: how many texts of the task hold each; as many rows at most as the items have seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits, np.uint8)
        seeds, counts = np.empty(0, U64), np.empty(0, np.int64)
        for b in gather(batches, size=TEXT_BYTES):
            offsets, h = plain_words(strings(b.column("text")))
            g, start = ngrams(h, offsets, N)
            hit = bloom.might_hold(held, g)
            g, _ = _held(g[hit], spread(offsets)[start[hit]])
            seeds, back = np.unique(np.concatenate((seeds, g)), return_inverse=True)
            counts = np.bincount(back, np.concatenate((counts, np.ones(len(g), np.int64))), len(seeds)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(counts)], names=["seed", "texts"])

    return run


def smith_waterman(item: np.ndarray, text: np.ndarray, match: int = 2, mismatch: int = -1, gap: int = 1) -> tuple[int, int, int]:
    """Best local score, the end of the alignment in the text (exclusive) and in the item; a row of the matrix at a time, gaps along it by a running maximum."""
    slope = np.arange(len(text) + 1) * gap
    above = np.zeros(len(text) + 1, np.int64)
    best, end, at = 0, 0, 0
    for i, w in enumerate(item):
        row = np.maximum(above - gap, 0)
        row[1:] = np.maximum(row[1:], above[:-1] + np.where(text == w, match, mismatch))
        row = np.maximum.accumulate(row + slope) - slope
        k = int(row.argmax())
        if row[k] > best:
            best, end, at = int(row[k]), k, i + 1
        above = row
    return best, end, at


class _Items:
    """A block of items: their words' hashes and the kept seeds, with the items on each."""

    def __init__(self, rows: pa.Table, kept: pa.Table):
        self.ids = rows.column("item_id").combine_chunks()
        self.offsets, self.words = plain_words(strings(rows.column("text").combine_chunks()))
        key = rows.column("item").to_numpy()
        order = np.argsort(key)
        of = order[np.searchsorted(key[order], kept.column("item").to_numpy())]
        seed = kept.column("seed").to_numpy().view(U64)
        by = np.argsort(seed, kind="stable")
        self.seed, self.of = seed[by], of[by]

    def pairs(self, g: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """text, item of each pair that has a kept seed in common."""
        a, z = np.searchsorted(self.seed, g), np.searchsorted(self.seed, g, side="right")
        many = z - a
        at = np.repeat(a - np.cumsum(many) + many, many) + np.arange(many.sum())
        pair = np.unique(np.repeat(owner, many) * np.int64(len(self.ids)) + self.of[at])
        return pair // len(self.ids), pair % len(self.ids)

    def hits(self, texts: pa.Array, min_score: float) -> tuple[np.ndarray, ...]:
        """text, item, score, end, size of each hit."""
        offsets, h = plain_words(texts)
        g, start = ngrams(h, offsets, N)
        hit = np.isin(g, self.seed)
        text, item = self.pairs(*_held(g[hit], spread(offsets)[start[hit]]))
        score, end = np.zeros(len(text)), np.zeros(len(text), np.int64)
        size = np.diff(self.offsets)[item]
        for i, (t, j) in enumerate(zip(text.tolist(), item.tolist(), strict=True)):
            best, end[i], _ = smith_waterman(self.words[self.offsets[j] : self.offsets[j + 1]], h[offsets[t] : offsets[t + 1]])
            score[i] = best / (2 * max(1, int(size[i])))
        ok = score >= min_score
        return text[ok], item[ok], score[ok], end[ok], size[ok]


def _aligner(items: _Items, min_score: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gather(batches, size=TEXT_BYTES):
            text, item, score, end, size = items.hits(strings(b.column("text")), min_score)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(text)), items.ids.take(pa.array(item)), pa.array(np.round(score, 6)), pa.array(end), pa.array(size)],
                names=["doc_id", "item_id", "score", "end_word", "item_words"],
            )

    return run


def _without(items: _Items, min_score: float, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gather(batches, text_col, TEXT_BYTES):
            clean = np.ones(b.num_rows, bool)
            clean[items.hits(strings(b.column(text_col)), min_score)[0]] = False
            yield b.filter(pa.array(clean))

    return run


def _blocks(texts: DataFrame, items: DataFrame) -> Iterator[_Items]:
    """The items with their kept seeds, ITEM_BYTES of text at a time. texts: text. items: item_id, text."""
    rows = pick(items, item_id="item_id", text="text").where("text IS NOT NULL").dropDuplicates()
    rows = cut(rows.withColumn("item", F.xxhash64(F.coalesce(F.col("item_id").cast("string"), F.lit("")), "text")).dropDuplicates(["item"]))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    seeds = cut(rows.select("item", "text").mapInArrow(_seeds, "seed bigint, item bigint, at bigint"))
    found = texts.mapInArrow(_counter(bloom.build(seeds, "seed")), "seed bigint, texts bigint").groupBy("seed").agg(F.sum("texts").alias("texts"))
    rare = max(RARE, int(RARE_SHARE * texts.count()))
    counted = cut(seeds.join(found, "seed"))
    # a window over the seeds of one item
    near = Window.partitionBy("item").orderBy("at", "seed")
    stretches = counted.withColumn("least", F.min(F.struct("texts", "seed")).over(near.rowsBetween(0, WINDOW - 1)).getField("seed"))
    kept = cut(stretches.where(f"texts <= {rare}").select("seed", "item").union(stretches.select(F.col("least").alias("seed"), "item")).distinct())
    n = max(1, -(-int(size) // ITEM_BYTES))
    for i in range(n):
        part = F.pmod(F.col("item"), F.lit(n)) == i
        # about ITEM_BYTES of text, and at most a seed for each of its words
        yield _Items(rows.where(part).join(kept.select("item").distinct(), "item", "left_semi").toArrow(), kept.where(part).toArrow())


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, item_id, score, end_word (where the passage ends in the text's words), item_words of every hit. items: item_id, text."""
    d = pick(docs, doc_id=id_col, text=text_col)
    schema = f"doc_id {d.schema['doc_id'].dataType.simpleString()}, item_id {items.schema['item_id'].dataType.simpleString()}, score double, end_word bigint, item_words bigint"
    out = None
    for block in _blocks(d.select("text"), items):
        hits = d.mapInArrow(_aligner(block, min_score), schema)
        out = hits if out is None else out.unionAll(hits)
    return out


def op1_seed_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every hit of every document with every item of the benchmark."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """The rows of docs, with all columns, whose text has no hit. A row's text alone decides; null texts stay."""
    for block in _blocks(pick(docs, text=text_col), items):
        docs = docs.mapInArrow(_without(block, min_score, text_col), docs.schema)
    return docs
