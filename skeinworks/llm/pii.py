"""Personal data: patterns, and information-theoretic sanitisation of the terms that give a protected entity away.

Entities are the values that four patterns find (email, ip, card, phone). Terms are the words anywhere in a text that
mentions one. Over the whole corpus, a term's disclosure of an entity is PMI(entity; term) / IC(entity), with document counts:
log(n(e,t) N / (n(e) n(t))) / log(N / n(e)). It is 1 where the term occurs with that entity only. Terms from DISCLOSURE
on are marked wherever they stand in a text with that entity, and in a rewritten text give way to a general class; patterns give way
to their kind.

Null and empty texts have no spans; repeated rows and ids each have their own. Offsets are code points, ends exclusive.
A corpus of one text, or an entity that all texts hold, discloses nothing (IC 0). Of terms in equal degree all are marked that reach
DISCLOSURE. An empty table yields no rows. Columns of one's own get names that the table lacks.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bloom
from ._common import U64, cut, gather, hashes, pick, spread, strings, table, unused, words
from .decontamination import SIGNS

KINDS = ("email", "ip", "card", "phone")
DISCLOSURE = 0.9
#: Bytes of text that are rewritten at once; bounds a worker's memory.
REWRITE_BYTES = 1 << 20

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_RUN = re.compile(r"[A-Za-z0-9._%+-]+\Z")
#: Digits before the match would start a longer or an equal failing match, so that only starts of runs count; possessive, hence linear.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_LETTER = re.compile(r"[^\W\d_]")
_BARE = re.compile(r"[^\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E](?:.*[^\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E])?", re.S)
_LUHN = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def emails(text: str) -> list[tuple[int, int]]:
    """From each @ outwards: linear in the text, and equal to scanning for the leftmost matches."""
    out, free, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and _LOCAL.match(text[start - 1]):
            start -= 1
        m = _DOMAIN.match(text, at) if start < at else None
        if m:
            out.append((start, m.end()))
            free = m.end()
        at = text.find("@", max(at + 1, free))
    return out


def _luhn(d: str) -> bool:
    return (sum(map(int, d[-1::-2])) + sum(_LUHN[int(x)] for x in d[-2::-2])) % 10 == 0


def find(text: str) -> list[tuple[str, int, int, str]]:
    """kind, start, end, value, by kind and then start."""
    out = [("email", a, b, text[a:b].lower()) for a, b in emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span(), m[0]))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 19 and _luhn(d):
            out.append(("card", *m.span(), d))
    for m in _PHONE.finditer(text):
        if 8 <= len(d := _NOT_DIGIT.sub("", m[0])) <= 15:
            out.append(("phone", *m.span(), d))
    return out


def _terms(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """term, start, end of each word that lies in no span."""
    taken = sorted(spans)
    first = [a for a, _ in taken]
    # spans of different kinds may nest: the largest end so far tells
    reach = np.maximum.accumulate([b for _, b in taken]).tolist() if taken else []
    out, seen = [], {}
    for w in _WORD.finditer(text):
        m = _BARE.search(text, *w.span())
        if m and len(m[0]) > 1 and _LETTER.search(m[0]):
            k = bisect_left(first, m.end())
            if not (k and reach[k - 1] > m.start()):
                if (term := seen.get(m[0])) is None:
                    term = seen[m[0]] = _signed(xxhash.xxh64_intdigest(m[0].lower()))
                out.append((term, m.start(), m.end()))
    return out


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


_SPAN = "struct<kind:string,start:bigint,stop:bigint>"


def _scanner():
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        rid = TaskContext.get().partitionId() << 40
        for b in gather(batches):
            spans, shas, entities, packed = [], [], [], []
            for text in b.column("text").to_pylist():
                found = find(text or "")
                spans.append([{"kind": k, "start": a, "stop": z} for k, a, z, _ in found])
                shas.append(hashlib.sha256(",".join(f"{k}:{a}:{z}" for k, a, z, _ in found).encode()).hexdigest())
                entities.append(sorted({_signed(xxhash.xxh64_intdigest(f"{k}:{v}")) for k, _, _, v in found}))
                packed.append(zlib.compress(text.encode(), 1) if found else None)
            rids = pa.array(np.arange(rid, rid + b.num_rows))
            rid += b.num_rows
            yield pa.RecordBatch.from_arrays(
                [rids, b.column("doc_id"), pa.array(spans, span), pa.array(shas), pa.array(entities, pa.list_(pa.int64())), pa.array(packed, pa.binary())],
                names=["rid", "doc_id", "spans", "sha", "entities", "packed"],
            )

    return run


def _spans_of(b: pa.RecordBatch) -> Iterator[tuple[str, list[tuple[int, int]]]]:
    for packed, found in zip(b.column("packed"), b.column("spans"), strict=True):
        yield zlib.decompress(packed.as_py()).decode(), [(x["start"], x["stop"]) for x in found.as_py()]


def _words_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rid and each distinct term of its text."""
    for b in batches:
        for i, (text, found) in enumerate(_spans_of(b)):
            terms = np.array(sorted({t for t, _, _ in _terms(text, found)}), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(terms), b.column("rid")[i].as_py())), pa.array(terms)], names=["rid", "term"])


def _marker(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """rid and the places of its flagged terms."""
    place = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    for b in batches:
        out = []
        for (text, found), flagged in zip(_spans_of(b), b.column("flagged").to_pylist(), strict=True):
            held = set(flagged)
            out.append([{"start": x, "stop": y} for t, x, y in _terms(text, found) if t in held])
        yield pa.RecordBatch.from_arrays([b.column("rid"), pa.array(out, place)], names=["rid", "extra"])


def _term_counter(bits: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.frombuffer(bits, np.uint8)
        for b in gather(batches):
            offsets, codes, distinct = words(strings(b.column("text")))
            bare = pc.replace_substring_regex(distinct, SIGNS, "")
            h = hashes(pc.cast(pa.array([x.lower() for x in bare.to_pylist()], pa.large_string()), pa.large_string()))
            ok = bloom.might_hold(held, h)[codes]
            owner, t = spread(offsets)[ok], h[codes[ok]]
            order = np.lexsort((owner, t))
            owner, t = owner[order], t[order]
            new = np.ones(len(t), bool)
            new[1:] = (t[1:] != t[:-1]) | (owner[1:] != owner[:-1])
            term, n = np.unique(t[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(term.view(np.int64)), pa.array(n.astype(np.int64))], names=["term", "n"])

    return run


def spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", disclosure: float = DISCLOSURE) -> DataFrame:
    """rid, doc_id, base_sha256, base (pattern spans), extra (spans of disclosing terms) of every row."""
    d = pick(docs, doc_id=id_col, text=text_col)
    kind = dict(d.dtypes)["doc_id"] if "struct" not in dict(d.dtypes)["doc_id"] else d.schema["doc_id"].dataType.simpleString()
    scan = cut(d.mapInArrow(_scanner(), f"rid bigint, doc_id {kind}, spans array<{_SPAN}>, sha string, entities array<bigint>, packed binary"))
    total = scan.count()
    n = F.lit(float(total))
    texts = scan.where("packed IS NOT NULL").select("rid", "spans", "packed")
    bits = bloom.build(texts.mapInArrow(_words_of, "rid bigint, term bigint"), "term")
    term = d.select("text").mapInArrow(_term_counter(bits), "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n_term"))
    own = scan.select("rid", F.explode("entities").alias("entity"))
    entity = own.groupBy("entity").agg(F.count("*").alias("n_entity"))
    content = F.log(n / F.col("n_entity"))
    # n_both is n_entity at most, so that a term of more texts than this discloses no such entity
    bound = F.exp(F.log("n_entity") + content * (1 - disclosure)) * (1 + 1e-9)
    mine = cut(own.join(entity.where(content > 0), "entity").withColumn("bound", bound))
    widest = mine.groupBy("rid").agg(F.max("bound").alias("widest"))
    most = widest.agg(F.max("widest")).first()[0] or 0.0
    rare = cut(texts.mapInArrow(_words_of, "rid bigint, term bigint").join(term.where(F.col("n_term") <= most), "term").join(widest, "rid").where("n_term <= widest").select("rid", "term", "n_term"))
    near = rare.join(mine, "rid").where("n_term <= bound")
    joint = near.groupBy("entity", "term").agg(F.count("*").alias("n_both"), F.first("n_entity").alias("n_entity"), F.first("n_term").alias("n_term"))
    pmi = F.log(F.col("n_both") * n / (F.col("n_entity") * F.greatest("n_term", "n_both")))
    flagged = joint.where(pmi >= content * disclosure - 1e-12).select("entity", "term")
    chosen = near.select("rid", "entity", "term").join(flagged, ["entity", "term"]).groupBy("rid").agg(F.collect_set("term").alias("flagged"))
    marked = texts.join(chosen, "rid").mapInArrow(_marker, "rid bigint, extra array<struct<start:bigint,stop:bigint>>")
    return scan.drop("packed").join(marked, "rid", "left").select(
        "rid", "doc_id", F.col("sha").alias("base_sha256"), F.col("spans").alias("base"),
        F.coalesce(F.transform("extra", lambda x: F.struct(F.lit("term").alias("kind"), x["start"].alias("start"), x["stop"].alias("stop"))), F.array().cast(f"array<{_SPAN}>")).alias("extra"),
    )


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in gather(batches):
        found = [[k for k, _, _, _ in find(text or "")] for text in b.column("text").to_pylist()]
        counts = [pa.array([f.count(k) for f in found], pa.int64()) for k in KINDS]
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), *counts], names=["doc_id", *[f"n_{k}" for k in KINDS]])


def counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone of every row: what the patterns find in whole texts, read once and not shuffled."""
    d = pick(docs, doc_id=id_col, text=text_col)
    return d.mapInArrow(_counter, f"doc_id {d.schema['doc_id'].dataType.simpleString()}, " + ", ".join(f"n_{k} bigint" for k in KINDS))


def op6_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The personal data of every document, and the terms that disclose it."""
    s = spans(table(spark, sf_dir, "documents"))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    text = F.array_join(F.transform(F.concat("base", "extra"), lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")
    return s.select("doc_id", *[count(k) for k in KINDS], "base_sha256", text.alias("spans"), F.size("extra").cast("long").alias("n_term"))


def _rewriter(text_col: str, columns: list[str], count_col: str | None, found_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gather(batches, text_col, REWRITE_BYTES):
            texts = b.column(text_col).to_pylist()
            for i, found in enumerate(b.column(found_col).to_pylist()):
                if found:
                    texts[i] = rewrite(texts[i], [(s["kind"], s["start"], s["stop"]) for s in found])
            cols = {c: b.column(c) for c in columns}
            cols[text_col] = pa.array(texts, b.column(text_col).type)
            if count_col:
                cols[count_col] = pa.array([None if t is None else len(t) for t in texts], b.column(count_col).type)
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=columns)

    return run


def rewrite(text: str, found: list[tuple[str, int, int]]) -> str:
    """Spans give way to their kind; of overlapping spans the first to start, and of these the longest, covers the rest."""
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda s: (s[1], -s[2])):
        if b <= at:
            continue
        if a >= at:
            out += [text[at:a], f"[{kind.upper()}]"]
        at = b
    return "".join([*out, text[at:]])


def sanitise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """docs with all columns and rows, texts rewritten; count_col, if given, gets the new number of code points."""
    key = lambda i, t: F.struct(F.col(f"`{i}`").alias("i"), F.md5(F.coalesce(F.col(f"`{t}`"), F.lit("")).cast("binary")).alias("h"))
    keyed = pick(docs, doc_id=id_col, text=text_col).select(key("doc_id", "text").alias("doc_id"), "text")
    own, other, found_col = unused(docs.columns, "own", "other", "found")
    found = spans(keyed).select(F.col("doc_id").alias(other), F.concat("base", "extra").alias(found_col)).where(F.size(found_col) > 0)
    one = cut(found.groupBy(other).agg(F.first(found_col).alias(found_col)))
    joined = docs.withColumn(own, key(id_col, text_col)).join(one, F.col(own).eqNullSafe(F.col(other)), "left").drop(own, other)
    return joined.mapInArrow(_rewriter(text_col, docs.columns, count_col, found_col), docs.schema)
