"""Token files by an adaptive context-mixing range coder, in independently reset, checksummed blocks.

A block is up to BLOCK ids (fewer in small files, so that a file always has many blocks). Its model starts empty: tables tell
which id last followed the same two ids (order 2), the same id (order 1), each with its confidence, and which id came most often
(order 0). One symbol says which order's prediction is right, or none; its frequencies are the sum of three adaptive
tables, chosen by the confidence of order 2, by that of order 1, and by which of the predictions agree. Without a hit the id's
length in bits follows, by the lengths met so far in the block, then its lower bits. A range coder with a range of 32 to
48 bits and words of 16 codes all that. Every number is an integer below 2**53, so that any machine's doubles hold it exactly.

Numpy steps through up to LANES blocks at once, an id of each at a time; blocks stay independent of each other. The four
frequencies of a table's row stand in one 64-bit integer: rows add as integers, and one product gives the running sums.

File: magic, number of texts, ids of texts (with a mark for null), their numbers of tokens, blocks; then for each block its
number of tokens, of 16-bit words and the crc32 of its ids; then the words. Every part is little-endian; a header crc32 closes
the head. A wrong checksum raises ValueError.

Null and empty texts have the end id alone; null ids come first; repeated ids and rows each have their place (rows of one id in
the order of a hash of their text). An empty table writes no file and reads as no rows. Only id and text are read, so that
no other column can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from ._common import Writer, cut, gather, kept_without, new_folder, open_file, pick, strings, table

BLOCK, LANES = 2048, 8192
#: Places of a block's tables: the highest eight bits of a hash.
SLOTS = 256
MAGIC = b"SKTOK002"
TEXT_BYTES = 24 << 20  # of a file, about; up to 5/4 of it, and a piece
#: Text of which the ids are found at once; bounds a worker's memory.
PIECE_BYTES = 6 << 20
_EVERY = 128
_FULL, _LEAST, _WORD = 2.0**48, 2.0**32, 2.0**16
_STEP, _FIELD, _SUMS, _ONES = np.uint64(24), np.uint64(0xFFFF), np.uint64(0x0001000100010001), np.uint64(0x0001000100010001)
_LOW = np.maximum(np.arange(17) - 1, 0)
_PARTS, _OF_EACH = 2.0**_LOW, 0.5**_LOW
#: The least number of a length.
_LEAST_OF = np.where(np.arange(17) > 0, _PARTS, 0)


def _either(which: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a where true, else b, of 32 bits: faster than np.where."""
    return b ^ ((a ^ b) & np.negative(which.astype(np.uint32)))


class _Model:
    """The state of n blocks; encoder and decoder take the same steps."""

    def __init__(self, n: int, decodes: bool):
        lane = np.arange(n)
        self.base, self.lane4, self.lane8, self.lane17 = lane * SLOTS, lane * 4, lane * 8, lane * 17
        # an entry: the id, and above it the confidence, 0 to 3; in one, above that the number of ids that came to the place, modulo 2**14
        self.two, self.one = np.zeros(n * SLOTS, np.uint32), np.zeros(n * SLOTS, np.uint32)
        self.best, self.most = np.zeros(n, np.uint32), np.zeros(n, np.uint32)
        self.f2, self.f1, self.f0 = np.full(n * 4, _ONES), np.full(n * 4, _ONES), np.full(n * 8, _ONES + np.uint64(4 << 48))
        # the places of the last id and the last two, and what one has at the first
        self.s1, self.s2, self.at1 = self.base.copy(), self.base.copy(), np.zeros(n, np.uint32)
        self.mixed = np.zeros(n, np.uint32)
        self.lengths, self.rows = np.ones((n, 17), np.int64), []
        self.n, self.t, self.decodes = n, 0, decodes

    def predict(self, k: int) -> None:
        """Of the first k lanes: the three predictions, and the frequencies of the four symbols with their running sums."""
        if not self.t & (_EVERY - 1) and self.t:
            for f in (self.f2, self.f1, self.f0):
                np.right_shift(f, np.uint64(1), out=f)
                f &= np.uint64(0x7FFF7FFF7FFF7FFF)
                f |= _ONES
        if not self.t & 63 or self.t in (8, 16, 32):
            self._spread_lengths()
        self.t += 1
        self.e2, self.e1 = self.two.take(self.s2[:k]), self.at1[:k] & np.uint32(0x3FFFF)
        self.a, self.b, self.c = self.e2 & np.uint32(0xFFFF), self.e1 & np.uint32(0xFFFF), self.best[:k]
        agree = (self.a == self.b).view(np.int8) + (self.b == self.c).view(np.int8) * np.int8(2) + (self.a == self.c).view(np.int8) * np.int8(4)
        self.r2, self.r1, self.r0 = self.lane4[:k] + (self.e2 >> np.uint32(16)), self.lane4[:k] + (self.e1 >> np.uint32(16)), self.lane8[:k] + agree
        self.g2, self.g1, self.g0 = self.f2.take(self.r2), self.f1.take(self.r1), self.f0.take(self.r0)
        self.freq = self.g2 + self.g1 + self.g0
        self.sums = self.freq * _SUMS

    def total(self) -> np.ndarray:
        return (self.sums >> np.uint64(48)).astype(np.float64)

    def of(self, field: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbols' frequencies and the sums up to and with them."""
        return ((self.freq >> field) & _FIELD).astype(np.float64), ((self.sums >> field) & _FIELD).astype(np.float64)

    def learn(self, k: int, ids: np.ndarray, field: np.ndarray) -> None:
        """field: where the symbol's frequency stands, in bits."""
        more = _STEP << field
        self.f2[self.r2], self.f1[self.r1], self.f0[self.r0] = self.g2 + more, self.g1 + more, self.g0 + more
        self.two[self.s2[:k]] = self._next(self.e2, self.a, ids)
        self.one[self.s1[:k]] = (self.at1[:k] & np.uint32(0xFFFC0000)) | self._next(self.e1, self.b, ids)
        mixed = ids * np.uint32(2654435761)
        one = self.base[:k] + (mixed >> np.uint32(24))
        self.at1[:k] = self.one.take(one) + np.uint32(1 << 18)
        n = self.at1[:k] >> np.uint32(18)
        self.best[:k] = _either(n > self.most[:k], ids, self.best[:k])
        np.maximum(self.most[:k], n, out=self.most[:k])
        self.s2[:k] = self.base[:k] + ((mixed + (self.mixed[:k] >> np.uint32(5))) * np.uint32(2246822519) >> np.uint32(24))
        self.s1[:k], self.mixed[:k] = one, mixed

    @staticmethod
    def _next(entry: np.ndarray, guess: np.ndarray, ids: np.ndarray) -> np.ndarray:
        sure = np.minimum(entry + np.uint32(1 << 16), guess + np.uint32(3 << 16))
        return _either(guess == ids, sure, _either(entry < 1 << 16, ids, entry - np.uint32(1 << 16)))

    def _spread_lengths(self) -> None:
        """256 parts dealt out by the lengths met so far, one to each at least."""
        if self.rows:
            self.lengths += np.bincount(np.concatenate(self.rows), minlength=self.n * 17).reshape(-1, 17)
            self.rows = []
        f = 1 + self.lengths * 239 // self.lengths.sum(1, keepdims=True)
        top = self.lengths.argmax(1)
        f[np.arange(self.n), top] += 256 - f.sum(1)
        if self.decodes:
            self.length_of = np.repeat(np.tile(np.arange(17, dtype=np.uint8), self.n), f.reshape(-1))
        self.parts = ((np.cumsum(f, axis=1) - f) + (f << 16)).astype(np.uint32).reshape(-1)

    def length_part(self, row: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a length's parts begin; how many there are, divided by how many numbers have it: a power of two, so that nothing is rounded."""
        both = self.parts.take(row)
        return (both & np.uint32(0xFFFF)).astype(np.float64), (both >> np.uint32(16)).astype(np.float64) * _OF_EACH.take(length)

    def learn_length(self, at: np.ndarray) -> None:
        self.rows.append(at)


class _Out:
    """Words in the order of their place in the lane, then of lanes: lanes get on at about the same pace, so that writes stay near each other."""

    def __init__(self, n: int, block: int):
        self.low, self.range = np.zeros(n), np.full(n, _FULL)
        # an id takes at most 14.5 bits for the symbol (3 of 65,535), 8 for the length and 15 more: under 2.5 words
        self.at, self.words, self.carries = np.arange(n), np.empty(n * (block * 5 // 2 + 8), np.uint16), []

    def put(self, lanes: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Puts out a word of each of the lanes; their new low ends."""
        word, at = np.floor(low / _LEAST), self.at.take(lanes)
        self.words[at] = word.astype(np.int32).astype(np.uint16)
        self.carries.append(at[word >= _WORD])  # a 17th bit, which goes up at the end
        self.at[lanes] = at + len(self.at)
        return (low - word * _LEAST) * _WORD

    def close(self) -> list[np.ndarray]:
        n = len(self.at)
        # one word more: with zeros behind it, a number that the last range holds
        self.put(np.arange(n), np.ceil(self.low / _LEAST) * _LEAST)
        carry = np.concatenate(self.carries)
        while len(carry):  # a lane's first word has none
            carry = carry - n
            words = self.words[carry]
            self.words[carry] = words + np.uint16(1)
            carry = carry[words == 0xFFFF]
        many = self.at // n
        words = _turned(self.words[: n * many.max()].reshape(-1, n))
        return [words[i, :k].astype("<u2", copy=False) for i, k in enumerate(many.tolist())]


def _turned(a: np.ndarray) -> np.ndarray:
    """The transpose, in tiles that the cache holds."""
    out = np.empty(a.shape[::-1], a.dtype)
    for i in range(0, a.shape[0], 64):
        for j in range(0, a.shape[1], 128):
            out[j : j + 128, i : i + 64] = a[i : i + 64, j : j + 128].T
    return out


def encode_blocks(ids: np.ndarray, block: int = BLOCK) -> list[np.ndarray]:
    """The 16-bit words of each block of the ids (below 65536), LANES blocks at a time."""
    out = []
    for at in range(0, len(ids), block * LANES):
        out += _encode(ids[at : at + block * LANES], block)
    return out


def _encode(ids: np.ndarray, block: int) -> list[np.ndarray]:
    n = -(-len(ids) // block)
    whole = np.zeros(n * block, np.uint16)
    whole[: len(ids)] = ids
    steps = _turned(whole.reshape(n, block))
    last = len(ids) - (n - 1) * block
    m, out = _Model(n, False), _Out(n, block)
    for t in range(min(block, len(ids))):
        k = n if t < last else n - 1
        x = steps[t, :k].astype(np.uint32)
        m.predict(k)
        symbol = (m.a != x).view(np.uint8) * (np.uint8(1) + (m.b != x).view(np.uint8) * (np.uint8(1) + (m.c != x).view(np.uint8)))
        field = symbol.astype(np.uint64) << np.uint64(4)
        freq, upto = m.of(field)
        r = np.floor(out.range[:k] / m.total())
        out.low[:k] += r * (upto - freq)
        out.range[:k] = r * freq
        # a range of 2**32 holds more than 2**17 after a symbol, so that one word is enough
        short = np.flatnonzero(out.range < _LEAST)
        out.low[short] = out.put(short, out.low.take(short))
        out.range[short] *= _WORD
        miss = np.flatnonzero(symbol == 3)
        if len(miss):
            y = x.take(miss).astype(np.float64)
            length = np.maximum((y.view(np.int64) >> 52) - 1022, 0)  # from the exponent
            row = m.lane17.take(miss) + length
            r = np.floor(out.range.take(miss) / 256)
            part, share = m.length_part(row, length)
            low = out.low.take(miss) + r * part
            r = np.floor(r * share)
            low += r * (y - _LEAST_OF.take(length))
            short = np.flatnonzero(r < _LEAST)
            while len(short):
                low[short] = out.put(miss.take(short), low.take(short))
                wider = r.take(short) * _WORD
                r[short] = wider
                short = short[wider < _LEAST]
            out.low[miss], out.range[miss] = low, r
            m.learn_length(row)
        m.learn(k, x, field)
    return out.close()


def decode_blocks(words_: np.ndarray, lengths: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ids of blocks, all but the last as long as the first, from all their words and how many each has."""
    out, ends = [np.empty(0, np.uint16)], np.concatenate(([0], np.cumsum(lengths)))
    for at in range(0, len(sizes), LANES):
        to = min(at + LANES, len(sizes))
        out.append(_decode(words_[ends[at] : ends[to]], ends[at : to + 1] - ends[at], sizes[at:to]))
    return np.concatenate(out)


def _decode(words_: np.ndarray, ends: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    n, block = len(sizes), int(sizes[0])
    # in the order of the encoder; zeros behind each lane's words, for what is read beyond them
    many = np.diff(ends)
    whole = np.zeros((n, int(many.max()) + 4), np.uint16)
    for i, (a, z) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
        whole[i, : z - a] = words_[a:z]
    words, at = _turned(whole).reshape(-1), np.arange(n)
    code, range_ = np.zeros(n), np.full(n, _FULL)

    def taken(lanes: np.ndarray) -> np.ndarray:
        """The lanes' next words; damaged ones may ask for more than there are."""
        place = at.take(lanes)
        at[lanes] = place + n
        return words.take(place, mode="clip")

    for _ in range(3):
        code = code * _WORD + taken(np.arange(n))
    m, steps = _Model(n, True), np.zeros((block, n), np.uint16)
    for t in range(block):
        k = n if t < sizes[-1] else n - 1
        m.predict(k)
        r = np.floor(range_[:k] / m.total())
        v = (code[:k] / r).astype(np.int64)
        not0, not1, not2 = (v >= (m.sums >> np.uint64(16 * i) & _FIELD).view(np.int64) for i in range(3))
        symbol = not0.view(np.uint8) + not1.view(np.uint8) + not2.view(np.uint8)
        field = symbol.astype(np.uint64) << np.uint64(4)
        freq, upto = m.of(field)
        code[:k] -= r * (upto - freq)
        range_[:k] = r * freq
        short = np.flatnonzero(range_ < _LEAST)
        code[short] = code.take(short) * _WORD + taken(short)
        range_[short] *= _WORD
        x = _either(not0, _either(not1, m.c, m.b), m.a)
        miss = np.flatnonzero(not0 & not1 & not2)
        if len(miss):
            r = np.floor(range_.take(miss) / 256)
            rest = code.take(miss)
            # the masks matter to damaged blocks only, which must not reach into others
            part = (rest / r).astype(np.int64) & 255
            length = m.length_of.take(m.base.take(miss) + part).astype(np.int64)
            row = m.lane17.take(miss) + length
            first, share = m.length_part(row, length)
            rest -= r * first
            r = np.floor(r * share)
            y = np.floor(rest / r)
            rest -= r * y
            short = np.flatnonzero(r < _LEAST)
            for _ in range(2):  # a damaged block may have a range of 0
                rest[short] = rest.take(short) * _WORD + taken(miss.take(short))
                wider = r.take(short) * _WORD
                r[short] = wider
                short = short[wider < _LEAST]
            code[miss], range_[miss] = rest, r
            x[miss] = (y + _LEAST_OF.take(length)).astype(np.int64) & 0xFFFF
            m.learn_length(row)
        steps[t, :k] = x
        m.learn(k, x, field)
    return _turned(steps).reshape(-1)[: int(sizes.sum())]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def block_size(n: int) -> int:
    """The length of the blocks of a file of n ids: small files have shorter blocks, rather than few."""
    return int(min(BLOCK, max(128, n // 1024)))


def pack(doc_ids: list, sizes: np.ndarray, ids: np.ndarray, block: int | None = None) -> bytes:
    """A file's bytes."""
    block = block or block_size(len(ids))
    blocks = encode_blocks(ids, block)
    many = np.array([min(block, len(ids) - i * block) for i in range(len(blocks))], "<u4")
    head = b"".join([
        np.array([len(doc_ids), len(blocks), block], "<i8").tobytes(), np.array([i is None for i in doc_ids], np.uint8).tobytes(), np.array([i or 0 for i in doc_ids], "<i8").tobytes(),
        sizes.astype("<i8").tobytes(), many.tobytes(), np.array([len(w) for w in blocks], "<u4").tobytes(), np.array([crc(ids[i * block : (i + 1) * block]) for i in range(len(blocks))], "<u4").tobytes(),
    ])
    return b"".join([MAGIC, np.array([len(head), zlib.crc32(head)], "<u4").tobytes(), head, *(w.tobytes() for w in blocks)])


def unpack(data: bytes | memoryview) -> tuple[list, np.ndarray, np.ndarray]:
    """doc ids, number of tokens of each, all ids."""
    data = memoryview(data)
    size, check = (int(x) for x in np.frombuffer(data, "<u4", 2, 8))
    head = data[16 : 16 + size]
    if bytes(data[:8]) != MAGIC or zlib.crc32(head) != check:
        raise ValueError("not a token file, or its head is damaged")
    n, k, block = (int(x) for x in np.frombuffer(head, "<i8", 3))
    at, parts = 24, []
    for kind, many in ((np.uint8, n), ("<i8", n), ("<i8", n), ("<u4", k), ("<u4", k), ("<u4", k)):
        parts.append(np.frombuffer(head, kind, many, at))
        at += many * np.dtype(kind).itemsize
    null, doc_ids, sizes, many, lengths, sums = parts
    lengths = lengths.astype(np.int64)
    try:
        with np.errstate(all="ignore"):
            ids = decode_blocks(np.frombuffer(data, "<u2", int(lengths.sum()), 16 + size), lengths, many.astype(np.int64))
    except (IndexError, FloatingPointError) as e:  # words that no encoder writes
        raise ValueError("the blocks are damaged") from e
    for i in range(k):
        if crc(ids[i * block : (i + 1) * block]) != sums[i]:
            raise ValueError(f"block {i} is damaged")
    return [None if z else int(i) for z, i in zip(null, doc_ids, strict=True)], sizes, ids


def _writer(folder: str, path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = tokens.remembered(path), TaskContext.get().partitionId()
        held: list[tuple[list, np.ndarray, np.ndarray]] = []
        text, nth = 0, 0

        def close() -> pa.RecordBatch:
            name = f"ids-{part:06d}-{nth:06d}.bin"
            ids = np.concatenate([x[2] for x in held])
            out = Writer(f"{folder}/{name}")
            out.write(pack([i for x in held for i in x[0]], np.concatenate([x[1] for x in held]), ids))
            out.close()
            return pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(ids)], pa.int64()), pa.array([out.size], pa.int64())], names=["file", "n", "bytes"])

        for b in gather(batches, size=PIECE_BYTES):
            texts = strings(b.column("text"))
            ids, offsets = tokens.with_ends(*encoder.encode(texts), end)
            held.append((b.column("doc_id").to_pylist(), np.diff(offsets), ids.astype(np.uint16)))
            text += texts.nbytes
            if text >= TEXT_BYTES * 5 // 4:  # rather than a small file with what a partition has beyond TEXT_BYTES
                yield close()
                held, text, nth = [], 0, nth + 1
        if held:
            yield close()

    return run


def _reader(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, first in zip(b.column("file").to_pylist(), b.column("first").to_pylist(), strict=True):
                with open_file(f"{folder}/{name}") as f:
                    doc_ids, sizes, ids = unpack(f.read())
                ends = np.cumsum(sizes)
                crcs = [crc(ids[e - n : e]) for e, n in zip(ends.tolist(), sizes.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(first + ends - sizes), pa.array(sizes), pa.array(crcs, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def write(docs: DataFrame, folder: str, path: str | None = None, end: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes token files in ascending order of id; returns file, n (ids), bytes, first (ids of all files before)."""
    from pyspark.sql import Window

    d = pick(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    size = d.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(1, -(-size // TEXT_BYTES))
    d = d.withColumn("tie", F.xxhash64("text")).repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").select("doc_id", "text")
    files = cut(d.mapInArrow(_writer(folder, path or tokens.vocabulary(), end), "file string, n bigint, bytes bigint"))
    # a row for each file of TEXT_BYTES of text
    return files.withColumn("first", F.coalesce(F.sum("n").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))


def read(files: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each text in the files."""
    files = cut(files)
    spread = files.repartition(max(1, files.count()), "file").select("file", "first")
    return spread.mapInArrow(_reader(folder), "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op4_context_range_coder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, written to token files and read back."""
    folder = new_folder(spark, "token-files")
    return kept_without(read(write(table(spark, sf_dir, "documents"), folder), folder), folder)
