"""Token ids of whole texts: each distinct word of a batch is encoded once.

The tokenizer's rules never reach across ASCII white space, which it drops; so a text's ids are those of its words, one
after the other. Nor do they reach from letters into signs behind them: a word of letters and closing signs is two units, and
units of letters alone skip the rules and go to the merges at once, in lower case as far as ASCII goes. Units go to the library
in long strings; those that hold a special token's own name go one by one.
"""

from __future__ import annotations

import functools
import os
import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ._common import words

# a task has one core; the library's own threads would only contend
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

VOCABULARY = "word_bpe_49k.json"
#: Units that a worker remembers, at most, and one batch more.
REMEMBERED = 500_000
#: Signs that may close a word; none of them begins a contraction's rule or a special token's name.
CLOSING = "!\"#$%&()*+,-./:;=?@[]^_`{}~"


@functools.lru_cache(2)
def tokenizer(path: str, literal: bool):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = literal
    return t


@functools.lru_cache(4)
def merger(path: str, ascii_only: bool = False):
    """The tokenizer without its splitting rules: for words of letters only, parted by spaces. ascii_only: lower-case ASCII letters,
    which the normalizers and the names of bytes leave as they are."""
    from tokenizers import Tokenizer, normalizers, pre_tokenizers

    t = Tokenizer.from_file(path)
    spaces = pre_tokenizers.CharDelimiterSplit(" ")
    t.normalizer = None if ascii_only else normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
    t.pre_tokenizer = spaces if ascii_only else pre_tokenizers.Sequence([spaces, pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return t


def _joined(units: pa.Array, ends: np.ndarray) -> pa.Array:
    """The units between the ends as strings, with spaces between them."""
    return pc.binary_join(pa.ListArray.from_arrays(ends.astype(np.int32), units), pa.scalar(" ", pa.large_string()))


def _of_letters(units: pa.Array) -> np.ndarray:
    """Units of letters only that stay so in lower case and in the composed form."""
    alpha = pc.utf8_is_alpha(units).to_numpy(zero_copy_only=False)
    wide = np.flatnonzero(alpha & ~pc.string_is_ascii(units).to_numpy(zero_copy_only=False))
    if len(wide):
        # Arrow's own NFC takes letters apart and leaves them so
        some = units.take(pa.array(wide))
        alpha = alpha.copy()
        whole = _joined(some, np.array([0, len(some)]))[0].as_py()
        if "\u0130" in whole or not unicodedata.is_normalized("NFC", whole):
            alpha[wide] = ["\u0130" not in w and unicodedata.is_normalized("NFC", w) for w in some.to_pylist()]
    return alpha


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _behind(whole: pa.Array, bare: pa.Array, cut: pa.Array) -> pa.Array:
    """What stands in each whole string behind its bare one; empty where it was not cut."""
    size, kept = (pc.binary_length(x).to_numpy(zero_copy_only=False).astype(np.int64) for x in (whole, bare))
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset + 1 : whole.offset + len(whole) + 1]
    many = np.where(cut.to_numpy(zero_copy_only=False), size - kept, 0)
    to = np.cumsum(many)
    at = np.repeat(ends - to, many) + np.arange(to[-1] if len(to) else 0)
    data = np.frombuffer(whole.buffers()[2], np.uint8)[at] if len(at) else np.empty(0, np.uint8)
    return pa.LargeStringArray.from_buffers(len(whole), pa.py_buffer(np.concatenate(([0], to)).astype(np.int64)), pa.py_buffer(data))


class Encoder:
    """literal: names of special tokens in a text are ordinary text, so that no text holds the end's id."""

    def __init__(self, path: str, literal: bool = False, end: str = "<|endoftext|>"):
        self.path, self.literal, self.end = path, literal, end
        self.plain = tokenizer(path, False)
        self.end_id = self.plain.token_to_id(end)
        self.closes = np.array([(self.plain.id_to_token(i) or "").endswith("</w>") for i in range(self.plain.get_vocab_size())])
        self.forget()

    def forget(self) -> None:
        # unit 0 is the empty one, which has no ids; ends has one more than units, in front
        self.known, self.met = pa.array([""], pa.large_string()), np.zeros(1, np.int32)
        self.ids, self.ends = np.empty(0, np.uint32), np.zeros(2, np.int64)

    def _keep_common(self) -> None:
        """Only the units met in more than one batch stay, or none if that does not help."""
        stay = self.met > 1
        stay[0] = True
        if 2 * np.count_nonzero(stay) > REMEMBERED:
            return self.forget()
        sizes = np.diff(self.ends)
        self.ids = self.ids[np.repeat(stay, sizes)]
        self.known, self.met, self.ends = self.known.filter(pa.array(stay)), self.met[stay] >> 1, np.concatenate(([0], np.cumsum(sizes[stay])))

    def _learn(self, new: pa.Array) -> np.ndarray:
        """Adds the units to those known, in the order that comes back."""
        plain = _of_letters(new)
        low = plain & pc.string_is_ascii(new).to_numpy(zero_copy_only=False) & pc.equal(pc.ascii_lower(new), new).to_numpy(zero_copy_only=False)
        order, ids, sizes = [], [self.ids], []
        for which, t in ((low, merger(self.path, True)), (plain & ~low, merger(self.path))):
            at = np.flatnonzero(which)
            for i in range(0, len(at), 100_000):
                part = at[i : i + 100_000]
                cuts = np.append(np.arange(0, len(part), 500), len(part))
                got = t.encode_batch_fast(_joined(new.take(pa.array(part)), cuts).to_pylist(), add_special_tokens=False)
                ids.append(np.concatenate([np.array(e.ids, np.uint32) for e in got]))
                # a word's last piece ends it, which tells the words apart
                ends = np.flatnonzero(self.closes[ids[-1]])
                assert len(ends) == len(part)
                sizes.append(np.diff(ends, prepend=-1))
            order.append(at)
        rest = np.flatnonzero(~plain)
        signs = new.take(pa.array(rest))
        named = pc.match_substring(signs, "<|").to_numpy(zero_copy_only=False)
        even = signs.filter(pa.array(~named)).to_pylist()
        for i in range(0, len(even), 2000):
            part = even[i : i + 2000]
            step = 100
            got = self.plain.encode_batch_fast([self.end.join(part[j : j + step]) + self.end for j in range(0, len(part), step)], add_special_tokens=False)
            all_ids = np.concatenate([np.array(e.ids, np.uint32) for e in got])
            ends = np.flatnonzero(all_ids == self.end_id)
            assert len(ends) == len(part)
            ids.append(np.delete(all_ids, ends))
            sizes.append(np.diff(ends, prepend=-1) - 1)
        odd = signs.filter(pa.array(named)).to_pylist()
        if odd:
            own = tokenizer(self.path, self.literal)
            lists = [own.encode(w, add_special_tokens=False).ids for w in odd]
            ids.append(np.array([i for x in lists for i in x], np.uint32))
            sizes.append(np.array([len(x) for x in lists]))
        order += [rest[~named], rest[named]]
        place = np.concatenate(order)
        self.known = pa.concat_arrays([self.known, new.take(pa.array(place))])
        self.met = np.concatenate((self.met, np.zeros(len(place), np.int32)))
        self.ids, self.ends = np.concatenate(ids), np.concatenate((self.ends, self.ends[-1] + np.cumsum(np.concatenate(sizes))))
        return place

    def _units(self, units: pa.Array) -> np.ndarray:
        """The number of each distinct unit, learned if new."""
        number = pc.fill_null(pc.index_in(units, value_set=self.known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = np.flatnonzero(number < 0)
        if len(new):
            first = len(self.known)
            place = self._learn(units.take(pa.array(new)))
            number[new[place]] = first + np.arange(len(place))
        self.met[number] += 1
        return number

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text's begin (one more at the end)."""
        offsets, codes, distinct = words(texts)
        if not len(codes):
            return np.empty(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        if len(self.known) > REMEMBERED:
            self._keep_common()
        # letters and the signs behind them; any other word is a unit with nothing behind it
        bare = pc.utf8_rtrim(distinct, CLOSING)
        cut = pa.array(_of_letters(bare))
        both = pa.concat_arrays([pc.if_else(cut, pc.ascii_lower(bare), distinct), _behind(distinct, bare, cut)]).dictionary_encode()
        unit = self._units(both.dictionary)[both.indices.to_numpy()].reshape(2, -1).T.reshape(-1)
        # the ids of the distinct words, one after the other; then of all words
        ids, ends = _spans(self.ids, self.ends, unit)
        ids, ends = _spans(ids, ends[::2], codes)
        return ids, ends[offsets]


def _spans(ids: np.ndarray, ends: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the spans asked for, one after the other, and their ends; ends has one more than spans, in front."""
    start, size = ends[which], np.diff(ends)[which]
    to = np.concatenate(([0], np.cumsum(size)))
    return ids[np.repeat(start - to[:-1], size) + np.arange(to[-1])], to


@functools.lru_cache(1)
def remembered(path: str) -> Encoder:
    """The worker's own encoder, which keeps its units from task to task."""
    return Encoder(path)


def with_ends(ids: np.ndarray, offsets: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids with one more after each text, and the new offsets."""
    to = offsets + np.arange(len(offsets))
    out = np.full(to[-1], end, np.uint32)
    inner = np.ones(len(out), bool)
    inner[to[1:] - 1] = False
    out[inner] = ids
    return out, to
