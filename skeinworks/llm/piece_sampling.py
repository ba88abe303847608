"""Sampled segmentations of SentencePiece vocabularies: Gumbel top-k without replacement by a perturbed A* search.

A text is cut where no piece can reach across (before each run of the space mark), and each distinct unit becomes a lattice of
the vocabulary's pieces, with UTF-8 byte pieces for characters that it lacks. Piece weights follow Zipf's law in the
piece's rank, for BPE model files hold ranks, no probabilities. A backward pass gives every lattice point the exact
log-mass of its completions; that is the A* heuristic. Nodes of the search are sets of whole-text segmentations: a prefix and
the next pieces it may not take. A node's value is the maximum of its members' Gumbel-perturbed log-probabilities, drawn top
down: the child that holds the maximum inherits it, the set of all others draws one truncated at it. Popping
the best node K times yields K distinct segmentations, the K largest perturbed values of all.

inclusion: the probability 1 - exp(-exp(log p - kappa)) that a segmentation is among the K given the threshold kappa,
the next perturbed value; 1 / inclusion weighs an estimate over the samples. Draws depend on the row's key and places alone.

All texts of a batch take each step of the search together; numbers of a text depend on its key and itself alone, not on the
batch. The mass a node leaves aside is summed over its other edges, never taken as 1 - p, so that no branch is lost.

Null and empty texts: one segmentation without pieces. A text with fewer than K segmentations yields all of them, inclusion 1.
Repeated rows and ids yield the same samples again, null ids share the key of an empty id. An empty table yields no rows. Only id and
text are read, so that no other column can clash.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ._common import U64, gather, join_hash, mix, pick, strings, table, uniform

MODEL, K = "piece_bpe_32k.model", 2
MARK = "▁"
#: Bytes of text of which all lattices are held at once.
BATCH_BYTES = 1 << 20
#: Units of which all paths are held at once.
PATH_UNITS = 1 << 15
_RANK_SHIFT = 10.0


class Vocabulary:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.pieces = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        real = [i for i in range(len(self.pieces)) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(len(self.pieces)) if sp.is_byte(i)}
        self.byte = np.array([self.bytes.get(b, sp.unk_id()) for b in range(256)])
        self.raw = [p.replace(MARK, " ").encode() for p in self.pieces]
        for b, i in self.bytes.items():
            self.raw[i] = bytes([b])
        weight = -np.log(np.arange(len(real)) + _RANK_SHIFT)
        weight -= np.log(np.exp(weight).sum())
        self.weight = np.full(len(self.pieces) + 1, weight.min() - 10)
        self.weight[real] = weight
        step, self.ends = {}, [-1]
        for i in real:
            at = 0
            for c in map(ord, self.pieces[i]):
                key = at << 21 | c
                if key not in step:
                    step[key] = len(self.ends)
                    self.ends.append(-1)
                at = step[key]
            self.ends[at] = i
        self.ends = np.array(self.ends)
        keys, to = np.array(list(step), np.int64), np.array(list(step.values()))
        bits = max(4, int(len(keys) * 3).bit_length())
        self.shift, self.mask = U64(64 - bits), (1 << bits) - 1
        self.keys, self.to = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int64)
        at = self._slot(keys)
        while len(keys):  # each free slot takes one of those that ask for it, the others ask for the next
            free = self.keys[at] < 0
            slot, first = np.unique(at[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[slot], self.to[slot] = keys[won], to[won]
            rest = np.delete(np.arange(len(keys)), won)
            keys, to, at = keys[rest], to[rest], (at[rest] + 1) & self.mask
        size = np.array([len(r) for r in self.raw])
        self.raw_size, self.raw_at = size, np.cumsum(size) - size
        self.raw_bytes = np.frombuffer(b"".join(self.raw), np.uint8)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.astype(U64) * U64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def next(self, state: np.ndarray, chars: np.ndarray) -> np.ndarray:
        """The trie's node behind each of these on each character, or -1."""
        key = state << 21 | chars
        at = self._slot(key)
        there = self.keys[at]
        out = np.where(there == key, self.to[at], -1)
        more = np.flatnonzero((there != key) & (there >= 0))
        while len(more):
            at[more] = (at[more] + 1) & self.mask
            there = self.keys[at[more]]
            hit = there == key[more]
            out[more[hit]] = self.to[at[more[hit]]]
            more = more[~hit & (there >= 0)]
        return out

    def expand(self, ids: np.ndarray, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids, those of -1 as the byte pieces of their characters; how many each has become."""
        many = np.ones(len(ids), np.int64)
        lone = np.flatnonzero(ids < 0)
        if not len(lone):
            return ids, many
        c = chars[lone]
        many[lone] = size = 1 + (c > 0x7F) + (c > 0x7FF) + (c > 0xFFFF)
        out = np.repeat(ids, many)
        start = (np.cumsum(many) - many)[lone]
        for nth in range(4):
            on = size > nth
            part = c[on] >> 6 * (size[on] - 1 - nth)
            head = np.array([0, 0, 0xC0, 0xE0, 0xF0])[size[on]] | part
            out[start[on] + nth] = self.byte[head if nth == 0 else 0x80 | part & 0x3F]
        return out, many

    def decode(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of the ids, space for each mark."""
        return self.raw_bytes[_ranges(self.raw_at[ids], self.raw_size[ids])]


def _ranges(start: np.ndarray, many: np.ndarray) -> np.ndarray:
    """All places of stretches that start there and are so long, one after the other."""
    ends = np.cumsum(many)
    return np.repeat(start - ends + many, many) + np.arange(ends[-1] if len(ends) else 0)


def _running(values: np.ndarray, first: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Running sums in each stretch, by its own numbers alone."""
    out = np.zeros(len(values))
    sums, live = np.zeros(len(first)), np.arange(len(first))
    for n in range(int(many.max()) if len(many) else 0):
        live = live[many[live] > n]
        at = first[live] + n
        sums[live] += values[at]
        out[at] = sums[live]
    return out


@functools.lru_cache(2)
def vocabulary(path: str | None = None) -> Vocabulary:
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    return Vocabulary(path)


def units(text: str) -> list[str]:
    """The marked text, cut before each run of marks. (A mark that the text holds itself counts as a space, as the library has it.)"""
    if not text:
        return []
    parts = (MARK + text.replace(" ", MARK)).split(MARK)[1:]
    out, held = [], 1
    for p in parts:
        if p:
            out.append(MARK * held + p)
            held = 1
        else:
            held += 1
    if held > 1:
        out.append(MARK * (held - 1))
    return out


class Lattice:
    """The lattices of distinct units: nodes are places in units, edges pieces with the probability of taking each there.

    Node 0 is the end of all units; the others come in order of their distance from the end, so that the backward pass takes them
    slice by slice. Edges are sorted by their node.
    """

    def __init__(self, words: list[str], v: Vocabulary):
        size = np.fromiter(map(len, words), np.int64, len(words))
        chars = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        start = np.cumsum(size) - size
        stop = np.repeat(start + size, size)
        left = stop - np.arange(len(chars))
        by = np.argsort(left.astype(np.uint16) if len(left) and left.max() < 1 << 16 else left, kind="stable")
        node_of = np.empty(len(chars), np.int64)
        node_of[by] = np.arange(1, len(chars) + 1)
        levels = 1 + np.searchsorted(left[by], np.arange(1, (int(left.max()) if len(left) else 0) + 2))
        self.root = node_of[start]
        found, many = [], np.zeros(len(chars), np.int64)
        p, state = np.arange(len(chars)), np.zeros(len(chars), np.int64)
        n = 0
        while len(p):
            state = v.next(state, chars[p + n])
            ok = state >= 0
            p, state = p[ok], state[ok]
            n += 1
            piece = v.ends[state]
            hit = piece >= 0
            at = p[hit]
            found.append((at, many[at], piece[hit], n))
            many[at] += 1
            if n == 1:
                lone = np.ones(len(chars), bool)
                lone[at] = False
                lone = np.flatnonzero(lone)
                found.append((lone, many[lone], np.full(len(lone), -1), 1))
                many[lone] += 1
            more = n < left[p]
            p, state = p[more], state[more]
        # an edge's place is its node's first and how many pieces were found there before
        count = many[by]
        self.first = np.concatenate(([0, 0], np.cumsum(count)))
        first = self.first[node_of]
        self.ids, length = np.empty(self.first[-1], np.int32), np.empty(self.first[-1], np.int32)
        for at, before, piece, n in found:
            place = first[at] + before
            self.ids[place], length[place] = piece, n
        del found, first
        self.node = np.repeat(np.arange(1, len(chars) + 1, dtype=np.int32), count)
        self.char = np.repeat(chars[by].astype(np.int32), count)
        self.to = np.where(length < np.repeat(left[by], count), node_of[np.minimum(np.repeat(by, count) + length, max(0, len(chars) - 1))], 0).astype(np.int32) if len(length) else length
        many_of = np.diff(self.first)
        self.x, self.p = np.empty(len(length)), np.empty(len(length))
        self.others, self.total = np.ones(len(chars) + 1), np.ones(len(chars) + 1)
        value, beta = v.weight[self.ids], np.zeros(len(chars) + 1)
        for a, b in zip(levels[:-1], levels[1:], strict=True):
            if a == b:
                continue
            lo, hi = self.first[a], self.first[b]
            many, at = many_of[a:b], self.first[a:b] - lo
            x = value[lo:hi] + beta[self.to[lo:hi]]
            top, of = np.maximum.reduceat(x, at), np.repeat(np.arange(b - a), many)
            x -= top[of]
            mass = np.exp(x)
            # what all but the likeliest edge hold is summed up apart: 1 - p would lose it
            best = np.flatnonzero(x == 0)
            ones, apart = np.bincount(of[best], minlength=b - a), mass.copy()
            apart[best] = 0
            others = np.add.reduceat(apart, at)
            total = others + ones
            beta[a:b] = top + np.log(total)
            self.others[a:b], self.total[a:b] = others, total
            self.x[lo:hi], self.p[lo:hi] = x, mass / total[of]

    def logs(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The log-probabilities of taking each of these edges, and of taking another one there."""
        node, x = self.node[edges], self.x[edges]
        others, total = self.others[node], self.total[node]
        with np.errstate(divide="ignore"):
            return x - np.log(total), np.log(np.where((x == 0) & (total - others < 1.5), others / total, 1 - self.p[edges]))

    def walk(self, nodes: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From each node to its unit's end, all at once: the edges, one walk after the other, and where each begins (one more at the end)."""
        live, at, rounds = np.arange(len(nodes)), nodes.copy(), []
        many = np.zeros(len(nodes), np.int64)
        on = at > 0
        live, at = live[on], at[on]
        while len(live):
            u = uniform(mix(seeds[live] + U64((len(rounds) + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)))
            edge, last = self.first[at], self.first[at + 1] - 1
            p = self.p[edge]
            look = np.flatnonzero((u > p) & (edge < last))
            while len(look):
                u[look] -= p[look]
                edge[look] += 1
                p[look] = self.p[edge[look]]
                look = look[(u[look] > p[look]) & (edge[look] < last[look])]
            rounds.append((live, edge))
            many[live] += 1
            at = self.to[edge]
            on = at > 0
            live, at = live[on], at[on]
        begin = np.concatenate(([0], np.cumsum(many)))
        out = np.empty(begin[-1], np.int64)
        for i, (who, edge) in enumerate(rounds):
            out[begin[who] + i] = edge
        return out, begin


def _truncated(log_mass: np.ndarray, u: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Gumbel values of sets of these log-masses, given that they are at most `most`."""
    with np.errstate(divide="ignore", over="ignore", invalid="ignore"):
        out = -np.logaddexp(-most, np.log(-np.log(u)) - log_mass)
    return np.where(np.isneginf(log_mass), -np.inf, out)


class _Paths:
    """One segmentation of each of some texts: edges, text after text, and the values of the sets they leave aside."""

    def __init__(self, lat: Lattice, edges: np.ndarray, sizes: np.ndarray, unit: np.ndarray, value: np.ndarray, seeds: np.ndarray, nth: int, own: np.ndarray):
        """sizes: edges of each text; unit: to which of its text's units an edge belongs; own: the step from which on sets are the path's own."""
        self.edges, self.sizes, self.unit, self.value = edges, sizes, unit, value
        self.begin = np.concatenate(([0], np.cumsum(sizes)))
        logp, log_rest = lat.logs(edges)
        done = np.empty(len(edges))
        bounds = self.begin.tolist()
        for a, z in zip(bounds[:-1], bounds[1:], strict=True):  # sums of a text's own numbers, whatever stands before it
            np.cumsum(logp[a:z], out=done[a:z])
        some = sizes > 0
        self.logp = np.zeros(len(sizes))
        self.logp[some] = done[self.begin[1:][some] - 1]
        self.before = done - logp
        step = np.arange(len(edges)) - np.repeat(self.begin[:-1], sizes)
        at = np.flatnonzero(step >= np.repeat(own, sizes))
        u = uniform(mix(np.repeat(join_hash(seeds, np.full(1, nth + 1, U64)), sizes)[at] + (step[at] + 1).astype(U64) * U64(0xD1342543DE82EF95)))
        self.g = np.full(len(edges), -np.inf)
        self.g[at] = _truncated(self.before[at] + log_rest[at], u, np.repeat(value, sizes)[at])

    def best(self) -> tuple[np.ndarray, np.ndarray]:
        """The largest value of each text's sets, and at which step."""
        top, step = np.full(len(self.sizes), -np.inf), np.zeros(len(self.sizes), np.int64)
        some = np.flatnonzero(self.sizes)
        if len(some):
            top[some] = np.maximum.reduceat(self.g, self.begin[some])
            place = np.where(self.g == np.repeat(top, self.sizes), np.arange(len(self.g)), len(self.g))
            step[some] = np.minimum.reduceat(place, self.begin[some]) - self.begin[some]
        return top, step


def _put(out: np.ndarray, to: np.ndarray, source: np.ndarray, start: np.ndarray, many: np.ndarray) -> None:
    out[_ranges(to, many)] = source[_ranges(start, many)]


def top_k(lat: Lattice, codes: np.ndarray, ends: np.ndarray, keys: np.ndarray, k: int) -> tuple[list[_Paths], list[np.ndarray], np.ndarray]:
    """The segmentations of texts, best first: of each rank the paths and the texts that have one; and the threshold of each text.
    codes: the units of all texts. ends: where each text's units begin (one more at the end)."""
    n, texts, seeds = len(ends) - 1, np.arange(len(ends) - 1), mix(keys)
    nth = np.arange(ends[-1]) - np.repeat(ends[:-1], np.diff(ends))
    own = join_hash(np.repeat(keys, np.diff(ends)), nth.astype(U64))
    fresh = lambda at, j: lat.walk(lat.root[codes[at]], mix(own[at] + U64(j * 0xA24BAED4963EE407 & (1 << 64) - 1)))  # noqa: E731  walks of these units
    value = -np.log(-np.log(uniform(mix(seeds ^ U64(0xABCDEF)))))
    edges, begin = fresh(slice(None), 0)
    paths = [_Paths(lat, edges, np.diff(begin[ends]), np.repeat(nth, np.diff(begin)), value, seeds, 0, np.zeros(n, np.int64))]
    members, row = [texts], [texts]  # of a rank: its texts, and the row of each text in it (-1: none)
    taken: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []  # of each pop and text: path, step, edge
    while True:
        tops = np.full((len(paths), n), -np.inf)
        steps = np.zeros((len(paths), n), np.int64)
        for q, p in enumerate(paths):
            tops[q, members[q]], steps[q, members[q]] = p.best()
        of = tops.argmax(0)
        value, step = tops[of, texts], steps[of, texts]
        r = len(paths)
        on = np.flatnonzero(value > -np.inf)
        if r == k or not len(on):
            return paths, members, value
        of_on, step_on = of[on], step[on]
        at = np.empty(len(on), np.int64)
        edge, unit, before = np.empty(len(on), np.int64), np.empty(len(on), np.int64), np.empty(len(on))
        for q, p in enumerate(paths):
            mine = np.flatnonzero(of_on == q)
            at[mine] = p.begin[row[q][on[mine]]] + step_on[mine]
            edge[mine], unit[mine], before[mine] = p.edges[at[mine]], p.unit[at[mine]], p.before[at[mine]]
        node = lat.node[edge]
        first, many = lat.first[node], lat.first[node + 1] - lat.first[node]
        cand = _ranges(first, many)
        start = np.cumsum(many) - many
        p = lat.p[cand].copy()
        p[cand == np.repeat(edge, many)] = 0
        for was_of, was_step, was_edge in taken:
            same = np.where((was_of[on] == of_on) & (was_step[on] == step_on), was_edge[on], -1)
            p[cand == np.repeat(same, many)] = 0
        s = seeds[on]
        u1, u2 = (uniform(mix((s ^ U64(x)) + U64(1000003 * r) + step_on.astype(U64))) for x in (0, 0x77))
        run = _running(p, start, many)
        total = run[start + many - 1]
        drawn = np.add.reduceat(run < np.repeat(u1 * total, many), start)
        # rounding may put the draw behind all: then the last that is left
        last = np.maximum.reduceat(np.where(p > 0, np.arange(len(p)), -1), start) - start
        drawn = np.minimum(drawn, last)
        new = first + drawn
        p[start + drawn] = 0
        left = np.add.reduceat(p, start)
        with np.errstate(divide="ignore"):
            rest_value = _truncated(before + np.log(left), u2, value[on])
        for q, p_ in enumerate(paths):
            mine = np.flatnonzero(of_on == q)
            p_.g[at[mine]] = rest_value[mine]
        taken.append(tuple(_scatter(n, on, x, -1) for x in (of_on, step_on, new)))
        rest, rest_begin = lat.walk(lat.to[new], mix(s + step_on.astype(U64)) ^ U64(r))
        n_rest = np.diff(rest_begin)
        # only units behind the one that changes are walked again
        behind = ends[on + 1] - ends[on] - unit - 1
        again = _ranges(ends[on] + unit + 1, behind)
        tail, tail_begin = fresh(again, r)
        cuts = tail_begin[np.concatenate(([0], np.cumsum(behind)))]
        sizes = step_on + 1 + n_rest + np.diff(cuts)
        to = np.cumsum(sizes) - sizes
        out, units_ = np.empty(int(sizes.sum()), np.int64), np.empty(int(sizes.sum()), np.int64)
        for q, p_ in enumerate(paths):
            mine = np.flatnonzero(of_on == q)
            head = p_.begin[row[q][on[mine]]]
            _put(out, to[mine], p_.edges, head, step_on[mine])
            _put(units_, to[mine], p_.unit, head, step_on[mine])
        out[to + step_on], units_[to + step_on] = new, unit
        _put(out, to + step_on + 1, rest, rest_begin[:-1], n_rest)
        units_[_ranges(to + step_on + 1, n_rest)] = np.repeat(unit, n_rest)
        after = to + step_on + 1 + n_rest
        place = _ranges(after, np.diff(cuts))
        out[place], units_[place] = tail, np.repeat(nth[again], np.diff(tail_begin))
        paths.append(_Paths(lat, out, sizes, units_, value[on], s, r, step_on + 1))
        members.append(on)
        row.append(_scatter(n, on, np.arange(len(on)), -1))


def _scatter(n: int, at: np.ndarray, values: np.ndarray, fill: int) -> np.ndarray:
    out = np.full(n, fill, np.int64)
    out[at] = values
    return out


def _coded(column: pa.Array) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The code of each unit, where each text's begin (one more at the end), the distinct units."""
    lists = pc.split_pattern(column, " ")
    flat = lists.flatten().dictionary_encode()
    codes, ends = flat.indices.to_numpy().astype(np.int64), lists.offsets.to_numpy().astype(np.int64)
    ends = ends - ends[0]
    distinct = [MARK + w for w in flat.dictionary.to_numpy(zero_copy_only=False)]
    # runs of spaces, spaces at an end and marks make other units
    empty = pc.equal(flat.dictionary, "").to_numpy(zero_copy_only=False)
    odd = set((np.searchsorted(ends, np.flatnonzero(empty[codes]), side="right") - 1).tolist()) | set(np.flatnonzero(pc.match_substring(column, MARK).to_numpy(zero_copy_only=False)).tolist())
    if odd:
        known = {w: i for i, w in enumerate(distinct)}
        parts, sizes = [], np.diff(ends)
        last = 0
        for i in sorted(odd):
            parts.append(codes[ends[last] : ends[i]])
            own = [known.setdefault(w, len(known)) for w in units(column[i].as_py())]
            parts.append(np.array(own, np.int64))
            sizes[i], last = len(own), i + 1
        parts.append(codes[ends[last] :])
        codes, ends, distinct = np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes))), list(known)
    return codes, ends, distinct


def _sampler(path: str | None, k: int, keep: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        for b in gather(batches, size=BATCH_BYTES):
            column = strings(b.column("text"))
            codes, ends, distinct = _coded(column)
            lat = Lattice(distinct, v)
            keys = b.column("key").to_numpy().view(U64)
            marked = pc.replace_substring(column, MARK, " ")
            space, nothing = (pa.scalar(x, pa.large_string()) for x in (" ", ""))
            marked = pc.if_else(pc.equal(marked, ""), marked, pc.binary_join_element_wise(space, marked, nothing))
            # lattices of many texts, paths of a few at a time
            at = 0
            while at < b.num_rows:
                to = max(at + 1, int(np.searchsorted(ends, ends[at] + PATH_UNITS, side="right")) - 1)
                paths, members, kappa = top_k(lat, codes[ends[at] : ends[to]], ends[at : to + 1] - ends[at], keys[at:to], k)
                for rank, (p, of) in enumerate(zip(paths, members, strict=True)):
                    yield _rows(v, lat, p, rank, pa.array(of), kappa[of], b.column("doc_id").slice(at, to - at), marked.slice(at, to - at), keep)
                at = to

    return run


def _rows(v: Vocabulary, lat: Lattice, p: _Paths, rank: int, of: pa.Array, kappa: np.ndarray, doc_id: pa.Array, texts: pa.Array, keep: bool) -> pa.RecordBatch:
    ids, many = v.expand(lat.ids[p.edges].astype(np.int64), lat.char[p.edges].astype(np.int64))
    ends = np.concatenate(([0], np.cumsum(many)))[p.begin]
    raw, bounds = memoryview(ids.astype("<u4").tobytes()), (4 * ends).tolist()
    crcs = [zlib.crc32(raw[a:z]) for a, z in zip(bounds[:-1], bounds[1:], strict=True)]
    # the ids' bytes, text by text, against the texts'
    got, got_ends = v.decode(ids), np.concatenate(([0], np.cumsum(v.raw_size[ids])))[ends].tolist()
    want = texts.take(of).cast(pa.large_binary()).to_pylist()
    flat = memoryview(got.tobytes())
    good = [flat[a:z] == w for a, z, w in zip(got_ends[:-1], got_ends[1:], want, strict=True)]
    inclusion = np.where(np.isneginf(kappa), 1.0, -np.expm1(-np.exp(np.minimum(50.0, p.logp - kappa))))
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())) if keep else pa.nulls(len(of), pa.list_(pa.int32()))
    return pa.RecordBatch.from_arrays(
        [doc_id.take(of), pa.array(np.full(len(of), rank), pa.int32()), pa.array(np.diff(ends)), pa.array(crcs, pa.int64()), pa.array(np.round(p.logp, 9)), pa.array(p.value), pa.array(inclusion), pa.array(good, pa.bool_()), lists],
        names=["doc_id", "sample", "n_pieces", "ids_crc32", "log_prob", "perturbed", "inclusion", "decodes", "ids"],
    )


def sample(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, keep_ids: bool = True) -> DataFrame:
    """doc_id, sample (0: the largest), n_pieces, ids_crc32, log_prob, perturbed, inclusion, decodes (the ids give the text back), ids."""
    from pyspark.sql import functions as F

    d = pick(docs, doc_id=id_col, text=text_col).withColumn("key", F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    return d.mapInArrow(_sampler(path, k, keep_ids), f"doc_id {dict(d.dtypes)['doc_id']}, sample int, n_pieces bigint, ids_crc32 bigint, log_prob double, perturbed double, inclusion double, decodes boolean, ids array<int>")


def op7_gumbel_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K sampled segmentations of every document: their ids, and digests of them."""
    return sample(table(spark, sf_dir, "documents"))
