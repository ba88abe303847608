"""Near-duplicate classes: DartMinHash signatures, banded joining, exact verification.

DartMinHash (Christiani): every weighted element spans the region [0, weight) x [0, infinity) of a plane in which
hashed darts fall with unit intensity. The plane is cut into dyadic cells; a hash gives each cell its number of darts
(Poisson), and each dart its place and its coordinate. A text keeps, for each of T coordinates, the dart of lowest rank;
two texts agree in a coordinate with the probability of their weighted Jaccard similarity. About T ln T + 2 T darts fall
for a text, however many elements it has.

Elements are the distinct word 5-shingles (weight 1), or with weights="count" weighted by how often they occur.
Bands of equal signature parts give candidates. Nodes that hang together by candidates form a group, and all pairs of a group are
compared by their exact similarity, large groups block by block (see links). The work grows with the square of a group's size, the
rows with that over the size of a block. A class is a connected component of links; equal texts (by a 64-bit hash) are one node from
the start. At similarity 0.8, 36 bands of 6 miss a pair with probability 2e-5, unless other texts hold it together.

Null texts count as empty; empty texts are equal to each other and near to nothing else; texts of one to four words have
one shingle. Repeated rows and ids are each returned; an empty table yields no rows. Only id and text are read, and rows that are
kept stay whole, so that no other column can clash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import U64, Scratch, cut, gather, hashes, join_hash, mix, ngrams, pick, spread, strings, table, uniform, words

SHINGLE, BANDS, ROWS, SIMILARITY = 5, 36, 6, 0.8
#: A block of a large group holds about so many nodes and elements at most; that bounds a task's memory.
NODES, WEIGHT = 1500, 1 << 20
RARE = 16
_STEP = U64(0x9E3779B97F4A7C15)
_TABLES: dict[int, np.ndarray] = {}


def _poisson(u: np.ndarray, log_mean: int) -> np.ndarray:
    """Poisson numbers of mean 2**log_mean from uniform ones."""
    if log_mean not in _TABLES:
        mean = 2.0**log_mean
        k = np.arange(int(mean + 12 * math.sqrt(mean) + 30))
        logs = -mean + k * math.log(mean) - np.concatenate(([0.0], np.cumsum(np.log(np.maximum(k[1:], 1)))))
        _TABLES[log_mean] = np.cumsum(np.exp(logs))
    return np.searchsorted(_TABLES[log_mean], u)


def dart_minhash(elements: np.ndarray, owner: np.ndarray, weight: np.ndarray, n: int, t: int) -> np.ndarray:
    """n signatures of t coordinates. Elements of a text must be distinct; a text without weight gets zeros."""
    sig, best = np.zeros(n * t, U64), np.full(n * t, np.inf)
    total = np.bincount(owner, weight, n)
    reach = np.where(total > 0, (math.log(t) + 2) * t / np.maximum(total, 1e-300), 0.0)
    todo = total > 0
    while todo.any():
        best.reshape(n, t)[todo] = np.inf
        live = todo[owner] & (weight > 0)
        e, o, x = elements[live], owner[live], weight[live]
        r = reach[o]
        for nu in range(max(1, math.ceil(math.log2(x.max() + 1)))):
            for rho in range(max(1, math.ceil(math.log2(r.max() + 1)))):
                hit = np.flatnonzero((x > 2.0**nu - 1) & (r > 2.0**rho - 1))
                if not len(hit):
                    continue
                seed = join_hash(e[hit], np.full(1, nu * 64 + rho, U64))
                many = _poisson(uniform(mix(seed)), nu + rho)
                at = np.repeat(np.arange(len(hit)), many)
                if not len(at):
                    continue
                nth = np.arange(len(at)) - np.repeat(np.cumsum(many) - many, many)
                dart = mix(seed[at] + (nth + 1).astype(U64) * _STEP)
                of = hit[at]
                rank = 2.0**rho - 1 + 2.0**rho * uniform(mix(dart ^ U64(0xA5A5A5A5)))
                ok = rank <= r[of]
                if nu or x.max() < 1 or (x < 1).any():
                    ok &= 2.0**nu - 1 + 2.0**nu * uniform(mix(dart ^ U64(0x5C5C5C5C5C))) < x[of]
                rank, dart, of = rank[ok], dart[ok], of[ok]
                slot = o[of] * t + (mix(dart ^ U64(0x3333)) % U64(t)).astype(np.int64)
                np.minimum.at(best, slot, rank)
                won = best[slot] == rank
                sig[slot[won]] = dart[won]
        full = np.isfinite(best.reshape(n, t)).all(axis=1)
        todo &= ~full
        reach = np.where(todo, reach * 2, reach)
    return sig.reshape(n, t)


def shingles(texts: pa.Array, n: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text, sorted: hashes, owners, how often each occurs. Shorter texts: all their words make one."""
    offsets, codes, distinct = words(texts)
    h = hashes(distinct)[codes]
    grams, start = ngrams(h, offsets, n)
    owner = spread(offsets)[start]
    size = np.diff(offsets)
    for i in np.flatnonzero((size > 0) & (size < n)):
        g = U64(size[i])
        for x in h[offsets[i] : offsets[i + 1]]:
            g = join_hash(np.array([g]), np.array([x]))[0]
        grams, owner = np.append(grams, g), np.append(owner, i)
    order = np.lexsort((grams, owner))
    grams, owner = grams[order], owner[order]
    new = np.ones(len(grams), bool)
    new[1:] = (grams[1:] != grams[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return grams[first], owner[first], np.diff(np.append(first, len(grams)))


def _sketcher(bands: int, rows: int, n: int, weights: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in gather(batches, size=4 << 20):
            texts = strings(b.column("text"))
            g, owner, many = shingles(texts, n)
            w = many.astype(float) if weights == "count" else np.ones(len(g))
            sig = dart_minhash(g, owner, w, len(texts), bands * rows).reshape(len(texts), bands, rows)
            key = np.full((len(texts), bands), 1, U64) * np.arange(1, bands + 1, dtype=U64)
            for i in range(rows):
                key = join_hash(key, sig[:, :, i])
            some = np.bincount(owner, minlength=len(texts)) > 0
            flat = pa.array(key[some].reshape(-1).view(np.int64))
            ends = np.concatenate(([0], np.cumsum(some * bands))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("node"), pa.array(np.bincount(owner, w, len(texts))), pa.ListArray.from_arrays(pa.array(ends), flat)],
                names=["doc_id", "node", "size", "bands"],
            )

    return run


def _whole(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows in order of `pair`, joined to batches of about `size` bytes that split no pair."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        if sum(x.nbytes for x in held) < size:
            continue
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        pair = t.column("pair").to_numpy()
        at = int(np.searchsorted(pair, pair[-1]))
        if at:
            yield t.slice(0, at)
        held = [t.slice(at)]
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _overlaps(code: np.ndarray, owner: np.ndarray, group: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """i, j and the number of common elements of each pair of rows that has some: rows of one group, and of its two sides where it has two.

    code: the elements, those of a group together and in order; owner: their rows. Elements of up to RARE rows are counted pair by pair,
    others as products of 0/1 matrices.
    """
    k = len(group)
    first = np.flatnonzero(np.append(True, code[1:] != code[:-1])) if len(code) else np.empty(0, np.int64)
    many = np.diff(np.append(first, len(code)))
    df, nth = np.repeat(many, many), np.repeat(np.arange(len(many)), many)
    keys, low = [np.empty(0, np.int64)], (df > 1) & (df <= RARE)
    o, c = owner[low], nth[low]
    for lag in range(1, RARE):
        at = np.flatnonzero(c[lag:] == c[:-lag])
        keys.append(o[at] * k + o[at + lag])
    key, both = np.unique(np.concatenate(keys), return_counts=True)
    i, j = key // k, key % k
    lo, hi = np.searchsorted(group, np.arange(group[-1] + 1)), np.searchsorted(group, np.arange(group[-1] + 1), side="right")
    two = np.array([side[x:y].any() and not side[x:y].all() for x, y in zip(lo, hi, strict=True)])
    ok = ~two[group[i]] | (side[i] != side[j])
    i, j, both = i[ok], j[ok], both[ok]
    o, c = owner[df > RARE], nth[df > RARE]
    dense = np.zeros(group[-1] + 1, bool)
    dense[group[o]] = True
    alone = ~dense[group[i]]
    yield i[alone], j[alone], both[alone]
    of = group[o]
    for g in np.flatnonzero(dense):
        rows = np.arange(lo[g], hi[g])
        left, right = (rows[side[rows] == 0], rows[side[rows] == 1]) if two[g] else (rows, rows)
        place_l, place_r = np.full(k, -1), np.full(k, -1)
        place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
        x, y = np.searchsorted(of, g), np.searchsorted(of, g, side="right")
        eo, ec = o[x:y], c[x:y]
        inter = np.zeros((len(left), len(right)), np.float32)
        codes = np.unique(ec)
        for at in range(0, len(codes), 1024):
            u, v = np.searchsorted(ec, codes[at]), np.searchsorted(ec, codes[min(at + 1024, len(codes)) - 1], side="right")
            col = np.searchsorted(codes[at : at + 1024], ec[u:v])
            m = [np.zeros((len(z), min(1024, len(codes) - at)), np.float32) for z in (left, right)]
            for z, place in zip(m, (place_l, place_r), strict=True):
                in_ = place[eo[u:v]] >= 0
                z[place[eo[u:v]][in_], col[in_]] = 1
            inter += m[0] @ m[1].T
        mine = group[i] == g
        a, b, n = i[mine], j[mine], both[mine]
        if two[g]:
            a, b = np.where(side[a] == 0, a, b), np.where(side[a] == 0, b, a)
        inter[place_l[a], place_r[b]] += n
        if not two[g]:
            inter = np.triu(inter, 1)
        a, b = np.nonzero(inter)
        yield left[a], right[b], inter[a, b]


def _matcher(similarity: float, n: int, weights: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _whole(batches):
            g, owner, many = shingles(strings(t.column("text")), n)
            if weights == "count":  # an element that occurs twice is two elements: what two texts share is the sum of the smaller counts
                nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                g, owner = join_hash(np.repeat(g, many), nth.astype(U64)), np.repeat(owner, many)
            k, total = t.num_rows, np.bincount(owner, minlength=t.num_rows)
            pair, node = t.column("pair").to_numpy(), t.column("node").to_numpy()
            group = np.cumsum(np.append(False, pair[1:] != pair[:-1]))
            order = np.lexsort((g, group[owner]))
            g, owner = g[order], owner[order]
            code = np.cumsum(np.append(False, (g[1:] != g[:-1]) | (group[owner][1:] != group[owner][:-1]))) if len(g) else np.empty(0, np.int64)
            degree, root = np.zeros(k, np.int64), np.arange(k)
            for i, j, both in _overlaps(code, owner, group, t.column("side").to_numpy()):
                ok = both / np.maximum(total[i] + total[j] - both.astype(float), 1e-12) >= similarity
                i, j = i[ok], j[ok]
                degree += np.bincount(i, minlength=k) + np.bincount(j, minlength=k)
                while len(i):
                    low, was = np.minimum(root[i], root[j]), root.copy()
                    np.minimum.at(root, i, low)
                    np.minimum.at(root, j, low)
                    root = root[root]
                    if (root == was).all():
                        break
            some = degree > 0
            yield pa.RecordBatch.from_arrays([pa.array(node[some]), pa.array(node[root[some]]), pa.array(degree[some])], names=["node", "root", "n_links"])

    return run


def links(nodes: DataFrame, texts: DataFrame, similarity: float, keep: Scratch, n: int = SHINGLE, weights: str = "set") -> tuple[DataFrame, DataFrame]:
    """node, n_links and node, root of every node with a link. nodes: node, size, bands. texts: node, text (a row or more of each node).

    Nodes that share a band are candidates, and a group is a component of candidates. Every pair of nodes of a group is compared, each
    once: a group beyond NODES nodes or WEIGHT elements is dealt into blocks, and each two blocks meet in one task, which gives back
    how many links each node has there and a node of the part it hangs together with, not the links.
    Pairs of blocks whose sizes alone keep all similarities below the bound are left out.
    """
    rows = nodes.select("node", F.explode("bands").alias("band"))
    leaders = rows.groupBy("band").agg(F.min("node").alias("leader"), F.count("*").alias("n")).where("n > 1").select("band", "leader")
    # a node's leaders hang together by the smallest of them: an edge for the node and one for each two leaders met, not one for each band
    held = rows.join(leaders, "band").groupBy("node").agg(F.collect_set("leader").alias("all")).select(F.array_union("all", F.array("node")).alias("all"))
    near = keep.put(held.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a <> b").distinct())
    grouped = keep.put(components(near, keep).join(nodes.select("node", "size"), "node"))
    big = grouped.groupBy("root").agg(((F.count("*") > NODES) | (F.sum("size") > WEIGHT)).alias("big"))
    # sizes two grades apart differ by more than the similarity lets them
    step = max(-math.log(similarity), 0.01) * 1.0001 if similarity > 0 else None
    grade = F.when(F.col("big"), F.floor(F.log(F.greatest("size", F.lit(1.0))) / step)).otherwise(F.lit(0)) if step else F.lit(0)
    graded = grouped.join(big, "root").select("root", "node", grade.cast("int").alias("grade"), "size")
    cells = keep.put(graded.groupBy("root", "grade").agg(F.ceil(F.greatest(F.count("*") / NODES, F.sum("size") / WEIGHT, F.lit(1.0))).cast("int").alias("parts")))
    beside = lambda by, c: cells.select("root", (F.col("grade") + by).alias("grade"), F.col("parts").alias(c))
    known = cells.join(beside(-1, "above"), ["root", "grade"], "left").join(beside(1, "below"), ["root", "grade"], "left").na.fill(0, ["above", "below"])
    at = graded.join(known, ["root", "grade"]).withColumn("part", F.pmod(F.xxhash64("node", F.lit(7)), "parts").cast("int"))
    span = lambda c: F.slice(F.sequence(F.lit(0), F.col(c)), F.lit(1), F.col(c))
    block = lambda g, p, h, q, side: F.struct(F.xxhash64("root", g, p, h, q).alias("pair"), side.cast("int").alias("side"))
    own, part = F.col("grade"), F.col("part")
    pairs = F.concat(
        F.transform(span("parts"), lambda q: block(own, F.least(part, q), own, F.greatest(part, q), part > q)),
        F.transform(span("above"), lambda q: block(own, part, own + 1, q, F.lit(0))),
        F.transform(span("below"), lambda q: block(own - 1, q, own, part, F.lit(1))),
    )
    dealt = keep.put(at.select("node", F.explode(pairs).alias("p")).select("node", "p.*"))
    texts = texts.join(grouped.select("node"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text"))
    met = dealt.join(texts, "node").repartition("pair").sortWithinPartitions("pair")
    found = keep.put(met.mapInArrow(_matcher(similarity, n, weights), "node bigint, root bigint, n_links bigint"))
    joined = keep.put(found.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b")).distinct())
    return found.groupBy("node").agg(F.sum("n_links").alias("n_links")), components(joined, keep)


def components(edges: DataFrame, keep: Scratch) -> DataFrame:
    """node, root (the smallest node) of every node with an edge. In rounds: each node takes the label of its smallest neighbour, if smaller,
    then that one's label; edges between different labels are the next round's, each once, until none is left. No round has more edges
    than the one before, and each node's label is followed from the last round back to the first."""
    edges, rounds = keep.put(edges.select("a", "b")), []
    while True:
        both = edges.union(edges.select("b", "a")).toDF("node", "other")
        low = keep.put(both.groupBy("node").agg(F.min("other").alias("m")).select("node", F.least("node", "m").alias("root")))
        label = keep.put(low.join(low.toDF("root", "far"), "root").select("node", F.col("far").alias("root")))
        ends = edges.join(label.toDF("a", "x"), "a").join(label.toDF("b", "y"), "b").where("x <> y")
        left = keep.put(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        keep.drop(low, edges)
        rounds.append(label)
        edges = left
        if left.isEmpty():
            break
    keep.drop(edges)
    out = rounds.pop()
    while rounds:
        label, later = rounds.pop(), out
        out = keep.put(label.join(later.toDF("root", "far"), "root", "left").select("node", F.coalesce("far", "root").alias("root")))
        keep.drop(label, later)
    return out


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
    shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS, weights: str = "set",
) -> DataFrame:
    """doc_id, node (64-bit hash of the text), root (a node that names the class), class_id (smallest doc_id of the class), class_size (rows), n_links (links of the text to other texts), of every row."""
    keep = Scratch(docs.sparkSession, "near-dedup")
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit(""))).withColumn("node", F.xxhash64("text"))
    kind = d.schema["doc_id"].dataType.simpleString()
    base = keep.put(d.mapInArrow(_sketcher(bands, rows, shingle, weights), f"doc_id {kind}, node bigint, size double, bands array<bigint>"))
    nodes = keep.put(base.groupBy("node").agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("bands").alias("bands")))
    degrees, roots = links(nodes, d.select("node", "text"), similarity, keep, shingle, weights)
    named = keep.put(nodes.drop("bands", "size").join(roots, "node", "left").join(degrees, "node", "left").withColumn("root", F.coalesce("root", "node")))
    classes = named.groupBy("root").agg(F.min("first_id").alias("class_id"), F.sum("n").alias("class_size"))
    known = keep.put(named.join(classes, "root").select("node", "root", "class_id", "class_size", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))
    return keep.close(base.select("doc_id", "node").join(known, "node").select("doc_id", "node", "root", "class_id", "class_size", "n_links"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs with all columns; of each class one row stays, of the smallest id, a null one last (of rows alike in id and text: one)."""
    from pyspark.sql import Window

    # ids may be null or repeated, so the root tells classes apart
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("node").alias("node"))).alias("first")
    kept = cut(near_duplicates(docs, id_col, text_col, **options).groupBy("root").agg(first).select(F.col("first.id").alias("kept_id"), F.col("first.node").alias("kept_node")))
    own = F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    # the id decides together with the text, so that a group of copies meets in no task; rows stay whole, so that no name can clash
    marked = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{id_col}`").alias("id"), own.alias("node"))
    one = marked.join(kept, F.col("id").eqNullSafe(F.col("kept_id")) & (F.col("node") == F.col("kept_node")))
    nth = F.row_number().over(Window.partitionBy("id", "node").orderBy("id"))
    return one.withColumn("nth", nth).where("nth = 1").select("row.*")


def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of every document, how many it has, and to how many other texts the document's text is near."""
    return near_duplicates(table(spark, sf_dir, "documents")).drop("node", "root")
