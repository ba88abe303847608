"""The corpus operators against brute force, on a small table with nulls, empty and long texts, repeated rows and clashing names."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from skeinworks.llm import decontamination, lm_score, near_dedup, piece_sampling, pii, quality_net, quality_rules, range_coder, sharding, token_counts, tokens

R = random.Random(5)
NAMES = [f"w{i}" for i in range(400)]


def prose(n):
    return " ".join(R.choices(NAMES, k=n))


BASE, ITEM = prose(200), " ".join(f"item{i}" for i in range(30))
NEAR = BASE.split()
NEAR[100] = "changed"
TEXTS = [
    (0, BASE), (1, BASE), (2, " ".join(NEAR)), (3, prose(60) + " " + ITEM + " " + prose(20)), (4, ""), (5, None), (6, "a b"), (7, prose(3000)), (7, "twice"), (7, "twice"), (None, "no id"),
    (8, "mail a.b@c.org or 10.0.0.1, card 4111 1111 1111 1111, call +44 (20) 7946-0958 now"), (9, "x\ny\n\nx\nthe same words the same words the same words " * 9), (10, "ünïcode ▁ mark  two spaces  漢字 😀"),
]
SCHEMA = "doc_id long, text string, band long, node string, shard int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, 1, "n", 2) for i, t in TEXTS], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def brute_alignment(a, b):
    m, best = np.zeros((len(a) + 1, len(b) + 1), int), 0
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            m[i, j] = max(0, m[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), m[i - 1, j] - 1, m[i, j - 1] - 1)
            best = max(best, m[i, j])
    return best


def test_alignment():
    for _ in range(40):
        a, b = (np.array(R.choices(range(4), k=R.randint(1, 15))) for _ in range(2))
        assert decontamination.smith_waterman(a, b)[0] == brute_alignment(a, b)


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame([(1, ITEM), (2, "too short"), (3, None), (4, "not in any text at all")], "item_id long, text string")
    hits = decontamination.contaminated(docs, items).collect()
    assert [(r.doc_id, r.item_id, r.score) for r in hits] == [(3, 1, 1.0)]
    assert decontamination.drop_contaminated(docs, items).count() == len(TEXTS) - 1
    assert decontamination.contaminated(none, items).count() == 0


def test_token_counts(docs, none):
    e = tokens.Encoder(tokens.vocabulary(), literal=True)
    want = Counter((i, len(e.plain.encode(t or "", add_special_tokens=False).ids) + 1) for i, t in TEXTS)
    assert Counter((r.doc_id, r.n_tokens) for r in token_counts.count_tokens(docs, block=50).collect()) == want
    assert token_counts.count_tokens(none).count() == 0


def test_quality_rules(docs, none):
    def base(t):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        twice = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(twice)

    got = quality_rules.rules(docs, docs.where("doc_id < 3")).collect()
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == Counter((i, *base(t)) for i, t in TEXTS)
    assert all(r.base_failed == (r.n_words < 50 or 2 * r.n_repeat_words > r.n_words) and not (r.kept and r.base_failed) for r in got)
    assert quality_rules.rules(none, none).count() == 0


def test_every_trusted_text_counts(spark, tmp_path):
    n = 20_500
    rows = [(i, f"text {i}") for i in range(n)] + [(5, "again"), (None, "no id"), (n, "bad"), (n + 1, "toxic"), (n + 2, None)]
    labels = [(i, 1, None) for i in range(n)] + [(3, 1, 0), (None, 1, 0), (n, 0, 0), (n + 1, 1, 1), (n + 2, 1, 0), (n + 9, 1, 0)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    got = Counter(r.text for r in quality_rules.trusted_texts(spark, str(tmp_path)).collect())
    assert got == Counter([t for i, t in rows if i is not None and i not in (n, n + 1)])


def test_range_coder(spark, docs, none, tmp_path):
    for n in (0, 1, 99, 1000):
        ids = np.array(R.choices([0, 1, 2, 7, 65535], k=n), np.int64)
        sizes = np.array([n // 2, n - n // 2])
        data = range_coder.pack([None, 3], sizes, ids, block=100)
        back = range_coder.unpack(data)
        assert back[0] == [None, 3] and (back[1] == sizes).all() and (back[2] == ids).all()
    for at in (20, len(data) - 3):
        bad = bytearray(data)
        bad[at] ^= 255
        with pytest.raises(ValueError):
            range_coder.unpack(bytes(bad))
    folder = f"file://{tmp_path}"
    empty = range_coder.write(none, f"{folder}/none")
    assert empty.count() == 0 and range_coder.read(empty, f"{folder}/none").count() == 0
    got = range_coder.read(range_coder.write(docs, folder), folder).orderBy("start").collect()
    e, at = tokens.Encoder(tokens.vocabulary()), 0
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == Counter((i, range_coder.crc(np.array([*e.plain.encode(t or "", add_special_tokens=False).ids, 1]))) for i, t in TEXTS)
    for r in got:
        assert r.start == at
        at += r.n_tokens


@pytest.mark.parametrize("block", [1, 7, 64, 2048])
def test_blocks(block):
    """Every block comes back: of one id, of ids that never or always repeat, of a last block that is short."""
    r = np.random.default_rng(block)
    for n in (1, block, block + 1, 5 * block + 3, 9000):
        for ids in (r.integers(0, 1 << 16, n), np.zeros(n, np.int64), np.full(n, 65535), r.zipf(1.3, n) % 49000, np.arange(n) % 65536, np.tile([5, 6, 7, 5, 9], n)[:n]):
            data = range_coder.pack([1], np.array([n]), ids, block=block)
            assert (range_coder.unpack(data)[2] == ids).all()


def test_long_blocks_and_carries():
    """Counts above 2**14 in a block; words of ones, through which a carry goes."""
    r = np.random.default_rng(2)
    for ids in (np.zeros(40_000, np.int64), r.integers(0, 2, 40_000) * 7, r.integers(0, 1 << 16, 40_000)):
        data = range_coder.pack([1], np.array([40_000]), ids, block=20_000)
        assert (range_coder.unpack(data)[2] == ids).all()
    out = range_coder._Out(2, 8)
    for low in (5.0, 2.0**48 - 1, 2.0**48 - 1, 2.0**48 + 3 * 2.0**32):
        out.put(np.array([1]), np.array([low]))
    assert [w.tolist() for w in out.close()] == [[0], [1, 0, 0, 3, 0]]


def test_files_of_partitions_a_little_above_the_size(spark, tmp_path, monkeypatch):
    """One file, not one more for the rest."""
    monkeypatch.setattr(range_coder, "TEXT_BYTES", 1000)
    monkeypatch.setattr(range_coder, "PIECE_BYTES", 100)
    batches = [pa.RecordBatch.from_arrays([pa.array(range(i, i + 11)), pa.array(["a" * 100] * 11)], names=["doc_id", "text"]) for i in (0, 11)]
    monkeypatch.setattr("pyspark.TaskContext.get", lambda: type("Context", (), {"partitionId": lambda self: 0})())
    run = range_coder._writer(f"file://{tmp_path}", tokens.vocabulary(), 1)
    assert sum(b.num_rows for b in run(iter(batches[:1]))) == 1
    assert sum(b.num_rows for b in run(iter(batches))) == 2


def test_damaged_blocks():
    ids = np.random.default_rng(1).integers(0, 3000, 5000)
    data = range_coder.pack([1], np.array([5000]), ids, block=128)
    for at in range(900, len(data), 371):
        bad = bytearray(data)
        bad[at] ^= 0x55
        with pytest.raises(ValueError):
            range_coder.unpack(bytes(bad))


def test_near_duplicates(docs, none):
    got = {(r.doc_id, r.node): r for r in near_dedup.near_duplicates(docs).collect()}
    by_id = {k[0]: r for k, r in got.items()}
    assert {by_id[i].class_id for i in (0, 1, 2)} == {0} and by_id[2].n_links == 1 and by_id[0].class_size == 3
    assert by_id[4].class_id == by_id[5].class_id == 4 and by_id[6].class_id == 6 and by_id[3].class_id == 3
    assert near_dedup.near_duplicates(docs).count() == len(TEXTS)
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.select("doc_id").collect() if r.doc_id in (0, 1, 2, 4, 5)) == {0: 1, 4: 1}
    assert near_dedup.near_duplicates(none).count() == 0


def brute_links(texts):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} for w in map(str.split, texts)]
    return [(i, j) for i in range(len(sets)) for j in range(i) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]


@pytest.mark.parametrize("block", [100, 1500])
def test_links_of_one_member(spark, monkeypatch, block):
    """Texts that are near to one member only of a large class, and share bands with many of it."""
    monkeypatch.setattr(near_dedup, "NODES", block)
    r = random.Random(11)

    def changed(text, n):
        w = text.split()
        for at in r.sample(range(5, 195, 8), n):
            w[at] = f"c{r.randrange(10**9)}"
        return " ".join(w)

    hub = " ".join(f"h{i}" for i in range(200))
    members = [changed(hub, 3) for _ in range(600)]
    texts = [hub, *members, *(changed(m, 3) for m in members[:12])]
    root = list(range(len(texts)))

    def top(x):
        return x if root[x] == x else top(root[x])

    for i, j in brute_links(texts):
        a, b = sorted((top(i), top(j)))
        root[b] = a
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {x.doc_id: x.class_id for x in got.collect()} == {i: top(i) for i in range(len(texts))}


@pytest.mark.parametrize("block, weights", [(8, "set"), (1500, "set"), (8, "count")])
def test_link_counts(spark, monkeypatch, block, weights):
    """Every link counts: of texts of one length and of others, in one block and in many."""
    monkeypatch.setattr(near_dedup, "NODES", block)
    r = random.Random(12)
    whole = [f"l{i}" for i in range(300)]
    texts = []
    for k in range(90):
        own = whole[: r.choice((150, 170, 200, 230, 260, 300))]
        for _ in range(r.randrange(4)):
            own[r.randrange(len(own))] = f"x{k}"
        texts.append(" ".join(own))
    texts = sorted(set(texts))
    want = Counter(x for pair in brute_links(texts) for x in pair)
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), weights=weights)
    assert {x.doc_id: x.n_links for x in got.collect()} == {i: want[i] for i in range(len(texts))}


def test_candidates_of_a_large_group(spark, monkeypatch):
    """Edges between candidates are about as many as nodes, however many bands the nodes of a group share, and rounds do not repeat them."""
    r, seen, written = random.Random(13), [], []
    components, put = near_dedup.components, near_dedup.Scratch.put

    def counted(edges, keep):
        seen.append((edges.count(), edges.select(F.explode(F.array("a", "b"))).distinct().count()))
        at = len(written)
        out = components(edges, keep)
        seen[-1] += (sum(d.count() for d in written[at:]),)
        return out

    def stored(self, df):
        out = put(self, df)
        written.append(out.persist())
        out.count()
        return out

    monkeypatch.setattr(near_dedup, "components", counted)
    monkeypatch.setattr(near_dedup.Scratch, "put", stored)
    hub = [f"g{i}" for i in range(200)]
    texts = []
    for k in range(400):
        own = list(hub)
        for at in r.sample(range(5, 195, 8), 3):
            own[at] = f"d{k}_{at}"
        texts.append(" ".join(own))
    got = near_dedup.near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    edges, nodes, rows = seen[0]
    assert {x.class_id for x in got.collect()} == {0}
    assert nodes == 400 and edges <= 2 * nodes and rows <= 8 * nodes


def test_components(spark):
    r = random.Random(14)
    for edges in ([(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)], [(r.randrange(300), r.randrange(300, 600)) for _ in range(260)], []):
        root = list(range(600))
        for _ in range(600):
            was = list(root)
            for a, b in edges:
                root[a] = root[b] = min(root[a], root[b])
            if root == was:
                break
        keep = near_dedup.Scratch(spark, "edges")
        got = near_dedup.components(spark.createDataFrame(edges, "a long, b long"), keep).collect()
        assert sorted(map(tuple, got)) == sorted((i, root[i]) for i in {x for e in edges for x in e})


def test_classes_without_ids_of_their_own(docs, spark):
    """Null and repeated ids do not make one class of several."""
    kept = near_dedup.drop_near_duplicates(docs).collect()
    assert Counter(r.text[:5] for r in kept if r.doc_id in (None, 7)) == Counter(["no id", "twice", TEXTS[7][1][:5]])
    rows = [(None, f"text {i}") for i in range(30)] + [(1, f"other {i}") for i in range(30)] + [(None, BASE), (3, " ".join(NEAR))]
    kept = near_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.text for r in kept) == sorted(t for _, t in rows if t != BASE)


def test_signatures():
    same, n, size = [], 40, 60
    for k in range(n):
        a = np.unique(np.random.default_rng(k).integers(0, 2**63, size).astype(np.uint64))
        both = np.concatenate((a[: size * 2 // 3], a[size // 3 :]))
        sig = near_dedup.dart_minhash(both, np.repeat([0, 1], [40, 40]), np.ones(80), 2, 128)
        same.append((sig[0] == sig[1]).mean())
    assert abs(np.mean(same) - 1 / 3) < 0.02  # 20 of 60


def test_pii(docs, none):
    got = {r.doc_id: [s.kind for s in r.base] for r in pii.spans(docs).collect()}
    assert got[8] == ["email", "ip", "card", "phone"] and not got[4] and not got[5] and not got[0]
    for _ in range(300):
        t = "".join(R.choices("a.@-b1 ", k=30))
        assert pii.emails(t) == [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    clean = pii.sanitise(docs)
    assert clean.columns == docs.columns and clean.count() == len(TEXTS)
    text = clean.where("doc_id = 8").first().text
    assert "[EMAIL]" in text and "4111" not in text and "7946" not in text
    assert pii.sanitise(none).count() == 0


def test_disclosure_in_whole_texts(spark):
    """Terms far from their entity are found and marked wherever they stand; against brute force."""
    r = random.Random(6)
    rows = []
    for i in range(120):
        w = r.choices(NAMES[:60], k=80)
        if i % 4 == 0:
            w[40] = f"u{i % 12}@site.org"
            w[2] = w[70] = f"Name{i % 12}"
            w[r.choice((10, 39))] = f"Firm{i % 24}"
        if i % 8 == 0:
            w[60] = "10.0.0.7"
        rows.append((i, " ".join(w)))
    texts = dict(rows)
    entities = {i: {(k, v) for k, _, _, v in pii.find(t)} for i, t in rows}
    terms = {i: {x.lower() for x in t.split() if not re.search("[@.]", x)} for i, t in rows}
    n_e, n_t = (Counter(x for s in d.values() for x in s) for d in (entities, terms))
    both = Counter((e, t) for i in texts for e in entities[i] for t in terms[i])
    n = len(rows)
    flagged = {(e, t) for (e, t), k in both.items() if math.log(k * n / (n_e[e] * n_t[t])) >= 0.9 * math.log(n / n_e[e]) - 1e-12}
    want = {i: [m.span() for m in re.finditer(r"\S+", t) if any((e, m[0].lower()) in flagged for e in entities[i])] for i, t in rows}
    assert all(len(want[i]) >= 2 for i in want if i % 4 == 0)
    got = pii.spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {x.doc_id: [(s.start, s.stop) for s in x.extra] for x in got} == want


def test_piece_sampling(docs, none):
    got = piece_sampling.sample(docs, k=3).collect()
    assert all(r.decodes and 0 < r.inclusion <= 1 for r in got)
    long = [r for r in got if r.doc_id == 0]
    assert len({tuple(r.ids) for r in long}) == 3
    assert [r.perturbed for r in sorted(long, key=lambda r: r.sample)] == sorted((r.perturbed for r in long), reverse=True)
    assert [r.n_pieces for r in got if r.doc_id == 4] == [0]
    assert sorted(map(str, got)) == sorted(map(str, piece_sampling.sample(docs, k=3).collect()))
    assert piece_sampling.sample(none).count() == 0


def test_sharding(spark, docs, none):
    def jump(key, n):
        b, j, key = -1, 0, key % 2**64
        while j < n:
            b, key = j, (key * 2862933555777941757 + 1) % 2**64
            j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
        return b

    keys = [0, 1, -1, 2**62, -(2**63), *(R.randrange(2**63) for _ in range(200))]
    rows = spark.createDataFrame([(k, "t") for k in keys], "doc_id long, text string")
    for r in sharding.shard(rows).collect():
        assert (r.shard, r.grown_shard) == (jump(r.doc_id, 16), jump(r.doc_id, 17)) and r.grown_shard in (r.shard, 16)
    got = sharding.shard(docs).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in TEXTS)
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert sharding.shard(none).count() == 0
    named = spark.createDataFrame([("a", "x"), ("b", None), (None, "y"), ("a", "z")], "doc_id string, text string")
    got = {(r.doc_id, r.size): (r.shard, r.grown_shard) for r in sharding.shard(named).collect()}
    assert len(got) == 4 - 1 and got[None, 2] == (jump(0, 16), jump(0, 17)) and all(z in (a, 16) for a, z in got.values())
    hot = spark.createDataFrame([(None, f"t{i}") for i in range(500)], "doc_id long, text string")
    assert sorted(r.slot for r in sharding.shard(hot).collect()) == list(range(500))


def test_quality_net(spark, docs, none):
    rows = [(i, ("good clear prose " if i % 2 else "x#$ %%! ") * R.randint(5, 60)) for i in range(200)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, label int")
    net = quality_net.train(table, labels)
    got = quality_net.score(table, net).collect()
    assert all(0 <= r.score <= 1 and (r.score > 0.5) == (r.doc_id % 2 == 1) for r in got if r.doc_id >= 160)
    assert quality_net.score(docs, net).count() == len(TEXTS) and quality_net.score(none, net).count() == 0
    assert quality_net.train(none, labels).scores(*quality_net._rows(quality_net.strings(__import__("pyarrow").array([""])))) == [0.5]


def test_language_model(docs, none):
    from pyspark.sql import functions as F

    held = {3, 8}
    split = lambda t: [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None]
    counts = Counter(w for i, t in TEXTS if i not in held for w in split(t))
    n, v = sum(counts.values()), len(counts)
    got = lm_score.score(docs, F.col("doc_id").isin(*held)).collect()
    want = Counter((i, len(split(t)), sum(counts[w] > 0 for w in split(t)), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in split(t)), 6)) for i, t in TEXTS)
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    seen, unseen = (next(r for r in got if r.doc_id == i) for i in (0, 3))
    assert all(r.score < 0 for r in got) and seen.score / seen.n_tokens > unseen.score / unseen.n_tokens
    assert lm_score.score(none, F.lit(False)).count() == 0
