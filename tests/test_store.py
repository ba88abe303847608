"""Tables that change: snapshots, migrations, procedures, embedding and classification stages, exports."""

import datetime
import json
import os

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from skeinworks.operators import classify, embedding, media, procedures, state, threads
from skeinworks.sources import export
from skeinworks.sources.paged import PagedSource, pages
from skeinworks.sources.store import BOOTSTRAP, TABLES, Store, View

NOW = "2024-01-10 12:00:00"


def at(hours: float) -> datetime.datetime:
    return datetime.datetime(2024, 1, 10, 12) - datetime.timedelta(hours=hours)


@pytest.fixture
def store(spark, tmp_path):
    s = Store(spark, f"file://{tmp_path}/store")
    assert s.migrate(BOOTSTRAP, "threads", NOW) == [n for n, _ in BOOTSTRAP] and s.migrate(BOOTSTRAP) == []
    assert [m["filename"] for m in s.migrations()] == [n for n, _ in BOOTSTRAP]
    return s


def fill(store, name, rows):
    names = [c.split()[0] for c in TABLES[name].split(", ")]
    store.put(name, store.spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], TABLES[name]))


def key(i: int) -> bytearray:
    return bytearray(i.to_bytes(2, "big"))


def test_snapshots(store, spark):
    for n in range(4):
        store.put("t", spark.range(n).toDF("x"))
    assert store.version("t") == 3 and store.get("t").count() == 3
    assert sorted(d for d in os.listdir(f"{store.folder[7:]}/t") if d.startswith("v")) == ["v2", "v3"]
    view = View(store, "seen", lambda: store.get("t").agg(F.count("*").alias("n")))
    assert view.get().first().n == 3
    store.put("t", spark.range(7).toDF("x"))
    assert view.get().first().n == 3 and view.refresh().first().n == 7
    with pytest.raises(KeyError):
        store.get("none")


def test_merges(spark):
    base = spark.createDataFrame([(1, "a", 5), (2, "b", None), (3, None, 7)], "k int, delta string, v int")
    delta = spark.createDataFrame([(1, "z", None), (3, "y", 9), (4, "x", 1)], "k int, delta string, v int")
    assert sorted(map(tuple, state.merge(base, delta, "k").collect())) == [(1, "z", 5), (2, "b", None), (3, "y", 9)]
    _, sent, hit = state.merged_rows(base, delta, "k")
    assert (sent, hit) == (3, 2)
    up = state.upsert(spark.createDataFrame([(1, "a", 5), (2, "b", 9)], "k int, x string, v int"), spark.createDataFrame([(1, "z", 5), (2, "y", 8), (4, "x", 1)], "k int, x string, v int"), "k", "v")
    assert sorted(map(tuple, up.collect())) == [(1, "z", 5), (2, "b", 9), (4, "x", 1)]
    assert sorted(map(tuple, state.set_status(base, delta, 19, "k", "v").collect()), key=str) == [(1, "a", 19), (2, "b", None), (3, None, 19)]


def test_batches():
    calls = iter([5, 5, 3, 5])
    assert list(state.run_batches(lambda n: next(calls), None, 5)) == [5, 5, 3]
    assert list(state.run_batches(lambda n: 5 if n < 9 else 0, 2)) == [5, 5] and list(state.run_batches(lambda n: 4 - n)) == [4, 3, 2, 1]
    assert [state.servers_for(n) for n in (0, 1, 5000, 5001, 10000, 10001)] == [0, 1, 1, 2, 2, 4]


def test_process_casts(store):
    rows = [{"id": i, "hash": key(i), "root_hash": key(i if i % 3 == 0 else 0), "parent_hash": None if i % 3 == 0 else key(0), "fid": i, "ts": at(30 - i), "threads_status": 0} for i in range(28)]
    fill(store, "casts", rows)
    fill(store, "threads", [{"hash": key(3), "author_fid": 77, "thread_status": 5}])
    assert procedures.process_casts(store, NOW, batch_size=10) == [10, 10, 4]
    got = {r.id: r.threads_status for r in store.get("casts").collect()}
    assert got == {i: 0 if i >= 24 else 2 if i % 3 == 0 else 1 for i in range(28)}
    made = {bytes(r.hash): (r.author_fid, r.thread_status) for r in store.get("threads").collect()}
    assert made == {bytes(key(i)): (77, 5) if i == 3 else (i, 0) for i in range(0, 24, 3)}
    assert procedures.process_casts(store, NOW) == []


def test_sync_spam_labels(store):
    fill(store, "threads", [{"hash": key(i), "author_fid": i, "spam": s} for i, s in enumerate([None, 2, 0, 2, 2, None])])
    store.put("user_labels", store.spark.createDataFrame([(0, "spam", "2"), (1, "spam", "2"), (2, "spam", "2"), (3, "spam", "0"), (4, "other", "0"), (5, "spam", None)], TABLES["user_labels"]))
    assert procedures.sync_spam_labels(store, batch_size=2) == [2, 1]
    assert {r.author_fid: r.spam for r in store.get("threads").collect()} == {0: 2, 1: 2, 2: 2, 3: 0, 4: 2, 5: None}
    assert procedures.sync_spam_labels(store, max_batches=1) == []


def test_process_thread_blobs(store):
    text = "a root that is long enough, number {}"
    casts = [{"id": i, "hash": key(i), "root_hash": key(i), "fid": 1, "text": text.format(i) if i != 2 else "short", "ts": at(9 - i)} for i in range(1, 6)]
    casts.append({"id": 9, "hash": key(9), "root_hash": key(1), "parent_hash": key(1), "fid": 2, "text": "an answer to the first of the roots", "ts": at(1), "mentions": [1], "positions": [0]})
    fill(store, "casts", casts)
    fill(store, "profiles", [{"fid": 1, "username": "alice"}, {"fid": 2, "username": "bob"}])
    fill(store, "reactions", [{"fid": 1, "target_hash": key(9), "reaction_type": 1}])
    fill(store, "user_labels", [{"target_fid": 1, "label_type": "spam", "label_value": "2"}])
    fill(store, "threads", [{"hash": key(i), "author_fid": 1, "ts": at(9 - i), "spam": [2, 2, 0, 2, None][i - 1], "thread_status": 0, "reactions": 0} for i in range(1, 6)])
    assert procedures.process_thread_blobs_batch(store, NOW, batch_size=2) == [2, 1]
    got = {bytes(r.hash)[1]: r for r in store.get("threads").collect()}
    assert [got[i].thread_status for i in range(1, 6)] == [1, 99, 0, 1, 0]
    assert got[1].blob == f"@alice: {text.format(1)}\n~1: @bob: @alicean answer to the first of the roots" and got[1].fids == [2, 1] and got[1].reactions == 1
    assert got[1].tokens > 10 and str(got[1].blob_ts) == NOW and got[3].blob is None


MEDIA = [
    ("\"[{'url': 'https://A.com/X'}]\"", ["https://a.com/x"], 2), ("\"[{'url': 'https://a.com/x'}, {'castId': {'fid': 1}}]\"", ["https://a.com/x"], 2),
    ("\"[{'castId': {'fid': 1}}]\"", [], 1), ("\"[{'url': ''}]\"", [], 1), ("\"{'url': 'https://z.com'}\"", [], 1), ('"[{bad"', [], 5),
    ("\"[{\\\"url\\\": 'https://q.com/`x`'}]\"", ["https://q.com/'x'"], 2),
]


def test_process_media(store):
    fill(store, "casts", [{"id": i, "embeds": e, "ts": at(20 - i), "media_status": 0} for i, (e, _, _) in enumerate(MEDIA)] + [{"id": 90, "embeds": '"[]"', "ts": at(9), "media_status": 0}, {"id": 91, "ts": at(9), "media_status": 0}, {"id": 92, "embeds": MEDIA[0][0], "ts": at(0.5), "media_status": 0}])
    fill(store, "media", [{"url": "https://q.com/'x'", "media_status": 3}])
    assert procedures.process_media_casts(store, NOW, batch_size=4) == [(4, 1), (3, 0)]
    got = {r.id: r.media_status for r in store.get("casts").collect()}
    assert got == {i: s for i, (_, _, s) in enumerate(MEDIA)} | {90: 0, 91: 0, 92: 0}
    assert sorted((r.url, r.media_status) for r in store.get("media").collect()) == [("https://a.com/x", 0), ("https://q.com/'x'", 3)]


def test_embed_urls(spark):
    got = {r.id: (r.urls, r.has_cast, r.media_status) for r in media.embed_urls(spark.createDataFrame([(i, e) for i, (e, _, _) in enumerate(MEDIA)], "id int, embeds string")).collect()}
    assert got == {i: (u, "castId" in e, s) for i, (e, u, s) in enumerate(MEDIA)}
    nested = spark.createDataFrame([('[{"castId": {"hash": {"data": [1, 171, 0]}}}]',), ("[]",), ("[{",)], "embeds string")
    assert [r[0] and bytes(r[0]) for r in nested.select(media.first_hash(F.col("embeds"))).collect()] == [b"\x01\xab\x00", None, None]


CATALOG = [
    ({"frames_url": "https://m.app", "title": "M", "manifest": {"frame": {"name": "Mini app", "primary_category": "games"}}, "metadata": {"html": {"ogTitle": "The mini app"}}}, ("The mini app", None, ["games"])),
    ({"frames_url": "https://t.app", "title": "tie2", "manifest": {"frame": {"name": "tie1", "title": 5, "tags": [], "primary_category": "x", "description": "d", "og_description": "e"}}}, ("tie1", "d", ["x"])),
    ({"frames_url": "https://u.app", "manifest": {"frame": {"title": "longest here", "tags": ["a", "", None, 7, {"o": 1}]}}, "metadata": "none"}, ("longest here", None, ["a", "7"])),
    ({"frames_url": "https://v.app", "manifest": None, "title": ""}, (None, None, [])),
    ({"title": "no address"}, None), ({"frames_url": ""}, None),
]


def test_catalogue(store, spark, tmp_path):
    items = [c for c, _ in CATALOG]
    stored = [{"frames": items[:3], "next": {"cursor": "two"}}, {"frames": items[3:], "next": {"cursor": None}}, {"frames": [{"frames_url": "never"}]}]
    (tmp_path / "pages.json").write_text(json.dumps(stored))
    spark.dataSource.register(PagedSource)
    raw = spark.read.format("paged_json").option("pages", f"file://{tmp_path}/pages.json").load()
    assert media.ingest(store, raw, NOW) == 4
    got = {r.frames_url: (r.title, r.description, r.tags) for r in store.get("catalog").collect()}
    assert got == {c["frames_url"]: want for c, want in CATALOG if want}
    again = spark.createDataFrame([(json.dumps({"frames_url": "https://m.app", "title": "New"}),)], "raw string")
    assert media.ingest(store, again, "2024-01-11 00:00:00") == 1
    assert {r.frames_url: r.title for r in store.get("catalog").collect()}["https://m.app"] == "New" and store.get("catalog").count() == 4


def test_pages_keep_what_was_fetched():
    def fetch(cursor):
        if cursor == "b":
            raise OSError("gone")
        return {"frames": [cursor], "next": {"cursor": "b" if cursor else "a"}}

    assert list(pages(fetch)) == [None, "a"]


def test_embedding_stages(store):
    fill(store, "threads", [{"hash": key(i), "ts": at(i), "spam": 0 if i == 3 else 2, "thread_status": 1, "blob": None if i == 1 else " \n" if i == 2 else f"↳ text {i}"} for i in range(8)])
    seen = []

    def encoder(texts):
        assert all("↳" not in t for t in texts)
        return embedding.hashing_encoder(texts, 16)

    got = embedding.embed_threads(store, embedding.BINARY, encoder, batch_size=4, dimension=16, sleep=seen.append)
    assert got == [{"done": 2, "blank": 2}, {"done": 3}]
    rows = {bytes(r.hash)[1]: r for r in store.get("threads").collect()}
    assert [rows[i].thread_status for i in range(8)] == [3, 19, 19, 1, 3, 3, 3, 3]
    want = encoder(["- text 4"])[0]
    assert bytes(rows[4].blob_embedding_binary) == np.packbits(want > 0).tobytes()
    embedding.embed_threads(store, embedding.FLOAT, encoder, dimension=16)
    rows = {bytes(r.hash)[1]: r for r in store.get("threads").collect()}
    assert rows[4].thread_status == 5 and rows[4].blob_embedding == pytest.approx(want.tolist())


def test_embedding_errors(store):
    def fails(message):
        def encoder(texts):
            raise RuntimeError(message)

        return encoder

    def fresh():
        fill(store, "threads", [{"hash": key(i), "ts": at(i), "spam": 2, "thread_status": 1, "blob": "text"} for i in range(3)])

    quick = lambda s: None
    for message, status in (("HTTP 503", 1), ("bad request", 19)):
        fresh()
        assert embedding.embed_threads(store, embedding.BINARY, fails(message), max_batches=1, sleep=quick) == [{"overload" if status == 1 else "error": 3}]
        assert {r.thread_status for r in store.get("threads").collect()} == {status}
    fresh()
    assert embedding.embed_threads(store, embedding.BINARY, lambda t: np.ones((len(t), 5)), max_batches=1) == [{"dimension": 3}]
    fresh()
    with pytest.raises(embedding.TooManyErrors):
        embedding.embed_threads(store, embedding.BINARY, fails("not ready yet"), batch_size=1, sleep=quick)
    waits = []
    with pytest.raises(RuntimeError):
        embedding.retried(lambda: fails("429")(None), sleep=waits.append)
    with pytest.raises(RuntimeError):
        embedding.retried(lambda: fails("x")(None), sleep=waits.append)
    assert waits == [1.0, 2.0, 1.0, 1.0]
    assert embedding.split_keys("a, b,") == ["a", "b"] and embedding.split_keys("a;b") == ["a", "b"] and embedding.split_keys("a b") == ["a", "b"] and embedding.split_keys(" Bearer x ") == ["Bearer x"]
    pooled = embedding.pooling_encoder(lambda t: [int(c) for c in t], np.eye(4))(["0011", "3", ""])
    assert pooled == pytest.approx(np.array([[0.7071068, 0.7071068, 0, 0], [0, 0, 0, 1], [0, 0, 0, 0]]))


def test_embed_posts(store):
    fill(store, "casts", [{"id": i, "text": [None, "", " ", "a text", "another text", "late"][i], "claimed_at": {4: at(2), 5: at(0.5)}.get(i)} for i in range(6)])
    encoder = lambda t: embedding.hashing_encoder(t, 8)
    assert procedures.get_unprocessed_count(store.get("casts")) == 3
    assert embedding.embed_posts(store, NOW, encoder) == [(3, 2)]
    rows = {r.id: r for r in store.get("casts").collect()}
    assert [rows[i].embedding384 is not None for i in range(6)] == [False, False, False, True, True, False]
    assert max(abs(x) for i in (3, 4) for x in rows[i].embedding384) == 127
    assert embedding.reset_stale(store, "2024-01-10 13:00:00") == 2  # the blank one and the late one
    assert procedures.get_unprocessed_count(store.get("casts")) == 1


ANSWERS = {
    "Thread_Type: advice-giving\nvalue_exchange:none\ninteraction_pattern: debate": ("advice-giving", "none", "debate"),
    "Sure!\n- thread_type :  NOISE \nthread_type: nonsense\nvalue_exchange: social-capital\nThe interaction_pattern: show-and-tell": ("noise", "social-capital", "show-and-tell"),
    "thread_type: noise\nthread_type: life-update\nvalue_exchange:none\ninteraction_pattern: debate": ("life-update", "none", "debate"),
    "thread_type: discussion\nvalue_exchange:none\ninteraction_pattern: debate": (None, "none", "debate"),
    "thread_type: value_exchange: none\nvalue_exchange none": (None, None, None),
    "": (None, None, None),
}


def test_label_answers(spark):
    rows = spark.createDataFrame([(a,) for a in ANSWERS], "a string")
    got = {r.a: (r.thread_type, r.value_exchange, r.interaction_pattern) for r in rows.select("a", *[c.alias(k) for k, c in threads.T.parse_labels(F.col("a")).items()]).collect()}
    assert got == ANSWERS
    for a, want in ANSWERS.items():
        found = classify.parse(a)
        assert tuple(found.get(k) for k in threads.T.LABELS) == want


def test_classification(store):
    fill(store, "threads", [{"hash": key(i), "ts": at(i), "spam": 2 if i else 0, "thread_status": 3, "blob": [None, "↳ fine", "", "never", "second try"][i]} for i in range(5)])
    good = "thread_type:noise\nvalue_exchange:none\ninteraction_pattern:debate"

    def model(prompt, nth):
        if "never" in prompt:
            raise OSError("no answer")
        return good if "- fine" in prompt or nth == 1 else "no idea"

    assert classify.classify_threads(store, NOW, model, batch_size=3) == [(1, 2), (1, 0)]
    got = {bytes(r.hash)[1]: (r.thread_status, r.thread_type) for r in store.get("threads").collect()}
    assert got == {0: (3, None), 1: (12, "noise"), 2: (10, None), 3: (10, None), 4: (12, "noise")}
    assert len(classify.parse(classify.by_rules("what is this?"))) == 3
    sent = []
    ask = classify.generator("http://host", "model", post=lambda url, body, s: sent.append((url, body["options"]["seed"], body["options"]["temperature"])) or {"response": " x "})
    assert ask("p", 0) == "x" and ask("p", 2) == "x" and sent == [("http://host/api/generate", 42, 0.1), ("http://host/api/generate", 44, 0.3)]


def test_export(store, spark, tmp_path):
    rows = [{"hash": key(i), "ts": at(i % 50), "spam": 2 if i % 10 else 0, "thread_status": 5 if i % 7 else 3, "blob": f"t{i}", "blob_embedding_binary": key(i)} for i in range(100)]
    fill(store, "threads", rows)
    want = [r["blob"] for r in sorted((r for r in rows if r["spam"] == 2 and r["thread_status"] == 5), key=lambda r: (r["ts"], r["hash"]))]
    folder = f"{tmp_path}/out"
    names = export.export_threads(store.get("threads"), f"file://{folder}", 20)
    assert names == [f"threads-part-{i:05d}.parquet" for i in range(-(-len(want) // 20))] and sorted(f for f in os.listdir(folder) if f.endswith(".parquet")) == names
    files = [pq.ParquetFile(f"{folder}/{n}") for n in names]
    assert [b for f in files for b in f.read().column("blob").to_pylist()] == want
    assert files[0].schema_arrow.names == list(export.COLUMNS) and files[0].metadata.row_group(0).column(0).compression == "ZSTD" and not files[0].metadata.row_group(0).column(0).has_dictionary_page
    assert export.export_threads(store.get("threads"), f"file://{folder}", 20) == []
    os.remove(f"{folder}/{names[-1]}")
    os.remove(f"{folder}/{names[-2]}")
    assert export.next_shard(f"file://{folder}") == len(names) - 2
    assert export.export_threads(store.get("threads"), f"file://{folder}", 20) == names[-2:]
    assert [b for n in names for b in pq.read_table(f"{folder}/{n}").column("blob").to_pylist()] == want
    one = spark.range(5).select("id", F.lit(1).alias("row"))
    assert export.export(one, f"file://{tmp_path}/one", ["id"], 9, "p-%05d.parquet") == ["p-00000.parquet"]
    with pytest.raises(ValueError):
        export.numbered(one, ["id"])
    assert [len(x) for x in export.fetched(spark.range(10), 4)] == [4, 4, 2]
    export.export_pages(one, f"file://{tmp_path}/pages", ["id"], 2)
    assert spark.read.parquet(f"file://{tmp_path}/pages").count() == 5
