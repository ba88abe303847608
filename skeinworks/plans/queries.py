"""The registered queries of the engine, each with the SQL that DuckDB answers alike."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens
from ..functions import vectors as V
from ..operators import canonical, classify, clusters, media, procedures, state, threads
from ..sources import export
from ..sources.adapters import Model, oracle
from ..streaming import posts as posts_stream

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def enter(f: Callable[[Model], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Model(spark, sf_dir))
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return enter


_GOOD = "good AS (SELECT target_fid AS fid FROM user_labels WHERE TRY_CAST(label_value AS INT) = 2)"
_COUNTS = f"{_GOOD}, counts AS (SELECT target_hash AS hash, count(*) AS n_reactions FROM reactions WHERE fid IN (SELECT fid FROM good) GROUP BY ALL)"
_TREE = """tree AS (SELECT hash AS root, hash, parent_hash, fid, 0 AS depth, [hash] AS path FROM posts WHERE parent_hash IS NULL AND hash = root_hash
 UNION ALL SELECT t.root, p.hash, p.parent_hash, p.fid, t.depth + 1, list_append(t.path, p.hash) FROM tree t JOIN posts p ON p.parent_hash = t.hash
   WHERE t.depth < 10)"""
_NODES = "nodes AS (SELECT t.*, p.username, coalesce(c.n_reactions, 0) AS n_reactions FROM tree t JOIN profiles p USING (fid) LEFT JOIN counts c USING (hash))"
_POP = """popular AS (SELECT root, hash, n_reactions, rn FROM (SELECT *, row_number() OVER (PARTITION BY root ORDER BY n_reactions DESC, hash) AS rn,
   count(*) OVER (PARTITION BY root) AS n FROM nodes WHERE n_reactions > 0) WHERE rn <= greatest(2, ceil(n * 0.05)))"""
_KEPT = """op AS (SELECT root, fid AS op_fid FROM nodes WHERE depth = 0),
 seeds AS (SELECT n.root, n.hash FROM nodes n JOIN op USING (root) WHERE n.fid = op.op_fid UNION SELECT n.root, n.hash FROM nodes n
   JOIN op USING (root) JOIN reactions r ON r.fid = op.op_fid AND r.target_hash = n.hash UNION SELECT root, hash FROM popular),
 way AS (SELECT DISTINCT n.root, unnest(n.path) AS hash FROM nodes n JOIN seeds s ON s.root = n.root AND s.hash = n.hash),
 kept AS (SELECT n.* FROM nodes n JOIN way w ON w.root = n.root AND w.hash = n.hash)"""
_SUB = """below AS (SELECT root, n_reactions, unnest(path) AS anc FROM kept), sub AS (SELECT k.root, k.hash, max(b.n_reactions) AS popularity
   FROM kept k JOIN below b ON b.root = k.root AND b.anc = k.hash GROUP BY ALL)"""
_SIB = """sib AS (SELECT k.*, s.popularity, row_number() OVER (PARTITION BY k.root, k.parent_hash ORDER BY s.popularity DESC NULLS LAST,
   k.hash) AS sibling FROM kept k JOIN sub s ON s.root = k.root AND s.hash = k.hash)"""
_PRE = """ways AS (SELECT root, hash, len(path) AS n, unnest(path) AS anc, generate_subscripts(path, 1) AS i FROM sib),
 pre AS (SELECT w.root, w.hash, string_agg(lpad(CAST(s.sibling AS VARCHAR), 9, '0'), '.' ORDER BY w.i) AS position FROM ways w
   JOIN sib s ON s.root = w.root AND s.hash = w.anc GROUP BY w.root, w.hash, w.n HAVING count(*) = w.n)"""
_ALL = ("posts", "reactions", "profiles", "user_labels")
_TO_KEPT = f"{oracle(*_ALL)}, {_COUNTS}, {_TREE}, {_NODES}, {_POP}, {_KEPT}"
_TO_PRE = f"{_TO_KEPT}, {_SUB}, {_SIB}, {_PRE}"


def _nodes(m: Model) -> DataFrame:
    return threads.enriched(threads.tree(m.posts), m.profiles, threads.reaction_counts(m.reactions, m.user_labels))


def _kept(m: Model) -> DataFrame:
    return threads.kept(_nodes(m), m.reactions)


def _arrays(posts: DataFrame) -> DataFrame:
    """The posts with mentions, positions, quotes and urls as arrays."""
    some = lambda *c: F.array_compact(F.array(*c))
    near, far = F.least(F.lit(10), F.octet_length("text")), F.least(F.lit(25), F.octet_length("text"))
    places = some(F.when(F.col("mentioned").isNotNull(), near), F.when(F.col("mentioned2").isNotNull(), F.when(F.col("hash") % 20 == 0, near).otherwise(far)))
    return posts.select(
        "hash", "parent_hash", "root_hash", "fid", "text", some("mentioned", "mentioned2").alias("mentions"), places.alias("positions"),
        some("quoted", "quoted2").alias("quotes"), some("url", "url2").alias("urls"),
    )


@query(f"""{oracle(*_ALL)}, r AS (SELECT target_hash AS hash, count(*) FILTER (WHERE reaction_type = 1) AS like_count,
   count(*) FILTER (WHERE reaction_type = 2) AS recast_count FROM reactions JOIN user_labels ON fid = target_fid
   WHERE TRY_CAST(label_value AS INT) = 2 GROUP BY ALL),
 c AS (SELECT parent_hash AS hash, count(*) AS comment_count FROM posts JOIN user_labels ON fid = target_fid WHERE TRY_CAST(label_value AS INT) = 2
   GROUP BY ALL)
 SELECT p.hash, p.root_hash, coalesce(like_count, 0) AS like_count, coalesce(recast_count, 0) AS recast_count, coalesce(comment_count,
   0) AS comment_count FROM r FULL OUTER JOIN c USING (hash) JOIN posts p USING (hash)""")
def engagement_counts(m: Model) -> DataFrame:
    return threads.engagement(m.posts, m.reactions, m.user_labels)


@query(f"{oracle('posts')} SELECT hash, CASE WHEN hash = root_hash AND parent_hash IS NULL THEN 2 ELSE 1 END AS threads_status FROM posts")
def root_reply_split(m: Model) -> DataFrame:
    return threads.roots_and_replies(m.posts)


_THREADS = "SELECT hash, fid AS author_fid, ts, CASE hash % 3 WHEN 0 THEN 2 WHEN 1 THEN 0 END AS spam, CAST(floor(hash / 50.0) AS BIGINT) % 3 AS status FROM posts WHERE hash = root_hash"


@query(f"""{oracle('posts', 'user_labels')} SELECT t.hash, TRY_CAST(label_value AS INT) AS spam FROM ({_THREADS}) t
   JOIN user_labels ON author_fid = target_fid AND label_type = 'spam' WHERE t.spam IS DISTINCT FROM TRY_CAST(label_value AS INT)""")
def spam_label_diff(m: Model) -> DataFrame:
    return state.changed_labels(m.spark.sql(_THREADS.replace("FROM posts", "FROM {posts}"), posts=m.posts), m.user_labels)


@query(f"{oracle('posts', 'reactions', 'user_labels')}, {_COUNTS} SELECT hash, n_reactions FROM counts")
def good_reactions_semi(m: Model) -> DataFrame:
    return threads.reaction_counts(m.reactions, m.user_labels)


@query(f"""{oracle('posts')} SELECT r.hash AS root, count(DISTINCT p.hash) AS n_posts, max(CASE WHEN p.hash = r.hash THEN p.fid END) AS root_fid,
   max(CASE WHEN p.hash = r.hash THEN p.text END) AS root_text FROM posts r JOIN posts p ON p.root_hash = r.hash OR p.hash = r.hash
   GROUP BY r.hash""")
def size_check_or_join(m: Model) -> DataFrame:
    return threads.thread_sizes(m.posts)


@query(f"{oracle('posts')}, {_TREE} SELECT root, hash, depth, array_to_string(path, '/') AS path FROM tree")
def thread_tree(m: Model) -> DataFrame:
    return threads.tree(m.posts).select("root", "hash", "depth", F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"))


@query(f"{oracle('posts')}, {_TREE} SELECT root, max(depth) AS depth, count(*) AS n FROM tree GROUP BY root")
def thread_tree_sql(m: Model) -> DataFrame:
    """The SQL surface of the expansion: a recursive CTE."""
    return m.spark.sql("""WITH RECURSIVE tree AS (SELECT hash AS root, hash, 0 AS depth FROM {posts} WHERE parent_hash IS NULL AND hash = root_hash
        UNION ALL SELECT t.root, p.hash, t.depth + 1 FROM tree t JOIN {posts} p ON p.parent_hash = t.hash WHERE t.depth < 10) SELECT root,
   max(depth) AS depth, count(*) AS n FROM tree GROUP BY root""", posts=m.posts)


@query(f"{oracle(*_ALL)}, {_COUNTS}, {_TREE}, {_NODES}, {_POP} SELECT root, hash, n_reactions, rn FROM popular")
def popular_top5pct(m: Model) -> DataFrame:
    return threads.popular(_nodes(m))


@query(f"{_TO_KEPT} SELECT root, hash, depth, n_reactions FROM kept")
def kept_nodes(m: Model) -> DataFrame:
    return _kept(m).select("root", "hash", "depth", "n_reactions")


@query(f"{_TO_KEPT}, {_SUB} SELECT * FROM sub")
def subtree_popularity(m: Model) -> DataFrame:
    return threads.subtree_popularity(_kept(m))


@query(f"{_TO_KEPT}, {_SUB}, {_SIB} SELECT root, hash, sibling FROM sib")
def sibling_rank(m: Model) -> DataFrame:
    return threads.sibling_rank(_kept(m)).select("root", "hash", "sibling")


@query(f"{_TO_PRE} SELECT * FROM pre")
def preorder_paths(m: Model) -> DataFrame:
    return threads.preorder(_kept(m)).select("root", "hash", "position")


# a post's text with its mentions and lost links, without quotes; offsets are 25 bytes at most, so that 30 characters tell the place
_BODY = """cuts AS (SELECT hash, text, mentioned AS fid, 0 AS i, least(10, octet_length(encode(text))) AS off FROM posts WHERE mentioned IS NOT NULL
   UNION ALL SELECT hash, text, mentioned2, 1, least(CASE WHEN hash % 20 = 0 THEN 10 ELSE 25 END, octet_length(encode(text))) FROM posts
   WHERE mentioned2 IS NOT NULL),
 placed AS (SELECT c.hash, c.text, '@' || u.username AS tag, c.i, CASE WHEN off >= octet_length(encode(c.text)) THEN length(c.text)
   ELSE len(list_filter(range(1, least(length(c.text), 30) + 1), lambda n: octet_length(encode(substring(c.text, 1, n - 1))) < off)) END AS pos
   FROM cuts c JOIN profiles u USING (fid)),
 tags AS (SELECT hash, text, tag, min({'pos': pos, 'i': i}) AS spot FROM placed GROUP BY ALL),
 segments AS (SELECT hash, text, tag, spot, lag(spot.pos, 1, 0) OVER (PARTITION BY hash ORDER BY spot) AS prev FROM tags),
 injected AS (SELECT hash, string_agg(substring(text, prev + 1, spot.pos - prev) || tag, '' ORDER BY spot) || substring(any_value(text),
   max(spot.pos) + 1) AS body FROM segments GROUP BY hash),
 lost AS (SELECT hash, list_sort(list_distinct(list_filter([url, url2], lambda u: u IS NOT NULL AND instr(lower(text), lower(u)) = 0))) AS urls FROM posts),
 bodies AS (SELECT p.hash, coalesce(j.body, p.text) AS body, CASE WHEN len(l.urls) > 0 THEN ' ' || array_to_string(l.urls, ' ') ELSE '' END AS tail
   FROM posts p LEFT JOIN injected j USING (hash) JOIN lost l USING (hash))"""
_EDGES = "edges AS (SELECT hash, quoted AS q FROM posts WHERE quoted IS NOT NULL UNION SELECT hash, quoted2 FROM posts WHERE quoted2 IS NOT NULL)"
_WALK = """walk AS (SELECT hash, 0 AS level, [hash] AS path FROM seeds_ JOIN posts USING (hash) JOIN profiles USING (fid)
 UNION ALL SELECT p.hash, w.level + 1, list_append(w.path, p.hash) FROM walk w JOIN edges e ON e.hash = w.hash JOIN posts p ON p.hash = e.q
   JOIN profiles USING (fid) WHERE w.level < 3 AND NOT list_contains(w.path, p.hash))"""
# which posts of the walk a leaf of it supports
_SUPPORTED = """walked AS (SELECT DISTINCT hash FROM walk), supported AS (SELECT hash FROM walked WHERE hash NOT IN (SELECT hash FROM edges)
 UNION SELECT e.hash FROM edges e JOIN supported s ON s.hash = e.q JOIN walked w ON w.hash = e.hash)"""
_TIDY = "regexp_replace(regexp_replace({0}, 'https://(farcaster\\.xyz|warpcast\\.com)/[^/]+/0x[a-fA-F0-9]+', '', 'g'), '[\\n\\r\\t]+', ' ', 'g')"


def _plain(m: Model) -> DataFrame:
    """The preorder with texts that have mentions and links written in, but no quotes: those of posts that quote none; others raw."""
    posts = _arrays(m.posts)
    whole = F.concat("body", T.tail(F.col("text"), F.col("urls")))
    final = F.when(F.size("quotes") == 0, T.tidy(whole)).otherwise(F.col("text"))
    texts = threads.mentions_in(posts, m.profiles).select("hash", final.alias("final_text"))
    return threads.preorder(_kept(m)).join(texts, "hash")


_SHOWN = f"""{_TO_PRE}, {_BODY}, {_EDGES}, texts AS (SELECT p.hash, CASE WHEN p.hash IN (SELECT hash FROM edges) THEN p.text
   ELSE {_TIDY.format('b.body || b.tail')} END AS final_text FROM posts p JOIN bodies b USING (hash)),
 shown AS (SELECT s.root, s.fid, pre.position, s.n_reactions, CASE WHEN s.depth = 0 THEN ''
   ELSE '~' || s.depth || ': ' END || '@' || s.username || ': ' || t.final_text AS line
 FROM sib s JOIN pre USING (root, hash) JOIN texts t USING (hash) WHERE s.depth = 0 OR length(t.final_text) >= 20)"""


@query(f"""{_SHOWN} SELECT root, array_to_string(list(fid ORDER BY p DESC, fid), ',') AS fids FROM (SELECT root, fid, max(n_reactions) AS p FROM shown
   GROUP BY ALL) GROUP BY root""")
def fids_by_popularity(m: Model) -> DataFrame:
    return threads.blobs(_plain(m)).select("root", F.array_join(F.transform("fids", lambda x: x.cast("string")), ",").alias("fids"))


@query(f"{_SHOWN} SELECT root, string_agg(line, chr(10) ORDER BY position) AS blob, CAST(sum(n_reactions) AS BIGINT) AS reactions FROM shown GROUP BY root")
def thread_blob_plain(m: Model) -> DataFrame:
    return threads.blobs(_plain(m)).select("root", "blob", "reactions")


@query()
def thread_blob_full(m: Model) -> DataFrame:
    """Quotes, mentions, links and all; a repeated tag needs a back reference, which DuckDB's expressions lack."""
    return threads.build(_arrays(m.posts), m.reactions, m.user_labels, m.profiles)


@query(f"{oracle('posts', 'profiles')}, {_BODY} SELECT hash, body FROM injected")
def mention_injection(m: Model) -> DataFrame:
    posts = _arrays(m.posts).where(F.size("mentions") > 0)
    return threads.mentions_in(posts, m.profiles).where("tags IS NOT NULL").select("hash", "body")


@query(f"""{oracle('posts')}, l AS (SELECT hash, list_sort(list_distinct(list_filter([url, url2], lambda u: u IS NOT NULL
   AND instr(lower(linked_text), lower(u)) = 0))) AS urls FROM posts WHERE url IS NOT NULL) SELECT hash, CASE
   WHEN len(urls) > 0 THEN ' ' || array_to_string(urls, ' ') ELSE '' END AS tail FROM l""")
def missing_urls(m: Model) -> DataFrame:
    return m.posts.where("url IS NOT NULL").select("hash", T.tail(F.col("linked_text"), F.array("url", "url2")).alias("tail"))


@query(f"{oracle('posts', 'profiles')}, {_EDGES}, seeds_ AS (SELECT hash FROM posts), {_WALK} SELECT hash, level, array_to_string(path, '/') AS path FROM walk")
def quote_expand(m: Model) -> DataFrame:
    posts = _arrays(m.posts)
    return threads.quote_walk(posts, posts, m.profiles).select("hash", "level", F.array_join(F.transform("path", lambda x: x.cast("string")), "/").alias("path"))


@query(f"{oracle('posts', 'profiles')}, {_EDGES}, seeds_ AS (SELECT hash FROM posts), {_WALK}, {_SUPPORTED} SELECT hash FROM supported")
def quote_support(m: Model) -> DataFrame:
    """Which posts get a hydrated text: those from which quotes lead to a post that quotes none."""
    posts = _arrays(m.posts)
    return threads.supported(posts, m.profiles, posts.select("hash"))


# a text with a quote in it is never too short
@query(f"""{_TO_PRE}, {_BODY}, {_EDGES}, seeds_ AS (SELECT DISTINCT hash FROM kept), {_WALK}, {_SUPPORTED},
 roots AS (SELECT s.hash, CASE WHEN s.hash NOT IN (SELECT hash FROM supported) THEN length(p.text) WHEN s.hash IN (SELECT hash FROM edges) THEN 99
   ELSE length({_TIDY.format('b.body || b.tail')}) END AS n
 FROM sib s JOIN pre USING (root, hash) JOIN posts p USING (hash) JOIN bodies b USING (hash) WHERE s.depth = 0)
 SELECT p.hash AS root, CASE WHEN r.n < 20 THEN 99 ELSE 1 END AS thread_status FROM posts p LEFT JOIN roots r USING (hash) WHERE p.hash = p.root_hash
   AND p.parent_hash IS NULL""")
def status_transition(m: Model) -> DataFrame:
    return threads.build(_arrays(m.posts), m.reactions, m.user_labels, m.profiles).select("root", "thread_status")


@query("SELECT lang, count(*) AS n_pending FROM documents WHERE text IS NOT NULL AND length(trim(text)) > 0 AND doc_id % 5 = 0 GROUP BY lang")
def pending_count(m: Model) -> DataFrame:
    posts = m.raw("documents").withColumn("embedding384", F.when(F.col("doc_id") % 5 != 0, F.array(F.lit(1))))
    return procedures.pending(posts).groupBy("lang").agg(F.count("*").alias("n_pending"))


@query(f"{oracle('posts')} SELECT status, count(*) AS n FROM ({_THREADS}) GROUP BY status")
def status_histogram(m: Model) -> DataFrame:
    return procedures.status_histogram(m.spark.sql(_THREADS.replace("FROM posts", "FROM {posts}"), posts=m.posts), "status")


@query("SELECT o_orderkey, CASE WHEN o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_quantity > 45) THEN 19 ELSE 1 END AS status FROM orders")
def status_by_keys(m: Model) -> DataFrame:
    """A status for the rows whose key is in a list."""
    rows = m.raw("orders").select("o_orderkey", F.lit(1).alias("status"))
    return state.set_status(rows, m.raw("lineitem").where("l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey")), 19, "o_orderkey", "status")


@query("""SELECT count(*) AS n_rows, CAST(sum(n) AS BIGINT) AS n_tokens, avg(n) AS mean_tokens FROM (SELECT len(regexp_extract_all(text,
   '[A-Za-z]+|[0-9]+|[^A-Za-z0-9\\s]')) AS n FROM documents)""")
def token_totals(m: Model) -> DataFrame:
    return tokens.total_tokens(m.raw("documents"), "text")


@query()
def token_counts_bpe(m: Model) -> DataFrame:
    """Byte-pair tokens by the SQL function; the merges are beyond SQL."""
    tokens.register(m.spark)
    return m.spark.sql("SELECT doc_id, token_count(text) AS n_tokens FROM {d}", d=m.raw("documents"))


@query("SELECT doc_id, CASE WHEN regexp_matches(text, '[0-9]{3}') THEN 1 ELSE 0 END AS hit FROM documents")
def regex_filter(m: Model) -> DataFrame:
    return m.raw("documents").select("doc_id", F.col("text").rlike("[0-9]{3}").cast("int").alias("hit"))


@query("""SELECT event_id, CASE WHEN event_id % 3 = 2 AND ts < TIMESTAMP '2024-01-15 00:00:00' - INTERVAL 5 MINUTE THEN 1
   ELSE event_id % 3 END AS status FROM events""")
def stale_reset(m: Model) -> DataFrame:
    rows = m.raw("events").select("event_id", (F.col("event_id") % 3).alias("status"), F.col("ts").alias("claimed_at"))
    return state.reset_stale(rows, 2, 1, F.expr("TIMESTAMP_NTZ '2024-01-15 00:00:00'")).select("event_id", "status")


@query(f"{oracle('posts')} SELECT hash, ts FROM ({_THREADS}) WHERE status = 0 AND spam = 2 ORDER BY ts, hash LIMIT 25")
def claim_batch(m: Model) -> DataFrame:
    rows = m.spark.sql(_THREADS.replace("FROM posts", "FROM {posts}"), posts=m.posts)
    return state.claim(rows, F.expr("status = 0 AND spam = 2"), [F.col("ts"), F.col("hash")], 25).select("hash", "ts")


@query("SELECT user_id, value, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1")
def upsert_update(m: Model) -> DataFrame:
    e = m.raw("events").select("user_id", "value", "event_id")
    return state.upsert(e.where("event_id % 2 = 0"), e.where("event_id % 2 = 1"), "user_id", "event_id")


@query("""SELECT p_partkey AS k, 'old' AS origin FROM part WHERE p_partkey % 2 = 0 UNION ALL SELECT DISTINCT l_partkey, 'new' FROM lineitem
   WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_partkey % 2 = 0)""")
def insert_ignore(m: Model) -> DataFrame:
    base = m.raw("part").where("p_partkey % 2 = 0").select(F.col("p_partkey").alias("k"), F.lit("old").alias("origin"))
    return state.insert_new(base, m.raw("lineitem").select(F.col("l_partkey").alias("k"), F.lit("new").alias("origin")), "k")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus FROM orders")
def keyed_merge(m: Model) -> DataFrame:
    o = m.raw("orders").select("o_orderkey", "o_orderstatus")
    return state.merge(o, o.where("o_orderkey % 4 = 0").select("o_orderkey", F.lit("X").alias("o_orderstatus")), "o_orderkey")


_EMBEDS = """CASE page_id % 5 WHEN 0 THEN '"[{''url'': ''' || url || '''}]"' WHEN 1 THEN '"[{''castId'': {''fid'': 1}}]"' WHEN 2 THEN '"[{bad"'
   WHEN 3 THEN '"[]"' ELSE '"[{''url'': ''' || url || '''}, {''castId'': {''fid'': 2}}]"' END"""


def _embeds(m: Model) -> DataFrame:
    u = F.col("url")
    is_ = lambda n: F.col("page_id") % 5 == n
    linked = lambda end: F.concat(F.lit("\"[{'url': '"), u, F.lit(end + ']"'))
    embeds = (
        F.when(is_(0), linked("'}")).when(is_(1), F.lit("\"[{'castId': {'fid': 1}}]\"")).when(is_(2), F.lit('"[{bad"'))
        .when(is_(3), F.lit('"[]"')).otherwise(linked("'}, {'castId': {'fid': 2}}"))
    )
    return m.raw("pages").select(F.col("page_id").alias("id"), embeds.alias("embeds"))


_HASHED = "'[{\"castId\": {\"fid\": 1, \"hash\": {\"type\": \"Buffer\", \"data\": [' || CAST(doc_id % 256 AS VARCHAR(9)) || ', 0, 255]}}}]'"


@query("SELECT doc_id, CASE WHEN doc_id % 3 <> 0 THEN lower(lpad(to_hex(doc_id % 256), 2, '0')) || '00ff' END AS hash FROM documents")
def embedded_hash(m: Model) -> DataFrame:
    """The bytes of a quoted post's hash out of nested JSON, or out of pseudo-JSON by a pattern."""
    d = m.raw("documents").select("doc_id", F.when(F.col("doc_id") % 3 != 0, F.expr(_HASHED)).otherwise("[{}]").alias("json"))
    loose = F.replace(F.replace("json", F.lit('"'), F.lit("'")), F.lit("'type': 'Buffer', "), F.lit(""))
    raw = F.when(F.col("doc_id") % 2 == 0, media.first_hash(F.col("json"))).otherwise(T.embedded_hash(loose))
    return d.select("doc_id", T.to_hex(raw).alias("hash"))


@query(f"""{oracle('posts', 'profiles')}, q AS (SELECT p.hash, p.text, o.text AS q_text, u.username FROM posts p
   LEFT JOIN posts o ON o.hash = p.quoted LEFT JOIN profiles u ON u.fid = o.fid)
 SELECT hash, md5(CASE WHEN q_text IS NULL THEN text ELSE concat(text, ' ', 'QUOTE:["', q_text, '" - @', username, ']') END) AS final_text FROM q
   WHERE q_text IS NOT NULL OR hash % 7 NOT IN (0, 2, 4)""")
def inline_quotes(m: Model) -> DataFrame:
    """The older form of quotes, over hashes of eight bytes written out in each post's embeds."""
    posts = m.posts
    size = [F.shiftrightunsigned("quoted", 8 * (7 - i)).bitwiseAND(F.lit(255)).cast("string") for i in range(8)]
    embeds = F.when(F.col("quoted").isNotNull(), F.concat(F.lit("\"[{'castId': {'hash': {'data': ["), F.array_join(F.array(*size), ", "), F.lit("]}}}]\"")))
    raw = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    own = posts.select("hash", "text", "quoted", embeds.alias("embeds"))
    sources = posts.select(raw("hash").alias("hash"), "fid", "text")
    found = own.join(sources.select(F.col("hash").alias("there")), raw("quoted") == F.col("there"), "left").where("there IS NOT NULL OR hash % 7 NOT IN (0, 2, 4)")
    return threads.inline_quotes(found.select("hash", "text", "embeds"), sources, m.profiles).select("hash", F.md5(F.col("final_text").cast("binary")).alias("final_text"))


_JSON = f"""raw AS (SELECT page_id AS id, {_EMBEDS} AS e FROM pages), fixed AS (SELECT id, replace(replace(replace(substring(e, 2, length(e) - 2),
   '''', '\"'), '\\\"', '\"'), '`', '''') AS j FROM raw WHERE e <> '\"[]\"')"""


@query(f"""WITH {_JSON} SELECT id, lower(json_extract_string(j, '$[0].url')) AS url FROM fixed WHERE json_valid(j) AND json_extract_string(j,
   '$[0].url') IS NOT NULL""")
def embeds_json_extract(m: Model) -> DataFrame:
    return media.embed_urls(_embeds(m)).select("id", F.explode("urls").alias("url"))


@query(f"""WITH {_JSON} SELECT id, json_valid(j) AND contains(j, 'castId') AS has_cast, CASE WHEN NOT json_valid(j) THEN 5 WHEN json_extract_string(j,
   '$[0].url') IS NOT NULL THEN 2 ELSE 1 END AS media_status FROM fixed""")
def media_status(m: Model) -> DataFrame:
    return media.embed_urls(_embeds(m)).select("id", "has_cast", "media_status")


@query("""SELECT p_partkey, CASE WHEN length(p_name) >= length(p_type) AND length(p_name) >= length(p_brand) THEN p_name
   WHEN length(p_type) >= length(p_brand) THEN p_type ELSE p_brand END AS title FROM part""")
def longest_of(m: Model) -> DataFrame:
    return m.raw("part").select("p_partkey", T.longest(F.col("p_name"), F.col("p_type"), F.col("p_brand")).alias("title"))


@query("SELECT doc_id, len(regexp_extract_all(text, '[A-Za-z]+|[0-9]+|[^A-Za-z0-9\\s]')) AS n_tokens FROM documents")
def token_counts(m: Model) -> DataFrame:
    return m.raw("documents").select("doc_id", T.pretoken_count(F.col("text")).cast("long").alias("n_tokens"))


_S = T.SPACE
_NORM = f"""regexp_replace(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(text, '')), '^@[a-z0-9_.-]+:[{_S}]*', ''),
   '@[a-z0-9_.-]+\\b', '', 'g'), 'https?://[^{_S}]+', '', 'g'), '[{_S}]+', ' ', 'g')), '[^\\p{{L}}\\p{{N}}_ #]', '', 'g')"""


@query(f"SELECT turn, conv_id, {_NORM} AS norm FROM conversations")
def lsh_normalize(m: Model) -> DataFrame:
    return m.raw("conversations").select("turn", "conv_id", T.normalise(F.col("text")).alias("norm"))


@query(f"""SELECT doc_id, len(list_distinct(list_transform(range(1, greatest(2, length(n) - 1)), lambda i: substring(n, i, 3)))) AS n_shingles
   FROM (SELECT doc_id, {_NORM} AS n FROM documents) WHERE length(n) >= 3""")
def shingle_counts(m: Model) -> DataFrame:
    norm = m.raw("documents").select("doc_id", T.normalise(F.col("text")).alias("norm")).where("length(norm) >= 3")
    return norm.select("doc_id", F.size(T.char_shingles(F.col("norm"))).cast("long").alias("n_shingles"))


@query(f"SELECT min(doc_id) AS first_id, count(*) AS n FROM (SELECT doc_id, {_NORM} AS norm FROM documents) GROUP BY norm HAVING count(*) > 1")
def exact_norm_dupes(m: Model) -> DataFrame:
    return m.raw("documents").groupBy(T.normalise(F.col("text")).alias("norm")).agg(F.min("doc_id").alias("first_id"), F.count("*").alias("n")).where("n > 1").drop("norm")


@query()
def minhash_bands(m: Model) -> DataFrame:
    """The production signatures' bands of every distinct text; hashes of the library's own, beyond SQL."""
    nodes = m.raw("documents").select(T.normalise(F.col("text")).alias("norm")).distinct().select(F.md5(F.col("norm").cast("binary")).alias("node"), "norm")
    return canonical.bands(canonical.signatures(nodes), 0.9)


@query()
def near_dupes(m: Model) -> DataFrame:
    """Leaders in order of time over MinHash bands; order and signatures are beyond SQL."""
    return canonical.canonicals(m.raw("documents").select(F.col("doc_id").alias("hash"), F.col("doc_id").alias("ts"), "text"))


@query(f"""SELECT count(*) AS n_total, count(DISTINCT norm) AS n_unique, count(*) - count(DISTINCT norm) AS n_duplicates,
   round(100.0 * (count(*) - count(DISTINCT norm)) / count(*), 4) AS rate FROM (SELECT {_NORM} AS norm FROM documents)""")
def canonical_report(m: Model) -> DataFrame:
    norm = m.raw("documents").select("doc_id", T.normalise(F.col("text")).alias("norm"))
    firsts = norm.groupBy("norm").agg(F.min("doc_id").alias("canonical_hash"))
    return canonical.report(norm.join(firsts, "norm"))


@query(f"""SELECT min(doc_id) AS canonical_hash, count(*) AS n, max(doc_id) * 60 AS last_ts, min(doc_id) * 60 AS first_ts FROM (SELECT doc_id,
   {_NORM} AS norm FROM documents) GROUP BY norm HAVING count(*) > 1 ORDER BY n DESC, canonical_hash LIMIT 10""")
def largest_groups(m: Model) -> DataFrame:
    """The ten largest groups of equal texts: the report's feature."""
    norm = m.raw("documents").select("doc_id", (F.col("doc_id") * 60).alias("ts"), T.normalise(F.col("text")).alias("norm"))
    firsts = norm.groupBy("norm").agg(F.min("doc_id").alias("canonical_hash"))
    return canonical.largest(norm.join(firsts, "norm"), 10)


@query("""WITH s AS (SELECT max(list_max(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE))))) / 127 AS scale FROM embeddings) SELECT vec_id,
   array_to_string(list_transform(embedding, lambda x: CAST(greatest(-128, least(127, round_even(CAST(x AS DOUBLE) / scale, 0))) AS INT)), ',') AS q
   FROM embeddings, s""")
def quantize_int8(m: Model) -> DataFrame:
    return V.quantise(m.raw("embeddings"), "embedding").select("vec_id", F.array_join(F.transform("quantised", lambda x: x.cast("string")), ",").alias("q"))


@query("""WITH s AS (SELECT max(list_max(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE))))) / 127 AS scale FROM embeddings),
   q AS (SELECT list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, list_transform(embedding, lambda x: scale * greatest(-128, least(127,
   round_even(CAST(x AS DOUBLE) / scale, 0)))) AS w FROM embeddings, s)
 SELECT round(avg(list_cosine_similarity(v, w)), 6) AS fidelity FROM q""")
def quantize_fidelity(m: Model) -> DataFrame:
    q = V.quantise(m.raw("embeddings"), "embedding")
    return q.agg(F.round(F.avg(V.fidelity(F.col("embedding"), F.col("quantised"), F.col("scale"))), 6).alias("fidelity"))


@query("SELECT vec_id, array_to_string(list_transform(embedding, lambda x: CASE WHEN x > 0 THEN '1' ELSE '0' END), '') AS bits FROM embeddings")
def pack_bits(m: Model) -> DataFrame:
    return m.raw("embeddings").select("vec_id", V.signs(F.col("embedding")).alias("bits"))


@query("""SELECT q_id, vec_id, distance FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY distance, vec_id) AS rn
   FROM (SELECT q.vec_id AS q_id, e.vec_id, list_sum(list_transform(range(1, 65), lambda i: CASE
   WHEN (q.embedding[i] > 0) <> (e.embedding[i] > 0) THEN 1 ELSE 0 END)) AS distance
 FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id)) WHERE rn <= 10""")
def hamming_topk(m: Model) -> DataFrame:
    """Every hundredth vector against all rows, in blocks of queries."""
    e = m.raw("embeddings").select("vec_id", "embedding")
    return V.nearest(e, "vec_id", "embedding", e.where("vec_id % 100 = 0"), 10, "hamming").select("q_id", "vec_id", F.col("distance").cast("long").alias("distance"))


@query("""SELECT q_id, rn, round(sim, 5) AS sim FROM (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY sim DESC, vec_id) AS rn
   FROM (SELECT q.vec_id AS q_id, e.vec_id, list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(e.embedding AS DOUBLE[])) AS sim
 FROM embeddings q, embeddings e WHERE q.vec_id % 100 = 0 AND q.vec_id <> e.vec_id)) WHERE rn <= 10""")
def cosine_topk(m: Model) -> DataFrame:
    e = m.raw("embeddings").select("vec_id", "embedding")
    near = V.nearest(e, "vec_id", "embedding", e.where("vec_id % 100 = 0"), 10)
    return near.select("q_id", F.col("rank").cast("long").alias("rn"), F.round(1 - F.col("distance"), 5).alias("sim"))


@query(f"""{oracle('posts')}, t AS (SELECT root_hash, list(DISTINCT fid) AS fids FROM posts GROUP BY root_hash) SELECT root_hash FROM t
   WHERE list_contains(fids, 7)""")
def author_threads(m: Model) -> DataFrame:
    """Threads in which an author takes part: the containment test on the authors of a thread, as a filter before the set is made."""
    return threads.of_author(m.posts, 7)


@query("""SELECT label, size, string_agg(t, chr(10) || chr(10) || repeat('-', 20) || chr(10) || chr(10) ORDER BY vec_id) AS sample FROM (SELECT label,
   vec_id, 'v' || vec_id AS t, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn, count(*) OVER (PARTITION BY label) AS size
   FROM embeddings WHERE label >= 0) WHERE rn <= 40 GROUP BY ALL""")
def cluster_samples(m: Model) -> DataFrame:
    e = m.raw("embeddings").select("label", "vec_id", F.concat(F.lit("v"), F.col("vec_id").cast("string")).alias("t"))
    return clusters.samples(e, "label", "vec_id", "t")


@query()
def kmeans(m: Model) -> DataFrame:
    """Clusters of the library's own; which is which is not fixed by SQL."""
    return clusters.kmeans(m.raw("embeddings").select("vec_id", "embedding"), "embedding").select("vec_id", "cluster")


@query("SELECT label, count(*) AS n, (SELECT avg(CASE WHEN label < 0 THEN 1.0 ELSE 0.0 END) * 100 FROM embeddings) AS noise FROM embeddings GROUP BY label")
def cluster_report(m: Model) -> DataFrame:
    return clusters.cluster_report(m.raw("embeddings").select("label"), "label")


@query()
def density_clusters(m: Model) -> DataFrame:
    """Density clusters of all vectors, on the driver."""
    return clusters.density(m.raw("embeddings"), "vec_id", "embedding", least=30, samples=2)


@query()
def communities(m: Model) -> DataFrame:
    """Label propagation over the graph of 15 nearest neighbours of every vector."""
    return clusters.communities(clusters.neighbour_graph(m.raw("embeddings"), "vec_id", "embedding", 15))


@query("SELECT doc_id, source FROM documents WHERE lang = 'en' ORDER BY source, doc_id LIMIT 100 OFFSET 200")
def export_page(m: Model) -> DataFrame:
    return export.page(m.raw("documents").where("lang = 'en'").select("doc_id", "source"), ["source", "doc_id"], 2, 100)


_ANSWER = """CASE WHEN doc_id % 6 = 5 THEN 'Sure, here it is:' || chr(10) ELSE '  ' END
 || CASE doc_id % 4 WHEN 0 THEN 'Thread_Type: advice-giving' WHEN 1 THEN 'thread_type: discussion'
   WHEN 2 THEN '- thread_type :  Noise ' || chr(10) || 'thread_type: life-update' ELSE 'my thread_type is: market-alert' END || chr(10)
 || CASE doc_id % 3 WHEN 0 THEN 'value_exchange:none' WHEN 1 THEN 'VALUE_EXCHANGE: Social-Capital' ELSE 'value_exchange none' END
 || CASE WHEN doc_id % 5 = 0 THEN '' ELSE chr(10) || 'interaction_pattern: debate' || CASE WHEN doc_id % 5 = 1 THEN ' or so' ELSE '' END END"""


def _label_sql(key: str, before: tuple[str, ...]) -> str:
    mine = " AND ".join([f"contains(x, '{key}')", "contains(x, ':')", *(f"NOT contains(x, '{b}')" for b in before)])
    known = ", ".join(f"'{v}'" for v in T.LABELS[key])
    value = "trim(substring(x, instr(x, ':') + 1), chr(32) || chr(9) || chr(13))"
    return f"list_extract(list_filter(list_transform(list_filter(lines, lambda x: {mine}), lambda x: {value}), lambda v: v IN ({known})), -1) AS {key}"


_FOUND = ", ".join(_label_sql(k, tuple(T.LABELS)[:i]) for i, k in enumerate(T.LABELS))
_LABELLED = f"""lines AS (SELECT doc_id, string_split(lower(trim(answer, chr(32) || chr(9) || chr(10) || chr(13))), chr(10)) AS lines FROM answers),
 found AS (SELECT doc_id, {_FOUND} FROM lines)"""


@query(f"""WITH answers AS (SELECT doc_id, {_ANSWER} AS answer FROM documents), {_LABELLED} SELECT *, CASE
   WHEN thread_type IS NULL OR value_exchange IS NULL OR interaction_pattern IS NULL THEN 10 ELSE 12 END AS status FROM found""")
def label_parse(m: Model) -> DataFrame:
    answers = m.raw("documents").select("doc_id", F.expr(_ANSWER).alias("answer"))
    found = T.parse_labels(F.col("answer"))
    out = answers.select("doc_id", *[c.alias(k) for k, c in found.items()])
    return out.withColumn("status", F.when(F.concat(*found).isNull(), 10).otherwise(12))


@query("SELECT doc_id, length(text) AS n FROM documents WHERE length(trim(text)) > 0")
def label_prompt(m: Model) -> DataFrame:
    """The length of the thread inside each prompt; blank texts are asked nothing."""
    asked = m.raw("documents").select("doc_id", T.prompt(F.col("text"), template="{labels}{answer}|{text}").alias("p")).where("p IS NOT NULL")
    frame = T.prompt(F.lit("x"), template="{labels}{answer}|{text}")
    return asked.select("doc_id", (F.length("p") - F.length(frame) + 1).alias("n"))


@query()
def label_rules(m: Model) -> DataFrame:
    """The rule-based classifier over whole texts; Python code, beyond SQL."""
    return classify.classify(m.raw("documents").select(F.col("doc_id").alias("hash"), "text"))


# fixed fields of a catalogue document, made of a page's columns
_DOCUMENT = """'{"frames_url": ' || CASE WHEN page_id % 13 = 5 THEN 'null' ELSE '"' || url || '"' END || ', "title": "' || repeat('t',
   CAST(page_id % 5 AS INT)) || '", "manifest": {"frame": {"name": "name' || CAST(page_id % 3 AS VARCHAR(9))
 || '", "title": ' || CASE WHEN page_id % 4 = 1 THEN '"a much longer title"' ELSE 'null' END || ', "tags": ' || CASE page_id % 4 WHEN 0 THEN '[]'
   WHEN 1 THEN '["a", "", 7, null]' WHEN 2 THEN 'null' ELSE '"no list"' END
 || ', "primary_category": ' || CASE WHEN page_id % 3 = 0 THEN '"games"'
   ELSE 'null' END || '}}, "metadata": {"html": {"ogTitle": "og' || CAST(page_id % 1000 AS VARCHAR(9)) || '", "ogDescription": "' || repeat('d',
   CAST(page_id % 2 AS INT)) || '"}}}'"""
_LONGEST = """list_reduce(list_prepend(NULL::VARCHAR, list_filter([{0}], lambda x: x IS NOT NULL AND length(x) > 0)), lambda a, b: CASE
   WHEN a IS NULL OR length(b) > length(a) THEN b ELSE a END)"""


@query(f"""WITH raw AS (SELECT page_id, CAST({_DOCUMENT} AS JSON) AS j FROM pages), fields AS (SELECT page_id, j->>'$.frames_url' AS frames_url,
   j->>'$.manifest.frame.name' AS a, j->>'$.manifest.frame.title' AS b,
 j->>'$.metadata.html.ogTitle' AS c, j->>'$.title' AS d, j->>'$.metadata.html.ogDescription' AS e, j->>'$.manifest.frame.primary_category' AS f FROM raw)
 SELECT frames_url, {_LONGEST.format('a, b, c, d')} AS title, nullif(e, '') AS description, CASE WHEN page_id % 4 = 1 THEN 'a,7' ELSE coalesce(f,
   '') END AS tags FROM fields WHERE frames_url IS NOT NULL""")
def catalog_flatten(m: Model) -> DataFrame:
    raw = m.raw("pages").select(F.expr(_DOCUMENT).alias("raw"))
    return media.catalog_rows(raw).select("frames_url", "title", "description", F.array_join("tags", ",").alias("tags"))


@query("""SELECT event_type, count(*) AS n, round(avg(value), 6) AS mean_value, quantile_cont(value, 0.95) AS p95, min(value) AS low,
   max(value) AS high FROM events GROUP BY event_type""")
def metric_summary(m: Model) -> DataFrame:
    return state.summary(m.raw("events"), "event_type", "value")


@query("SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def daily_events(m: Model) -> DataFrame:
    return posts_stream.daily_counts(m.raw("events")).select(F.to_date("day").alias("day"), "event_type", "n")


@query(f"{oracle('posts')} SELECT hash FROM posts WHERE list_contains([mentioned, mentioned2], 10)")
def mentions_of(m: Model) -> DataFrame:
    """Posts that mention an author: containment in an array."""
    return _arrays(m.posts).where(F.array_contains("mentions", F.lit(10).cast("bigint"))).select("hash")


@query(f"{oracle('posts', 'reactions', 'user_labels')}, {_COUNTS} SELECT hash, round(n_reactions / (SELECT count(*) FROM reactions), 9) AS share FROM counts")
def reaction_share(m: Model) -> DataFrame:
    """Each post's share of all reactions, these counted by a scalar subquery."""
    total = m.reactions.agg(F.count("*")).scalar()
    return threads.reaction_counts(m.reactions, m.user_labels).select("hash", F.round(F.col("n_reactions") / total, 9).alias("share"))


@query("SELECT event_type, round(epoch(max(ts) - min(ts)), 2) AS elapsed FROM events GROUP BY event_type")
def batch_elapsed(m: Model) -> DataFrame:
    """Seconds from the first to the last event of each kind."""
    return m.raw("events").groupBy("event_type").agg(state.elapsed(F.min("ts"), F.max("ts")).alias("elapsed"))


@query("SELECT doc_id, upper(hex(encode(source))) AS digits, source AS back FROM documents")
def hex_round_trip(m: Model) -> DataFrame:
    digits = T.to_hex(F.encode("source", "UTF-8"))
    return m.raw("documents").select("doc_id", F.upper(digits).alias("digits"), F.decode(T.from_hex(digits), "UTF-8").alias("back"))
