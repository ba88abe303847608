"""Small forests with results worked out by hand: trees, pruning, quotes, mentions, links, statuses."""

import pytest
from pyspark.sql import functions as F

from skeinworks.functions import text as T
from skeinworks.functions import vectors as V
from skeinworks.operators import threads

POST = "hash long, parent_hash long, root_hash long, fid long, text string, mentions array<long>, positions array<int>, quotes array<long>, urls array<string>"
NAMES = [(1, "alice"), (2, "bob"), (3, "carol"), (5, "dave")]
LABELS = [(1, "spam", "2"), (2, "spam", "2"), (3, "spam", "0"), (5, "trust", "2"), (5, "trust", "2"), (3, "trust", "x")]


def post(hash_, parent, fid, text, root=1, mentions=(), positions=(), quotes=(), urls=()):
    return (hash_, parent, root, fid, text, list(mentions), list(positions), list(quotes), list(urls))


@pytest.fixture(scope="module")
def world(spark):
    def make(posts, reactions=()):
        return (
            spark.createDataFrame(posts, POST), spark.createDataFrame(list(reactions), "fid long, target_hash long, reaction_type int"),
            spark.createDataFrame(LABELS, "target_fid long, label_type string, label_value string"), spark.createDataFrame(NAMES, "fid long, username string"),
        )

    return make


def built(world, posts, reactions=(), **options):
    return {r.root: r for r in threads.build(*world(posts, reactions), **options).collect()}


TREE = [
    post(1, None, 1, "Hello everyone, welcome to my thread"), post(2, 1, 2, "This is a long enough reply from bob"), post(3, 1, 3, "short"),
    post(4, 3, 1, "Thanks carol, that is very kind of you"), post(5, 1, 4, "ghost reply that nobody can ever see"),
    post(6, 5, 2, "child of the ghost, also long enough"), post(7, 1, 5, "nobody reacted to this long reply at all"),
]
LIKES = [(2, 1, 1), (5, 1, 1), (1, 2, 1), (3, 7, 1), (2, 6, 1), (5, 6, 1)]


def test_thread(world):
    r = built(world, TREE, LIKES)[1]
    assert r.blob.split("\n") == ["@alice: Hello everyone, welcome to my thread", "~1: @bob: This is a long enough reply from bob", "~2: @alice: Thanks carol, that is very kind of you"]
    assert (r.fids, r.reactions, r.thread_status) == ([1, 2], 3, 1)


def test_popularity_of_authors_is_of_their_own_posts(world):
    """dave's post has fewer reactions than its child, bob's; authors go by their own."""
    posts = [post(1, None, 1, "the root is long enough for all"), post(2, 1, 5, "a reply that is long enough by dave"), post(3, 2, 2, "an answer to it, also long enough")]
    likes = [(1, 3, 1), (2, 3, 1), (5, 3, 1), (1, 2, 1), (2, 1, 1), (5, 1, 1)]
    r = built(world, posts, likes)[1]
    assert r.fids == [2, 1, 5] and r.reactions == 6


def test_roots(world):
    ghost = built(world, [post(1, None, 4, "a root without a profile that is long")])[1]
    assert (ghost.blob, ghost.reactions, ghost.thread_status) == (None, 0, 1)
    for n, status in ((19, 99), (20, 1)):
        assert built(world, [post(1, None, 1, "x" * n)])[1].thread_status == status


def test_status_is_of_the_hydrated_text(world):
    short = built(world, [post(1, None, 1, "hello", mentions=[2], positions=[5], urls=["https://a.example/long/enough"])])[1]
    assert short.blob == "@alice: hello@bob https://a.example/long/enough" and short.thread_status == 1
    gone = built(world, [post(1, None, 1, "look https://warpcast.com/somebody/0xabcdef0123")])[1]
    assert gone.blob == "@alice: look " and gone.thread_status == 99


def test_depth(world):
    chain = [post(i, i - 1 if i > 1 else None, 1, f"a chain of posts, the number {i:02d}") for i in range(1, 14)]
    lines = built(world, chain)[1].blob.split("\n")
    assert len(lines) == 11 and lines[-1].startswith("~10: ")


def test_large_threads(world):
    posts = [post(1, None, 1, "the root of a large thread"), *(post(i, 1, 2, f"a reply that is long enough {i}") for i in (2, 3, 4))]
    r = built(world, posts, [(2, 1, 1), (1, 2, 1)], large=3)[1]
    assert r.blob == "@alice: the root of a large thread\n\n(thread too large: 4 replies)"
    assert (r.fids, r.reactions, r.thread_status) == ([1], 1, 1)
    assert built(world, posts, large=4)[1].blob.count("\n") == 0


def test_raw_fallback_is_left_raw(world):
    """A quote that leads nowhere: the text as it is, tags, line breaks and all."""
    text = "raw @x@x\n\n\ttext with an unknown quote"
    r = built(world, [post(1, None, 1, text, quotes=[99], mentions=[2], positions=[0])])[1]
    assert r.blob == f"@alice: {text}"


@pytest.mark.parametrize("n, kept", [(0, 0), (1, 1), (2, 2), (10, 2), (41, 3), (100, 5)])
def test_popularity_floor(spark, n, kept):
    nodes = spark.createDataFrame([(1, i, i % 7 + 1) for i in range(n)] or [(1, 0, 0)], "root long, hash long, n_reactions long")
    assert threads.popular(nodes).count() == kept


@pytest.mark.parametrize(
    "text, mentions, positions, want",
    [
        ("hey , how are you doing today?", [2], [4], "hey @bob, how are you doing today?"),
        ("é , salut à tous mes amis", [2], [3], "é @bob, salut à tous mes amis"),
        ("é , salut à tous mes amis", [2], [1], "é@bob , salut à tous mes amis"),
        ("😀x", [2], [2], "😀@bobx"),
        ("abc", [2], [99], "abc@bob"),
        ("hi  and  again", [2, 2], [3, 8], "hi @bob and  again"),
        ("hi  and  again", [2, 2], [8, 3], "hi @bob and  again"),
        ("two  here", [2, 1], [4, 4], "two @bob@alice here"),
        ("two  here", [1, 2], [4, 4], "two @alice@bob here"),
        ("a  b  c", [1, 2], [5, 2], "a @bob b @alice c"),
        ("x", [4], [0], "x"),
    ],
)
def test_mentions(world, text, mentions, positions, want):
    posts, _, _, profiles = world([post(1, None, 1, text, mentions=mentions, positions=positions)])
    assert threads.mentions_in(posts, profiles).first().body == want


def test_a_post_that_comes_twice(world):
    """Its tags are written in once."""
    posts, _, _, profiles = world([post(1, None, 1, "hi ", mentions=[2], positions=[3])] * 2)
    assert {r.body for r in threads.mentions_in(posts, profiles).collect()} == {"hi @bob"}


def test_links_and_clean_up(spark):
    def one(column):
        return spark.range(1).select(column).first()[0]

    urls = F.array(F.lit("https://b.org/2"), F.lit("https://a.org/1"), F.lit("https://a.org/1"))
    assert one(T.tail(F.lit("see it"), urls)) == " https://a.org/1 https://b.org/2"
    assert one(T.tail(F.lit("see HTTPS://A.org/1"), F.array(F.lit("https://a.org/1")))) == ""
    for text, want in (("hi @bob@bob", "hi @bob"), ("a\n\n\tb", "a b"), ("look https://warpcast.com/u/0xAbC1 ok", "look  ok"), ("at https://farcaster.xyz/u/0x12", "at "), ("https://other.xyz/u/0x12", "https://other.xyz/u/0x12")):
        assert one(T.tidy(F.lit(text))) == want


def hydration(world, posts, seeds=(1,)):
    p, _, _, profiles = world(posts)
    return {r.hash: r.hydrated for r in threads.hydrated(p, profiles, p.where(F.col("hash").isin(*seeds)).select("hash")).collect()}


def test_quotes(world):
    leaf = post(2, None, 2, "original words here", root=2)
    assert hydration(world, [post(1, None, 1, "look at this great post", quotes=[2]), leaf])[1] == 'look at this great post QUOTE:["original words here" - @bob]'
    linked = post(1, None, 1, "look at this great post", quotes=[2], urls=["https://x.org/a"])
    assert hydration(world, [linked, leaf])[1] == 'look at this great post QUOTE:["original words here" - @bob] https://x.org/a'
    chain = [post(i, None, 1, f"t{i}", root=i, quotes=[i + 1] if i < 4 else []) for i in range(1, 5)]
    assert hydration(world, chain)[1] == 't1 QUOTE:["t2 QUOTE:["t3 QUOTE:["t4" - @alice]" - @alice]" - @alice]'
    longer = [post(i, None, 1, f"t{i}", root=i, quotes=[i + 1] if i < 5 else []) for i in range(1, 6)]
    assert 1 not in hydration(world, longer)
    assert hydration(world, [post(1, None, 1, "a", quotes=[2]), post(2, None, 2, "b", root=2, quotes=[1])]) == {}


def test_quote_choice(world):
    two = [post(1, None, 1, "q", quotes=[3, 2]), post(2, None, 2, "small", root=2), post(3, None, 3, "large", root=3)]
    assert hydration(world, two)[1] == 'q QUOTE:["small" - @bob]'
    sooner = [post(1, None, 1, "q", quotes=[2, 3]), post(2, None, 2, "quoting", root=2, quotes=[4]), post(3, None, 3, "leaf", root=3), post(4, None, 3, "deep", root=4)]
    assert hydration(world, sooner)[1] == 'q QUOTE:["leaf" - @carol]'
    cycle = [post(1, None, 1, "a", quotes=[2, 3]), post(2, None, 2, "b", root=2, quotes=[1]), post(3, None, 3, "c", root=3)]
    assert hydration(world, cycle) == {1: 'a QUOTE:["c" - @carol]', 2: 'b QUOTE:["a QUOTE:["c" - @carol]" - @alice]', 3: "c"}


def test_long_chains_of_seeds(world):
    """Thirteen posts of a thread that quote each other: each seeds a walk of its own, and all are hydrated."""
    chain = [post(i, None, 1, f"t{i}", root=i, quotes=[i + 1] if i < 13 else []) for i in range(1, 14)]
    got = hydration(world, chain, range(1, 14))
    assert len(got) == 13 and got[1].count("QUOTE") == 12


def test_engagement(spark):
    posts = spark.createDataFrame([(10, None, 10, 1), (11, 10, 10, 1), (12, 10, 10, 2), (13, 10, 10, 3), (20, None, 20, 1), (21, 20, 20, 2)], "hash long, parent_hash long, root_hash long, fid long")
    reactions = spark.createDataFrame([(1, 10, 1), (3, 10, 1), (2, 10, 2), (5, 21, 1), (2, 99, 1)], "fid long, target_hash long, reaction_type int")
    labels = spark.createDataFrame(LABELS, "target_fid long, label_type string, label_value string")
    got = {r.hash: (r.like_count, r.recast_count, r.comment_count) for r in threads.engagement(posts, reactions, labels).collect()}
    assert got == {10: (1, 1, 2), 20: (0, 0, 1), 21: (2, 0, 0)}
    once = {r.hash: r.like_count for r in threads.engagement(posts, reactions, labels, dedupe_labels=True).collect()}
    assert once[21] == 1


def test_inline_quotes(spark):
    embeds = "\"[{'castId': {'fid': 3, 'hash': {'data': [10, 0, 255]}}}]\""
    posts = spark.createDataFrame([(1, "see this", embeds), (2, "see https://warpcast.com/b/0x0a00ffaabb now", embeds), (3, "none", None), (4, "lost", embeds.replace("255", "254"))], "hash long, text string, embeds string")
    sources = spark.createDataFrame([(bytearray([10, 0, 255]), 2, r"a $1 \ b")], "hash binary, fid long, text string")
    profiles = spark.createDataFrame(NAMES, "fid long, username string")
    got = {r.hash: r.final_text for r in threads.inline_quotes(posts, sources, profiles).collect()}
    quote = r'QUOTE:["a $1 \ b" - @bob]'
    assert got == {1: f"see this {quote}", 2: f"see {quote} now", 3: "none", 4: 'lost QUOTE:["" - @]'}


def test_vectors(spark):
    got = V.quantise(spark.createDataFrame([([0.6, -1.0],), ([0.25, 0.0],)], "v array<float>"), "v").collect()
    assert [list(r.quantised) for r in got] == [[76, -127], [32, 0]] and got[0].scale == pytest.approx(1 / 127)
    row = spark.createDataFrame([([176, 1], [1.0, -1.0, 0.0, 2.0, 1.0, 0.0, 0.0, 0.0], "[0.5, -2]")], "b array<int>, v array<float>, t string")
    r = row.select(V.bit_string(F.col("b")), V.signs(F.col("v")), V.packed(F.col("v")), V.unpacked(V.packed(F.col("v"))), V.parsed(F.col("t")), V.half(F.array(F.lit(0.1).cast("float"))), F.length(V.half_bytes(F.col("v")))).first()
    assert r[0] == "1011000000000001" and r[1] == "10011000" and bytes(r[2]) == b"\x98" and r[3] == "10011000" and r[4] == [0.5, -2.0] and r[5] == [pytest.approx(0.0999756)] and r[6] == 16
    assert row.select(V.checked(F.col("v"), 8)).first()[0] is not None
    with pytest.raises(Exception, match="8 values|of 9"):
        row.select(V.checked(F.col("v"), 9)).collect()
    pool = spark.range(1).select(V.mean_pool(F.array(F.array(F.lit(1.0), F.lit(3.0)), F.array(F.lit(5.0), F.lit(1.0)), F.array(F.lit(9.0), F.lit(9.0))), F.array(F.lit(1), F.lit(1), F.lit(0)))).first()[0]
    assert pool == [3.0, 2.0]


def test_normaliser(spark):
    cases = {
        "@Bob: Hello, WORLD! see https://x.y/z @amy #tag": "hello world see #tag", "": "", "@amy-": "-".replace("-", ""), "mail @a.b. now": "mail  now", "x@amyé y": "x@amyé y".replace("@", ""),
        "a b c": "a b c", "naïve — Ünïcode": "naïve  ünïcode", "ab\ncd": "ab cd",
    }
    rows = spark.createDataFrame([(k,) for k in cases], "t string").select("t", T.normalise(F.col("t")).alias("n"), T.char_shingles(T.normalise(F.col("t"))).alias("s")).collect()
    import re

    def plain(text):
        t = re.sub(r"^@[a-z0-9_.-]+:\s*", "", text.lower())
        t = re.sub(r"https?://\S+", "", re.sub(r"@[a-z0-9_.-]+\b", "", t))
        return re.sub(r"[^\w\s#]", "", re.sub(r"\s+", " ", t).strip())

    for r in rows:
        assert r.n == plain(r.t), r.t
    shingles = {k: set(spark.range(1).select(T.char_shingles(F.lit(k))).first()[0]) for k in ("ab", "a b", "", "abcd")}
    assert shingles == {"ab": {"ab"}, "a b": {"a b"}, "": {""}, "abcd": {"abc", "bcd"}}
