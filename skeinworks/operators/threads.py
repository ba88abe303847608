"""Reply trees: engagement, expansion, pruning, order, quotes, and the text of a thread.

Every operator works on all threads at once, keyed by the root; loops are as long as threads are deep (MAX_DEPTH), never as
long as there are rows. posts: hash, parent_hash, root_hash, fid, text. reactions: fid, target_hash, reaction_type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import cut

MAX_DEPTH, LARGE, MIN_TEXT = 10, 50_000, 20


def good_labels(labels: DataFrame) -> DataFrame:
    """fid of each label row of value 2, whatever its type; a user with several such rows comes several times."""
    return labels.where(F.expr("try_cast(label_value AS INT)") == 2).select(F.col("target_fid").alias("fid"))


def reaction_counts(reactions: DataFrame, labels: DataFrame) -> DataFrame:
    """hash, n_reactions: reactions of users with a good label, counted once however many label rows a user has."""
    good = reactions.join(good_labels(labels), "fid", "left_semi")
    return good.groupBy(F.col("target_hash").alias("hash")).agg(F.count("*").alias("n_reactions"))


def engagement(posts: DataFrame, reactions: DataFrame, labels: DataFrame, dedupe_labels: bool = False) -> DataFrame:
    """hash, root_hash, like_count, recast_count, comment_count of posts with any, by users with a good label.

    A user with two good label rows counts twice, unless dedupe_labels.
    """
    good = good_labels(labels)
    good = good.distinct() if dedupe_labels else good
    r = reactions.join(good, "fid").groupBy(F.col("target_hash").alias("hash")).agg(
        F.count_if(F.col("reaction_type") == 1).alias("like_count"), F.count_if(F.col("reaction_type") == 2).alias("recast_count")
    )
    c = posts.join(good, "fid").groupBy(F.col("parent_hash").alias("hash")).agg(F.count("*").alias("comment_count"))
    both = r.join(c, "hash", "full_outer")
    counts = [F.coalesce(x, F.lit(0)).alias(x) for x in ("like_count", "recast_count", "comment_count")]
    return both.join(posts.select("hash", "root_hash"), "hash").select("hash", "root_hash", *counts)


def root_status():
    """2 for a root, 1 for a reply."""
    return F.when((F.col("hash") == F.col("root_hash")) & F.col("parent_hash").isNull(), 2).otherwise(1)


def roots_and_replies(posts: DataFrame) -> DataFrame:
    """hash, threads_status."""
    return posts.select("hash", root_status().alias("threads_status"))


def tree(posts: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """root, hash, parent_hash, fid, depth, path of each post that its root reaches.

    A join by level; replies are dealt out by their parent once, so that each level shuffles its own posts only. Each level is written
    once; the deepest thread ends the loop.
    """
    spark = posts.sparkSession
    root = posts.where("parent_hash IS NULL AND hash = root_hash")
    at = cut(root.select(F.col("hash").alias("root"), "hash", "parent_hash", "fid", F.lit(0).alias("depth"), F.array("hash").alias("path")))
    child = posts.where("parent_hash IS NOT NULL").select(F.col("hash").alias("child"), F.col("parent_hash").alias("parent"), F.col("fid").alias("child_fid"))
    child = cut(child.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "parent"))
    out = at
    for depth in range(1, max_depth + 1):
        at = at.join(child, F.col("hash") == F.col("parent")).select(
            "root", F.col("child").alias("hash"), F.col("parent").alias("parent_hash"), F.col("child_fid").alias("fid"),
            F.lit(depth).alias("depth"), F.array_append("path", F.col("child")).alias("path"),
        )
        at = cut(at)
        if at.isEmpty():
            break
        out = out.unionAll(at)
    return out


def enriched(tree_: DataFrame, profiles: DataFrame, counts: DataFrame) -> DataFrame:
    """With username and n_reactions; posts without a profile go."""
    return cut(tree_.join(profiles, "fid").join(counts, "hash", "left").withColumn("n_reactions", F.coalesce("n_reactions", F.lit(0))))


def popular(nodes: DataFrame, floor: int = 2) -> DataFrame:
    """Of each root's posts with reactions, the first twentieth, `floor` at least."""
    w = Window.partitionBy("root")
    ranked = nodes.where("n_reactions > 0").withColumn("rn", F.row_number().over(w.orderBy(F.desc("n_reactions"), "hash"))).withColumn("n", F.count("*").over(w))
    return ranked.where(F.col("rn") <= F.greatest(F.lit(floor), F.ceil(F.col("n") * 0.05))).select("root", "hash", "n_reactions", "rn")


def kept(nodes: DataFrame, reactions: DataFrame, floor: int = 2) -> DataFrame:
    """The nodes that stay: the author's own, those the author reacted to, the popular, and all on the way to them."""
    op = nodes.where("depth = 0").select("root", F.col("fid").alias("op_fid"))
    own = nodes.join(op, "root").where("fid = op_fid").select("root", "hash")
    liked = nodes.join(op, "root").join(reactions.select(F.col("fid").alias("op_fid"), F.col("target_hash").alias("hash")), ["op_fid", "hash"], "left_semi").select("root", "hash")
    seeds = own.union(liked).union(popular(nodes, floor).select("root", "hash")).distinct()
    way = nodes.join(seeds, ["root", "hash"], "left_semi").select("root", F.explode("path").alias("hash")).distinct()
    return cut(nodes.join(way, ["root", "hash"], "left_semi"))


def subtree_popularity(kept_: DataFrame) -> DataFrame:
    """root, hash, popularity: the most reactions among kept posts below, itself included. Linear in path lengths."""
    below = kept_.select("root", "n_reactions", F.explode("path").alias("hash")).groupBy("root", "hash").agg(F.max("n_reactions").alias("popularity"))
    return kept_.select("root", "hash").join(below, ["root", "hash"])


def sibling_rank(kept_: DataFrame) -> DataFrame:
    w = Window.partitionBy("root", "parent_hash").orderBy(F.desc_nulls_last("popularity"), "hash")
    return cut(kept_.join(subtree_popularity(kept_), ["root", "hash"]).withColumn("sibling", F.row_number().over(w)))


def preorder(kept_: DataFrame, max_depth: int = MAX_DEPTH) -> DataFrame:
    """Kept posts whose whole way is kept, with `position`: the padded sibling ranks along the path; it sorts a thread in preorder."""
    ranked = sibling_rank(kept_)
    step = ranked.select("root", F.col("hash").alias("anc"), F.lpad(F.col("sibling").cast("string"), 9, "0").alias("code"))
    on_way = ranked.select("root", "hash", F.size("path").alias("n"), F.posexplode("path").alias("i", "anc")).join(step, ["root", "anc"])
    paths = on_way.groupBy("root", "hash", "n").agg(F.sort_array(F.collect_list(F.struct("i", "code"))).alias("codes")).where(F.size("codes") == F.col("n"))
    return ranked.join(paths.select("root", "hash", F.array_join(F.transform("codes", lambda c: c["code"]), ".").alias("position")), ["root", "hash"])


def thread_sizes(posts: DataFrame) -> DataFrame:
    """root, n_posts, root_fid, root_text: posts that name the root, or are it (two equal joins in place of an OR), and the root's own."""
    by_root = posts.where("root_hash IS NOT NULL").select(F.col("root_hash").alias("root"), "hash", "fid", "text")
    both = by_root.union(posts.where("root_hash IS NULL OR root_hash <> hash").select(F.col("hash").alias("root"), "hash", "fid", "text"))
    its = F.col("hash") == F.col("root")
    return both.groupBy("root").agg(F.count("*").alias("n_posts"), F.max(F.when(its, F.col("fid"))).alias("root_fid"), F.max(F.when(its, F.col("text"))).alias("root_text"))


def mentions_in(posts: DataFrame, profiles: DataFrame) -> DataFrame:
    """The posts with `tags` and `body`: the text with @username at each mention's byte offset. posts: hash, text, mentions,
    positions (arrays). A name is written in once a post, at its first place, even if the post comes twice; texts are shuffled once, to
    meet their tags."""
    place = F.transform(F.arrays_zip("mentions", "positions"), lambda m, i: F.struct(m["mentions"].alias("fid"), T.byte_to_char(F.col("text"), m["positions"]).alias("pos"), i.alias("i")))
    each = posts.where(F.size("mentions") > 0).select("hash", F.explode(place).alias("m")).select("hash", "m.*")
    tags = each.join(profiles, "fid").withColumn("tag", F.concat(F.lit("@"), "username")).groupBy("hash", "tag").agg(F.min(F.struct("pos", "i")).alias("at"))
    sorted_ = F.sort_array(F.collect_list(F.struct(F.col("at.pos").alias("pos"), F.col("at.i").alias("i"), "tag")))
    both = posts.join(tags.groupBy("hash").agg(sorted_.alias("tags")), "hash", "left")
    return both.withColumn("body", F.when(F.col("tags").isNull(), F.col("text")).otherwise(T.inject(F.col("text"), F.col("tags"))))


def quote_walk(seeds: DataFrame, posts: DataFrame, profiles: DataFrame, levels: int = 3) -> DataFrame:
    """hash, quoted, level, path of posts on quote chains from the seeds (hash); no post twice on a chain, each with a profile. posts: hash, fid, quotes (array)."""
    # whoever is on a chain is looked up, never all posts
    known = lambda d: d.join(posts.select("hash", "fid", "quotes"), "hash").join(profiles, "fid")
    at = cut(known(seeds.select("hash").distinct()).select("hash", "quotes", "username", F.lit(0).alias("level"), F.array("hash").alias("path")))
    out = at
    for level in range(1, levels + 1):
        to = at.select("path", F.explode(F.array_distinct("quotes")).alias("hash")).where(~F.array_contains("path", F.col("hash")))
        at = cut(known(to).select("hash", "quotes", "username", F.lit(level).alias("level"), F.array_append("path", F.col("hash")).alias("path")))
        out = out.unionAll(at)
    return out


def quote_texts(walk: DataFrame, bodies: DataFrame) -> DataFrame:
    """hash, hydrated: texts with their quotes written in, from the leaves up; the first round in which a quoted post is done decides,
    within it the smallest hash. Posts that no leaf supports have no row. Each round adds a post or is the last. bodies: hash, body, tail."""
    nodes = cut(walk.groupBy("hash").agg(F.first("quotes").alias("quotes"), F.first("username").alias("username")).join(bodies, "hash"))
    quoting = F.col("quotes").isNotNull() & (F.size("quotes") > 0)
    done = nodes.where(~quoting).select("hash", F.concat("body", "tail").alias("hydrated"), "username")
    edges = nodes.where(quoting).select("hash", F.explode(F.array_distinct("quotes")).alias("child"))
    while True:
        ready = edges.join(done.select("hash"), "hash", "left_anti").join(done.select(F.col("hash").alias("child"), "hydrated", F.col("username").alias("by")), "child")
        first = ready.groupBy("hash").agg(F.min_by(F.struct("hydrated", "by"), "child").alias("q"))
        new = nodes.join(first, "hash").select("hash", F.concat_ws("", "body", F.lit(' QUOTE:["'), "q.hydrated", F.lit('" - @'), "q.by", F.lit("]"), "tail").alias("hydrated"), "username")
        new = cut(new)
        if new.isEmpty():
            break
        done = done.unionAll(new)
    return done.select("hash", "hydrated")


def blobs(order: DataFrame, min_text: int = MIN_TEXT) -> DataFrame:
    """root, blob, fids, reactions. order: preorder rows with `final_text`; short replies are left out of all three.

    fids: authors by the reactions of the best of their own shown posts. A root's rows meet in one task; see LARGE.
    """
    shown = order.where((F.col("depth") == 0) | (F.length("final_text") >= min_text))
    row = F.struct("position", T.line(F.col("depth"), F.col("username"), F.col("final_text")).alias("line"))
    by_fid = shown.groupBy("root", "fid").agg(F.max("n_reactions").alias("p"))
    ranked = F.sort_array(F.collect_list(F.struct((-F.col("p")).alias("p"), "fid")))
    fids = by_fid.groupBy("root").agg(F.transform(ranked, lambda x: x["fid"]).alias("fids"))
    lines = F.transform(F.sort_array(F.collect_list(row)), lambda x: x["line"])
    return shown.groupBy("root").agg(F.array_join(lines, "\n").alias("blob"), F.sum("n_reactions").alias("reactions")).join(fids, "root")


def status_after(root_text):
    """99 for root texts under the least length, else 1; a root without a text, which has no profile, counts as built."""
    return F.when(F.length(root_text) < MIN_TEXT, 99).otherwise(1)


def hydrated(posts: DataFrame, profiles: DataFrame, seeds: DataFrame) -> DataFrame:
    """hash, hydrated: the seeds' texts, and those they quote, with mentions, quotes and urls; raw texts have no row."""
    return _hydrated(*_walked(posts, profiles, seeds), profiles)


def _walked(posts: DataFrame, profiles: DataFrame, seeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The quote walk, and the posts on it, written once."""
    walk = quote_walk(seeds, posts, profiles)
    return walk, cut(posts.join(walk.select("hash").distinct(), "hash", "left_semi"))


def _hydrated(walk: DataFrame, some: DataFrame, profiles: DataFrame) -> DataFrame:
    tail = T.tail(F.col("text"), F.coalesce("urls", F.array().cast("array<string>"))).alias("tail")
    texts = quote_texts(walk, mentions_in(some, profiles).select("hash", "body", tail))
    return texts.select("hash", T.tidy(F.col("hydrated")).alias("hydrated"))


def supported(posts: DataFrame, profiles: DataFrame, seeds: DataFrame, levels: int = 3) -> DataFrame:
    """hash of the posts that have a row in hydrated(): those of the walk from which quotes lead to a post that quotes none. No text and no
    path is read or shuffled: a post is on the walk if it is within reach, by whichever chain."""
    quotes = F.coalesce(F.array_distinct("quotes"), F.array().cast(posts.schema["quotes"].dataType)).alias("quotes")
    known = posts.select("hash", "fid", quotes).join(profiles, "fid", "left_semi").select("hash", "quotes")
    nodes = at = cut(known.join(seeds, "hash", "left_semi"))
    for _ in range(levels):
        to = at.select(F.explode("quotes").alias("hash")).distinct().join(nodes, "hash", "left_anti")
        at = cut(known.join(to, "hash", "left_semi"))
        if at.isEmpty():
            break
        nodes = nodes.unionAll(at)
    edges = nodes.select("hash", F.explode("quotes").alias("child"))
    done = new = cut(nodes.where(F.size("quotes") == 0).select("hash").distinct())
    while True:
        above = edges.join(new.withColumnRenamed("hash", "child"), "child", "left_semi").select("hash").distinct()
        new = cut(above.join(done, "hash", "left_anti"))
        if new.isEmpty():
            return done
        done = done.unionAll(new)


def build(
    posts: DataFrame, reactions: DataFrame, labels: DataFrame, profiles: DataFrame, roots: DataFrame | None = None,
    large: int = LARGE, floor: int = 2, count=T.pretoken_count,
) -> DataFrame:
    """root, blob, fids, reactions, tokens, thread_status of every root, or of those given (hash). posts also: mentions, positions, quotes, urls (arrays).

    Threads of more than `large` posts get their root's text and a note. count: a text's number of tokens, as a column function.
    """
    own = posts.where("parent_hash IS NULL AND hash = root_hash").select("hash")
    roots = own if roots is None else roots.select("hash")
    some = posts.join(roots.select(F.col("hash").alias("root_hash")), "root_hash", "left_semi")
    reactions = reactions.join(some.select(F.col("hash").alias("target_hash")), "target_hash", "left_semi")
    counts = reaction_counts(reactions, labels)
    # sizes need no texts; those of large threads' roots are looked up
    sizes = thread_sizes(some.withColumn("text", F.lit(None).cast("string"))).drop("root_text")
    big = cut(sizes.where(F.col("n_posts") > large))
    texts = some.join(big.select(F.col("root").alias("hash")), "hash", "left_semi").groupBy(F.col("hash").alias("root")).agg(F.max("text").alias("root_text"))
    big = cut(big.join(texts, "root", "left"))
    small = some.join(big, some.root_hash == big.root, "left_anti")
    keep = kept(enriched(tree(small), profiles, counts), reactions, floor)
    # kept posts have a profile, so that all of them are on the walk
    walk, on_it = _walked(posts, profiles, keep.select("hash"))
    order = preorder(keep).join(_hydrated(walk, on_it, profiles), "hash", "left").join(on_it.select("hash", "text"), "hash")
    order = cut(order.withColumn("final_text", F.coalesce("hydrated", "text")))
    made = blobs(order).join(order.where("depth = 0").select("root", F.col("final_text").alias("root_text")), "root")
    note = F.concat_ws("", F.lit("@"), "username", F.lit(": "), "root_text", F.lit("\n\n(thread too large: "), F.col("n_posts").cast("string"), F.lit(" replies)"))
    named = big.join(profiles.withColumnRenamed("fid", "root_fid"), "root_fid", "left").join(counts.withColumnRenamed("hash", "root"), "root", "left")
    summary = named.select("root", note.alias("blob"), F.coalesce("n_reactions", F.lit(0)).alias("reactions"), F.array("root_fid").alias("fids"), "root_text")
    all_ = made.select("root", "blob", "reactions", "fids", "root_text").unionByName(summary)
    return roots.select(F.col("hash").alias("root")).join(all_, "root", "left").select(
        "root", "blob", "fids", F.coalesce("reactions", F.lit(0)).alias("reactions"), count(F.col("blob")).alias("tokens"), status_after(F.col("root_text")).alias("thread_status"),
    )


def of_author(posts: DataFrame, fid: int) -> DataFrame:
    """root_hash of the threads in which an author takes part."""
    return posts.where(F.col("fid") == fid).select("root_hash").distinct()


def inline_quotes(posts: DataFrame, sources: DataFrame, profiles: DataFrame) -> DataFrame:
    """hash, final_text: the older, flat form. The first quoted post's hash stands as a list of bytes in `embeds`; its text and author
    take the place of links to posts, or come at the end. posts: hash, text, embeds. sources: hash (binary), fid, text."""
    quoted = posts.withColumn("quoted", T.embedded_hash(F.col("embeds")))
    named = sources.join(profiles, "fid", "left").select(F.col("hash").alias("quoted"), F.col("text").alias("q_text"), F.col("username").alias("q_name"))
    q = F.concat_ws("", F.lit('QUOTE:["'), "q_text", F.lit('" - @'), "q_name", F.lit("]"))
    both = quoted.join(named, "quoted", "left").withColumn("q", F.when(F.col("embeds").contains("castId"), q))
    return both.select("hash", T.with_quote(F.col("text"), F.col("q")).alias("final_text"))
