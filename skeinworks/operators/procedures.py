"""The batch procedures over a store's tables: claim, compute, apply, until nothing is left.

Each returns the rows of each batch. A batch is the first rows in order of time (then hash); `as_of` stands for the clock. A batch
that dies leaves the tables as they were, so that the next run claims its rows again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.shared import cut
from ..sources.store import Store
from . import media, state, threads


def _clock(as_of: str) -> Column:
    return F.lit(as_of).cast("timestamp")


def process_casts(store: Store, as_of: str, batch_size: int = 200_000, max_batches: int | None = None, hours: int = 6) -> list[int]:
    """Posts older than `hours` become roots (2) or replies (1); roots enter the threads, unless they are there."""

    def step(_: int) -> int:
        casts = store.get("casts")
        ready = (F.col("threads_status") == 0) & (F.col("ts") < _clock(as_of) - F.make_dt_interval(hours=F.lit(hours)))
        claimed = state.claim(casts.select("hash", "parent_hash", "root_hash", "fid", "ts", "threads_status"), ready, [F.col("ts"), F.col("hash")], batch_size)
        found = cut(threads.roots_and_replies(claimed).join(claimed.drop("threads_status"), "hash"))
        n = found.count()
        if n:
            roots = found.where("threads_status = 2").select("hash", F.col("fid").alias("author_fid"), "ts", F.lit(0).cast("smallint").alias("thread_status"))
            # the threads first: if the posts' snapshot fails, the rows are claimed again and the threads are there already
            store.put("threads", state.insert_new(store.get("threads"), roots, "hash"))
            store.put("casts", state.merge(casts, found.select("hash", F.col("threads_status").cast("smallint")), "hash"))
        return n

    return list(state.run_batches(step, max_batches, batch_size))


def sync_spam_labels(store: Store, batch_size: int = 100_000, max_batches: int | None = None) -> list[int]:
    """Threads take their author's spam label where it differs, until none does."""

    def step(_: int) -> int:
        now = store.get("threads")
        delta = state.changed_labels(now, store.get("user_labels")).dropDuplicates(["hash"]).orderBy("hash").limit(batch_size)
        delta = cut(delta.select("hash", F.col("spam").cast("smallint"), F.lit(True).alias("hit")))
        n = delta.count()
        if n:
            # a label may be null, so the value is set and not merged
            both = now.join(delta.withColumnRenamed("spam", "new_spam"), "hash", "left")
            store.put("threads", both.select(*[F.when(F.col("hit"), F.col("new_spam")).otherwise(F.col("spam")).alias("spam") if c == "spam" else F.col(c) for c in now.columns]))
        return n

    return list(state.run_batches(step, max_batches))


def process_thread_blobs_batch(
    store: Store, as_of: str, batch_size: int = 100_000, max_batches: int | None = None, large: int = threads.LARGE, count: Callable[[Column], Column] = T.pretoken_count
) -> list[int]:
    """New threads that are no spam get their text, authors, reactions and tokens; status 1, or 99 if the root is too short."""

    def step(_: int) -> int:
        now = store.get("threads")
        claimed = cut(state.claim(now, (F.col("thread_status") == 0) & (F.col("spam") == 2), [F.col("ts"), F.col("hash")], batch_size).select("hash"))
        n = claimed.count()
        if n:
            made = threads.build(store.get("casts"), store.get("reactions"), store.get("user_labels"), store.get("profiles"), roots=claimed, large=large, count=count)
            delta = made.select(
                F.col("root").alias("hash"), "blob", "fids", F.col("reactions").cast("long"), F.col("tokens").cast("int"),
                F.col("thread_status").cast("smallint"), _clock(as_of).alias("blob_ts"),
            )
            store.put("threads", state.merge(now, delta, "hash"))
        return n

    return list(state.run_batches(step, max_batches))


def process_media_casts(store: Store, as_of: str, batch_size: int = 100_000, max_batches: int | None = None, hours: int = 1) -> list[tuple[int, int]]:
    """Links of posts older than `hours` enter the media table, unless they are there; the posts get their media status. (posts, new links) of each batch."""
    out = []

    def step(_: int) -> int:
        casts = store.get("casts")
        ready = (F.col("media_status") == 0) & media.has_embeds(F.col("embeds")) & (F.col("ts") < _clock(as_of) - F.make_dt_interval(hours=F.lit(hours)))
        claimed = state.claim(casts.select("id", "embeds", "ts", "media_status"), ready, [F.col("ts"), F.col("id")], batch_size)
        found = cut(media.embed_urls(claimed))
        n = found.count()
        if n:
            before = store.get("media")
            links = found.select(F.explode("urls").alias("url")).distinct().select("url", F.lit(0).cast("smallint").alias("media_status"))
            fresh = cut(links.join(before.select("url"), "url", "left_anti"))
            store.put("media", before.unionByName(fresh, allowMissingColumns=True))
            store.put("casts", state.merge(casts, found.select("id", F.col("media_status").cast("smallint")), "id"))
            out.append((n, fresh.count()))
        return n

    list(state.run_batches(step, max_batches, batch_size))
    return out


def get_unprocessed_count(posts: DataFrame) -> int:
    """Posts with text and without an embedding."""
    return pending(posts).count()


def pending(posts: DataFrame, text: str = "text", embedding: str = "embedding384") -> DataFrame:
    return posts.where(F.col(embedding).isNull() & F.col(text).isNotNull() & (F.length(F.trim(text)) > 0))


def status_histogram(rows: DataFrame, status: str) -> DataFrame:
    return rows.groupBy(status).agg(F.count("*").alias("n"))
