"""Streaming forms: settled posts classified as they come, daily windows with a watermark, and what a running query reports."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators import threads

SETTLED, PERIOD = "6 hours", "5 minutes"


def settled(posts: DataFrame, as_of, hours: int = 6) -> DataFrame:
    """Posts old enough to be assigned."""
    return posts.where(F.col("ts") < as_of - F.make_dt_interval(hours=F.lit(hours)))


def classified(posts: DataFrame, delay: str = SETTLED) -> DataFrame:
    """hash, threads_status, ts of a stream of posts, each post once: repeats within the delay are dropped by the watermark's state."""
    timed = posts.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", delay)
    once = timed.dropDuplicatesWithinWatermark(["hash"])
    return once.select("hash", threads.root_status().alias("threads_status"), "ts")


def daily_counts(events: DataFrame, delay: str = SETTLED) -> DataFrame:
    """Events by day and kind; days close when the watermark passes. Timestamps without a zone are cast first. On a batch: all days."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    by_day = e.withWatermark("ts", delay).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"))
    return by_day.select(F.col("w.start").alias("day"), "event_type", "n")


def drain(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hands all there is to step in batches, then ends; a restart goes on at the checkpoint."""
    stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def serve(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, period: str = PERIOD) -> StreamingQuery:
    """The same for ever, every `period`; the caller stops it."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(processingTime=period).start()


def into_parquet(path: str) -> Callable[[DataFrame, int], None]:
    """A step that writes each batch to its own folder, so that a batch that is run twice stands there once."""

    def step(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return step


@dataclass
class Progress(StreamingQueryListener):
    """Rows, seconds and speed of each batch of a query; add it by spark.streams.addListener."""

    total: int = 0
    batches: list[dict] = field(default_factory=list)

    def onQueryStarted(self, event) -> None: ...

    def onQueryIdle(self, event) -> None: ...

    def onQueryTerminated(self, event) -> None: ...

    def onQueryProgress(self, event) -> None:
        p = json.loads(event.progress.json)
        seconds = p.get("durationMs", {}).get("triggerExecution", 0) / 1000
        self.total += p["numInputRows"]
        self.batches.append({"batch": p["batchId"], "rows": p["numInputRows"], "seconds": seconds, "watermark": p.get("eventTime", {}).get("watermark")})

    def summary(self, remaining: int = 0) -> dict[str, float]:
        """Rows a second over all and over the last ten batches, the mean and 95th percentile of a batch's seconds, minutes to go."""
        import numpy as np

        took = [b["seconds"] for b in self.batches if b["rows"]]
        last = [b for b in self.batches if b["rows"]][-10:]
        speed = lambda rows, seconds: rows / seconds if seconds else 0.0
        overall = speed(self.total, sum(took))
        return {
            "rows": self.total, "rows_per_second": overall, "recent": speed(sum(b["rows"] for b in last), sum(b["seconds"] for b in last)),
            "mean": float(np.mean(took)) if took else 0.0, "p95": float(np.percentile(took, 95)) if took else 0.0,
            "minutes_left": remaining / overall / 60 if overall else 0.0,
        }
