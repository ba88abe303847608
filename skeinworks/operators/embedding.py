"""Texts to vectors: a pluggable encoder, retries, row states, and checks of what comes back.

The states of a thread: 1 text built, 2 claimed, 3 bits stored, 4 claimed, 5 floats stored, 19 failed or blank. Overload sends rows back
to the state before the claim.
"""

from __future__ import annotations

import time
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vectors as V
from ..sources.shared import cut
from ..sources.store import Store
from . import state

Encoder = Callable[[list[str]], np.ndarray]
DIMENSION, BATCH, TRIES, MAX_ERRORS = 512, 128, 3, 10
# fixed values: what the messages of a service say
RATE_LIMIT = ("rate limit", "too many requests", "429")
OVERLOAD = ("server is overloaded", "not ready yet", "server error", "503")


class TooManyErrors(RuntimeError):
    pass


def error_kind(message: str) -> str:
    """rate_limit, overload or error, by what an error's message says."""
    m = message.lower()
    return "rate_limit" if any(t in m for t in RATE_LIMIT) else "overload" if any(t in m for t in OVERLOAD) else "error"


def split_keys(text: str) -> list[str]:
    """A service's keys: parted by commas, else semicolons, else spaces, unless a space belongs to a bearer's prefix."""
    sign = "," if "," in text else ";" if ";" in text else " " if " " in text and "Bearer" not in text else None
    return [text.strip()] if sign is None else [k.strip() for k in text.split(sign) if k.strip()]


def retried(call: Callable[[], object], tries: int = TRIES, sleep: Callable[[float], None] = time.sleep) -> object:
    """Waits of 1, 2, 4 ... seconds after a rate limit, of one second after another error; the last error is raised."""
    for n in range(tries):
        try:
            return call()
        except Exception as e:
            if n == tries - 1:
                raise
            sleep(2.0**n if error_kind(str(e)) == "rate_limit" else 1.0)


def hashing_encoder(texts: list[str], size: int = DIMENSION) -> np.ndarray:
    """A deterministic stand-in for a model: hashed words, L2-normalised."""
    out = np.zeros((len(texts), size), np.float32)
    for i, t in enumerate(texts):
        for w in t.lower().split():
            h = zlib.crc32(w.encode())
            out[i, h % size] += 1 - 2 * (h >> 31)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def pooling_encoder(tokens: Callable[[str], list[int]], vectors: np.ndarray, most: int = 256) -> Encoder:
    """An encoder of a token's vectors: the first `most` tokens of a text, mean over them, L2-normalised."""

    def encode(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), vectors.shape[1]), np.float32)
        for i, t in enumerate(texts):
            ids = tokens(t)[:most]
            out[i] = vectors[ids].sum(0) / max(len(ids), 1e-9) if ids else 0
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12)

    return encode


def embed(df: DataFrame, encoder: Encoder = hashing_encoder, batch: int = BATCH, dimension: int | None = None, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """hash, vector, error of df (hash, text). error: null, blank, overload, error, or dimension; an error spoils its batch only."""
    kind = df.schema["hash"].dataType.simpleString()

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for at in range(0, len(f), batch):
                part = f.iloc[at : at + batch]
                full = [t.replace("↳", "-") if isinstance(t, str) and t.strip() else None for t in part["text"]]
                vectors, error = [None] * len(full), None
                try:
                    if any(full):
                        got = np.asarray(retried(lambda full=full: encoder([t for t in full if t]), sleep=sleep))
                        if dimension and got.shape[1] != dimension:
                            error = "dimension"
                        else:
                            for i, v in zip([i for i, t in enumerate(full) if t], got, strict=True):
                                vectors[i] = v.astype(np.float32).tolist()
                except Exception as e:  # noqa: BLE001  told in the row
                    error = "overload" if error_kind(str(e)) == "overload" else "error"
                yield pd.DataFrame({"hash": part["hash"].to_numpy(), "vector": vectors, "error": ["blank" if t is None else error for t in full]})

    return df.select("hash", "text").mapInPandas(run, f"hash {kind}, vector array<float>, error string")


@dataclass
class Stage:
    """What one pass over the threads claims, and where its rows go."""

    ready: int = 1
    claimed: int = 2
    done: int = 3
    binary: bool = True


BINARY, FLOAT = Stage(), Stage(3, 4, 5, False)


def embed_threads(
    store: Store, stage: Stage = BINARY, encoder: Encoder = hashing_encoder, batch_size: int = BATCH, max_batches: int | None = None,
    dimension: int = DIMENSION, sleep: Callable[[float], None] = time.sleep,
) -> list[dict[str, int]]:
    """Claims the newest threads that are ready and no spam, stores their vectors, and settles their states; the counts of each batch.

    A batch that dies goes back to the state before the claim. After MAX_ERRORS batches in a row that fail as a whole, it stops.
    """
    out, failures = [], 0

    def step(_: int) -> int:
        nonlocal failures
        now = store.get("threads")
        ready = (F.col("thread_status") == stage.ready) & (F.col("spam") == 2)
        claimed = cut(state.claim(now, ready, [F.desc("ts"), F.desc("hash")], batch_size).select("hash", F.col("blob").alias("text")))
        n = claimed.count()
        if not n:
            return 0
        store.put("threads", state.set_status(now, claimed, stage.claimed))
        try:
            got = cut(embed(claimed.repartition(max(1, n // BATCH)), encoder, dimension=dimension, sleep=sleep))
            counts = {r.error or "done": r.n for r in got.groupBy("error").agg(F.count("*").alias("n")).collect()}
            value = V.packed(F.col("vector")) if stage.binary else F.col("vector")
            delta = got.select("hash", _settled(stage).alias("thread_status"), F.when(F.col("error").isNull(), value).alias("blob_embedding_binary" if stage.binary else "blob_embedding"))
            store.put("threads", state.merge(store.get("threads"), delta, "hash"))
        except Exception:
            store.put("threads", state.set_status(store.get("threads"), claimed, stage.ready))
            raise
        failures = 0 if counts.get("done") or set(counts) <= {"blank"} else failures + 1
        out.append(counts)
        if failures >= MAX_ERRORS:
            raise TooManyErrors(f"{failures} batches in a row failed: {counts}")
        return n

    list(state.run_batches(step, max_batches))
    return out


def _settled(stage: Stage):
    is_ = lambda kind: F.coalesce(F.col("error") == kind, F.lit(False))
    return state.settle(F.col("error").isNull(), is_("blank"), is_("overload"), stage.done, stage.ready)


def embed_posts(store: Store, as_of: str, encoder: Encoder = hashing_encoder, batch_size: int = 200_000, max_batches: int | None = None) -> list[tuple[int, int]]:
    """Posts with text and without a vector, claimed once in an hour, get int8 vectors by one scale a batch; (claimed, stored) of each batch."""
    out, clock = [], F.lit(as_of).cast("timestamp")

    def step(_: int) -> int:
        casts = store.get("casts")
        open_ = F.col("embedding384").isNull() & F.col("text").isNotNull() & (F.col("text") != "")
        fresh = F.col("claimed_at").isNull() | (F.col("claimed_at") < clock - F.make_dt_interval(hours=F.lit(1)))
        claimed = cut(state.claim(casts, open_ & fresh, [F.col("id")], batch_size).select("id", F.col("id").alias("hash"), "text"))
        n = claimed.count()
        if n:
            got = embed(claimed.repartition(max(1, n // 4096)), encoder)
            vectors = cut(V.quantise(got.where("vector IS NOT NULL"), "vector").select(F.col("hash").alias("id"), F.col("quantised").alias("embedding384")))
            delta = claimed.select("id").join(vectors, "id", "left").withColumn("claimed_at", clock)
            merged, sent, hit = state.merged_rows(casts, delta, "id")
            if sent != hit:
                raise RuntimeError(f"{sent} rows were to be updated, {hit} were")
            store.put("casts", merged)
            out.append((n, vectors.count()))
        return n

    list(state.run_batches(step, max_batches))
    return out


def reset_stale(store: Store, as_of: str, minutes: int = 5) -> int:
    """Claims of posts that never got a vector, older than so many minutes, are open again; how many."""
    casts, clock = store.get("casts"), F.lit(as_of).cast("timestamp")
    stale = F.col("embedding384").isNull() & (F.col("claimed_at") < clock - F.make_dt_interval(mins=F.lit(minutes))) & F.col("text").isNotNull() & (F.col("text") != "")
    n = casts.where(stale).count()
    if n:
        store.put("casts", casts.withColumn("claimed_at", F.when(~F.coalesce(stale, F.lit(False)), F.col("claimed_at"))))
    return n
