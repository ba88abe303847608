"""Token counts by a pluggable tokenizer: a plain rule in column functions, or byte-pair ranks out of a file."""

from __future__ import annotations

import base64
import functools
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import pretoken_count


@functools.lru_cache(4)
def _encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def _udf(path: str | None, pattern: str | None):
    if path is None:
        import public_tokenizers

        path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN

    @F.pandas_udf("int")
    def count(texts: pd.Series) -> pd.Series:
        encoding = _encoding(path, pattern)
        return texts.map(lambda t: None if t is None else len(encoding.encode_ordinary(t))).astype("Int32")

    return count


def bpe_count(path: str | None = None, pattern: str | None = None) -> Callable[[Column], Column]:
    """A function that counts a text's byte-pair tokens; names of special tokens count as text, null as null.

    path: a file of ranks that every worker has; by default one of the installed vocabularies, with their own pattern.
    """
    return _udf(path, pattern)


def register(spark: SparkSession, path: str | None = None, pattern: str | None = None, name: str = "token_count") -> None:
    """The SQL function token_count(text)."""
    spark.udf.register(name, _udf(path, pattern))


def total_tokens(texts: DataFrame, text: str = "blob", count: Callable[[Column], Column] = pretoken_count) -> DataFrame:
    """n_rows, n_tokens, mean_tokens over all rows; null and empty texts have no tokens."""
    n = texts.select(F.coalesce(count(F.col(text)), F.lit(0)).alias("n"))
    return n.agg(F.count("*").alias("n_rows"), F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_tokens"), F.avg("n").alias("mean_tokens"))
