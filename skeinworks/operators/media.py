"""Links of posts out of damaged JSON, and catalogue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import bytes_of, longest
from ..sources.shared import cut
from .state import upsert

CORRUPT, HAS_URL, NO_URL = 5, 2, 1


def repaired(embeds: Column) -> Column:
    """Pseudo-JSON as JSON: the outer signs go, single quotes become double ones, escaped double ones plain, backticks single quotes."""
    inner = F.substring(embeds, F.lit(2), F.length(embeds) - 2)
    return F.replace(F.replace(F.replace(inner, F.lit("'"), F.lit('"')), F.lit('\\"'), F.lit('"')), F.lit("`"), F.lit("'"))


def has_embeds(embeds: Column) -> Column:
    return embeds.isNotNull() & (embeds != '"[]"')


def embed_urls(posts: DataFrame, key: str = "id") -> DataFrame:
    """key, urls (lower case, distinct, sorted), has_cast, media_status; a row that cannot be parsed has status 5 and spoils no other."""
    parsed = posts.where(has_embeds(F.col("embeds"))).withColumn("v", F.try_parse_json(repaired(F.col("embeds"))))
    items = F.expr("try_variant_get(v, '$', 'array<variant>')")
    url = F.expr("filter(transform(items, e -> lower(try_variant_get(e, '$.url', 'string'))), u -> u IS NOT NULL AND u <> '')")
    out = parsed.withColumn("items", items).withColumn("urls", F.coalesce(F.array_sort(F.array_distinct(url)), F.array().cast("array<string>")))
    cast = F.expr("coalesce(exists(items, e -> try_variant_get(e, '$.castId') IS NOT NULL), false)").alias("has_cast")
    return out.select(key, "urls", cast, F.when(F.col("v").isNull(), CORRUPT).when(F.size("urls") > 0, HAS_URL).otherwise(NO_URL).alias("media_status"))


def first_hash(embeds: Column) -> Column:
    """The bytes at $[0].castId.hash.data of a post's JSON array; null where it has none."""
    return bytes_of(F.try_variant_get(F.try_parse_json(embeds), "$[0].castId.hash.data", "array<int>"))


def catalog_rows(raw: DataFrame, column: str = "raw") -> DataFrame:
    """frames_url, title, description, tags, raw_data of catalogue documents; those without an address go.

    Title and description are the longest of their candidates, of equals the first. Tags are the list's strings and numbers that are not
    empty; without such a list the primary category alone.
    """
    v = raw.withColumn("v", F.try_parse_json(column))
    text = lambda path: F.expr(f"CASE WHEN schema_of_variant(variant_get(v, '{path}')) = 'STRING' THEN variant_get(v, '{path}', 'string') END")
    full = lambda c: F.when(F.length(c) > 0, c)
    # fixed values: the candidates, in order
    titles = ("$.manifest.frame.name", "$.manifest.frame.title", "$.manifest.frame.og_title", "$.metadata.html.ogTitle", "$.title")
    descriptions = ("$.manifest.frame.description", "$.manifest.frame.og_description", "$.metadata.html.ogDescription")
    listed = F.expr("try_variant_get(v, '$.manifest.frame.tags', 'array<variant>')")
    kind = "schema_of_variant(t)"
    solid = F.expr("filter(tags, t -> t IS NOT NULL AND to_json(t) NOT IN ('null', '\"\"', '0', '0.0', 'false', '{}', '[]'))")
    plain = F.expr(f"transform(filter(tags, t -> {kind} IN ('STRING', 'BIGINT', 'DOUBLE') OR {kind} LIKE 'DECIMAL%'), t -> variant_get(t, '$', 'string'))")
    category = full(text("$.manifest.frame.primary_category"))
    return v.withColumn("tags", listed).withColumn("tags", solid).withColumn("some", F.size("tags") > 0).withColumn("tags", plain).select(
        full(text("$.frames_url")).alias("frames_url"), longest(*[full(text(p)) for p in titles]).alias("title"), longest(*[full(text(p)) for p in descriptions]).alias("description"),
        F.when(F.col("some"), F.col("tags")).when(category.isNotNull(), F.array(category)).otherwise(F.array().cast("array<string>")).alias("tags"),
        F.col(column).alias("raw_data"),
    ).where("frames_url IS NOT NULL")


def ingest(store, raw: DataFrame, as_of: str, column: str = "raw") -> int:
    """Catalogue documents into the store's catalogue: a key that is there gets the new row. Returns the number of documents with an address."""
    rows = cut(catalog_rows(raw, column).withColumn("last_updated", F.lit(as_of).cast("timestamp")))
    store.put("catalog", upsert(store.get("catalog"), rows, "frames_url", "last_updated"))
    return rows.count()
