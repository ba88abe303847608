"""Sharding by jump consistent hashing, in DataFrame functions only.

The key's 64-bit linear congruential sequence (Lamping and Veach) is stepped inside a higher-order
fold, its products taken in 16-bit limbs so that nothing overflows under ANSI arithmetic. The shard
depends on the key and the number of shards alone: no ring table, and a further shard takes keys only
into itself. Integer ids are keys as they are, others by a 64-bit hash. Null keys count as key 0; repeated keys share a
shard; null texts count as empty; an empty table gives no rows. Only id and text are read, so that no other column can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._common import pick, table

SHARDS = 16
#: Ranges of the key's hash within a shard: the table of their sizes has SHARDS * RANGES rows at most, at any input size.
RANGES = 2048
_LIMBS = [(2862933555777941757 >> (16 * i)) & 0xFFFF for i in range(4)]


def jump_shard(key: Column, shards: int) -> Column:
    """The shard, 0 to shards-1, of an integer key."""
    if shards < 1:
        raise ValueError("shards must be positive")
    low = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF))
    key = F.coalesce(key.cast("long"), F.lit(0).cast("long"))
    first = F.struct(
        F.lit(0).cast("long").alias("b"), F.lit(0).cast("long").alias("j"),
        low(F.shiftrightunsigned(key, 32)).alias("hi"), low(key).alias("lo"),
    )

    def step(s: Column, _: Column) -> Column:
        hi, lo = s["hi"], s["lo"]
        p = [lo * F.lit(c).cast("long") for c in _LIMBS]
        q = [hi * F.lit(c).cast("long") for c in _LIMBS[:2]]
        short = lambda x: x.bitwiseAND(F.lit(0xFFFF)) * F.lit(65536)
        below = p[0] + short(p[1]) + F.lit(1)
        above = low(F.shiftright(below, 32) + F.shiftright(p[1], 16) + low(p[2]) + short(p[3]) + low(q[0]) + short(q[1]))
        jump = F.floor((s["j"] + 1).cast("double") * (F.lit(2147483648.0) / (F.shiftright(above, 1) + 1).cast("double"))).cast("long")
        return F.when(s["j"] >= shards, s).otherwise(F.struct(s["j"].alias("b"), jump.alias("j"), above.alias("hi"), low(below).alias("lo")))

    # every step moves on by a shard at least
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), first, step, lambda s: s["b"].cast("int"))


def shard(docs: DataFrame, shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every row.

    slot: gapless from 0 in each shard. Rows are ranked inside ranges of a hash of the key and the text, and the ranges' sizes are
    summed up before: no shard is ever sorted by one task, and a key that a third of all rows share is dealt out by its texts.
    """
    d = pick(docs, doc_id=id_col, text=text_col)
    whole = d.schema["doc_id"].dataType.typeName() in ("byte", "short", "integer", "long")
    key = F.coalesce(F.col("doc_id").cast("long") if whole else F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")), F.lit(0).cast("long"))
    rows = d.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"), jump_shard(key, shards).alias("shard"),
        jump_shard(key, shards + 1).alias("grown_shard"), key.alias("key"),
    ).withColumn("range", F.pmod(F.xxhash64("key", "text_crc32", F.lit(7)), F.lit(RANGES)).cast("int"))
    before = Window.partitionBy("shard").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("shard", "range").count().withColumn("first_slot", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    rank = F.row_number().over(Window.partitionBy("shard", "range").orderBy("key", "size", "text_crc32"))
    # bounded: SHARDS * RANGES rows of three numbers
    return rows.withColumn("rank", rank).join(F.broadcast(starts), ["shard", "range"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        (F.col("first_slot") + F.col("rank") - 1).cast("long").alias("slot"), "grown_shard",
    )


def op8_jump_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of every document by its id, and its place there."""
    return shard(table(spark, sf_dir, "documents"))
