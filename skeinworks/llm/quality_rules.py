"""Quality rules in DataFrame functions only: base rules of a text, and a hashed n-gram log-likelihood ratio.

Every text is cut into runs of letters and digits or of other signs; runs and pairs of runs are hashed into
BUCKETS cells. Two smoothed multinomials over the cells, one of trusted target texts and one of the whole raw
corpus, give each cell the weight log(p_target / p_raw). A text's score is the mean weight of its cells,
so length does not count, and a fixed threshold decides on every document.

Null and empty texts: no words, all counts 0, base_failed. No trusted row at all: the weights are about 0,
only the base rules decide. Repeated rows are each judged; an empty table yields no rows. Only id and text are read, so that no
other column can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import pick, table

BUCKETS = 8192
#: Added to each cell, as a share of an even spread of the trusted mass.
SMOOTH = 0.05
THRESHOLD = -0.35
SPACE, BLANKS, SYMBOLS = r"[\x20\x09-\x0D]+", " \t\n\x0b\x0c\r", "#*$%&|<>"
GRAM = r"[\p{L}\p{N}]+|[^\p{L}\p{N}\x20\x09-\x0D]+"


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def without(text: Column, signs: str) -> Column:
    """The text without these ASCII signs: a byte search for each, which leaves a text that has none as it is."""
    for sign in signs:
        text = F.replace(text, F.lit(sign), F.lit(""))
    return text


def _once(value: Column, f) -> Column:
    """f(value) with the value computed once: a lambda's variable, where a plain use inside a lambda would compute it for each element."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def repeated_words(words: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the text; exact up to 64-bit hashes of windows."""

    def windows(h: Column) -> Column:
        return F.transform(F.slice(h, 1, F.greatest(F.size(h) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2)))

    def covered(pairs: Column) -> Column:
        same = lambda s, j: F.get(pairs, j)["k"] == s["k"]
        twice = F.filter(F.transform(pairs, lambda s, j: F.when(same(s, j - 1) | same(s, j + 1), s["p"])), lambda p: p.isNotNull())
        state = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("long").alias("n"))
        return F.aggregate(F.sort_array(twice), state, lambda s, p: F.struct(p.alias("last"), (s["n"] + F.least(F.lit(3), p - s["last"])).alias("n")), lambda s: s["n"])

    def counted(keys: Column) -> Column:
        pairs = F.sort_array(F.transform(keys, lambda x, i: F.struct(x.alias("k"), i.alias("p"))))
        # most texts repeat no window, and need no sort
        return F.when(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(0).cast("long")).otherwise(_once(pairs, covered))

    return _once(F.transform(words, lambda w: F.xxhash64(w)), lambda h: _once(windows(h), counted))


def cells(text: Column, buckets: int = BUCKETS) -> Column:
    """The cells of the text's runs and pairs of neighbouring runs."""
    cell = lambda h: F.pmod(h, F.lit(buckets)).cast("int")
    runs = F.transform(F.regexp_extract_all(text, F.lit(GRAM), F.lit(0)), lambda w: F.xxhash64(w))
    pairs = lambda g: F.transform(F.slice(g, 2, F.greatest(F.size(g) - 1, F.lit(0))), lambda h, i: cell(F.xxhash64(F.get(g, i), h)))
    return _once(runs, lambda g: F.concat(F.transform(g, cell), pairs(g)))


def weights(docs: DataFrame, trusted: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """One row: the weight of each cell, as an array of `buckets` doubles."""
    count = lambda d, name: d.select(F.explode(cells(F.col("text"), buckets)).alias("cell")).groupBy("cell").agg(F.count("*").alias(name))
    raw, target = count(docs, "raw"), count(trusted, "target")
    # the grid of cells is as long as `buckets`, whatever the input
    grid = docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("cell"))
    all_ = grid.join(raw, "cell", "left").join(target, "cell", "left").select("cell", *[F.coalesce(c, F.lit(0)).cast("double").alias(c) for c in ("raw", "target")])
    packed = all_.agg(F.sort_array(F.collect_list(F.struct("cell", "raw", "target"))).alias("a"), F.sum("raw").alias("n_raw"), F.sum("target").alias("n_target"))
    add = F.col("n_target") * SMOOTH / buckets + 1e-6
    return packed.select(
        F.transform("a", lambda c: F.log((c["target"] + add) / (F.col("n_target") + add * buckets)) - F.log((c["raw"] + add) / (F.col("n_raw") + add * buckets))).alias("w")
    )


def rules(docs: DataFrame, trusted: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base counts, the score `llr` and the verdicts of every row of docs. trusted: a table with `text`."""
    d = pick(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce("text", F.lit("")))
    t = trusted.select(F.coalesce("text", F.lit("")).alias("text"))
    w = weights(d, t).scalar()
    lines = F.filter(F.split("text", "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")
    out = d.select(
        "doc_id", "text", word_list(F.col("text")).alias("words"), cells(F.col("text")).alias("cells"), w.alias("weights"),
    ).select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        F.length(without(F.col("text"), BLANKS)).cast("long").alias("word_chars"),
        (F.length("text") - F.length(without(F.col("text"), SYMBOLS))).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"),
        F.size("cells").cast("long").alias("n_cells"),
        F.aggregate("cells", F.lit(0.0), lambda s, c: s + F.get("weights", c)).alias("total"),
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    llr = F.when(F.col("n_cells") > 0, F.round(F.col("total") / F.col("n_cells"), 9)).otherwise(F.lit(0.0))
    return out.withColumn("llr", llr).withColumn("base_failed", failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("llr") >= threshold)).alias("kept"), "llr",
    )


def labelled(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of all rows of docs, a table of Parquet files, whose doc_id is in ids.

    Ids meet ids only. What comes back to the texts is one bit a row, as longs of 64 neighbouring rows of a file, small enough to be
    broadcast; so no text is shuffled.
    """
    place = lambda d, *cols: d.select(*cols, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("at"))
    word, bit = F.expr("at DIV 64"), F.expr("shiftleft(1L, CAST(at % 64 AS INT))")
    good = place(docs, "doc_id").join(ids.where("doc_id IS NOT NULL").distinct(), "doc_id", "left_semi")
    bits = good.groupBy("file", word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    rows = place(docs, "text").withColumn("word", word).join(F.broadcast(bits), ["file", "word"])
    return rows.where(F.col("bits").bitwiseAND(bit) != 0).select("text")


def trusted_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts that the labels call good and not toxic."""
    return labelled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").where("quality = 1 AND coalesce(toxic, 0) = 0").select("doc_id"))


def op3_ngram_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts, the likelihood ratio and the verdicts of every document."""
    return rules(table(spark, sf_dir, "documents"), trusted_texts(spark, sf_dir))
