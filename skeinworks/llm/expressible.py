"""What SQL can say of the corpus operators' results: some columns of four of them, each with its SQL for DuckDB.

The queries opN_ return more (hashes that DuckDB lacks, learned scores, offsets of patterns), which tests compare with brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import lm_score, pii, quality_rules, sharding
from ._common import table

_WORD, _BLANK = r"[^\x20\x09-\x0D]+", r"[\x20\x09-\x0D]"


def rules_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base counts and verdict of the quality rules."""
    out = quality_rules.rules(table(spark, sf_dir, "documents"), quality_rules.trusted_texts(spark, sf_dir))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


RULES_BASE = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), w AS (SELECT doc_id, t, regexp_extract_all(t, '{_WORD}') AS ws,
   list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM d),
 windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
 twice AS (SELECT doc_id, g FROM windows GROUP BY ALL HAVING count(*) > 1),
 covered AS (SELECT DISTINCT x.doc_id, x.i + o.o AS p FROM windows x JOIN twice USING (doc_id, g), (SELECT unnest([0, 1, 2]) AS o) o),
 repeated AS (SELECT doc_id, count(*) AS n FROM covered GROUP BY doc_id),
 counts AS (SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '{_BLANK}', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
   len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words FROM w LEFT JOIN repeated r USING (doc_id))
 SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts"""


def personal_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many emails, ips, cards and phones each document has."""
    return pii.counts(table(spark, sf_dir, "documents"))


_DIGITS = "regexp_replace(x, '[^0-9]', '', 'g')"
# of a card's digits, the last first, every second one doubled, its digits summed up
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(substring(reverse({_DIGITS}), i, 1) AS INT) ELSE (2 * CAST(substring(reverse({_DIGITS}), i, 1) AS INT)) % 10 + (2 * CAST(substring(reverse({_DIGITS}), i, 1) AS INT)) // 10 END))"
PERSONAL_COUNTS = f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
 SELECT doc_id, len(regexp_extract_all(t, '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+')) AS n_email,
  len(list_filter(regexp_extract_all(t, '[0-9]+(?:\\.[0-9]+)(?:\\.[0-9]+)(?:\\.[0-9]+)'), lambda x: list_max(list_transform(string_split(x, '.'), lambda p: CAST(p AS DOUBLE))) <= 255)) AS n_ip,
  len(list_filter(regexp_extract_all(t, '[0-9](?:[\\x20-]?[0-9])+'), lambda x: length({_DIGITS}) BETWEEN 16 AND 19 AND {_LUHN} % 10 = 0)) AS n_card,
  len(list_filter(regexp_extract_all(t, '\\+[0-9][\\x20().0-9-]+[0-9]'), lambda x: length({_DIGITS}) BETWEEN 8 AND 15)) AS n_phone FROM d"""


def shards_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard among 16 and among 17."""
    return sharding.op8_jump_shards(spark, sf_dir).select("doc_id", "size", "law", "shard", "grown_shard")


SHARDS_BY_KEY = """WITH RECURSIVE step AS (SELECT doc_id, n, CAST(-1 AS BIGINT) AS b, CAST(0 AS BIGINT) AS j, (CAST(doc_id AS HUGEINT) + 18446744073709551616) % 18446744073709551616 AS k
   FROM documents, (SELECT unnest([16, 17]) AS n) UNION ALL
  SELECT doc_id, n, j, CAST(floor((j + 1) * (CAST(2147483648 AS DOUBLE) / CAST(next // 8589934592 + 1 AS DOUBLE))) AS BIGINT), next
   FROM (SELECT *, (k * 2862933555777941757 + 1) % 18446744073709551616 AS next FROM step WHERE j < n)),
 final AS (SELECT doc_id, n, CAST(b AS INT) AS b FROM step WHERE j >= n)
 SELECT d.doc_id, strlen(coalesce(text, '')) + 1 AS size, 'key' AS law, a.b AS shard, z.b AS grown_shard
 FROM documents d JOIN final a ON a.doc_id = d.doc_id AND a.n = 16 JOIN final z ON z.doc_id = d.doc_id AND z.n = 17"""


def model_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts and the add-one score of every document, learned from those whose id leaves another remainder than 2 by 7."""
    out = lm_score.score(table(spark, sf_dir, "documents"), F.col("doc_id") % 7 == 2)
    return out.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", F.round("base_score", 4).alias("base_score"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MODEL_BASE = f"""WITH w AS (SELECT doc_id, doc_id % 7 = 2 AS held_out, unnest(list_append(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}'), ' ')) AS w FROM documents),
 counts AS (SELECT w, count(*) AS c FROM w WHERE NOT held_out GROUP BY w), sums AS (SELECT CAST(sum(c) AS BIGINT) AS n, count(*) AS v FROM counts)
 SELECT doc_id, held_out, count(*) AS n_tokens, count(c) AS n_known, n AS train_tokens, round(sum(log10((coalesce(c, 0) + 1) / CAST(n + v + 1 AS DOUBLE))), 4) AS base_score
 FROM w LEFT JOIN counts USING (w), sums GROUP BY doc_id, held_out, n"""

QUERIES = {f.__name__: f for f in (rules_base, personal_counts, shards_by_key, model_base)}
ORACLE = {"rules_base": RULES_BASE, "personal_counts": PERSONAL_COUNTS, "shards_by_key": SHARDS_BY_KEY, "model_base": MODEL_BASE}
