"""The post model, derived from the driver's tables by rules that any SQL engine can repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

_TREE = "CAST(floor(d.doc_id / 50.0) AS BIGINT)"
#: The same text builds the model in both engines. Posts quote, mention and link up to twice; quotes make chains and, with 6 ahead, cycles.
MODEL = {
    "users": "SELECT max(user_id) + 1 AS n_users FROM events",
    "posts": f"""SELECT d.doc_id AS hash,
        CASE WHEN d.doc_id % 50 = 0 THEN NULL ELSE {_TREE} * 50 + CAST(floor((d.doc_id % 50 - 1) / 3.0) AS BIGINT) END AS parent_hash,
        {_TREE} * 50 AS root_hash, (d.doc_id * 7 + {_TREE}) % u.n_users AS fid,
        d.text AS text, d.doc_id * 60 AS ts,
        CASE WHEN d.doc_id < 3 THEN NULL WHEN d.doc_id % 7 = 0 THEN d.doc_id - 3 WHEN d.doc_id % 7 = 4 THEN d.doc_id - 2
             WHEN d.doc_id % 7 = 2 THEN d.doc_id - 1 WHEN d.doc_id % 21 = 1 THEN d.doc_id + 6 END AS quoted,
        CASE WHEN d.doc_id % 14 = 0 AND d.doc_id >= 5 THEN d.doc_id - 5 END AS quoted2,
        CASE WHEN d.doc_id % 5 = 0 THEN d.doc_id % u.n_users END AS mentioned,
        CASE WHEN d.doc_id % 30 = 0 THEN d.doc_id % u.n_users WHEN d.doc_id % 10 = 0 THEN (d.doc_id + 3) % u.n_users END AS mentioned2,
        CASE WHEN d.doc_id % 11 = 0 THEN 'https://Site.example/p/' || CAST(d.doc_id AS VARCHAR(20)) END AS url,
        CASE WHEN d.doc_id % 22 = 0 THEN 'https://a.example/' || CAST(d.doc_id AS VARCHAR(20)) END AS url2,
        CASE WHEN d.doc_id % 11 = 0 AND d.doc_id % 3 = 0 THEN d.text || ' https://site.example/P/' || CAST(d.doc_id AS VARCHAR(20)) ELSE d.text END AS linked_text
        FROM documents d CROSS JOIN users u""",
    "reactions": """SELECT e.user_id AS fid, e.event_id % n.n AS target_hash, CASE e.event_type WHEN 'click' THEN 1 ELSE 2 END AS reaction_type
        FROM events e CROSS JOIN (SELECT count(*) AS n FROM documents) n WHERE e.event_type IN ('click', 'purchase')""",
    "profiles": "SELECT DISTINCT user_id AS fid, 'user' || CAST(user_id AS VARCHAR(20)) AS username FROM events WHERE user_id % 37 <> 5",
    "user_labels": """SELECT DISTINCT user_id AS target_fid, 'spam' AS label_type, CASE WHEN user_id % 5 <> 0 THEN '2' ELSE '0' END AS label_value FROM events
        UNION ALL SELECT DISTINCT user_id, 'trust', CASE WHEN user_id % 11 = 3 THEN '2' ELSE 'x' END FROM events WHERE user_id % 11 < 5""",
}


def oracle(*names: str) -> str:
    """The model's tables as the head of an oracle's WITH clause."""
    return "WITH RECURSIVE " + ", ".join(f"{n} AS ({MODEL[n]})" for n in ("users", *(n for n in MODEL if n in names and n != "users")))


class Model:
    """The model's tables over a folder of parquet tables, as lazy DataFrames: columns are pruned, filters pushed down to the scan."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def _sql(self, name: str, **tables: DataFrame) -> DataFrame:
        sql = MODEL[name].replace("CROSS JOIN users u", "CROSS JOIN {users} u")
        return self.spark.sql(sql.replace("FROM documents", "FROM {documents}").replace("FROM events", "FROM {events}"), **tables)

    @property
    def posts(self) -> DataFrame:
        users = self.spark.sql("SELECT max(user_id) + 1 AS n_users FROM {events}", events=self.raw("events"))
        return self._sql("posts", documents=self.raw("documents"), users=users)

    @property
    def reactions(self) -> DataFrame:
        return self._sql("reactions", events=self.raw("events"), documents=self.raw("documents"))

    @property
    def profiles(self) -> DataFrame:
        return self._sql("profiles", events=self.raw("events"))

    @property
    def user_labels(self) -> DataFrame:
        return self._sql("user_labels", events=self.raw("events"))
