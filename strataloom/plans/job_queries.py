"""The jobs as queries: each runs twice into one new folder and gives what stands there afterwards."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from jobs import delivery_inventory, grant_returns
from strataloom.plans import oracles as O
from strataloom.sinks.writers import shared_folder

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/strataloom-{name}-{uuid.uuid4().hex}"


@query(r"""
WITH d AS (
  SELECT doc_id, coalesce(nullif(source, ''), 'unstated') AS delivery, lang, md5(coalesce(text, '')) AS content_md5, octet_length(encode(coalesce(text, '')))::BIGINT AS size_bytes,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS n_words
  FROM documents
)
SELECT *, count(*) OVER c AS n_holders, min(doc_id) OVER c AS first_doc_id, doc_id IS DISTINCT FROM min(doc_id) OVER c AS is_copy FROM d WINDOW c AS (PARTITION BY content_md5)
""")
def job1_delivery_inventory(spark: SparkSession, d: str) -> DataFrame:
    out = _folder(spark, "job1")
    for _ in range(2):
        df = delivery_inventory.run(spark, f"{d}/documents.parquet", out, f"{out}/_checkpoint")
    return df


@query(f"""
WITH c AS ({O.COHORTS}), nf AS (SELECT stratum_key, count(DISTINCT feature_key) AS n FROM c GROUP BY 1),
s AS (SELECT stratum_key, specimen_id FROM c JOIN nf USING (stratum_key) GROUP BY 1, 2 HAVING count(value) / any_value(n) >= 0.5),
own AS (SELECT c.* FROM c JOIN s USING (stratum_key, specimen_id)), ns AS (SELECT stratum_key, count(*) AS n FROM s GROUP BY 1),
k AS (SELECT stratum_key, feature_key FROM own JOIN ns USING (stratum_key) GROUP BY 1, 2 HAVING count(value) / any_value(n) >= 0.5),
v AS (SELECT own.* FROM own JOIN k USING (stratum_key, feature_key) WHERE value IS NOT NULL),
z AS (SELECT stratum_key, feature_key, avg(value) AS m, stddev_samp(value) AS sd FROM v GROUP BY 1, 2)
SELECT stratum_key AS "grant", specimen_id, feature_key, round(value + 1e-9, 6) AS value, round(m + 1e-9, 3) AS z_center, round(CASE WHEN sd > 0 THEN sd END + 1e-9, 3) AS z_scale, round((value - m) / CASE WHEN sd > 0 THEN sd END + 1e-9, 4) + 0.0 AS value_z
FROM v JOIN z USING (stratum_key, feature_key)
""")
def job2_grant_returns(spark: SparkSession, d: str) -> DataFrame:
    out = _folder(spark, "job2")
    for _ in range(2):
        df = grant_returns.run(spark, d, out)
    return df
