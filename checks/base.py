"""Registry of checks and the views both dialects share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.operators import labels

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rows(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select


# P: orders as postings of a monthly snapshot.
P = """p AS (
  SELECT o_orderkey AS job_uid, c_mktsegment AS source, c_name AS company, r_name AS region,
         o_orderpriority AS seniority, o_orderstatus = 'P' AS is_management, o_orderkey % 2 = 0 AS is_remote,
         CASE WHEN o_totalprice > 100000 THEN o_totalprice END AS pay, o_totalprice > 100000 AS has_pay,
         CAST(date_trunc('month', o_orderdate) AS DATE) AS snapshot_date, CAST(o_orderdate AS DATE) AS day
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""

# S: line items as label rows; the return flag is the version, a small part means "processed, nothing found".
S = """s AS (
  SELECT l_orderkey AS job_uid, CASE WHEN p_size > 2 THEN p_brand END AS skill, l_returnflag AS prompt_version
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

# L: distinct labels of the newest version per key.
L = """newest AS (SELECT job_uid, max(prompt_version) AS v FROM s GROUP BY job_uid),
l AS (SELECT DISTINCT s.job_uid, s.skill FROM s JOIN newest n ON s.job_uid = n.job_uid AND s.prompt_version = n.v)"""


def postings(spark: SparkSession, sf: str) -> DataFrame:
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    joined = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
              .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    return joined.select(
        F.col("o_orderkey").alias("job_uid"), F.col("c_mktsegment").alias("source"), F.col("c_name").alias("company"),
        F.col("r_name").alias("region"), F.col("o_orderpriority").alias("seniority"),
        (F.col("o_orderstatus") == "P").alias("is_management"), (F.col("o_orderkey") % 2 == 0).alias("is_remote"),
        F.when(F.col("o_totalprice") > 100000, F.col("o_totalprice")).alias("pay"),
        (F.col("o_totalprice") > 100000).alias("has_pay"),
        F.trunc("o_orderdate", "month").alias("snapshot_date"), F.to_date("o_orderdate").alias("day"))


def label_table(spark: SparkSession, sf: str) -> DataFrame:
    li, p = table(spark, sf, "lineitem"), table(spark, sf, "part")
    return li.join(p, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("job_uid"), F.when(F.col("p_size") > 2, F.col("p_brand")).alias("skill"),
        F.col("l_returnflag").alias("prompt_version"))


def labelled_postings(spark: SparkSession, sf: str) -> DataFrame:
    return labels.with_label_sets(postings(spark, sf), labels.label_sets(label_table(spark, sf)))
