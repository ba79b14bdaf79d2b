"""Landed dumps end to end: orders are written as job-board documents, then read, normalised and kept as history."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.base import check, rows, table
from checks.classify import GRADE_WORD, LEVEL, PLACES, ROLE, TARGET, TEAM, case
from paylens.functions.dates import publish_date
from paylens.operators import history
from paylens.operators.groups import first_occurrence
from paylens.operators.sizes import shared_folder
from paylens.plans import jobs
from paylens.sources.boards import read_postings
from paylens.streaming.ingest import stream_ingest

DAY = "2001-09-01"
PER_DOCUMENT = 50

SOURCE = {"F": "greenhouse", "O": "lever", "P": "ashby"}


def land(spark, sf, root):
    """One compact document per line, at most 50 orders each; the urgent ones come twice, the copy under another title."""
    o, c, n, r = (table(spark, sf, t) for t in ("orders", "customer", "nation", "region"))
    df = (o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
          .join(r, F.col("n_regionkey") == F.col("r_regionkey")))
    lo = F.floor("o_totalprice")
    title = F.concat(case("o_orderpriority", GRADE_WORD), F.lit(" "), case("c_mktsegment", ROLE),
                     case("o_orderstatus", LEVEL))
    place = F.element_at(F.array(*[F.lit(p) for p, _ in PLACES]), F.col("c_nationkey") % 25 + 1)
    base = df.select(
        case("o_orderstatus", SOURCE).alias("source"), F.lower("r_name").alias("company"), "o_orderkey",
        title.alias("title"), place.alias("place"), case("o_orderstatus", TEAM).alias("team"), lo.alias("lo"),
        (lo * 2).alias("hi"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.explode(F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit(1), F.lit(2))).otherwise(
            F.array(F.lit(1)))).alias("copy"))
    title = F.concat("title", F.when(F.col("copy") == 2, " (copy)").otherwise(""))
    money = F.concat(F.lit("$"), F.format_number("lo", 0), F.lit(" - $"), F.format_number("hi", 0))
    forms = {
        "greenhouse": F.struct(
            F.col("o_orderkey").alias("id"), title.alias("title"), F.struct(F.col("place").alias("name")).alias("location"),
            F.concat(F.lit("&lt;p&gt;Python &amp;amp; SQL. Salary range: "), money, F.lit("&lt;/p&gt;")).alias("content"),
            F.concat("day", F.lit("T23:30:00-04:00")).alias("first_published"),
            F.array(F.struct(F.lit(1).alias("id"), F.col("team").alias("name"))).alias("departments")),
        "lever": F.struct(
            F.col("o_orderkey").cast("string").alias("id"), title.alias("text"),
            F.struct(F.col("place").alias("location"), F.col("team").alias("team")).alias("categories"),
            (F.unix_timestamp(F.col("day"), "yyyy-MM-dd") * 1000).alias("createdAt"), F.lit("Go and Kafka").alias("descriptionPlain"),
            F.struct(F.col("lo").cast("double").alias("min"), F.col("hi").cast("double").alias("max"),
                     F.lit("GBP").alias("currency"), F.lit("per-year-salary").alias("interval")).alias("salaryRange"),
            F.lit("remote").alias("workplaceType")),
        "ashby": F.struct(
            F.col("o_orderkey").cast("string").alias("id"), title.alias("title"), F.col("place").alias("location"),
            F.concat("day", F.lit("T10:00:00.000Z")).alias("publishedAt"), F.lit(False).alias("isRemote"),
            F.col("team").alias("department"), F.lit("  ").alias("descriptionPlain"),
            F.struct(F.array(F.struct(F.array(F.struct(
                F.lit("Salary").alias("compensationType"), F.lit("1 MONTH").alias("interval"), F.lit("USD").alias("currencyCode"),
                (F.col("lo") / 10).alias("minValue"), (F.col("hi") / 10).alias("maxValue"))).alias("components")))
                .alias("compensationTiers")).alias("compensation")),
    }
    for source, form in forms.items():
        grouped = base.where(F.col("source") == source).groupBy(
            "source", "company", F.floor(F.col("o_orderkey") / PER_DOCUMENT)).agg(
            F.array_sort(F.collect_list(F.struct("copy", "o_orderkey", form.alias("j")))).alias("js"))
        list_ = F.transform("js", lambda x: x["j"])
        text = F.to_json(list_) if source == "lever" else F.to_json(F.struct(list_.alias("jobs")))
        grouped.select("source", "company", text.alias("value")).write.mode("append").partitionBy(
            "source", "company").text(root)
    return root


def folder(spark):
    return f"{shared_folder(spark)}/ingest-{uuid.uuid4().hex}"


def gbp(spark, sf):
    """Pounds per dollar, from the data so that it is the same in both dialects."""
    rate = table(spark, sf, "supplier").agg(F.round(F.count(F.lit(1)) / (F.count(F.lit(1)) + 25), 4).alias("per_usd"))
    return rate.select(F.lit("GBP").alias("currency"), "per_usd")


ALL = """t AS (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS lo, CASE o_orderstatus WHEN 'F' THEN 'greenhouse'
  WHEN 'O' THEN 'lever' ELSE 'ashby' END AS source, lower(r_name) AS company
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey)"""
PLACE_SQL = "[" + ", ".join(f"'{p}'" for p, _ in PLACES) + "][c_nationkey % 25 + 1]"
BUCKET_SQL = "[" + ", ".join(f"'{b}'" for _, b in PLACES) + "][c_nationkey % 25 + 1]"
UID = "source || ':' || company || ':' || o_orderkey"


@check("landed_dump_union", rows(ALL, "c AS (SELECT unnest([1, 2]) AS copy)", select=f"""
  SELECT source, company, CAST(o_orderkey AS VARCHAR) AS job_id, {PLACE_SQL} AS location_raw,
         CASE WHEN source = 'greenhouse' THEN contains(lower({PLACE_SQL}), 'remote') ELSE source = 'lever' END AS is_remote,
         CAST(o_orderdate AS DATE) AS published, CASE o_orderstatus WHEN 'F' THEN 'Engineering' WHEN 'O' THEN 'Kitchen' END
           AS department, range_pay AS range_min FROM (SELECT *, CAST(CASE WHEN source = 'lever' THEN lo END AS DOUBLE) AS range_pay FROM t)
  JOIN c ON copy = 1 OR o_orderpriority = '1-URGENT'"""))
def landed_dump_union(spark, sf):
    root = land(spark, sf, folder(spark))
    return read_postings(spark, root, lines=True).select(
        "source", "company", "job_id", "location_raw", "is_remote", publish_date("published_at_raw").alias("published"),
        "department", F.col("range_pay.min").alias("range_min"))


KEPT = f"""rate AS (SELECT round(count(*) / (count(*) + 25), 4) AS r FROM supplier),
k AS (SELECT {UID} AS job_uid, {BUCKET_SQL} AS region, o_orderstatus = 'P' AS is_management, source,
  lo / CASE WHEN source = 'lever' THEN (SELECT r FROM rate) ELSE 1 END * CASE WHEN source = 'ashby' THEN 1.2 ELSE 1 END AS usd,
  lo, CAST(o_orderdate AS DATE) AS day FROM t WHERE {TARGET}),
z AS (SELECT *, usd * 1.5 AS mid, CASE WHEN source = 'greenhouse' THEN lo >= 20000 AND lo * 2 <= 1500000
  ELSE usd * 1.5 BETWEEN 10000 AND 1500000 END AS ok FROM k)"""


@check("daily_ingest", rows(ALL, KEPT, select=f"""
  SELECT job_uid, DATE '{DAY}' AS dt, region, is_management, ok AS has_salary,
         round(CASE WHEN ok THEN mid END, 2) AS salary_mid_usd FROM z"""))
def daily_ingest(spark, sf):
    """A whole day: read, filter, deduplicate, price, guard, write, label; then the written snapshot."""
    root = folder(spark)
    jobs.daily_run(spark, land(spark, sf, f"{root}/landing"), f"{root}/store", DAY, gbp(spark, sf), lines=True)
    return history.read_table(spark, f"{root}/store", "snapshots").select(
        "job_uid", "dt", "region", "is_management", "has_salary", F.round("salary_mid_usd", 2).alias("salary_mid_usd"))


@check("daily_labels", rows(ALL, KEPT, select="""
  SELECT job_uid, unnest(CASE source WHEN 'greenhouse' THEN ['Python', 'SQL'] ELSE ['Go', 'Kafka'] END) AS skill
  FROM z WHERE source <> 'ashby'"""))
def daily_labels(spark, sf):
    """The label rows of a day: every posting with a text is labelled."""
    root = folder(spark)
    jobs.daily_run(spark, land(spark, sf, f"{root}/landing"), f"{root}/store", DAY, gbp(spark, sf), lines=True)
    return history.read_table(spark, f"{root}/store", "skills").select("job_uid", "skill")


@check("run_summary", rows(ALL, KEPT, """c AS (SELECT unnest([1, 2]) AS copy),
raw AS (SELECT * FROM t JOIN c ON copy = 1 OR o_orderpriority = '1-URGENT')""", select=f"""
  SELECT DATE '{DAY}' AS date, (SELECT count(*) FROM raw) AS raw_jobs, (SELECT count(DISTINCT (source, company)) FROM raw) AS boards,
         count(*) AS snapshot_rows, count(*) AS new_rows, count(*) FILTER (ok) AS with_salary,
         count(*) FILTER (source <> 'ashby') AS labelled, 2 * count(*) FILTER (source <> 'ashby') AS label_rows,
         count(*) FILTER (source = 'lever') AS lever FROM z"""))
def run_summary(spark, sf):
    root = folder(spark)
    done = jobs.daily_run(spark, land(spark, sf, f"{root}/landing"), f"{root}/store", DAY, gbp(spark, sf), lines=True)
    return done.select("date", "raw_jobs", "boards", "snapshot_rows", "new_rows", "with_salary", "labelled", "label_rows",
                       F.coalesce(F.col("by_source")["lever"], F.lit(0)).alias("lever"))


@check("ingest_order", """
  SELECT 'lever:acme:' || (p_partkey % 100) AS job_uid, min_by('Engineer ' || p_partkey, p_partkey) AS title,
         count(*) AS copies FROM part GROUP BY 1""")
def ingest_order(spark, sf):
    """The same jobs at the same places of many documents in several files: the first in ingest order stays."""
    root = folder(spark)
    posting = F.to_json(F.array(F.struct((F.col("p_partkey") % 100).cast("string").alias("id"),
                                         F.concat(F.lit("Engineer "), F.col("p_partkey")).alias("text"))))
    parts = table(spark, sf, "part").select(F.lit("lever").alias("source"), F.lit("acme").alias("company"), "p_partkey",
                                            posting.alias("value"))
    parts.repartitionByRange(4, "p_partkey").sortWithinPartitions("p_partkey").drop("p_partkey").write.partitionBy(
        "source", "company").text(root)
    found = jobs.target_postings(read_postings(spark, root, lines=True))
    copies = found.groupBy("job_uid").agg(F.count(F.lit(1)).alias("copies"))
    return first_occurrence(found, "job_uid", "ingest_seq").select("job_uid", "title").join(copies, "job_uid")


@check("backfill_job", rows(ALL, KEPT, select="SELECT day AS dt, count(*) AS n, count(*) FILTER (ok) AS paid FROM z GROUP BY day"))
def backfill_job(spark, sf):
    root = folder(spark)
    jobs.backfill(spark, land(spark, sf, f"{root}/landing"), f"{root}/store", DAY, gbp(spark, sf), lines=True)
    return history.read_table(spark, f"{root}/store", "jobs").groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("has_salary").alias("paid"))


@check("stream_ingest", rows(ALL, KEPT, select=f"""
  SELECT job_uid, DATE '{DAY}' AS first_seen, region, ok AS has_salary FROM z"""))
def stream(spark, sf):
    """Micro-batches over the landed files, then the first-seen table they built."""
    root = folder(spark)
    landing = land(spark, sf, f"{root}/landing")
    stream_ingest(spark, landing, f"{root}/store", DAY, gbp(spark, sf), f"{root}/mark", lines=True).awaitTermination()
    return history.read_table(spark, f"{root}/store", "jobs").select("job_uid", "first_seen", "region", "has_salary")
