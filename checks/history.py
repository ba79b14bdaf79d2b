"""Snapshot history: series, slices, dictionaries, new keys, guard and quality rules."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.base import L, P, S, check, label_table, labelled_postings, postings, rows, table
from paylens.functions import classify
from paylens.operators import groups, history, keyfilter, labels, quality, reports
from paylens.operators.sizes import materialise, shared_folder, stage

E = """e AS (SELECT user_id, event_type, CAST(ts AS DATE) AS day, value, event_type = 'error' AS mgmt,
  value > 10 AS has_pay FROM events)"""
FIRST_USER = "f AS (SELECT user_id, min(day) AS first_seen FROM e GROUP BY user_id)"
FIRST_COMPANY = "f AS (SELECT company, min(snapshot_date) AS first_seen FROM p GROUP BY company)"


def event_rows(spark, sf):
    return table(spark, sf, "events").select(
        "user_id", "event_type", F.to_date("ts").alias("day"), "value", (F.col("event_type") == "error").alias("mgmt"),
        (F.col("value") > 10).alias("has_pay"))


def _series(spark, sf):
    e = event_rows(spark, sf)
    first = history.first_seen(e.select("user_id", F.col("day").alias("first_seen")), "user_id")
    return reports.daily_series(e, first, "user_id", "day", "value", "mgmt", "has_pay")


SERIES = """SELECT e.day, count(*) AS active, CAST(count(*) FILTER (f.first_seen = e.day) AS BIGINT) AS new,
  round_even(median(value) FILTER (has_pay AND NOT mgmt), 0) AS median
  FROM e LEFT JOIN f ON e.user_id = f.user_id GROUP BY e.day"""


@check("daily_series", rows(E, FIRST_USER, select=SERIES + " ORDER BY 1"))
def daily_series(spark, sf):
    return _series(spark, sf)


@check("pulse", rows(E, FIRST_USER, f"t AS ({SERIES})", select="""
  SELECT day, active, new, CASE WHEN (SELECT count(median) FROM t) >= 7 THEN median END AS median FROM t"""))
def pulse(spark, sf):
    return reports.pulse(_series(spark, sf))


def first_months(p):
    return history.first_seen(p.select("company", F.col("snapshot_date").alias("first_seen")), "company")


@check("latest_slice", rows(P, FIRST_COMPANY, select="""
  SELECT job_uid, p.company, p.snapshot_date, CAST(coalesce(f.first_seen = p.snapshot_date, false) AS INT) AS is_new
  FROM p LEFT JOIN f ON p.company = f.company WHERE p.snapshot_date = (SELECT max(snapshot_date) FROM p)"""))
def latest_slice(spark, sf):
    p = postings(spark, sf)
    return reports.latest_slice(classify.latest(p), first_months(p), "company").select(
        "job_uid", "company", "snapshot_date", "is_new")


@check("new_flags", rows(P, FIRST_COMPANY, select="""
  SELECT p.snapshot_date, count(*) AS n, CAST(sum(CASE WHEN f.first_seen = p.snapshot_date THEN 1 ELSE 0 END) AS BIGINT)
    AS new FROM p LEFT JOIN f ON p.company = f.company GROUP BY 1"""))
def new_flags(spark, sf):
    p = postings(spark, sf)
    return reports.latest_slice(p, first_months(p), "company").groupBy("snapshot_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_new").alias("new"))


def _encoded(spark, sf):
    return reports.encode_slice(labelled_postings(spark, sf), keep=["region", "seniority", "is_remote", "pay"])


COMPANY_DICT = "cd AS (SELECT company, row_number() OVER (ORDER BY md5(company)) - 1 AS idx FROM (SELECT DISTINCT company FROM p))"
ITEM_DICT = """held AS (SELECT l.job_uid, l.skill AS item FROM l JOIN p ON l.job_uid = p.job_uid WHERE l.skill IS NOT NULL),
id AS (SELECT item, row_number() OVER (ORDER BY md5(item)) - 1 AS idx FROM (SELECT DISTINCT item FROM held))"""


@check("slice_companies", rows(P, COMPANY_DICT, select="SELECT company, idx FROM cd"))
def slice_companies(spark, sf):
    return _encoded(spark, sf)[0]


@check("slice_items", rows(P, S, L, ITEM_DICT, select="SELECT item, idx FROM id"))
def slice_items(spark, sf):
    return _encoded(spark, sf)[1]


@check("dictionary_slice", rows(P, S, L, COMPANY_DICT, ITEM_DICT, """
coded AS (SELECT job_uid, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY held.item) AS ids
  FROM held JOIN id ON held.item = id.item GROUP BY job_uid)""", select="""
  SELECT p.job_uid, region, seniority, is_remote, pay, cd.idx AS company_idx,
         CASE WHEN n.job_uid IS NOT NULL THEN coalesce(coded.ids, '') END AS item_idx
  FROM p JOIN cd ON p.company = cd.company LEFT JOIN newest n ON p.job_uid = n.job_uid
  LEFT JOIN coded ON p.job_uid = coded.job_uid"""))
def dictionary_slice(spark, sf):
    coded = _encoded(spark, sf)[2]
    text = F.array_join(F.transform("item_idx", lambda i: i.cast("string")), ",")
    return coded.withColumn("item_idx", text)


@check("compact_slice", rows(P, S, L, """
named AS (SELECT l.job_uid, string_agg(l.skill, ',' ORDER BY l.skill) AS items FROM l JOIN p ON p.job_uid = l.job_uid
  WHERE l.skill IS NOT NULL GROUP BY 1)""", select="""
  SELECT region, seniority, CAST(is_remote AS INT) AS is_remote, CAST(is_management AS INT) AS is_management, company, pay,
    CASE WHEN n.job_uid IS NOT NULL THEN coalesce(items, '') END AS items, CAST(p.job_uid % 3 = 0 AS INT) AS is_new, count(*) AS n
  FROM p LEFT JOIN newest n ON n.job_uid = p.job_uid LEFT JOIN named ON named.job_uid = p.job_uid GROUP BY ALL"""))
def compact_slice(spark, sf):
    """The compact slice written as positional arrays, read back, and its indexes turned into names again."""
    target = f"{shared_folder(spark)}/compact-{uuid.uuid4().hex}"
    df = labelled_postings(spark, sf).withColumn("is_new", (F.col("job_uid") % 3 == 0).cast("int"))
    companies, items, coded = reports.encode_slice(df, keep=["region", "seniority", "is_remote", "is_management", "pay", "is_new"])
    companies, items = materialise(companies), materialise(items)
    reports.positional_rows(coded, "pay").write.text(target)
    back = reports.read_positional(spark.read.text(target)).withColumn("row", F.monotonically_increasing_id())
    back = materialise(back.withColumnRenamed("salary_mid_usd", "pay"))
    names = back.select("row", F.explode("item_idx").alias("idx")).join(items, "idx").groupBy("row").agg(
        F.array_join(F.array_sort(F.collect_list("item")), ",").alias("items"))
    full = back.join(companies.withColumnRenamed("idx", "company_idx"), "company_idx", "left").join(names, "row", "left")
    listed = F.when(F.col("item_idx").isNotNull(), F.coalesce("items", F.lit("")))
    return full.withColumn("items", listed).groupBy(
        "region", "seniority", "is_remote", "is_management", "company", "pay", "items", "is_new").agg(F.count(F.lit(1)).alias("n"))


@check("coverage", rows(P, S, select="""
  SELECT count(*) AS total, count(*) FILTER (has_pay) AS paid, count(DISTINCT k.job_uid) AS labelled,
         round_even(count(*) FILTER (has_pay) / count(*), 3) AS paid_share,
         round_even(count(DISTINCT k.job_uid) / count(*), 3) AS labelled_share
  FROM p LEFT JOIN (SELECT DISTINCT job_uid FROM s) k ON p.job_uid = k.job_uid"""))
def coverage(spark, sf):
    return reports.coverage(postings(spark, sf), label_table(spark, sf), has_pay="has_pay")


@check("distinct_counts", rows(P, "t AS (SELECT * FROM p WHERE snapshot_date = (SELECT max(snapshot_date) FROM p))",
                               select="""
  SELECT 'days' AS metric, CAST(NULL AS VARCHAR) AS name, count(DISTINCT snapshot_date) AS n FROM p
  UNION ALL SELECT 'companies', NULL, count(DISTINCT company) FROM t
  UNION ALL SELECT 'companies_of_source', source, count(DISTINCT company) FROM t GROUP BY source"""))
def distinct_counts(spark, sf):
    p = postings(spark, sf)
    return reports.distinct_counts(p, classify.latest(p))


SPANS = "(VALUES ('year', DATE '1997-01-01', DATE '1997-12-31'), ('all', DATE '1900-01-01', DATE '2100-01-01'))"


@check("distinct_over_days", rows(P, f"w AS (SELECT * FROM {SPANS} w(span, low, high))", select="""
  SELECT span, source, count(DISTINCT company) AS exact, true AS close FROM p JOIN w ON snapshot_date BETWEEN low AND high
  GROUP BY 1, 2"""))
def distinct_over_days(spark, sf):
    """Companies of a source over spans of days: the exact count, and whether the union of the days' sketches is within
    3 % of it."""
    p, spans = postings(spark, sf), spark.sql("SELECT * FROM VALUES ('year', DATE '1997-01-01', DATE '1997-12-31'), "
                                              "('all', DATE '1900-01-01', DATE '2100-01-01') w(span, low, high)")
    inside = F.col("snapshot_date").between(F.col("low"), F.col("high"))
    sketches = stage(reports.distinct_sketches(p, ["source", "snapshot_date"], "company"))
    guess = reports.distinct_over(sketches.join(spans, inside), ["span", "source"])
    exact = p.join(spans, inside).groupBy("span", "source").agg(F.count_distinct("company").alias("exact"))
    close = F.abs(F.col("n") - F.col("exact")) <= 0.03 * F.col("exact")
    return exact.join(guess, ["span", "source"]).select("span", "source", "exact", close.alias("close"))


@check("source_counts", rows(P, select="SELECT source, count(*) AS n FROM p GROUP BY source"))
def source_counts(spark, sf):
    return quality.source_counts(postings(spark, sf))


BOARD = """b AS (SELECT company, CASE source WHEN 'AUTOMOBILE' THEN 'greenhouse' WHEN 'BUILDING' THEN 'lever'
  WHEN 'FURNITURE' THEN 'ashby' ELSE source END AS source FROM p)"""


def _boards(p):
    board = (F.when(F.col("source") == "AUTOMOBILE", "greenhouse").when(F.col("source") == "BUILDING", "lever")
             .when(F.col("source") == "FURNITURE", "ashby").otherwise(F.col("source")))
    return p.withColumn("source", board)


URL = """CASE source WHEN 'greenhouse' THEN 'https://boards.greenhouse.io/' || company
  WHEN 'lever' THEN 'https://jobs.lever.co/' || company WHEN 'ashby' THEN 'https://jobs.ashbyhq.com/' || company END"""


@check("top_entities", rows(P, BOARD, select=f"""
  SELECT company, source, n, {URL} AS url FROM (SELECT company, source, count(*) AS n FROM b GROUP BY 1, 2)
  ORDER BY n DESC, company, source LIMIT 10"""))
def top_entities(spark, sf):
    return reports.top_entities(_boards(postings(spark, sf)))


@check("posting_projection", rows(P, select="""
  SELECT source || ':' || company || ':' || job_uid AS posting_key, region, is_remote, pay FROM p"""))
def posting_projection(spark, sf):
    key = classify.posting_key("source", "company", F.col("job_uid").cast("string")).alias("posting_key")
    return postings(spark, sf).select(key, "region", "is_remote", "pay")


@check("slice_counts", rows(P, select="""
  SELECT 'all' AS region, count(*) AS n, count(*) FILTER (NOT is_management AND pay IS NOT NULL) AS paid FROM p
  UNION ALL SELECT 'remote', count(*), count(*) FILTER (NOT is_management AND pay IS NOT NULL) FROM p WHERE is_remote
  UNION ALL SELECT 'ASIA', count(*), count(*) FILTER (NOT is_management AND pay IS NOT NULL) FROM p
    WHERE region = 'ASIA' AND seniority = '2-HIGH'"""))
def slice_counts(spark, sf):
    p = postings(spark, sf)

    def one(name, part):
        return part.agg(F.lit(name).alias("region"), F.count(F.lit(1)).alias("n"),
                        F.count_if(~F.col("is_management") & F.col("pay").isNotNull()).alias("paid"))
    return one("all", classify.slice_filter(p)).unionByName(one("remote", classify.slice_filter(p, "remote"))).unionByName(
        one("ASIA", classify.slice_filter(p, "ASIA", "2-HIGH")))


@check("first_occurrence", """
  SELECT user_id, event_type, event_id, value FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS r FROM events) WHERE r = 1""")
def first_occurrence(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return groups.first_occurrence(e, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@check("anti_new_keys", """
  WITH k AS (SELECT o_custkey || ':' || o_orderpriority AS job_uid, CAST(date_trunc('year', o_orderdate) AS DATE) AS dt
    FROM orders)
  SELECT job_uid, count(*) AS n FROM k t WHERE dt = (SELECT max(dt) FROM k)
  AND NOT EXISTS (SELECT 1 FROM k h WHERE h.job_uid = t.job_uid AND h.dt <> t.dt) GROUP BY 1""")
def anti_new_keys(spark, sf):
    """Customer and priority pairs that only the last year holds, found with key filters of all other years."""
    k = table(spark, sf, "orders").select(
        classify.posting_key(F.col("o_custkey").cast("string"), "o_orderpriority").alias("job_uid"),
        F.trunc("o_orderdate", "year").alias("dt"))
    last = k.agg(F.max("dt")).first()[0]
    today = k.where(F.col("dt") == F.lit(last)).groupBy("job_uid").agg(F.count(F.lit(1)).alias("n"))
    past = k.where(F.col("dt") != F.lit(last))
    filters = keyfilter.build(past, "job_uid", keyfilter.slots_for(past.count()), ["dt"])
    return today.join(keyfilter.find_known(today, past, filters).known, "job_uid", "left_anti")


@check("key_lookup", """
  WITH k AS (SELECT o_custkey || ':' || o_orderpriority AS job_uid, CAST(date_trunc('year', o_orderdate) AS DATE) AS dt
    FROM orders), t AS (SELECT DISTINCT job_uid FROM k WHERE dt = (SELECT max(dt) FROM k))
  SELECT k.dt, count(DISTINCT t.job_uid) AS known, max(a.n) AS stored FROM k JOIN t USING (job_uid)
  JOIN (SELECT dt, count(*) AS n FROM k GROUP BY dt) a ON a.dt = k.dt WHERE k.dt < (SELECT max(dt) FROM k) GROUP BY 1""")
def key_lookup(spark, sf):
    """Per year that was read for an exact check: keys of the last year that it holds, and its rows."""
    k = table(spark, sf, "orders").select(
        classify.posting_key(F.col("o_custkey").cast("string"), "o_orderpriority").alias("job_uid"),
        F.trunc("o_orderdate", "year").alias("dt"))
    last = k.agg(F.max("dt")).first()[0]
    past = k.where(F.col("dt") != F.lit(last))
    filters = keyfilter.build(past, "job_uid", keyfilter.slots_for(past.count()), ["dt"])
    found = keyfilter.find_known(k.where(F.col("dt") == F.lit(last)), past, filters)
    read = past.where(F.col("dt").isin(found.days_read))
    exact = read.join(found.candidates, ["job_uid", "dt"], "left_semi").groupBy("dt").agg(F.count_distinct("job_uid").alias("known"))
    return exact.join(read.groupBy("dt").agg(F.count(F.lit(1)).alias("stored")), "dt")


@check("publish_date_backfill", """
  SELECT CASE WHEN o_orderstatus = 'P' THEN DATE '2002-01-01' ELSE CAST(o_orderdate AS DATE) END AS first_seen,
         count(*) AS n FROM orders GROUP BY 1""")
def publish_date_backfill(spark, sf):
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    raw = (F.when(F.col("o_orderstatus") == "F", F.concat(day, F.lit("T23:49:03-04:00")))
           .when(F.col("o_orderstatus") == "O", F.concat(day, F.lit("T00:10:00Z"))).otherwise("soon"))
    o = table(spark, sf, "orders").select("o_orderkey", raw.alias("published_at_raw"))
    return history.backfill_rows(o, "2002-01-01").groupBy("first_seen").agg(F.count(F.lit(1)).alias("n"))


@check("backfill_summary", """
  SELECT count(*) AS rows, count(DISTINCT CAST(o_orderdate AS DATE)) AS days, CAST(min(o_orderdate) AS DATE) AS first_day,
         CAST(max(o_orderdate) AS DATE) AS last_day FROM orders""")
def backfill_summary(spark, sf):
    o = table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("first_seen"))
    return history.backfill_summary(o)


@check("volume_guard", rows(E, "d AS (SELECT max(day) AS last FROM e)", """
per AS (SELECT event_type, day, count(*) AS n FROM e WHERE day <> (SELECT last FROM d) GROUP BY 1, 2)""", """
recent AS (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY day DESC) AS r FROM per)""", """
want AS (SELECT event_type, median(n) AS expected FROM recent WHERE r <= 7 GROUP BY 1)""", """
got AS (SELECT event_type, count(*) AS n FROM e WHERE day = (SELECT last FROM d) AND event_type <> 'purchase'
  AND (event_type <> 'view' OR value > 20) GROUP BY 1)""", """
j AS (SELECT w.event_type AS scope, coalesce(g.n, 0) AS got, expected FROM want w LEFT JOIN got g
  ON w.event_type = g.event_type)""", "t AS (SELECT 'total' AS scope, CAST(sum(got) AS BIGINT) AS got, sum(expected) AS expected FROM j)",
                            select="""
  SELECT * FROM j WHERE got < 0.5 * expected UNION ALL
  SELECT * FROM t WHERE got < 0.6 * expected"""))
def volume_guard(spark, sf):
    """A last day on which one source went silent and another lost most of its rows, against counts that are kept per day.
    The day before was stored at half its size first and then replaced, which retracts its old counts."""
    e = event_rows(spark, sf).select(F.col("event_type").alias("source"), "day", "value")
    days = [r.day for r in e.select("day").distinct().orderBy("day").collect()]
    store = f"{shared_folder(spark)}/guard-{uuid.uuid4().hex}"
    per_day = materialise(e.where(F.col("day") != days[-1]).groupBy("source", "day").agg(F.count(F.lit(1)).alias("n")))
    for day, part in ((days[-2], 2), *((d, 1) for d in days[:-1])):
        counts = per_day.where(F.col("day") == day).select("source", F.ceil(F.col("n") / part).alias("n"))
        history.write_day(counts, store, "counts", str(day), key="source")
    now = e.where((F.col("day") == days[-1]) & (F.col("source") != "purchase")
                  & ((F.col("source") != "view") | (F.col("value") > 20)))
    return quality.volume_problems(history.day_counts(spark, store, str(days[-1])), quality.source_counts(now))


@check("quality_assertions", rows(P, select="""
  SELECT 'paid_without_mid' AS rule, CAST(count(*) FILTER (has_pay AND pay IS NULL) AS BIGINT) AS violations FROM p
  UNION ALL SELECT 'mid_out_of_range', count(*) FILTER (NOT pay BETWEEN 10000 AND 1500000) FROM p
  UNION ALL SELECT 'duplicate_keys', count(*) - count(DISTINCT company) FROM p
  UNION ALL SELECT 'range_too_wide', count(*) FILTER (pay / 1000 > 20 * 20) FROM p
  UNION ALL SELECT 'labelled_share_below_0_9', CAST(count(*) FILTER (is_remote) < 0.9 * count(*) AS BIGINT) FROM p"""))
def quality_assertions(spark, sf):
    """The company stands in for the key, so that there are duplicates to find."""
    p = postings(spark, sf).withColumns({"low": F.lit(1000.0), "high": F.col("pay") / 20,
                                         "marks": F.when(F.col("is_remote"), 1)})
    return quality.assertions(p, quality.pay_rules("company", "pay", "low", "high", "has_pay", "marks"))


@check("partition_roundtrip", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE) AS dt, count(*) AS n, "
                              "sum(CAST(o_orderkey AS BIGINT))::BIGINT AS keys FROM orders GROUP BY 1")
def partition_roundtrip(spark, sf):
    """Backfill a table partitioned by day and read it back."""
    store = f"{shared_folder(spark)}/roundtrip-{uuid.uuid4().hex}"
    o = table(spark, sf, "orders").select("o_orderkey", F.trunc("o_orderdate", "month").alias("first_seen"))
    history.write_backfill(o, store, "orders", "o_orderkey")
    back = spark.read.schema("o_orderkey bigint, first_seen date, dt date").parquet(f"{store}/orders")
    return back.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("o_orderkey").alias("keys"))


@check("processed_keys", rows(S, select="SELECT DISTINCT job_uid FROM s"))
def processed_keys(spark, sf):
    return labels.processed_keys(label_table(spark, sf))


@check("cache_state", rows(S, select="""
  SELECT job_uid, max(prompt_version) AS prompt_version,
         CASE WHEN max(prompt_version) = 'R' THEN 'current' ELSE 'stale' END AS state FROM s GROUP BY 1"""))
def cache_state(spark, sf):
    return labels.cache_state(label_table(spark, sf), "R")


@check("latest_version_labels", rows(S, L, select="""
  SELECT job_uid, skill FROM l WHERE skill IS NOT NULL
  UNION ALL SELECT job_uid, NULL FROM l GROUP BY job_uid HAVING count(skill) = 0"""))
def latest_version_labels(spark, sf):
    return labels.latest_labels(label_table(spark, sf))


@check("label_tally", rows(S, select="""
  SELECT count(skill) AS label_rows, count(DISTINCT job_uid) AS labelled_keys,
         count(DISTINCT CASE WHEN skill IS NOT NULL THEN job_uid END) AS keys_with_label,
         round(count(DISTINCT CASE WHEN skill IS NOT NULL THEN job_uid END) / count(DISTINCT job_uid), 3)
           AS share_with_label FROM s"""))
def label_tally(spark, sf):
    return labels.label_tally(label_table(spark, sf))


@check("top_labels", rows(S, select="""
  SELECT skill, count(*) AS n FROM s WHERE skill IS NOT NULL GROUP BY 1 ORDER BY n DESC, skill LIMIT 10"""))
def top_labels(spark, sf):
    return labels.top_labels(label_table(spark, sf))
