"""Readers and whole jobs over files that are landed from the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check, rows, table
from checks.ingest import ALL, DAY, KEPT, PLACE_SQL, folder, gbp, land
from paylens.functions import dates
from paylens.plans import jobs
from paylens.sources import boards, gold, rates, registry


@check("registry_load", """
  SELECT lower(c_mktsegment) AS source, 'c' || c_custkey AS slug,
         CASE WHEN c_nationkey % 2 = 0 THEN 'c' || c_custkey ELSE c_name END AS name FROM customer WHERE c_acctbal > 0""")
def registry_load(spark, sf):
    """Registry files of a hundred boards each."""
    root, c = folder(spark), table(spark, sf, "customer")
    board = F.struct(
        F.when(F.col("c_nationkey") % 2 == 1, F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") % 3 == 0, F.lower("c_mktsegment")).otherwise("").alias("ats"),
        F.lower("c_mktsegment").alias("source"), F.concat(F.lit("c"), F.col("c_custkey")).alias("slug"),
        F.when(F.col("c_acctbal") > 0, "active").otherwise("dead").alias("status"))
    files = c.groupBy(F.floor(F.col("c_custkey") / 100).alias("part")).agg(F.to_json(F.collect_list(board)).alias("value"))
    files.write.partitionBy("part").text(root)
    return registry.read_registry(spark, root)


@check("rates_read", """
  SELECT DATE '2001-08-31' AS as_of, 'N' || n_nationkey AS currency, CAST(n_nationkey + 2 AS DOUBLE) / 8 AS per_usd FROM nation
  UNION ALL SELECT DATE '2001-08-31', 'USD', 1.0""")
def rates_read(spark, sf):
    """The first provider failed on the newest day before the run, so the second one counts."""
    root, n = folder(spark), table(spark, sf, "nation")

    def table_of(step):
        pairs = F.collect_list(F.struct(F.concat(F.lit("n"), F.col("n_nationkey")), (F.col("n_nationkey") + step) / 8))
        return F.map_from_entries(pairs)
    for provider, day, doc in (
            ("primary", "2001-08-30", F.struct(F.lit("success").alias("result"), table_of(1).alias("rates"))),
            ("primary", "2001-08-31", F.struct(F.lit("error").alias("result"))),
            ("secondary", "2001-08-31", F.struct(table_of(2).alias("usd"))),
            ("secondary", "2001-09-02", F.struct(table_of(3).alias("usd")))):
        n.agg(F.to_json(doc).alias("value")).write.text(f"{root}/provider={provider}/as_of={day}")
    return rates.read_rates(spark, root, DAY)


@check("gold_read", """
  SELECT doc_id AS id, text, CASE WHEN quality = 1 THEN 'good' ELSE '' END AS expected
  FROM documents JOIN labels USING (doc_id) WHERE doc_id % 10 <> 0""")
def gold_read(spark, sf):
    root = folder(spark)
    both = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id").select(
        F.when(F.col("doc_id") % 10 != 0, F.col("doc_id")).alias("id"), F.col("source").alias("title"), "text",
        F.when(F.col("quality") == 1, F.array(F.lit("good"))).otherwise(F.array().cast("array<string>")).alias("expected"))
    both.write.json(root)
    return gold.read_gold(spark, root).select("id", "text", F.array_join("expected", ",").alias("expected"))


@check("day_in_zone", "SELECT CAST(ts + INTERVAL 9 HOUR AS DATE) AS day, count(*) AS n FROM events GROUP BY 1")
def day_in_zone(spark, sf):
    return table(spark, sf, "events").groupBy(dates.day_in_zone("ts", "Asia/Tokyo").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))


@check("probed_boards", rows(ALL, "c AS (SELECT unnest([1, 2]) AS copy)", f"""
b AS (SELECT source AS ats, company AS slug, count(*) AS n_jobs,
  bool_or(source = 'lever' OR contains(lower({PLACE_SQL}), 'remote')) AS has_remote
  FROM t JOIN c ON copy = 1 OR o_orderpriority = '1-URGENT' GROUP BY 1, 2)""", select=f"""
  SELECT slug, arg_min(ats, ats) AS ats, arg_min(n_jobs, ats) AS n_jobs, arg_min(has_remote, ats) AS has_remote,
         'active' AS status, '{DAY}' AS added FROM b GROUP BY slug"""))
def probed_boards(spark, sf):
    """From landed board bodies to the registry; a board name counts once over all systems."""
    probes = boards.board_places(spark, land(spark, sf, folder(spark)), lines=True)
    return registry.board_registry(probes, added=DAY).select("slug", "ats", "n_jobs", "has_remote", "status", "added")


def day_of(spark, sf):
    root, pounds = folder(spark), gbp(spark, sf)
    jobs.daily_run(spark, land(spark, sf, f"{root}/landing"), f"{root}/store", DAY, pounds, lines=True)
    return f"{root}/store", pounds


@check("aggregate_job", rows(ALL, KEPT, select=f"""
  SELECT count(*) AS total, count(*) FILTER (ok) AS paid, count(*) FILTER (source <> 'ashby') AS labelled,
         DATE '{DAY}' AS day, count(*) AS active, 1 AS age_days, false AS stale, (SELECT round(1 / r, 4) FROM rate) AS usd FROM z"""))
def aggregate_job(spark, sf):
    """A day, then the published results: coverage, the day's point of the series and the freshness of the rates."""
    store, pounds = day_of(spark, sf)
    out = jobs.aggregate(spark, store, replicates=20, rates=pounds.withColumn("as_of", F.date_sub(F.lit(DAY).cast("date"), 1)), dt=DAY)
    point = out.series.select(F.col("snapshot_date").alias("day"), "active")
    return out.coverage.select("total", "paid", "labelled").join(point, F.lit(True)).join(
        out.freshness.select("age_days", "stale", "usd"), F.lit(True))  # one row each


URL_SQL = """CASE source WHEN 'greenhouse' THEN 'https://boards.greenhouse.io/' || company
  WHEN 'lever' THEN 'https://jobs.lever.co/' || company WHEN 'ashby' THEN 'https://jobs.ashbyhq.com/' || company END"""


@check("aggregate_published", rows(ALL, KEPT, """zz AS (SELECT *, split_part(job_uid, ':', 2) AS company FROM z)""", f"""
top AS (SELECT company, source, count(*) AS n, {URL_SQL} AS url FROM zz GROUP BY 1, 2 ORDER BY n DESC, company, source LIMIT 10),
mid AS (SELECT round_even(median(mid), 0) AS m FROM zz WHERE ok AND NOT is_management)""", select=f"""
  SELECT 'series' AS part, '{DAY}' AS name, NULL AS detail, count(*) AS n, CAST((SELECT m FROM mid) AS DOUBLE) AS x FROM zz
  UNION ALL SELECT 'new', '{DAY}', NULL, count(*), NULL FROM zz
  UNION ALL SELECT 'days', NULL, NULL, 1, NULL
  UNION ALL SELECT 'companies', NULL, NULL, count(DISTINCT company), NULL FROM zz
  UNION ALL SELECT 'companies_of_source', source, NULL, count(DISTINCT company), NULL FROM zz GROUP BY source
  UNION ALL SELECT 'top', company || '/' || source, url, n, NULL FROM top
  UNION ALL SELECT 'dictionary', company, NULL, 1, NULL FROM (SELECT DISTINCT company FROM zz)
  UNION ALL SELECT 'item', i, NULL, 1, NULL FROM (SELECT DISTINCT unnest(CASE source WHEN 'greenhouse' THEN ['Python', 'SQL']
    ELSE ['Go', 'Kafka'] END) AS i FROM zz WHERE source <> 'ashby')
  UNION ALL SELECT 'rows', region, CASE WHEN source = 'ashby' THEN 'open' ELSE 'two' END, count(*), round(sum(CASE WHEN ok THEN mid END), 0)
    FROM zz GROUP BY region, CASE WHEN source = 'ashby' THEN 'open' ELSE 'two' END"""))
def aggregate_published(spark, sf):
    """Every published table of a day but the premium and the rates, which have queries of their own."""
    store, _ = day_of(spark, sf)
    out = jobs.aggregate(spark, store)

    def part(df, kind, name, detail, n, x):
        return df.select(kind.alias("part"), name.cast("string").alias("name"), detail.cast("string").alias("detail"),
                         n.cast("bigint").alias("n"), x.cast("double").alias("x"))
    none, one, c = F.lit(None), F.lit(1), F.col
    labelled = F.when(c("item_idx").isNull(), "open").when(F.size("item_idx") == 0, "none").when(F.size("item_idx") == 2, "two")
    grouped = out.rows.groupBy("region", labelled.alias("held")).agg(
        F.count(one).alias("n"), F.round(F.sum("salary_mid_usd"), 0).alias("pay"))
    parts = [
        part(out.series, F.lit("series"), c("snapshot_date"), none, c("active"), c("median")),
        part(out.series, F.lit("new"), c("snapshot_date"), none, c("new"), none),
        part(out.counts, c("metric"), c("name"), none, c("n"), none),
        part(out.top_companies, F.lit("top"), F.concat_ws("/", "company", "source"), c("url"), c("n"), none),
        part(out.companies, F.lit("dictionary"), c("company"), none, one, none),
        part(out.items, F.lit("item"), c("item"), none, one, none),
        part(grouped, F.lit("rows"), c("region"), c("held"), c("n"), c("pay"))]
    found = parts[0]
    for df in parts[1:]:
        found = found.unionByName(df)
    return found


@check("bad_documents", """
  SELECT CASE c_nationkey % 3 WHEN 0 THEN 'lever' WHEN 1 THEN 'ashby' ELSE 'greenhouse' END AS source, lower(c_mktsegment) AS company,
         count(*) AS documents FROM customer WHERE c_custkey % 4 <> 0 GROUP BY 1, 2""")
def bad_documents(spark, sf):
    """Landed documents that are cut off, are no JSON, or hold no list of postings; every fourth is sound."""
    root, c = folder(spark), table(spark, sf, "customer")
    source = F.element_at(F.array(F.lit("lever"), F.lit("ashby"), F.lit("greenhouse")), (F.col("c_nationkey") % 3 + 1).cast("int"))
    sound = F.when(source == "lever", '[{"id": "1"}]').otherwise('{"jobs": []}')
    value = (F.when(F.col("c_custkey") % 4 == 0, sound).when(F.col("c_custkey") % 4 == 1, '{"jobs": [{"id')
             .when(F.col("c_custkey") % 4 == 2, "gateway error").otherwise('{"error": 404}'))
    c.select(source.alias("source"), F.lower("c_mktsegment").alias("company"), value.alias("value")).write.partitionBy(
        "source", "company").text(root)
    return boards.bad_documents(spark, root, lines=True)


@check("slice_report_job", rows(ALL, KEPT, select="""
  SELECT 'headline' AS chart, NULL AS name, count(*) AS n FROM z
  UNION ALL SELECT 'places', region, count(*) FROM z WHERE ok AND NOT is_management GROUP BY region HAVING count(*) >= 10"""))
def slice_report_job(spark, sf):
    """Every chart of one slice as one table; here the postings of the headline and the regions of the places."""
    store, _ = day_of(spark, sf)
    out = jobs.aggregate(spark, store, replicates=20)
    found = jobs.one_table(jobs.slice_report(out.slice, out.premium, 1))
    field = lambda name: F.get_json_object("row", f"$.{name}")
    return found.where("chart IN ('headline', 'places')").select(
        "chart", field("place").alias("name"), F.coalesce(field("postings"), field("n")).cast("bigint").alias("n")).where(
        "name IS NULL OR name IN ('us', 'eu', 'other')")
