"""Premium, medians, demand and the other slice reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import replay
from checks.base import L, P, S, check, labelled_postings, postings, rows
from paylens.functions.classify import paid
from paylens.operators import premium as pr
from paylens.operators import quantiles, reports
from paylens.operators.sizes import stage

STRATA = ["seniority", "region"]
GRADES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]

PREMIUM = """m AS (SELECT p.* FROM p JOIN newest n ON p.job_uid = n.job_uid WHERE has_pay AND NOT is_management),
items AS (SELECT DISTINCT skill FROM l WHERE skill IS NOT NULL),
x AS (SELECT i.skill AS item, m.seniority, m.region, m.pay, l.skill IS NOT NULL AS has
  FROM m CROSS JOIN items i LEFT JOIN l ON l.job_uid = m.job_uid AND l.skill = i.skill),
cells AS (SELECT item, seniority, region, count(*) FILTER (has) AS nw, count(*) FILTER (NOT has) AS nwo,
  median(pay) FILTER (has) AS mw, median(pay) FILTER (NOT has) AS mwo FROM x GROUP BY 1, 2, 3),
ok AS (SELECT * FROM (SELECT *, sum(nw) OVER (PARTITION BY item) AS total FROM cells)
  WHERE nw >= 8 AND nwo >= 8 AND total >= 15),
pct AS (SELECT item, CAST(sum(nw) AS BIGINT) AS n, (sum(mw / mwo * nw) / sum(nw) - 1) * 100 AS pct FROM ok GROUP BY 1),
mid AS (SELECT x.item, median(pay) AS m FROM x JOIN ok ON x.item = ok.item AND x.seniority = ok.seniority
  AND x.region = ok.region WHERE has GROUP BY 1),
premium AS (SELECT pct.item, n, round_even(pct, 1) AS premium_pct, round_even(m, 0) AS median_with
  FROM pct JOIN mid ON pct.item = mid.item WHERE pct > 0 ORDER BY premium_pct DESC, pct.item LIMIT 10)"""


def paid_members(spark, sf, labelled=None):
    """Stored, as the latest slice is; ``labelled`` are the labelled postings where they are stored already."""
    labelled = labelled_postings(spark, sf) if labelled is None else labelled
    return stage(paid(labelled, "pay", has_salary="has_pay").select("skills", "pay", *STRATA))


@check("stratified_premium", rows(P, S, L, PREMIUM, select="SELECT * FROM premium"))
def stratified_premium(spark, sf, labelled=None):
    return pr.stratified_premium(paid_members(spark, sf, labelled), "skills", "pay", STRATA)


REPLICATES = 1000
NAME = "'20260719|' || has || '|' || item || '|' || seniority || '|' || region || '|' || rep"
RESAMPLED = f"""pool AS (SELECT x.item, x.seniority, x.region, has, pay, row_number() OVER w AS r, count(*) OVER w2 AS n
  FROM x JOIN ok ON x.item = ok.item AND x.seniority = ok.seniority AND x.region = ok.region
  JOIN premium ON x.item = premium.item WINDOW w AS (PARTITION BY x.item, x.seniority, x.region, has ORDER BY pay),
  w2 AS (PARTITION BY x.item, x.seniority, x.region, has)),
named AS (SELECT *, {NAME} AS name, (n + 1) // 2 AS mid FROM (SELECT DISTINCT item, seniority, region, has, n FROM pool),
  (SELECT unnest(range({REPLICATES})) AS rep)),
drawn AS (SELECT *, {replay.beta("name", "mid", "n - mid + 1")} AS u, {replay.uniform("name || '|c'")} AS v FROM named),
low AS (SELECT *, greatest(1, least(n, ceil(n * u))) AS lo FROM drawn),
high AS (SELECT *, CASE WHEN n % 2 = 1 THEN lo ELSE greatest(lo, least(n, ceil(n * (1 - (1 - u) * pow(v, 1 / CAST(n - mid AS DOUBLE))))))
  END AS hi FROM low),
med AS (SELECT h.item, h.seniority, h.region, h.has, h.rep, h.n, (a.pay + b.pay) / 2 AS m FROM high h
  JOIN pool a ON a.item = h.item AND a.seniority = h.seniority AND a.region = h.region AND a.has = h.has AND a.r = h.lo
  JOIN pool b ON b.item = h.item AND b.seniority = h.seniority AND b.region = h.region AND b.has = h.has AND b.r = h.hi),
est AS (SELECT a.item, a.rep, (sum(a.m / b.m * a.n) / sum(a.n) - 1) * 100 AS e FROM med a JOIN med b ON a.item = b.item
  AND a.seniority = b.seniority AND a.region = b.region AND a.rep = b.rep AND a.has AND NOT b.has GROUP BY 1, 2),
ci AS (SELECT item, list_sort(list(e)) AS l FROM est GROUP BY 1)"""


@check("premium_bootstrap_ci", rows(P, S, L, PREMIUM, RESAMPLED, select=f"""
  SELECT premium.*, round_even(l[CAST(floor(0.025 * {REPLICATES - 1}) AS INT) + 1], 1) AS ci_lo,
         round_even(l[CAST(floor(0.975 * {REPLICATES - 1}) AS INT) + 1], 1) AS ci_hi FROM premium JOIN ci ON premium.item = ci.item"""))
def premium_bootstrap_ci(spark, sf):
    return pr.premium_with_ci(paid_members(spark, sf), "skills", "pay", STRATA, replicates=REPLICATES)


PAID = "v AS (SELECT * FROM p WHERE NOT is_management AND pay IS NOT NULL)"


def paid_postings(spark, sf):
    return paid(postings(spark, sf), "pay")


@check("value_histogram", rows(P, PAID, "b AS (SELECT CAST(range AS INT) AS bin FROM range(17))", select="""
  SELECT bin, CAST(bin * 25000 AS BIGINT) AS low, CASE WHEN bin < 16 THEN CAST((bin + 1) * 25000 AS BIGINT) END AS high,
         (SELECT count(*) FROM v WHERE CAST(least(floor(pay / 25000), 16) AS INT) = bin) AS n
  FROM b WHERE (SELECT count(*) FROM v) >= 30"""))
def value_histogram(spark, sf):
    return reports.histogram(paid_postings(spark, sf), "pay")


RANKED = """r AS (SELECT region, pay, row_number() OVER (PARTITION BY region ORDER BY pay) AS i,
  count(*) OVER (PARTITION BY region) AS n FROM v)"""


@check("index_quantiles", rows(P, PAID, RANKED, select="""
  SELECT region, n, max(pay) FILTER (i = least(n, floor(0.25 * n) + 1)) AS p25,
         max(pay) FILTER (i = least(n, floor(0.75 * n) + 1)) AS p75,
         max(pay) FILTER (i = least(n, floor(0.9 * n) + 1)) AS p90 FROM r GROUP BY 1, 2"""))
def index_quantiles(spark, sf):
    return quantiles.grouped_quantiles(paid_postings(spark, sf), ["region"], "pay", {
        "p25": quantiles.index_rank(0.25), "p75": quantiles.index_rank(0.75), "p90": quantiles.index_rank(0.9)})


@check("distribution_marks", rows(P, PAID, "r AS (SELECT pay, row_number() OVER (ORDER BY pay) AS i, count(*) OVER () AS n FROM v)",
                                  select="""
  SELECT n, round(median(pay), 4) AS median, max(pay) FILTER (i = least(n, floor(0.25 * n) + 1)) AS p25,
         max(pay) FILTER (i = least(n, floor(0.75 * n) + 1)) AS p75 FROM r GROUP BY n"""))
def distribution_marks(spark, sf):
    return reports.distribution_marks(paid_postings(spark, sf), "pay").withColumn("median", F.round("median", 4))


@check("median_by_grade", rows(P, PAID, select="""
  SELECT seniority, count(*) AS n, CASE WHEN count(*) >= 700 THEN round(median(pay), 4) END AS median,
         count(*) >= 700 AS shown FROM v GROUP BY 1"""))
def median_by_grade(spark, sf):
    return reports.median_by_grade(paid_postings(spark, sf), "pay", min_n=700, order=GRADES).withColumn(
        "median", F.round("median", 4))


@check("median_by_place", rows(P, PAID, select="""
  SELECT place, count(*) AS n, round(median(pay), 4) AS median FROM (
    SELECT region AS place, pay FROM v UNION ALL
    SELECT CASE WHEN is_remote THEN 'Remote' ELSE 'On-site' END, pay FROM v) GROUP BY 1 HAVING count(*) >= 10"""))
def median_by_place(spark, sf):
    return reports.median_by_place(paid_postings(spark, sf), "pay").withColumn("median", F.round("median", 4))


@check("median_over_history", rows(P, select="""
  SELECT snapshot_date, seniority, count(pay) AS n, round(median(pay), 4) AS median FROM p WHERE pay IS NOT NULL
  GROUP BY 1, 2"""))
def median_over_history(spark, sf):
    return quantiles.median_by(postings(spark, sf), ["snapshot_date", "seniority"], "pay").withColumn(
        "median", F.round("median", 4))


SHARES = """h AS (SELECT l.skill AS item, p.job_uid, p.pay, p.is_management FROM l JOIN p ON l.job_uid = p.job_uid
  WHERE l.skill IS NOT NULL),
labelled AS (SELECT count(*) AS n FROM p JOIN newest n ON p.job_uid = n.job_uid)"""


@check("item_demand", rows(P, S, L, SHARES, select="""
  SELECT item, count(*) AS n, floor(1000 * count(*) / (SELECT n FROM labelled) + 0.5) / 10 AS pct,
         count(*) FILTER (NOT is_management AND pay IS NOT NULL) AS paid_n,
         CASE WHEN count(*) FILTER (NOT is_management AND pay IS NOT NULL) >= 10
              THEN round(median(pay) FILTER (NOT is_management), 4) END AS median
  FROM h GROUP BY 1 ORDER BY n DESC, item LIMIT 15"""))
def item_demand(spark, sf):
    return reports.item_demand(labelled_postings(spark, sf), value="pay").withColumn("median", F.round("median", 4))


@check("top_payers", rows(P, PAID, """emp AS (SELECT company, source, count(*) AS c FROM p GROUP BY 1, 2
  ORDER BY c DESC, company, source LIMIT 10)""", select="""
  SELECT t.*, CASE WHEN emp.company IS NOT NULL THEN 'https://jobs.lever.co/' || t.company END AS url FROM (
    SELECT company, count(*) AS n, round(median(pay), 4) AS median FROM v GROUP BY 1 HAVING count(*) >= 5
    ORDER BY median(pay) DESC, company LIMIT 10) t LEFT JOIN emp ON t.company = emp.company"""))
def top_payers(spark, sf):
    p = postings(spark, sf)
    employers = reports.top_entities(p.withColumn("source", F.lit("lever")))
    return reports.top_payers(paid(p, "pay"), employers, "pay", min_n=5).withColumn("median", F.round("median", 4))


def _flagged_premium(spark, sf, labelled=None):
    best = stratified_premium(spark, sf, labelled)
    return best.withColumns({"ci_lo": F.when(F.col("n") % 3 == 0, -1.0).when(F.col("n") % 3 == 1, 1.0),
                             "ci_hi": F.lit(99.0)})


FLAGGED = """fp AS (SELECT *, CASE WHEN n % 3 = 0 THEN -1.0 WHEN n % 3 = 1 THEN 1.0 END AS ci_lo FROM premium)"""


@check("headline", rows(P, S, L, PREMIUM, FLAGGED, PAID, """
best AS (SELECT item, premium_pct, n FROM fp WHERE n >= 15
  ORDER BY CASE WHEN coalesce(ci_lo <= 0, false) THEN 1 ELSE 0 END, premium_pct DESC, item LIMIT 1)""", select="""
  SELECT (SELECT count(*) FROM p) AS postings, (SELECT count(*) FROM p WHERE is_remote) AS new,
         (SELECT count(*) FROM v) AS paid_n, (SELECT round(median(pay), 4) FROM v) AS median,
         (SELECT round(median(pay) / 12, 4) FROM v) AS median_month, (SELECT item FROM best) AS top_item,
         (SELECT premium_pct FROM best) AS top_item_pct, (SELECT n FROM best) AS top_item_n"""))
def headline(spark, sf):
    p = postings(spark, sf).withColumn("is_new", F.col("is_remote").cast("int"))
    return reports.headline(p, _flagged_premium(spark, sf), 2, "pay").withColumns({
        "median": F.round("median", 4), "median_month": F.round("median_month", 4)})


@check("learn_next", rows(P, S, L, PREMIUM, FLAGGED, SHARES, "d AS (SELECT item, count(*) AS c FROM h GROUP BY 1)", select="""
  SELECT fp.item, round(100 * c / (SELECT n FROM labelled), 1) AS demand_pct, premium_pct, n,
         round(greatest(5.0, least(22.0, sqrt(n) * 2)), 4) AS radius, NOT coalesce(ci_lo <= 0, false) AS significant
  FROM fp JOIN d ON fp.item = d.item WHERE round(100 * c / (SELECT n FROM labelled), 1) > 0"""))
def learn_next(spark, sf):
    shares = reports.item_shares(labelled_postings(spark, sf))
    return reports.learn_next(_flagged_premium(spark, sf), shares).withColumn("radius", F.round("radius", 4))
