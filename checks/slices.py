"""All charts of every slice, from the cube and from the whole slice report, against SQL over the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import L, P, S, check, labelled_postings, rows
from checks.pay import FLAGGED, PREMIUM, _flagged_premium
from paylens.operators import cube as c
from paylens.operators.sizes import stage
from paylens.plans import jobs

GRADES = ["5-LOW", "4-NOT SPECIFIED", "3-MEDIUM", "2-HIGH", "1-URGENT"]
COLUMNS = {  # chart: (name, count, numbers)
    "headline": ("top_item", "postings", ["new", "paid_n", "median", "median_month", "top_item_pct", "top_item_n"]),
    "histogram": ("bin", "n", ["low", "high"]), "marks": (None, "n", ["median", "p25", "p75"]),
    "grades": ("seniority", "n", ["median", "shown"]), "places": ("place", "n", ["median"]),
    "demand": ("item", "n", ["pct", "paid_n", "median"]), "payers": ("company", "n", ["median"]),
    "learn_next": ("item", "n", ["demand_pct", "premium_pct", "radius", "significant"])}


def flat(charts):
    """(chart, region, seniority, name, n, a to f) of all charts; a chart that ignores a filter has "all" there."""
    out = None
    for chart, (name, n, numbers) in COLUMNS.items():
        df = charts[chart]
        kept = [x for x in ("region", "seniority") if x in df.columns and x != name]
        where = [F.col(x).alias(x) if x in kept else F.lit("all").alias(x) for x in ("region", "seniority")]
        values = [F.round(F.col(x).cast("double"), 4) for x in numbers] + [F.lit(None).cast("double")] * (6 - len(numbers))
        named = F.lit(None) if name is None else F.col(name)
        part = df.select(F.lit(chart).alias("chart"), *where, named.cast("string").alias("name"), F.col(n).cast("bigint").alias("n"),
                         *[v.alias(x) for v, x in zip(values, "abcdef")])
        out = part if out is None else out.unionByName(part)
    return out


def chart_sql(chart, numbers, rest, region="sreg", seniority="sgr", name="name"):
    """One chart in the flat form; ``numbers`` are its values, ``rest`` follows the columns."""
    values = [f"round(CAST({x} AS DOUBLE), 4)" for x in numbers] + ["NULL"] * (6 - len(numbers))
    columns = ", ".join(f"{v} AS {x}" for v, x in zip(values, "abcdef"))
    return f"SELECT '{chart}' AS chart, {region} AS region, {seniority} AS seniority, {name} AS name, n, {columns} FROM {rest}"


# SL: every posting once per slice it belongs to; V: those with pay.
SLICES = [P, S, L, PREMIUM, FLAGGED, """
sl0 AS (SELECT *, unnest(CASE WHEN is_remote THEN [region, 'all', 'remote'] ELSE [region, 'all'] END) AS sreg FROM p),
sl AS (SELECT *, unnest([seniority, 'all']) AS sgr FROM sl0),
v AS (SELECT * FROM sl WHERE NOT is_management AND pay IS NOT NULL),
best AS (SELECT item, premium_pct, n AS top_n FROM fp WHERE n >= 15
  ORDER BY CASE WHEN coalesce(ci_lo <= 0, false) THEN 1 ELSE 0 END, premium_pct DESC, item LIMIT 1),
vs AS (SELECT sreg, sgr, count(*) AS n, median(pay) AS med, list_sort(list(pay)) AS l FROM v GROUP BY 1, 2),
tiles AS (SELECT sl.sreg, sl.sgr, count(*) AS n, count(*) FILTER (job_uid % 3 = 0) AS fresh, any_value(coalesce(vs.n, 0)) AS paid_n,
  any_value(CASE WHEN vs.n >= 10 THEN med END) AS med FROM sl LEFT JOIN vs ON vs.sreg = sl.sreg AND vs.sgr = sl.sgr GROUP BY 1, 2),
bins AS (SELECT sreg, sgr, least(floor(pay / 25000), 16) AS bin, count(*) AS n FROM v GROUP BY 1, 2, 3),
spine AS (SELECT vs.sreg, vs.sgr, b.bin, coalesce(bins.n, 0) AS n FROM vs JOIN (SELECT unnest(range(17)) AS bin) b ON vs.n >= 30
  LEFT JOIN bins ON bins.sreg = vs.sreg AND bins.sgr = vs.sgr AND bins.bin = b.bin),
grades AS (SELECT sreg, seniority, count(*) AS n, median(pay) AS med FROM v WHERE sgr = 'all' GROUP BY 1, 2),
places AS (SELECT sgr, place, count(*) AS n, median(pay) AS med FROM (
  SELECT sgr, pay, unnest([region, CASE WHEN is_remote THEN 'Remote' ELSE 'On-site' END]) AS place FROM v WHERE sreg = 'all')
  GROUP BY 1, 2 HAVING count(*) >= 10),
lab AS (SELECT sreg, sgr, count(*) AS labelled FROM sl JOIN newest ON newest.job_uid = sl.job_uid GROUP BY 1, 2),
held AS (SELECT sreg, sgr, l.skill AS name, count(*) AS n, count(pay) FILTER (NOT is_management) AS paid_n,
  median(pay) FILTER (NOT is_management) AS med FROM sl JOIN l ON l.job_uid = sl.job_uid WHERE l.skill IS NOT NULL GROUP BY 1, 2, 3),
demand AS (SELECT held.*, labelled, row_number() OVER (PARTITION BY held.sreg, held.sgr ORDER BY n DESC, name) AS r
  FROM held JOIN lab ON lab.sreg = held.sreg AND lab.sgr = held.sgr),
payers AS (SELECT *, row_number() OVER (PARTITION BY sreg, sgr ORDER BY med DESC, name) AS r FROM (
  SELECT sreg, sgr, company AS name, count(*) AS n, median(pay) AS med FROM v GROUP BY 1, 2, 3 HAVING count(*) >= 10)),
charts AS (""" + "\n  UNION ALL ".join([
    chart_sql("headline", ["fresh", "paid_n", "med", "med / 12", "premium_pct", "top_n"], "tiles LEFT JOIN best ON true", name="item"),
    chart_sql("histogram", ["bin * 25000", "CASE WHEN bin < 16 THEN (bin + 1) * 25000 END"], "spine", name="CAST(bin AS VARCHAR)"),
    chart_sql("marks", ["med", "l[CAST(least(n, floor(0.25 * n) + 1) AS INT)]", "l[CAST(least(n, floor(0.75 * n) + 1) AS INT)]"],
              "vs WHERE n >= 30", name="NULL"),
    chart_sql("grades", ["CASE WHEN n >= 10 THEN med END", "n >= 10"], "grades", seniority="'all'", name="seniority"),
    chart_sql("places", ["med"], "places", region="'all'", name="place"),
    chart_sql("demand", ["floor(1000 * n / labelled + 0.5) / 10", "paid_n", "CASE WHEN paid_n >= 10 THEN med END"],
              "demand WHERE labelled >= 100 AND r <= 15"),
    chart_sql("payers", ["med"], "payers WHERE r <= 10"),
    chart_sql("learn_next", ["round(100 * d.n / labelled, 1)", "premium_pct", "greatest(5.0, least(22.0, sqrt(fp.n) * 2))",
                             "NOT coalesce(ci_lo <= 0, false)"],
              "fp JOIN (SELECT sreg, sgr, name, n AS dn, labelled FROM demand) d ON fp.item = d.name "
              "WHERE round(100 * dn / labelled, 1) > 0").replace("d.n /", "dn /")]) + ")"]


def stored(spark, sf):
    return stage(labelled_postings(spark, sf).withColumn("is_new", (F.col("job_uid") % 3 == 0).cast("int")))


@check("slice_cube", rows(*SLICES, select="SELECT * FROM charts"))
def slice_cube(spark, sf):
    """Every chart of every region, remote or all, by every grade or all, from one cube."""
    df = stored(spark, sf)
    cube, premium = c.build_cube(df, "pay"), stage(_flagged_premium(spark, sf, df))
    return flat(c.slice_cube(cube, premium, 2) | {"grades": c.cube_grades(cube, order=GRADES)})


@check("slice_report_all", rows(*SLICES, select="""
  SELECT * REPLACE (CASE WHEN chart = 'places' THEN 'all' ELSE region END AS region) FROM charts
  WHERE (region = 'remote' OR chart = 'places') AND (seniority = '2-HIGH' OR chart = 'grades')"""))
def slice_report_all(spark, sf):
    """The whole report of one slice, read from the rows."""
    df = stored(spark, sf)
    report = jobs.slice_report(df, stage(_flagged_premium(spark, sf, df)), 2, "remote", "2-HIGH", value="pay", order=GRADES)
    given = {name: {"places": ["seniority"], "grades": ["region"]}.get(name, ["region", "seniority"]) for name in report}
    chosen = {"region": F.lit("remote"), "seniority": F.lit("2-HIGH")}
    return flat({name: df.withColumns({x: chosen[x] for x in given[name]}) for name, df in report.items()})
