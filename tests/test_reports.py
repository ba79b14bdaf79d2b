import json
from statistics import median

from pyspark.sql import functions as F

from paylens.operators import reports


def slice_of(spark):
    rows = [("us" if i % 3 else "eu", ["senior", "mid", "junior"][i % 3], i % 2 == 0, i % 11 == 0, f"c{i % 4}",
             50000.0 + 1000 * i if i % 5 else None, None if i % 7 == 0 else (["Go"] if i % 2 else ["Go", "C#"]), i % 6 == 0)
            for i in range(200)]
    return spark.createDataFrame(rows, "region string, seniority string, is_remote boolean, is_management boolean, "
                                       "company string, salary_mid_usd double, skills array<string>, is_new boolean"
                                 ).withColumn("is_new", F.col("is_new").cast("int"))


def premium(spark, rows):
    return spark.createDataFrame(rows, "item string, n bigint, premium_pct double, median_with double, ci_lo double, "
                                       "ci_hi double")


def test_thin_slices_are_hidden(spark):
    df = slice_of(spark)
    thin = df.limit(9)
    assert reports.histogram(thin).count() == 0 and reports.distribution_marks(thin).count() == 0
    assert reports.item_demand(thin).count() == 0 and reports.median_by_place(thin).count() == 0
    grades = {r.seniority: r for r in reports.median_by_grade(thin, min_n=3).collect()}
    assert all(r.shown == (r.n >= 3) and (r.median is not None) == r.shown for r in grades.values())


def test_histogram_has_empty_bins_and_an_open_end(spark):
    df = spark.createDataFrame([(v,) for v in [24999.0, 25000.0, 400000.0, 900000.0, None] + [60000.0] * 30], "v double")
    got = {r["bin"]: r.n for r in reports.histogram(df, "v").collect()}
    assert len(got) == 17 and (got[0], got[1], got[2], got[5], got[16]) == (1, 1, 30, 0, 2)


def test_headline_picks_a_solid_premium_first(spark):
    df = slice_of(spark)
    best = premium(spark, [("A", 14, 50.0, 1.0, 2.0, 3.0), ("B", 20, 40.0, 1.0, -1.0, 3.0), ("C", 20, 30.0, 1.0, 1.0, 3.0)])
    row = reports.headline(df, best, days=2).first()
    pay = [r.salary_mid_usd for r in df.where("not is_management and salary_mid_usd is not null").collect()]
    assert (row.top_item, row.postings, row.paid_n, row.median) == ("C", 200, len(pay), median(pay))
    assert row.median_month == median(pay) / 12 and row.new == df.where("is_new = 1").count()
    assert reports.headline(df, best.where("item = 'B'"), days=1).first().top_item == "B"
    none = reports.headline(df.limit(5), best.where("item = 'A'"), days=1).first()
    assert (none.new, none.median, none.top_item) == (None, None, None)


def test_learn_next(spark):
    best = premium(spark, [("Go", 4, 50.0, 1.0, None, None), ("C#", 400, 40.0, 1.0, -1.0, 3.0), ("Zig", 9, 1.0, 1.0, 1.0, 1.0)])
    got = {r.item: r for r in reports.learn_next(best, reports.item_shares(slice_of(spark))).collect()}
    assert set(got) == {"Go", "C#"} and (got["Go"].radius, got["C#"].radius) == (5.0, 22.0)
    assert got["Go"].significant and not got["C#"].significant and got["Go"].demand_pct == 100.0


def test_pulse_and_coverage_edge_cases(spark):
    series = spark.createDataFrame([(i, 1, 1, float(i) if i < 6 else None) for i in range(8)],
                                   "d int, active int, new int, median double")
    assert reports.pulse(series).where("median is not null").count() == 0
    assert reports.pulse(series, 6).where("median is not null").count() == 6
    empty = spark.createDataFrame([], "job_uid string, has_salary boolean")
    marks = spark.createDataFrame([("a", "Go")], "job_uid string, skill string")
    row = reports.coverage(empty, marks).first()
    assert (row.total, row.paid_share, row.labelled_share) == (0, 0.0, 0.0)


def test_positional_rows_round_trip(spark):
    rows = [("us", 'se"n,ior', True, False, 3, 245000.5, [0, 14], 1), (None, None, None, None, None, None, None, 0),
            ("e[u", "x", False, True, 0, 1e9, [], 0)]
    df = spark.createDataFrame(rows, "region string, seniority string, is_remote boolean, is_management boolean, company_idx bigint, "
                                     "salary_mid_usd double, item_idx array<bigint>, is_new int")
    lines = reports.positional_rows(df)
    texts = [json.loads(r.value) for r in lines.collect()]
    assert texts == [[r[0], r[1], int(bool(r[2])), int(bool(r[3])), *r[4:]] for r in rows]
    back = reports.read_positional(lines).collect()
    assert [tuple(r) for r in back] == [(r[0], r[1], int(bool(r[2])), int(bool(r[3])), *r[4:]) for r in rows]
    size = sum(len(r.value) + 1 for r in lines.collect())
    assert tuple(reports.compact_size(lines).first()) == (3, size, True)
    assert not reports.compact_size(lines, size - 1).first().fits


def test_distinct_counts_over_any_days(spark):
    df = spark.range(60_000).selectExpr("id % 30 as day", "concat('c', id % 7001) as company")
    sketches = reports.distinct_sketches(df, ["day"], "company")
    for days in (range(1), range(10), range(30)):
        part = sketches.where(F.col("day").isin(list(days)))
        exact = df.where(F.col("day").isin(list(days))).select("company").distinct().count()
        assert abs(reports.distinct_over(part).first().n - exact) <= 0.03 * exact
    both = reports.distinct_over(sketches.withColumn("half", F.col("day") < 15), ["half"]).collect()
    assert len(both) == 2
