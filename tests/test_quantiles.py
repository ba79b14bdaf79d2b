import random
from statistics import median

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paylens.operators import premium as pr
from paylens.operators import quantiles as q


def test_quantiles_match_sorting(spark):
    rng = random.Random(1)
    rows = [(rng.choice("abcde") if rng.random() > .05 else None,
             rng.choice([None, -5.0, 0.0, 1e-9, 7.5, rng.uniform(-1e6, 1e6), float(rng.randint(1, 40))]))
            for _ in range(3000)] + [("hot", float(rng.randint(1, 3))) for _ in range(1500)] + [("one", 4.25)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in q.grouped_quantiles(df, ["g"], "v", {
        "m": q.median_ranks, "p25": q.index_rank(.25), "p75": q.index_rank(.75), "p100": q.index_rank(1)}).collect()}
    groups = {}
    for g, v in rows:
        if v is not None:
            groups.setdefault(g, []).append(v)
    assert set(got) == set(groups)
    for g, vs in groups.items():
        vs.sort()
        at = lambda p: vs[min(len(vs) - 1, int(p * len(vs)))]
        assert got[g].n == len(vs)
        assert got[g].m == pytest.approx(median(vs)) and (got[g].p25, got[g].p75, got[g].p100) == (at(.25), at(.75), vs[-1])


def test_global_quantile_and_min_n(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0)], "g string, v double")
    assert q.median_by(df, [], "v").first().median == 3.0
    assert [r.g for r in q.median_by(df, ["g"], "v", min_n=2).collect()] == ["a"]
    assert q.index_quantile(df, "v", .5).first()["quantile"] == 3.0


def test_bucket_never_decreases(spark):
    rng = random.Random(2)
    values = sorted([rng.uniform(-1e7, 1e7) for _ in range(3000)] + [float(i) for i in range(-50, 50)])
    df = spark.createDataFrame([(v,) for v in values], "v double").coalesce(1)
    got = [r.b for r in df.select(q.bucket(F.col("v")).alias("b")).collect()]
    assert got == sorted(got)


PREMIUM_SQL = """
WITH known AS (SELECT row_number() OVER () AS k, * FROM postings WHERE items IS NOT NULL),
names AS (SELECT DISTINCT unnest(items) AS item FROM known),
cells AS (SELECT item, s, list(pay) FILTER (list_contains(items, item)) AS holding,
    list(pay) FILTER (NOT list_contains(items, item)) AS lacking FROM known CROSS JOIN names GROUP BY item, s),
sized AS (SELECT *, sum(coalesce(len(holding), 0)) OVER (PARTITION BY item) AS total FROM cells),
good AS (SELECT * FROM sized WHERE len(holding) >= 8 AND len(lacking) >= 8 AND total >= 15)
SELECT item, sum(len(holding)) AS n,
  (sum(list_median(holding) / list_median(lacking) * len(holding)) / sum(len(holding)) - 1) * 100 AS pct,
  list_median(flatten(list(holding))) AS mid, list((holding, lacking)) AS pools
FROM good GROUP BY item HAVING pct > 0"""


def premium_by_sql(rows):
    """item to (n, per cent, median, [(pay of holders, pay of others)])."""
    postings = pd.DataFrame(rows, columns=["s", "pay", "items"])  # noqa: F841  (read by DuckDB)
    return {r[0]: (int(r[1]), *r[2:]) for r in duckdb.connect().execute(PREMIUM_SQL).fetchall()}


def _rows(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        items = None if rng.random() < .1 else sorted(rng.sample(["A", "B", "C", "D", "E"], rng.randint(0, 3)))
        pay = rng.choice([100, 110, 120, rng.randint(80, 200)]) * 1000.0 + (15000 if items and "B" in items else 0)
        rows.append((rng.choice(["s1", "s1", "s1", "s2", "s3"]), pay, items))
    return rows + [("tiny", 1e5, ["Z"])] * 9


def test_premium_matches_sql(spark):
    for seed in (1, 2):
        rows = _rows(seed)
        df = spark.createDataFrame(rows, "s string, pay double, items array<string>").repartition(6)
        got = {r.item: r for r in pr.stratified_premium(df, "items", "pay", ["s"], k=None).collect()}
        want = premium_by_sql(rows)
        assert set(got) == set(want)
        for item, (n, pct, mid, _) in want.items():
            assert got[item].n == n and got[item].premium_pct == pytest.approx(pct, abs=.0501)
            assert got[item].median_with == pytest.approx(mid, abs=.5)


def synthetic(spark, unlabelled):
    rows = ([("x", 200000.0, ["Python"])] * 16 + [("x", 100000.0, [])] * 10 + [("x", 500000.0, None)] * unlabelled)
    return spark.createDataFrame(rows, "s string, pay double, items array<string>")


def test_unlabelled_rows_are_no_evidence(spark):
    row = pr.stratified_premium(synthetic(spark, 50), "items", "pay", ["s"]).first()
    assert (row.item, row.n, row.premium_pct, row.median_with) == ("Python", 16, 100.0, 200000.0)


def test_interval_matches_full_resampling(spark):
    rows = _rows(3)
    df = spark.createDataFrame(rows, "s string, pay double, items array<string>").repartition(6)
    got = {r.item: r for r in pr.premium_with_ci(df, "items", "pay", ["s"], replicates=1000).collect()}
    rng = np.random.default_rng(0)
    want = premium_by_sql(rows)
    assert "B" in got and set(got) == set(want)
    for item, (n, pct, _, pools) in want.items():
        est = sorted((sum(np.median(rng.choice(w, len(w))) / np.median(rng.choice(wo, len(wo))) * len(w)
                          for w, wo in pools) / n - 1) * 100 for _ in range(1000))
        assert got[item].ci_lo == pytest.approx(est[int(.025 * 999)], abs=2.0)
        assert got[item].ci_hi == pytest.approx(est[int(.975 * 999)], abs=2.0)
        assert got[item].ci_lo <= got[item].premium_pct <= got[item].ci_hi


def test_interval_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(_rows(4, 400), "s string, pay double, items array<string>")
    runs = [pr.premium_with_ci(df.repartition(n), "items", "pay", ["s"], replicates=50).collect() for n in (1, 7)]
    assert runs[0] == runs[1]
