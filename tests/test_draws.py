"""Random variates by name: their laws, and the same numbers from SQL."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from checks import replay
from paylens.functions import draws
from paylens.operators import evaluate, groups

DRAWS = 40_000


def named(spark, prefix, parts=8):
    return spark.range(DRAWS).repartition(parts).select("id", F.concat(F.lit(prefix), "id").alias("name"))


@pytest.mark.parametrize("n", [1, 2, 7, 8])
def test_median_ranks_have_the_law_of_a_resample(spark, n):
    got = named(spark, "m").select(draws.median_ranks(F.col("name"), F.lit(n).cast("bigint")).alias("r")).select("r.*").toPandas()
    low, high = got.low.to_numpy(), got.high.to_numpy()
    full = np.sort(np.random.default_rng(1).integers(1, n + 1, (DRAWS, n)), axis=1)
    want_low, want_high = full[:, (n - 1) // 2], full[:, n // 2]
    for got, want in ((low, want_low), (high, want_high), (low + high, want_low + want_high), (low * high, want_low * want_high)):
        for v in range(1, n * n + 1):
            assert abs((got == v).mean() - (want == v).mean()) < .015


@pytest.mark.parametrize(("n", "p"), [(0, .5), (1, .2), (5, .7), (40, .05), (1000, .31), (7, 0.0), (7, 1.0), (10**12, .5)])
def test_binomial_law(spark, n, p):
    got = named(spark, "b").select(draws.binomial(F.col("name"), F.lit(n), F.lit(p)).alias("x")).toPandas().x.to_numpy()
    want = np.random.default_rng(2).binomial(n, p, DRAWS)
    spread = max(1e-9, (n * p * (1 - p)) ** .5)
    assert abs(got.mean() - n * p) <= 5 * spread / DRAWS ** .5 + 1e-9
    assert abs(got.std() - spread) <= .03 * spread + 1e-9
    assert got.min() >= 0 and got.max() <= n
    if 0 < n <= 40:
        for v in range(n + 1):
            assert abs((got == v).mean() - (want == v).mean()) < .015


@pytest.mark.parametrize("shape", [1.0, 1.5, 60.0, 1e6])
def test_gamma_law(spark, shape):
    got = named(spark, "g").select(draws.gamma(F.col("name"), F.lit(shape)).alias("x")).toPandas().x.to_numpy()
    want = np.random.default_rng(3).gamma(shape, size=DRAWS)
    for q in (.01, .1, .5, .9, .99):
        at = np.quantile(want, q)
        assert abs((got <= at).mean() - q) < .012


def test_draws_do_not_depend_on_partitions_and_sql_replays_them(spark):
    def beta(parts):
        rows = named(spark, "s|", parts).select("id", draws.beta(F.col("name"), F.col("id") % 9 + 1, F.col("id") % 5 + 1).alias("x"))
        return [r.x for r in rows.orderBy("id").collect()]
    once = beta(8)
    assert once == beta(3)
    sql = replay.beta("'s|' || id", "id % 9 + 1", "id % 5 + 1")
    want = duckdb.connect().execute(f"SELECT {sql} FROM (SELECT range AS id FROM range({DRAWS})) ORDER BY id").fetchall()
    assert np.allclose(once, [x for x, in want], rtol=1e-12, atol=0)


def test_f1_interval_matches_full_resampling(spark):
    rng = np.random.default_rng(5)
    counts = rng.integers(0, 4, (300, 3))
    df = spark.createDataFrame([(i, *map(int, c)) for i, c in enumerate(counts)], "id long, tp int, fp int, fn int")
    got = evaluate.f1_ci(df, replicates=2000).first()
    picks = counts[rng.integers(0, 300, (2000, 300))].sum(axis=1)
    full = np.sort(2 * picks[:, 0] / (2 * picks[:, 0] + picks[:, 1] + picks[:, 2]))
    assert got.ci_lo == pytest.approx(full[int(.025 * 1999)], abs=.008)
    assert got.ci_hi == pytest.approx(full[int(.975 * 1999)], abs=.008)
    assert evaluate.f1_ci(df.repartition(7), replicates=50).first() == evaluate.f1_ci(df, replicates=50).first()


def test_global_rank(spark):
    rng = np.random.default_rng(6)
    rows = [(int(k), None if k % 11 == 0 else float(v)) for k, v in enumerate(rng.integers(0, 50, 3000))]
    df = spark.createDataFrame(rows, "id long, v double").repartition(5)
    got = {r.id: r.place for r in groups.global_rank(df, [F.desc("v"), F.asc("id")], "place").collect()}
    order = sorted(rows, key=lambda r: (r[1] is None, -(r[1] or 0), r[0]))
    assert got == {k: n + 1 for n, (k, _) in enumerate(order)}
    assert groups.global_rank(df.limit(0), [F.asc("id")]).count() == 0


def test_queue_without_limit_takes_turns(spark):
    rng = np.random.default_rng(7)
    rows = [(k, None if s == 4 else f"s{s}", int(rng.integers(0, 400))) for k, s in enumerate(rng.choice(5, 900, p=[.6, .2, .1, .06, .04]))]
    df = spark.createDataFrame(rows, "id long, source string, day int").repartition(6)
    order = [F.desc("day"), F.asc("id")]
    got = [r.id for r in groups.interleave(df, "source", "id", order).orderBy("position").collect()]
    lines = {}
    for k, s, d in sorted(rows, key=lambda r: (-r[2], r[0])):
        lines.setdefault(s, []).append(k)  # sources in the order of their best rows
    want = [line[turn] for turn in range(900) for line in lines.values() if turn < len(line)]
    assert got == want
    few = groups.interleave(df, "source", "id", order, 40).orderBy("position").collect()
    assert [r.id for r in few] == want[:40]
    positions = [r.position for r in groups.interleave(df, "source", "id", order).orderBy("position").collect()]
    assert positions == list(range(1, 901))


def test_top_rows_of_a_hot_group_in_three_cuts(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(k, "hot" if rng.random() < .9 else f"g{k % 5}", int(rng.integers(0, 1000))) for k in range(4000)]
    df = spark.createDataFrame(rows, "id long, g string, v int").repartition(4)
    order = [F.desc("v"), F.asc("id")]
    want = {}
    for k, g, v in sorted(rows, key=lambda r: (-r[2], r[0])):
        want.setdefault(g, []).append(k)
    for at_once in (groups.AT_ONCE, 100):
        monkeypatch.setattr(groups, "AT_ONCE", at_once)
        got = groups.top_per_group(df, ["g"], "id", order, 70).collect()
        assert {(r.g, r._place, r.id) for r in got} == {(g, n + 1, k) for g, ks in want.items() for n, k in enumerate(ks[:70])}
