"""Exact medians and index quantiles of groups of any size.

A group may hold a third of all rows, so no group is ever gathered in one task. A first pass counts rows by group and a
coarse, order-keeping bucket of the value, which combines before the shuffle to a small histogram per group; running
totals over it say which bucket holds a wanted rank. These picks, a few rows per group, are written out. A second pass
keeps only rows of picked buckets, and orders their values slot by slot, so that a bucket into which most values fall is
ordered by many tasks. Nearly unique values are thus never shuffled as a whole.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.operators.sizes import stage

SLOTS_PER_BUCKET = 4096
BUCKETS_PER_E_FOLD = 128  # a bucket spans about 0.8 % of its value; all doubles need under 0.2 million buckets

Ranks = Callable[[Column], Column]


def median_ranks(n: Column) -> Column:
    """1-based ranks whose mean is the median."""
    half = F.floor(n / 2)
    return F.when(n % 2 == 1, F.array(half + 1)).otherwise(F.array(half, half + 1))


def index_rank(q: float) -> Ranks:
    """Rank of ``sorted[min(n - 1, floor(q * n))]``."""
    return lambda n: F.array(F.least(n, F.floor(n * F.lit(float(q))) + 1))


def bucket(value: Column, per_e_fold: int = BUCKETS_PER_E_FOLD) -> Column:
    """Bucket that never decreases when the value grows; powers of two make finer buckets nest in coarser ones."""
    v = value.cast("double")
    return F.floor(F.signum(v) * F.log1p(F.abs(v)) * per_e_fold)


def value_counts(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """(by, _value, _bucket, _n): how often each value occurs in each group; NULL values are left out."""
    return (df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_value"))
            .groupBy(*by, "_value").agg(F.count(F.lit(1)).alias("_n"))
            .withColumn("_bucket", bucket(F.col("_value"))))


def bucket_counts(counts: DataFrame, by: list[str]) -> DataFrame:
    return counts.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_n"))


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner",
              extra: Column | None = None) -> DataFrame:
    """Join on equally named keys, NULL matching NULL; the right side's keys are dropped.

    NULL-safe keys also keep Catalyst from adding a not-null filter to one use of a count table only, so both uses
    share one shuffle.
    """
    renamed = right.select(*[F.col(k).alias(f"_right_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(renamed, on if extra is None else on & extra, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_right_{k}" for k in keys])


def running(df: DataFrame, by: list[str], order: str) -> DataFrame:
    """Add the half-open rank interval (_below, _upto] that each row's ``_n`` members occupy in their group."""
    w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.withColumn("_upto", F.sum("_n").over(w)).withColumn("_below", F.col("_upto") - F.col("_n"))


def running_values(df: DataFrame, keys: list[str]) -> DataFrame:
    """``running`` over the values of each group of ``keys``, without one task per group: totals of narrow slots come
    first and give every slot its offset. A slot is 2e-6 of its value wide."""
    slotted = df.withColumn("_slot", bucket(F.col("_value"), BUCKETS_PER_E_FOLD * SLOTS_PER_BUCKET))
    totals = slotted.groupBy(*keys, "_slot").agg(F.sum("_n").alias("_n"))
    offsets = running(totals, keys, "_slot").select(*keys, "_slot", F.col("_below").alias("_offset"))
    grain = [*keys, "_slot"]
    placed = running(join_same(slotted, offsets, grain), grain, "_value")
    return placed.withColumns({"_upto": F.col("_upto") + F.col("_offset"),
                               "_below": F.col("_below") + F.col("_offset")}).drop("_slot", "_offset")


def _inside(ranks: Column) -> Column:
    return F.filter(ranks, lambda r: (r["rank"] > F.col("_below")) & (r["rank"] <= F.col("_upto")))


def locate(histogram: DataFrame, by: list[str], wanted: dict[str, Ranks], min_n: int = 1) -> DataFrame:
    """(by, _bucket, _base, _wanted, n): the buckets that hold a wanted rank, for groups of at least ``min_n``."""
    def named(q: str, ranks: Column) -> Column:
        return F.transform(ranks, lambda r: F.struct(F.lit(q).alias("name"), r.alias("rank")))

    ranks = F.concat(*[named(q, f(F.col("n"))) for q, f in wanted.items()])
    placed = running(histogram, by, "_bucket").withColumn("n", F.sum("_n").over(Window.partitionBy(*by)))
    hit = reduce(lambda a, b: a | b, [  # plain comparisons drop nearly every bucket before any array is built
        (F.element_at(f(F.col("n")), i) > F.col("_below")) & (F.element_at(f(F.col("n")), i) <= F.col("_upto"))
        for f in wanted.values() for i in (1, -1)])
    return (placed.where((F.col("n") >= min_n) & hit).withColumn("_wanted", _inside(ranks))
            .select(*by, "_bucket", F.col("_below").alias("_base"), "_wanted", "n"))


def resolve(counts: DataFrame, picks: DataFrame, by: list[str], wanted: list[str]) -> DataFrame:
    """(by, n, one column per wanted name) from the counts of the picked buckets."""
    keys = [*by, "_bucket"]
    inside = join_same(counts.select(*keys, "_value", "_n"), picks, keys)
    ordered = running_values(inside, keys).withColumns({
        "_upto": F.col("_upto") + F.col("_base"), "_below": F.col("_below") + F.col("_base")})
    hits = ordered.select(*by, "n", "_value", F.explode(_inside(F.col("_wanted"))).alias("_hit"))
    return hits.groupBy(*by, "n").agg(
        *[F.avg(F.when(F.col("_hit.name") == q, F.col("_value"))).alias(q) for q in wanted])


def quantiles_of_counts(counts: DataFrame, by: list[str], wanted: dict[str, Ranks], min_n: int = 1) -> DataFrame:
    """Quantiles of each group of a table of value counts (by, _value, _bucket, _n)."""
    picks = locate(bucket_counts(counts, by), by, wanted, min_n)
    return resolve(counts, picks, by, list(wanted))


def grouped_quantiles(df: DataFrame, by: list[str], value: str, wanted: dict[str, Ranks],
                      min_n: int = 1) -> DataFrame:
    """One row per group with at least ``min_n`` values: the group, ``n`` and each wanted quantile, all exact. Reads
    ``df`` twice, the first time at once. The picks are read from a file, so their size is known to the planner."""
    rows = df.where(F.col(value).isNotNull()).select(*by, F.col(value).alias("_value")).withColumn(
        "_bucket", bucket(F.col("_value")))
    histogram = rows.groupBy(*by, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    picks = stage(locate(histogram, by, wanted, min_n))
    counts = join_same(rows, picks.select(*by, "_bucket"), [*by, "_bucket"], "left_semi").groupBy(
        *by, "_bucket", "_value").agg(F.count(F.lit(1)).alias("_n"))
    return resolve(counts, picks, by, list(wanted))


def median_by(df: DataFrame, by: list[str], value: str, min_n: int = 1, name: str = "median") -> DataFrame:
    return grouped_quantiles(df, by, value, {name: median_ranks}, min_n)


def index_quantile(df: DataFrame, value: str, q: float, by: list[str] | None = None,
                   name: str = "quantile") -> DataFrame:
    return grouped_quantiles(df, by or [], value, {name: index_rank(q)})
