"""Stratified premium of an item on a value, with a stratified bootstrap interval.

The "without" side of an item is its stratum minus the item's own members. It is never built row by row: counts of the
stratum and of the item are subtracted, first by bucket, then by value inside the few buckets that hold a wanted rank. What
is written out is one row per cell and bucket, and the values of picked buckets; members are read again for those.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.functions import draws
from paylens.functions.expr import round_half_even
from paylens.operators.quantiles import bucket, join_same, locate, median_ranks, resolve, running, running_values
from paylens.operators.sizes import materialise

MEDIAN = {"median": median_ranks}


@dataclass(frozen=True)
class Pools:
    """Tables behind a premium. All are reductions, written once to the shared folder and then read several times.

    A cell is an item in a stratum; it has two pools, those that hold the item and those that lack it. Pools carry a
    number, so that everything after this table is grouped and joined by one integer.
    """

    strata: list[str]
    members: DataFrame  # item (NULL for the whole stratum), strata, _value, _bucket: not written, read once per use
    buckets: DataFrame  # item (NULL for the whole stratum), strata, _bucket, _n
    pools: DataFrame  # pool, cell, holds, item, strata, size: both pools of every eligible cell of admitted items
    histogram: DataFrame  # pool, _bucket, _n

    @property
    def cell_keys(self) -> list[str]:
        return ["item", *self.strata]

    def picked(self, wanted: DataFrame) -> DataFrame:
        """(item, strata, _bucket, _value, _n) inside the buckets of cells named by ``wanted``, in one pass over the
        members."""
        grain = [*self.cell_keys, "_bucket"]
        inside = join_same(self.members, wanted.select(*grain).distinct(), grain, "left_semi")
        return materialise(inside.groupBy(*grain, "_value").agg(F.count(F.lit(1)).alias("_n")))

    def values(self, near: DataFrame) -> DataFrame:
        """(pool, _bucket, _value, _n) inside the buckets named by ``near``."""
        names = self.pools.select("pool", "holds", *self.cell_keys)
        near = near.select("pool", "_bucket").join(names, "pool")
        grain = [*self.cell_keys, "_bucket"]
        whole = near.where("not holds").withColumn("item", F.lit(None).cast(near.schema["item"].dataType))
        counts = self.picked(near.select(*grain).unionByName(whole.select(*grain)))
        own = counts.where(F.col("item").isNotNull())
        holding = join_same(near.where("holds"), own, grain)
        lacking = _less(join_same(near.where("not holds"), whole_strata(counts), [*self.strata, "_bucket"]), own,
                        [*grain, "_value"])
        wanted = ["pool", "_bucket", "_value", "_n"]
        return holding.select(*wanted).unionByName(lacking.select(*wanted))

    def only(self, items: DataFrame) -> Pools:
        pools = materialise(self.pools.join(items.select("item"), "item", "left_semi"))
        return Pools(self.strata, self.members, self.buckets, pools,
                     self.histogram.join(pools.select("pool"), "pool", "left_semi"))


def whole_strata(counts: DataFrame) -> DataFrame:
    return counts.where(F.col("item").isNull()).drop("item")


def _less(whole: DataFrame, own: DataFrame, keys: list[str]) -> DataFrame:
    """Subtract the item's own counts from those of its stratum."""
    left = join_same(whole, own.select(*keys, F.col("_n").alias("_own")), keys, "left")
    return (left.withColumn("_n", F.col("_n") - F.coalesce("_own", F.lit(0))).drop("_own")
            .where(F.col("_n") > 0))


def build_pools(df: DataFrame, items: str, value: str, strata: list[str], min_cell: int = 8,
                min_total: int = 15) -> Pools:
    """Pools of the labelled rows of ``df``; ``items`` is an array, NULL where a row was never labelled.

    An unlabelled row says nothing about any item and takes part on neither side. Every labelled row is counted once
    for its stratum (item NULL) and once per item it holds, in a single pass that combines before the shuffle. ``df`` is
    read again for picked buckets, so it should be a stored table.
    """
    named = F.filter(F.array_distinct(items), lambda x: x.isNotNull())
    member = F.explode(F.concat(F.array(F.lit(None).cast("string")), named)).alias("item")
    keys = ["item", *strata]
    known = df.where(F.col(items).isNotNull() & F.col(value).isNotNull())
    members = known.select(member, *strata, F.col(value).alias("_value")).withColumn("_bucket", bucket(F.col("_value")))
    by_bucket = materialise(members.groupBy(*keys, "_bucket").agg(F.count(F.lit(1)).alias("_n")))

    sizes = by_bucket.groupBy(*keys).agg(F.sum("_n").alias("n_with"))
    whole = whole_strata(sizes).withColumnRenamed("n_with", "_all")
    cells = join_same(sizes.where(F.col("item").isNotNull()), whole, strata).withColumn(
        "n_without", F.col("_all") - F.col("n_with")).drop("_all")
    per_item = Window.partitionBy("item")  # an item has one row per stratum here
    cells = (cells.withColumn("_total", F.sum("n_with").over(per_item))
             .where((F.col("_total") >= min_total) & (F.col("n_with") >= min_cell)
                    & (F.col("n_without") >= min_cell)).drop("_total")
             .withColumn("cell", F.monotonically_increasing_id()))
    both = F.explode(F.create_map(F.lit(True), "n_with", F.lit(False), "n_without")).alias("holds", "size")
    pools = materialise(cells.select("cell", *keys, both).withColumn(  # numbers are fixed by being written here
        "pool", F.col("cell") * 2 + F.col("holds").cast("int")))

    own = by_bucket.where(F.col("item").isNotNull())
    names = pools.select("pool", "holds", *keys)
    holding = join_same(names.where("holds"), own, keys)
    lacking = _less(join_same(names.where("not holds"), whole_strata(by_bucket), strata), own, [*keys, "_bucket"])
    wanted = ["pool", "_bucket", "_n"]
    histogram = materialise(holding.select(*wanted).unionByName(lacking.select(*wanted)))
    return Pools(strata, members, by_bucket, pools, histogram)


def _cell_medians(p: Pools) -> DataFrame:
    """cell, item, n_with and the exact medians of both pools of every eligible cell."""
    picks = materialise(locate(p.histogram, ["pool"], MEDIAN))
    medians = resolve(materialise(p.values(picks)), picks, ["pool"], ["median"]).select("pool", "median")
    return p.pools.join(medians, "pool").groupBy("cell", "item").agg(
        F.max(F.when(F.col("holds"), F.col("median"))).alias("median_with"),
        F.max(F.when(~F.col("holds"), F.col("median"))).alias("median_without"),
        F.max(F.when(F.col("holds"), F.col("size"))).alias("n_with"))


def _weighted(ratio: Column, weight: Column) -> Column:
    """Weighted mean of the ratios as a gain in per cent; a cell without a ratio, whose median is zero, is left out."""
    return (F.sum(ratio * weight) / F.sum(F.when(ratio.isNotNull(), weight)) - 1) * 100


def premium_from_pools(p: Pools, k: int | None = 10) -> DataFrame:
    """item, n, premium_pct, median_with: weighted mean of the strata's median ratios, positive ones, best first."""
    ranked = _cell_medians(p).groupBy("item").agg(
        F.sum("n_with").alias("n"),
        _weighted(F.try_divide("median_with", "median_without"), F.col("n_with")).alias("_pct"))
    ranked = ranked.where(F.col("_pct") > 0).withColumn("premium_pct", round_half_even(F.col("_pct"), 1))
    if k is not None:
        ranked = ranked.orderBy(F.desc("premium_pct"), "item").limit(k)
    ranked = materialise(ranked)

    kept = p.pools.where("holds").join(ranked.select("item"), "item", "left_semi").select(*p.cell_keys)
    pooled = join_same(p.buckets, kept, p.cell_keys, "left_semi").groupBy("item", "_bucket").agg(F.sum("_n").alias("_n"))
    picks = materialise(locate(pooled, ["item"], MEDIAN))
    values = p.picked(kept.join(picks.select("item", "_bucket"), "item")).groupBy("item", "_bucket", "_value").agg(
        F.sum("_n").alias("_n"))
    middle = resolve(values, picks, ["item"], ["median"]).select(
        "item", round_half_even(F.col("median")).alias("median_with"))
    return ranked.join(middle, "item").select("item", "n", "premium_pct", "median_with")


def stratified_premium(df: DataFrame, items: str = "skills", value: str = "salary_mid_usd",
                       strata: list[str] | None = None, min_cell: int = 8, min_total: int = 15,
                       k: int | None = 10) -> DataFrame:
    """Premium of each item inside strata. A cell counts with ``min_cell`` members on both sides, an item with
    ``min_total`` members over all strata."""
    pools = build_pools(df, items, value, strata or ["seniority", "region"], min_cell, min_total)
    return premium_from_pools(pools, k).orderBy(F.desc("premium_pct"), "item")


def _drawn_ranks(p: Pools, replicates: int, seed: int) -> DataFrame:
    """(pool, rep, _rank): the one or two ranks that carry the median of each replicate. A replicate costs a constant
    number of draws, whatever the size of the pool."""
    tasks = p.pools.sparkSession.sparkContext.defaultParallelism
    pools = p.pools.select("pool", "size", draws.named(seed, F.col("holds"), *map(F.col, p.cell_keys)).alias("_name"))
    reps = pools.repartition(tasks, "pool").select("*", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("rep"))
    ranks = reps.select("pool", "rep", draws.median_ranks(draws.named(F.col("_name"), F.col("rep")), F.col("size")).alias("d"))
    return ranks.select("pool", "rep", F.explode(F.array("d.low", "d.high")).alias("_rank"))


def _resampled_medians(p: Pools, replicates: int, seed: int) -> DataFrame:
    """pool, rep and the median of the pool in that replicate.

    Wanted ranks meet values in one ordered pass per pool and bucket: the value of a rank is that of the last step that
    begins below it.
    """
    ranks = materialise(_drawn_ranks(p, replicates, seed))
    spans = ranks.groupBy("pool").agg(F.min("_rank").alias("_first"), F.max("_rank").alias("_last"))
    near = materialise(running(p.histogram, ["pool"], "_bucket").join(spans, "pool").where(
        (F.col("_upto") >= F.col("_first")) & (F.col("_below") < F.col("_last"))).select(
        "pool", "_bucket", F.col("_below").alias("_base"), F.col("_upto").alias("_end")))
    grain = ["pool", "_bucket"]
    none = F.lit(None)
    steps = running_values(materialise(p.values(near)).join(near.drop("_end"), grain), grain).select(
        *grain, (F.col("_below") + F.col("_base")).alias("_at"), F.lit(1).alias("_kind"), "_value")
    wanted = ranks.select("pool", "_rank").distinct()
    buckets = near.select("pool", F.col("_base").alias("_at"), F.lit(1).alias("_kind"), "_bucket")
    ordered = Window.partitionBy("pool").orderBy("_at", "_kind")
    placed = (wanted.select("pool", F.col("_rank").alias("_at"), F.lit(0).alias("_kind"), none.cast("bigint").alias("_bucket"))
              .unionByName(buckets).withColumn("_bucket", F.last("_bucket", ignorenulls=True).over(ordered))
              .where("_kind = 0").withColumn("_value", none.cast("double")))
    inside = Window.partitionBy(*grain).orderBy("_at", "_kind")
    found = (placed.unionByName(steps.withColumn("_value", F.col("_value").cast("double")))
             .withColumn("_value", F.last("_value", ignorenulls=True).over(inside)).where("_kind = 0")
             .select("pool", F.col("_at").alias("_rank"), "_value"))
    return ranks.join(found, ["pool", "_rank"]).groupBy("pool", "rep").agg(F.avg("_value").alias("_m"))


def premium_ci(p: Pools, replicates: int = 1000, seed: int = 20260719) -> DataFrame:
    """item, ci_lo, ci_hi: percentile interval (floor index) of the premium under a bootstrap inside every pool.

    Draws depend only on the seed, the pool's names and the replicate, so the result is the same for any partitioning
    and after any retry. NULL if fewer than half of the replicates give a value.
    """
    names = p.pools.select("pool", "cell", "item", "holds", "size")
    named = _resampled_medians(p, replicates, seed).join(names, "pool")
    ratios = named.groupBy("cell", "item", "rep").agg(
        F.try_divide(F.max(F.when(F.col("holds"), F.col("_m"))), F.max(F.when(~F.col("holds"), F.col("_m")))).alias("_ratio"),
        F.max(F.when(F.col("holds"), F.col("size"))).alias("n_with"))
    estimates = ratios.groupBy("item", "rep").agg(_weighted(F.col("_ratio"), F.col("n_with")).alias("_est"))
    ordered = estimates.where(F.col("_est").isNotNull()).groupBy("item").agg(
        F.array_sort(F.collect_list("_est")).alias("_all"))  # at most one entry per replicate

    def at(q: float) -> Column:
        place = F.floor(F.lit(q) * (F.size("_all") - 1)).cast("int")
        return F.when(F.size("_all") >= replicates // 2, round_half_even(F.get("_all", place), 1))
    return ordered.select("item", at(0.025).alias("ci_lo"), at(0.975).alias("ci_hi"))


def premium_with_ci(df: DataFrame, items: str = "skills", value: str = "salary_mid_usd",
                    strata: list[str] | None = None, min_cell: int = 8, min_total: int = 15, k: int | None = 10,
                    replicates: int = 1000, seed: int = 20260719) -> DataFrame:
    """The premium table with an interval per item. Only the items that are reported are resampled."""
    p = build_pools(df, items, value, strata or ["seniority", "region"], min_cell, min_total)
    best = materialise(premium_from_pools(p, k))
    ci = premium_ci(p.only(best), replicates, seed)
    return best.join(ci, "item", "left").orderBy(F.desc("premium_pct"), "item")
