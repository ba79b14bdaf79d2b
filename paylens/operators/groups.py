"""Per-group picks and numbering that hold when one group has a third of all rows."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.operators.sizes import materialise, stage

SPREAD = 1024
AT_ONCE = 200_000  # rows of a group that may meet in one task


def first_occurrence(df: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    """One row per key, the first in ``order``. Duplicates collapse before the shuffle, so a hot key is one row per
    map task."""
    keys = [key] if isinstance(key, str) else key
    orders = [order] if isinstance(order, str) else order
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*orders)).alias("_first"))
    return first.select(*[F.col(f"_first.{c}").alias(c) if c in rest else F.col(c) for c in df.columns])


def top_per_group(df: DataFrame, by: list[str], key: str, order: list[Column], n: int,
                  spread: int = SPREAD) -> DataFrame:
    """The first ``n`` rows of every group plus their place.

    A group is first cut inside ``spread`` slices by key, so a group that holds a third of all rows is sorted by many
    tasks. Where that leaves more than AT_ONCE rows of a group, slices are cut again in bundles of the square root of their
    number, before the last cut. For small ``n`` Spark also cuts before each shuffle. Keep ``df`` thin: join texts back
    afterwards.
    """
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(key), F.lit(spread)))

    def cut(rows: DataFrame, *slices: Column) -> DataFrame:
        inner = F.row_number().over(Window.partitionBy(*by, *slices).orderBy(*order))
        return rows.withColumn("_place", inner).where(F.col("_place") <= n).drop("_place")
    kept = cut(sliced, F.col("_slice"))
    if spread * n > AT_ONCE:
        kept = cut(kept, F.col("_slice") % math.isqrt(spread))
    kept = kept.drop("_slice")
    return kept.withColumn("_place", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(
        F.col("_place") <= n)


def global_rank(df: DataFrame, order: list[Column], name: str = "_rank") -> DataFrame:
    """Add the 1-based place of every row in ``order`` over all rows, by many tasks.

    Rows are dealt into ranges of the order, sorted inside each and written once with their place in the range; the sizes
    of the ranges before it, one number per task, give the rest. The order should name every row, else ties are numbered
    as they come. ``df`` is read twice, the first time to sample its ranges, so it should be a stored table.
    """
    spark = df.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = stage(df.repartitionByRange(tasks, *order).sortWithinPartitions(*order).withColumn(
        "_at", F.monotonically_increasing_id()))  # the task in the upper bits, the row in the lower 33
    task = F.shiftright("_at", 33)
    sizes = sorted(ranges.groupBy(task.alias("task")).agg(F.count(F.lit(1)).alias("n")).collect())  # one row per task
    before, offsets = 0, []
    for row in sizes:
        offsets.append((row.task, before))
        before += row.n
    known = F.broadcast(spark.createDataFrame(offsets, "_task bigint, _before bigint"))
    place = F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return ranges.join(known, task == F.col("_task")).select(*df.columns, place.alias(name))


def interleave(df: DataFrame, group: str, key: str, order: list[Column], n: int | None = None) -> DataFrame:
    """Round-robin over groups, all rows or at most ``n``, with their 1-based ``position``.

    Inside a group rows follow ``order``; in every round groups follow the order of their best rows. With a limit only
    the first ``n`` rows of a group, and the first ``n`` groups, can be reached. Without one, ``order`` must name every row;
    ranks over all rows are taken by ranges, so no group and no round is a single task.
    """
    if n is None:
        return _interleave_all(df, group, order)
    ranked = top_per_group(df, [group], key, order, n).withColumnRenamed("_place", "_round")
    leaders = ranked.where(F.col("_round") == 1).orderBy(*order).limit(n)
    turns = leaders.select(F.col(group).alias("_group"), F.row_number().over(Window.orderBy(*order)).alias("_turn"))
    joined = ranked.join(turns, F.col(group).eqNullSafe(F.col("_group"))).drop("_group")
    queue = joined.orderBy("_round", "_turn").limit(n)
    place = F.row_number().over(Window.orderBy("_round", "_turn")).cast("bigint")  # at most n rows
    return queue.withColumn("position", place).drop("_round", "_turn")


def _interleave_all(df: DataFrame, group: str, order: list[Column]) -> DataFrame:
    """All rows in turns: ranked by group and order, a row's round is its rank less that of the first of its group."""
    ranked = global_rank(materialise(df), [F.asc(group), *order])
    firsts = ranked.groupBy(group).agg(F.min("_rank").alias("_first"))
    leaders = ranked.join(firsts.select("_first"), F.col("_rank") == F.col("_first")).drop("_rank")
    turns = global_rank(leaders, order, "_turn").select(F.col(group).alias("_group"), "_first", "_turn")
    joined = ranked.join(turns, F.col(group).eqNullSafe(F.col("_group")))
    rounds = joined.select(*df.columns, (F.col("_rank") - F.col("_first")).alias("_round"), "_turn")
    return global_rank(materialise(rounds), [F.asc("_round"), F.asc("_turn")], "position").drop("_round", "_turn")


def capped_sample(df: DataFrame, key: str, group: str, cap: int, n: int, seed: int) -> DataFrame:
    """Seeded sample of ``n`` rows with at most ``cap`` per group. The shuffle order is a hash of seed and key, so it
    does not depend on partitions."""
    df = df.withColumn("_order", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))))
    order = [F.col("_order"), F.col(key)]
    return top_per_group(df, [group], key, order, cap).orderBy(*order).limit(n).drop("_order", "_place")


def distinct_sample(df: DataFrame, key: str, title: str, held: DataFrame, n: int, seed: int) -> DataFrame:
    """Seeded sample of ``n`` rows with distinct titles that ``held`` does not contain yet."""
    df = df.withColumn("_order", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(key).cast("string"))))
    fresh = first_occurrence(df, title, ["_order", key]).join(held.select(title).distinct(), title, "left_anti")
    return fresh.orderBy("_order", key).limit(n).drop("_order").select(*[c for c in df.columns if c != "_order"])


def dictionary(df: DataFrame, name: str) -> DataFrame:
    """(name, idx): distinct names numbered from 0 in the order of their md5.

    Running totals over the 4,096 possible hash prefixes give each prefix its offset, so the names themselves are
    numbered in parallel.
    """
    names = df.where(F.col(name).isNotNull()).select(name).distinct().withColumn("_md5", F.md5(name))
    names = names.withColumn("_prefix", F.substring("_md5", 1, 3))
    sizes = names.groupBy("_prefix").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_prefix").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_prefix", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    inner = F.row_number().over(Window.partitionBy("_prefix").orderBy("_md5"))
    return (names.withColumn("_i", inner).join(F.broadcast(offsets), "_prefix")  # at most 4,096 rows
            .select(name, (F.col("_offset") + F.col("_i") - 1).alias("idx")))
