"""Mergeable filters over the keys of each day: which keys of today may the history hold, and on which days?

A filter is a Bloom filter cut into slots of one bitmap each, built with Spark's bitmap aggregates. A key falls into one slot
and sets HASHES bits there, so filters of equal size merge by OR, slot by slot. About BITS_PER_KEY bits are kept per key,
some 25 times less than the keys themselves; 1 key in 1,000 is taken for known by a filter that lacks it, and none the
other way round, so only hits need a look into the history.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens.operators.sizes import materialise

SLOT_BITS = 32_768  # of a bitmap of Spark's bitmap aggregates
HASHES = 7
BITS_PER_KEY = 16
LEAST_SLOTS = 256  # keeps the keys that share a slot few, however small a filter is


def slots_for(keys: int) -> int:
    """A power of two, so that days of similar size have filters of equal size."""
    needed = -(-keys * BITS_PER_KEY // SLOT_BITS)
    return max(LEAST_SLOTS, 1 << max(0, needed - 1).bit_length())


def _slot(key: Column, slots: Column) -> Column:
    return F.pmod(F.xxhash64(key), slots)


def _bits(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(k)), F.lit(SLOT_BITS)) for k in range(HASHES)])


def holds(bitmap: Column, key: Column) -> Column:
    """Are all bits of the key set?"""
    def is_set(bit: Column) -> Column:
        byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("bigint")
        return F.getbit(byte, (bit % 8).cast("int")) == 1
    return F.forall(_bits(key), is_set)


def build(df: DataFrame, key: str, slots: int, by: list[str] | None = None) -> DataFrame:
    """(by, slots, slot, bits) over the keys of ``df``, one filter per group."""
    by = by or []
    rows = df.where(F.col(key).isNotNull()).select(
        *by, _slot(F.col(key), F.lit(slots)).alias("slot"), F.explode(_bits(F.col(key))).alias("_bit"))
    return rows.groupBy(*by, "slot").agg(F.bitmap_construct_agg("_bit").alias("bits")).select(
        *by, F.lit(slots).cast("bigint").alias("slots"), "slot", "bits")


def merge(filters: DataFrame, by: list[str] | None = None) -> DataFrame:
    """One filter for all keys of several; those of different size stay apart."""
    return filters.groupBy(*(by or []), "slots", "slot").agg(F.bitmap_or_agg("bits").alias("bits"))


def _hits(keys: DataFrame, filters: DataFrame, key: str, keep: list[str]) -> DataFrame:
    """Pairs of a key and a filter that may hold it. Bitmaps are looked at inside the join and never copied out."""
    sizes = [r.slots for r in filters.select("slots").distinct().collect()]  # powers of two, so a few dozen at most
    if not sizes:  # nothing can hit: the keys need not be read
        return keys.sparkSession.createDataFrame([], T.StructType([keys.schema[key], *(filters.schema[c] for c in keep)]))
    placed = keys.select(F.col(key).alias("_key"), F.explode(F.array(*map(F.lit, sizes)).cast("array<bigint>")).alias("_slots"))
    placed = placed.withColumn("_slot", _slot(F.col("_key"), F.col("_slots")))
    same = (F.col("_slots") == F.col("slots")) & (F.col("_slot") == F.col("slot")) & holds(F.col("bits"), F.col("_key"))
    return placed.join(filters, same).select(F.col("_key").alias(key), *keep)


@dataclass(frozen=True)
class Found:
    """What a look-up found and what it cost."""

    known: DataFrame  # the keys that the history holds
    candidates: DataFrame  # (key, day): what the filters let through
    days_read: list  # days of history whose keys were read
    history: DataFrame

    def report(self, key: str = "job_uid", day: str = "dt") -> DataFrame:
        """One row: candidate keys, known keys, days and rows of history that were read for them."""
        read = self.history.where(F.col(day).isin(self.days_read)).agg(F.count(F.lit(1))).scalar()
        return self.candidates.agg(F.count_distinct(key).alias("candidates")).select(
            "candidates", self.known.agg(F.count(F.lit(1))).scalar().alias("known"),
            F.lit(len(self.days_read)).alias("days_read"), read.alias("rows_read"))


def find_known(today: DataFrame, history: DataFrame, filters: DataFrame, covered: list | None = None,
               key: str = "job_uid", day: str = "dt") -> Found:
    """The keys of ``today`` that ``history`` (key, day) holds. ``filters`` has (day, slots, slot, bits).

    The union of all filters settles most keys that are new; the others are looked up day by day, and only days with a hit
    are read, for an exact check. ``covered`` names the days that have filters, all if it is None; other days are read.
    """
    keys = today.where(F.col(key).isNotNull()).select(key).distinct()
    maybe = materialise(_hits(keys, merge(filters), key, []).distinct())
    candidates = materialise(_hits(maybe, merge(filters, [day]), key, [day]).distinct())
    hit_days = [r[0] for r in candidates.select(day).distinct().collect()]  # at most one per day of history
    days = hit_days
    past = history.select(key, day)
    exact = past.where(F.col(day).isin(hit_days)).join(candidates, [key, day], "left_semi").select(key)
    if covered is not None:
        bare = past.where(~F.col(day).isin(covered)) if covered else past
        bare_days = [r[0] for r in bare.select(day).distinct().collect()]
        days = sorted({*hit_days, *bare_days})
        if bare_days:
            exact = exact.unionByName(bare.join(keys, key, "left_semi").select(key))
    return Found(materialise(exact.distinct()), candidates, days, past)
