"""Every interactive slice at once: any region, or remote, or all, by any grade or all.

The rows are counted by region, remote flag, grade, what is counted (the row itself, its company, an item it holds, its
bin) and bucket of pay. These cells are small and mergeable: a slice is a sum of cells, and so is a slice over several days.
Exact medians need one more pass over the columns they are taken of: the cells tell which bucket holds a wanted rank, and only
values of those buckets are kept. The charts equal those of ``slice_report`` slice by slice.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.functions.classify import SENIORITY_ORDER
from paylens.functions.expr import round_half_up
from paylens.operators.groups import top_per_group
from paylens.operators.quantiles import Ranks, bucket, index_rank, join_same, locate, median_ranks, resolve
from paylens.operators.reports import HISTOGRAM_CAP, HISTOGRAM_WIDTH, best_premium, pay_bin
from paylens.operators.sizes import stage

SLICE = ["region", "seniority"]
BASE = ["region", "seniority", "is_remote"]
KIND = ["kind", "name"]


def _some(*values: Column) -> Column:
    return F.array_distinct(F.filter(F.array(*values), lambda x: x.isNotNull()))


def _regions(df: DataFrame) -> DataFrame:
    """Every row once per region slice it belongs to."""
    return df.withColumn("region", F.explode(_some(F.col("region"), F.lit("all"), F.when(F.col("is_remote"), "remote"))))


def _grades(df: DataFrame) -> DataFrame:
    return df.withColumn("seniority", F.explode(_some(F.col("seniority"), F.lit("all"))))


def slices(df: DataFrame) -> DataFrame:
    return _grades(_regions(df))


def places(df: DataFrame) -> DataFrame:
    """Regions and, overlapping them, remote against on-site, for every grade slice."""
    place = F.array(F.col("region"), F.when(F.col("is_remote"), "Remote").otherwise("On-site"))
    return _grades(df.withColumn("place", F.explode(place)))


def _members(rows: DataFrame, kind: str) -> DataFrame:
    """Every row once per name it is counted under."""
    if kind == "item":
        return rows.withColumn("name", F.explode(F.array_distinct("_items"))).where(F.col("name").isNotNull())
    return rows.withColumn("name", F.col("_company") if kind == "company" else F.lit(None).cast("string"))


def _often(paid: DataFrame, min_n: int) -> DataFrame:
    """Cells of names with at least ``min_n`` paid rows in all; no slice of another name can have as many. They now lie
    together by name, so that slices of a name are counted and ordered without another shuffle."""
    total = F.sum("_n").over(Window.partitionBy("name"))
    return paid.withColumn("_all", total).where(F.col("_all") >= min_n).drop("_all")


@dataclass(frozen=True)
class Cube:
    """``rows`` has (base, _company, _items, _value, _bucket, _new) of every row and is read for values of picked buckets
    only; ``cells`` has (base, kind, name, _bucket, n, new). A row that takes no part in pay statistics has no value and no
    bucket."""

    rows: DataFrame
    cells: DataFrame

    def of(self, kind: str) -> DataFrame:
        return self.cells.where(F.col("kind") == kind)

    def quantiles(self, kind: str, by: list[str], expand, wanted: dict[str, Ranks], min_n: int = 1) -> DataFrame:
        """by, n and the wanted quantiles; ``expand`` turns rows with base columns into rows of slices."""
        paid = self.of(kind).where(F.col("_bucket").isNotNull()).withColumnRenamed("n", "_n")
        if "name" in by:
            paid = _often(paid, min_n)
        histogram = expand(paid).groupBy(*by, "_bucket").agg(F.sum("_n").alias("_n"))
        picks = stage(locate(histogram, by, wanted, min_n))
        grain = [c for c in by if c == "name"] + ["_bucket"]
        members = _members(self.rows.where(F.col("_value").isNotNull()), kind)
        near = join_same(members, picks.select(*grain).distinct(), grain, "left_semi")
        values = near.groupBy(*BASE, "name", "_bucket", "_value").agg(F.count(F.lit(1)).alias("_n"))
        inside = join_same(expand(values), picks.select(*by, "_bucket"), [*by, "_bucket"], "left_semi").groupBy(
            *by, "_bucket", "_value").agg(F.sum("_n").alias("_n"))
        return resolve(inside, picks, by, list(wanted))

    def median(self, kind: str, by: list[str], expand, min_n: int = 1) -> DataFrame:
        return self.quantiles(kind, by, expand, {"median": median_ranks}, min_n)


def build_cube(df: DataFrame, value: str = "salary_mid_usd", items: str = "skills", company: str = "company",
               new: str = "is_new", management: str = "is_management") -> Cube:
    """The cells of a slice or of any table with the columns of one; ``df`` should be a stored table, as it is read again
    for every kind of name and every quantile."""
    paid = ~F.col(management) & F.col(value).isNotNull()
    rows = df.select(*BASE, F.col(company).cast("string").alias("_company"), F.col(items).cast("array<string>").alias("_items"),
                     F.when(paid, F.col(value)).alias("_value"), F.coalesce(F.col(new), F.lit(0)).alias("_new"))
    rows = rows.withColumn("_bucket", bucket(F.col("_value")))

    def one(kind: str, name: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), name.cast("string").alias("name"))

    sums = [F.count(F.lit(1)).alias("n"), F.sum("_new").alias("new")]
    plain = rows.groupBy(  # few groups, whatever the number of rows
        *BASE, "_bucket", F.when(F.col("_value").isNotNull(), pay_bin(F.col("_value"))).alias("_bin"),
        F.col("_items").isNotNull().alias("_labelled")).agg(*sums)
    counted = F.array(one("row", F.lit(None)), F.when(F.col("_labelled"), one("labelled", F.lit(None))),
                      F.when(F.col("_bin").isNotNull(), one("bin", F.col("_bin"))))
    unnamed = plain.select(*BASE, "_bucket", "n", "new", F.explode(F.filter(counted, lambda c: c.isNotNull())).alias("_c")).select(
        *BASE, "_c.*", "_bucket", "n", "new")
    named = [_members(rows, kind).groupBy(*BASE, F.lit(kind).alias("kind"), "name", "_bucket").agg(*sums)
             for kind in ("company", "item")]
    return Cube(rows, stage(reduce(DataFrame.unionByName, named, merge_cells(unnamed))))


def merge_cells(*parts: DataFrame) -> DataFrame:
    """Cells of several tables, such as days, as those of their union."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy(*BASE, *KIND, "_bucket").agg(F.sum("n").alias("n"), F.sum("new").alias("new"))


def cube_headline(cube: Cube, premium: DataFrame, days: int, min_n: int = 10, min_item: int = 15) -> DataFrame:
    sums = slices(cube.of("row")).groupBy(*SLICE).agg(
        F.sum("n").alias("postings"), F.sum("new").alias("_new"),
        F.coalesce(F.sum(F.when(F.col("_bucket").isNotNull(), F.col("n"))), F.lit(0)).alias("paid_n"))
    middle = cube.median("row", SLICE, slices, min_n).select(*SLICE, "median")
    return sums.join(middle, SLICE, "left").withColumn("_best", best_premium(premium, min_item)).select(
        *SLICE, "postings", F.when(F.lit(days > 1), F.col("_new")).alias("new"), "paid_n", "median",
        (F.col("median") / 12).alias("median_month"), F.col("_best.item").alias("top_item"),
        F.col("_best.premium_pct").alias("top_item_pct"), F.col("_best.n").alias("top_item_n"))


def cube_histogram(cube: Cube, min_n: int = 30) -> DataFrame:
    last = HISTOGRAM_CAP // HISTOGRAM_WIDTH
    counted = slices(cube.of("bin")).groupBy(*SLICE, F.col("name").cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    thick = counted.groupBy(*SLICE).agg(F.sum("n").alias("_all")).where(F.col("_all") >= min_n).drop("_all")
    spine = thick.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(last))))
    return spine.join(counted, [*SLICE, "bin"], "left").select(
        *SLICE, "bin", (F.col("bin") * HISTOGRAM_WIDTH).cast("bigint").alias("low"),
        F.when(F.col("bin") < last, (F.col("bin") + 1) * HISTOGRAM_WIDTH).cast("bigint").alias("high"),
        F.coalesce("n", F.lit(0)).alias("n"))


def cube_marks(cube: Cube, min_n: int = 30) -> DataFrame:
    return cube.quantiles("row", SLICE, slices, {"median": median_ranks, "p25": index_rank(0.25), "p75": index_rank(0.75)}, min_n)


def cube_grades(cube: Cube, min_n: int = 10, order: list[str] | None = None) -> DataFrame:
    """By region slice; the chart ignores the grade filter."""
    shown = F.col("n") >= min_n
    return cube.median("row", SLICE, _regions).where(F.col("seniority").isin(order or SENIORITY_ORDER)).select(
        *SLICE, "n", F.when(shown, F.col("median")).alias("median"), shown.alias("shown"))


def cube_places(cube: Cube, min_n: int = 10) -> DataFrame:
    """By grade slice; the chart ignores the region filter."""
    return cube.median("row", ["seniority", "place"], places, min_n).select("seniority", "place", "n", "median")


def cube_shares(cube: Cube) -> DataFrame:
    """(slice, item, n, paid_n, labelled) of every item."""
    paid = F.coalesce(F.sum(F.when(F.col("_bucket").isNotNull(), F.col("n"))), F.lit(0))
    total = slices(cube.of("labelled")).groupBy(*SLICE).agg(F.sum("n").alias("labelled"))
    held = slices(cube.of("item")).groupBy(*SLICE, F.col("name").alias("item")).agg(F.sum("n").alias("n"), paid.alias("paid_n"))
    return held.join(total, SLICE)


def cube_demand(cube: Cube, k: int = 15, min_n: int = 10, min_labelled: int = 100) -> DataFrame:
    enough = cube_shares(cube).where(F.col("labelled") >= min_labelled)
    top = top_per_group(enough, SLICE, "item", [F.desc("n"), F.asc("item")], k).drop("_place")
    medians = cube.median("item", [*SLICE, "name"], slices, min_n).select(*SLICE, F.col("name").alias("item"), "median")
    pct = round_half_up(1000 * F.col("n") / F.col("labelled")) / 10
    return top.join(medians, [*SLICE, "item"], "left").select(*SLICE, "item", "n", pct.alias("pct"), "paid_n", "median")


def cube_payers(cube: Cube, employers: DataFrame | None = None, k: int = 10, min_n: int = 10) -> DataFrame:
    found = cube.median("company", [*SLICE, "name"], slices, min_n).select(*SLICE, F.col("name").alias("company"), "n", "median")
    best = top_per_group(found, SLICE, "company", [F.desc("median"), F.asc("company")], k).drop("_place")
    if employers is not None:
        best = best.join(employers.groupBy("company").agg(F.max("url").alias("url")), "company", "left")
    return best


def cube_learn_next(cube: Cube, premium: DataFrame) -> DataFrame:
    demand = cube_shares(cube).select(*SLICE, "item", F.round(100 * F.col("n") / F.col("labelled"), 1).alias("demand_pct"))
    radius = F.greatest(F.lit(5.0), F.least(F.lit(22.0), F.sqrt("n") * 2))
    return premium.join(demand, "item").where(F.col("demand_pct") > 0).select(
        *SLICE, "item", "demand_pct", "premium_pct", "n", radius.alias("radius"),
        (~F.coalesce(F.col("ci_lo") <= 0, F.lit(False))).alias("significant"))


def slice_cube(cube: Cube, premium: DataFrame, days: int, employers: DataFrame | None = None) -> dict[str, DataFrame]:
    """All charts of ``slice_report`` for all slices, each with its slice."""
    return {
        "headline": cube_headline(cube, premium, days), "histogram": cube_histogram(cube), "marks": cube_marks(cube),
        "grades": cube_grades(cube), "places": cube_places(cube), "demand": cube_demand(cube),
        "payers": cube_payers(cube, employers), "learn_next": cube_learn_next(cube, premium)}


def one_slice(charts: dict[str, DataFrame], region: str = "all", seniority: str = "all") -> dict[str, DataFrame]:
    """The charts of one slice, with the columns of ``slice_report``. A slice without rows has none."""
    def chosen(name: str, chart: DataFrame) -> DataFrame:
        if name == "grades":
            return chart.where(F.col("region") == region).drop("region")
        if name == "places":
            return chart.where(F.col("seniority") == seniority).drop("seniority")
        return chart.where((F.col("region") == region) & (F.col("seniority") == seniority)).drop(*SLICE)
    return {name: chosen(name, chart) for name, chart in charts.items()}
