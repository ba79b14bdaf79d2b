"""Published aggregates and interactive slice reports over a snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.functions import vocab as v
from paylens.functions.classify import SENIORITY_ORDER, board_url, new_flag, paid
from paylens.functions.expr import round_half_even, round_half_up
from paylens.operators.groups import dictionary
from paylens.operators.labels import processed_keys
from paylens.operators.quantiles import (bucket, grouped_quantiles, index_rank, median_by, median_ranks,
                                         quantiles_of_counts)
from paylens.operators.sizes import materialise


# -- history level -----------------------------------------------------------------------------------------------

def daily_series(snap: DataFrame, first: DataFrame, key: str = "job_uid", date: str = "snapshot_date",
                 value: str = "salary_mid_usd", management: str = "is_management", has_pay: str = "has_salary",
                 seen: str = "first_seen") -> DataFrame:
    """Per snapshot day: active rows, rows first seen that day, and the median pay of paid non-management rows."""
    born = first.select(key, F.col(seen).alias("_born"))
    counts = (snap.select(key, date).join(born, key, "left").groupBy(date)
              .agg(F.count(F.lit(1)).alias("active"), F.count_if(F.col("_born") == F.col(date)).alias("new")))
    medians = median_by(paid(snap, value, management, has_pay), [date], value).select(
        date, round_half_even(F.col("median")).alias("median"))
    return counts.join(medians, date, "left").select(date, "active", "new", "median").orderBy(date)


def pulse(series: DataFrame, min_days: int = 7) -> DataFrame:
    """The series with its median line only once ``min_days`` days have one. One row per day of history."""
    dated = F.count("median").over(Window.partitionBy())
    return series.withColumn("median", F.when(dated >= min_days, F.col("median")))


def latest_slice(snap: DataFrame, first: DataFrame, key: str = "job_uid", date: str = "snapshot_date",
                 seen: str = "first_seen") -> DataFrame:
    """Rows of one snapshot day with the new flag."""
    born = first.select(key, F.col(seen).alias("_born"))
    return snap.join(born, key, "left").withColumn("is_new", new_flag("_born", date)).drop("_born")


def encode_slice(df: DataFrame, key: str = "job_uid", company: str = "company", items: str = "skills",
                 keep: list[str] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Compact form: a company dictionary, an item dictionary, and rows that hold indexes instead of names.

    ``items`` stays NULL where a row was never labelled; the indexes of a label set follow the order of its names.
    """
    companies = dictionary(df, company)
    held = df.select(key, F.explode(items).alias("_item"))
    names = dictionary(held, "_item")
    by_name = F.array_sort(F.collect_list(F.struct("_item", "idx")))  # at most one entry per catalogue label
    coded = held.join(names, "_item").groupBy(key).agg(F.transform(by_name, lambda x: x["idx"]).alias("_ids"))
    kept = keep or ["region", "seniority", "is_remote", "is_management", "salary_mid_usd", "is_new"]
    rows = (df.join(companies.withColumnRenamed("idx", "company_idx"), company, "left").join(coded, key, "left")
            .select(key, *kept, "company_idx", F.when(F.col(items).isNotNull(), F.coalesce(
                "_ids", F.array().cast("array<bigint>"))).alias("item_idx")))
    return companies, names.withColumnRenamed("_item", "item"), rows


#: Fields of a positional row of the compact slice, in this order.
POSITIONAL = ["region", "seniority", "is_remote", "is_management", "company_idx", "salary_mid_usd", "item_idx", "is_new"]


def positional_rows(rows: DataFrame, value: str = "salary_mid_usd") -> DataFrame:
    """(value): each row of an encoded slice as a JSON array in the order of POSITIONAL, flags as 0 or 1, the items as an
    array of indexes or null."""
    words = F.to_json(F.array("region", "seniority"))
    flags = [F.coalesce(F.col(c).cast("int"), F.lit(0)).cast("string") for c in ("is_remote", "is_management")]
    items = F.concat(F.lit("["), F.array_join("item_idx", ","), F.lit("]"))
    rest = [*flags, F.col("company_idx").cast("string"), F.col(value).cast("string"), items, F.col("is_new").cast("string")]
    fields = [F.substr(words, F.lit(2), F.length(words) - 2), *[F.coalesce(c, F.lit("null")) for c in rest]]
    return rows.select(F.concat(F.lit("["), F.concat_ws(",", *fields), F.lit("]")).alias("value"))


def read_positional(lines: DataFrame) -> DataFrame:
    """The typed columns of positional rows; the inverse of ``positional_rows``."""
    at = F.from_json("value", "array<string>")
    kinds = ["string", "string", "int", "int", "bigint", "double", None, "int"]

    def typed(k: int, kind: str | None) -> Column:
        field = F.get("f", F.lit(k))
        return F.from_json(field, "array<bigint>") if kind is None else field.cast(kind)
    return lines.select(at.alias("f")).select(*[typed(k, kind).alias(c) for k, (c, kind) in enumerate(zip(POSITIONAL, kinds))])


def compact_size(lines: DataFrame, limit: int = 3_000_000) -> DataFrame:
    """One row: rows, bytes with line ends, and whether they keep within ``limit``."""
    size = F.coalesce(F.sum(F.octet_length("value") + 1), F.lit(0))
    return lines.agg(F.count(F.lit(1)).alias("rows"), size.alias("bytes")).withColumn("fits", F.col("bytes") <= limit)


def coverage(snap: DataFrame, labels: DataFrame, key: str = "job_uid", has_pay: str = "has_salary") -> DataFrame:
    """One row: rows, paid rows, labelled keys (any version) and the two shares, 0 for an empty snapshot."""
    done = processed_keys(labels, key).withColumn("_done", F.lit(True))
    sums = snap.select(key, has_pay).join(done, key, "left").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(has_pay).alias("paid"),
        F.count_distinct(F.when(F.col("_done"), F.col(key))).alias("labelled"))

    def share(c: str) -> Column:
        return F.coalesce(round_half_even(F.try_divide(F.col(c), F.col("total")), 3), F.lit(0.0))
    return sums.select("*", share("paid").alias("paid_share"), share("labelled").alias("labelled_share"))


def distinct_counts(snap: DataFrame, latest_snap: DataFrame, date: str = "snapshot_date", company: str = "company",
                    source: str = "source") -> DataFrame:
    """(metric, name, n): days of history, and companies of the latest day in total and per source."""
    days = snap.agg(F.count_distinct(date).alias("n")).select(
        F.lit("days").alias("metric"), F.lit(None).cast("string").alias("name"), "n")
    pairs = latest_snap.select(source, company).distinct()
    every = pairs.agg(F.count_distinct(company).alias("n")).select(
        F.lit("companies").alias("metric"), F.lit(None).cast("string").alias("name"), "n")
    each = pairs.groupBy(source).agg(F.count(company).alias("n")).select(
        F.lit("companies_of_source").alias("metric"), F.col(source).alias("name"), "n")
    return reduce(DataFrame.unionByName, [days, every, each])


def distinct_sketches(df: DataFrame, by: list[str], column: str, lg_k: int = 14) -> DataFrame:
    """(by, sketch): a HyperLogLog sketch of the distinct values of each group, such as a day; at most about 2 ** lg_k
    bytes each. Stored once, any span of days is counted without reading its rows again."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(column, lg_k).alias("sketch"))


def distinct_over(sketches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, n): estimated distinct values of the union of the sketches of each group; with the default size the standard
    error is 0.65 %."""
    return sketches.groupBy(*(by or [])).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n"))


def top_entities(snap: DataFrame, k: int = 10, entity: str = "company", source: str = "source") -> DataFrame:
    counted = snap.groupBy(entity, source).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), entity, source).limit(k).withColumn("url", board_url(source, entity))


def rate_freshness(rates: DataFrame, today: str, codes: tuple[str, ...] = ("GBP", "EUR"),
                   max_age: int = v.FX_MAX_AGE_DAYS) -> DataFrame:
    """(currency, as_of, age_days, stale, usd): inverse of chosen rates and whether the table is out of date."""
    age = F.datediff(F.lit(today).cast("date"), F.col("as_of"))
    return rates.where(F.col("currency").isin(*codes)).select(
        "currency", "as_of", age.alias("age_days"), (age > max_age).alias("stale"),
        F.round(1 / F.nullif(F.col("per_usd"), F.lit(0.0)), 4).alias("usd"))


# -- slice level -------------------------------------------------------------------------------------------------

HISTOGRAM_WIDTH, HISTOGRAM_CAP = 25_000, 400_000


def pay_bin(value: Column, width: int = HISTOGRAM_WIDTH, cap: int = HISTOGRAM_CAP) -> Column:
    """Number of the bin; the last one is open."""
    return F.least(F.floor(value / width), F.lit(cap // width)).cast("int")


def histogram(df: DataFrame, value: str = "salary_mid_usd", width: int = HISTOGRAM_WIDTH, cap: int = HISTOGRAM_CAP,
              min_n: int = 30) -> DataFrame:
    """(bin, low, high, n): equal bins and an open last one, empty bins included; no rows for a thin slice."""
    last = cap // width
    index = pay_bin(F.col(value), width, cap)
    counted = df.where(F.col(value).isNotNull()).groupBy(index.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.range(last + 1).select(F.col("id").cast("int").alias("bin"))
    full = spine.join(counted, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    full = full.withColumn("_all", F.sum("n").over(Window.partitionBy()))  # last + 1 rows
    return full.where(F.col("_all") >= min_n).select(
        "bin", (F.col("bin") * width).cast("bigint").alias("low"),
        F.when(F.col("bin") < last, (F.col("bin") + 1) * width).cast("bigint").alias("high"), "n")


def distribution_marks(df: DataFrame, value: str = "salary_mid_usd", min_n: int = 30) -> DataFrame:
    """Median and quartile marks of a distribution; no row for a thin slice."""
    return grouped_quantiles(df, [], value, {"median": median_ranks, "p25": index_rank(0.25),
                                             "p75": index_rank(0.75)}, min_n)


def median_by_grade(df: DataFrame, value: str = "salary_mid_usd", grade: str = "seniority", min_n: int = 10,
                    order: list[str] | None = None) -> DataFrame:
    """(grade, n, median, shown): thin grades are kept by name with ``shown`` false and no median."""
    ranks = F.array(*[F.lit(g) for g in (order or SENIORITY_ORDER)])
    shown = F.col("n") >= min_n
    return (median_by(df, [grade], value).where(F.array_contains(ranks, F.col(grade)))
            .withColumn("_at", F.array_position(ranks, F.col(grade))).orderBy("_at")
            .select(grade, "n", F.when(shown, F.col("median")).alias("median"), shown.alias("shown")))


def median_by_place(df: DataFrame, value: str = "salary_mid_usd", region: str = "region", remote: str = "is_remote",
                    min_n: int = 10) -> DataFrame:
    """(place, n, median): regions and, overlapping them, remote against on-site, in one grouping."""
    places = F.array(F.col(region), F.when(F.col(remote), "Remote").otherwise("On-site"))
    return median_by(df.select(F.explode(places).alias("place"), value), ["place"], value, min_n)


def _members(items: str) -> Column:
    """One NULL for the row itself, then each distinct item it holds: one pass counts rows and items."""
    named = F.filter(F.array_distinct(items), lambda x: x.isNotNull())
    return F.explode(F.concat(F.array(F.lit(None).cast("string")), named)).alias("item")


def _with_total(counted: DataFrame) -> DataFrame:
    total = counted.where(F.col("item").isNull()).select("n").scalar()
    return counted.where(F.col("item").isNotNull()).withColumn("labelled", total)


def item_shares(df: DataFrame, items: str = "skills") -> DataFrame:
    """(item, n, labelled): labelled rows per item and in total; each row counts once per item it holds."""
    labelled = df.where(F.col(items).isNotNull())
    return _with_total(materialise(labelled.select(_members(items)).groupBy("item").agg(F.count(F.lit(1)).alias("n"))))


def item_demand(df: DataFrame, items: str = "skills", value: str = "salary_mid_usd", management: str = "is_management",
                k: int = 15, min_n: int = 10, min_labelled: int = 100) -> DataFrame:
    """(item, n, pct, paid_n, median): most wanted items, with the median pay of their paid rows when it is not thin.

    One pass counts each item by pay; demand, paid rows and medians all come from those counts.
    """
    pay = F.when(~F.col(management), F.col(value)).alias("_value")
    counts = materialise(df.where(F.col(items).isNotNull()).select(_members(items), pay).groupBy("item", "_value").agg(
        F.count(F.lit(1)).alias("_n")))
    paid_n = F.coalesce(F.sum(F.when(F.col("_value").isNotNull(), F.col("_n"))), F.lit(0))
    shares = _with_total(counts.groupBy("item").agg(F.sum("_n").alias("n"), paid_n.alias("paid_n")))
    top = materialise(shares.where(F.col("labelled") >= min_labelled).orderBy(F.desc("n"), "item").limit(k))
    held = counts.where(F.col("_value").isNotNull()).join(top.select("item"), "item", "left_semi")
    medians = quantiles_of_counts(held.withColumn("_bucket", bucket(F.col("_value"))), ["item"],
                                  {"median": median_ranks}, min_n).select("item", "median")
    pct = round_half_up(1000 * F.col("n") / F.col("labelled")) / 10
    return top.join(medians, "item", "left").select("item", "n", pct.alias("pct"), "paid_n", "median").orderBy(
        F.desc("n"), "item")


def top_payers(df: DataFrame, employers: DataFrame | None = None, value: str = "salary_mid_usd",
               company: str = "company", k: int = 10, min_n: int = 10) -> DataFrame:
    """(company, n, median[, url]): best-paying companies with enough paid rows; the url comes from ``employers``."""
    best = median_by(df, [company], value, min_n).orderBy(F.desc("median"), company).limit(k)
    if employers is not None:
        best = best.join(employers.groupBy(company).agg(F.max("url").alias("url")), company, "left")
    return best.orderBy(F.desc("median"), company)


def best_premium(premium: DataFrame, min_item: int = 15) -> Column:
    """(item, premium_pct, n) of the first premium with ``min_item`` rows whose interval does not touch zero, else of the
    first with enough rows."""
    solid = ~F.coalesce(F.col("ci_lo") <= 0, F.lit(False))
    rank = F.struct(F.when(solid, 0).otherwise(1), -F.col("premium_pct"), F.col("item"))
    return premium.where(F.col("n") >= min_item).agg(F.min_by(F.struct("item", "premium_pct", "n"), rank)).scalar()


def headline(df: DataFrame, premium: DataFrame, days: int, value: str = "salary_mid_usd",
             management: str = "is_management", new: str = "is_new", min_n: int = 10, min_item: int = 15) -> DataFrame:
    """One row of tiles: postings, new ones (not on the first day), median pay and its month, and the best premium."""
    pay = grouped_quantiles(paid(df, value, management), [], value, {"median": median_ranks}, min_n)
    middle = pay.agg(F.max("median")).scalar()
    paid_rows = F.count_if(~F.col(management) & F.col(value).isNotNull())
    tiles = df.agg(F.count(F.lit(1)).alias("postings"), F.count_if(F.col(new) == 1).alias("_new"),
                   paid_rows.alias("paid_n")).withColumns(
        {"median": middle, "_best": best_premium(premium, min_item)})
    return tiles.select(
        "postings", F.when(F.lit(days > 1), F.col("_new")).alias("new"), "paid_n", "median",
        (F.col("median") / 12).alias("median_month"), F.col("_best.item").alias("top_item"),
        F.col("_best.premium_pct").alias("top_item_pct"), F.col("_best.n").alias("top_item_n"))


def learn_next(premium: DataFrame, shares: DataFrame) -> DataFrame:
    """(item, demand_pct, premium_pct, n, radius, significant): premium against demand, items nobody asks for left
    out. A missing interval counts as significant."""
    demand = shares.select("item", F.round(100 * F.col("n") / F.col("labelled"), 1).alias("demand_pct"))
    radius = F.greatest(F.lit(5.0), F.least(F.lit(22.0), F.sqrt("n") * 2))
    return premium.join(demand, "item").where(F.col("demand_pct") > 0).select(
        "item", "demand_pct", "premium_pct", "n", radius.alias("radius"),
        (~F.coalesce(F.col("ci_lo") <= 0, F.lit(False))).alias("significant"))
