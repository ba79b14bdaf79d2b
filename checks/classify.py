"""Classifiers and pay parsing over texts that Spark builds from columns; SQL answers from the columns, not the texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.base import check, rows, table
from paylens.functions import classify, dates, money
from paylens.operators import quality, reports
from paylens.operators.groups import first_occurrence

GRADE_WORD = {"1-URGENT": "Senior", "2-HIGH": "Staff", "3-MEDIUM": "Junior", "4-NOT SPECIFIED": "Office",
              "5-LOW": "Mid-level"}
ROLE = {"AUTOMOBILE": "Software Engineer", "BUILDING": "Data Analyst", "FURNITURE": "Account Executive",
        "HOUSEHOLD": "Wizard", "MACHINERY": "Member of Technical Staff"}
LEVEL = {"F": " II", "O": "", "P": ", L5 Director"}
TEAM = {"F": "Engineering", "O": "Kitchen"}
PLACES = [
    ("San Francisco, CA", "us"), ("Berlin, Germany", "eu"), ("Tbilisi, Georgia", "other"), ("Atlanta, Georgia", "us"),
    ("London, Ontario", "other"), ("London", "eu"), ("Remote U.S.", "us"), ("Remote", "other"), ("Toronto, USA", "us"),
    ("Paris, Texas", "eu"), ("Remote - U.S.A. only", "us"), ("Yerevan", "other"), ("New York City", "us"),
    ("Zürich", "eu"), ("Singapore", "other"), ("Bogota, CO", "us"), ("Hybrid", "other"), ("EMEA", "eu"),
    ("SF Bay Area", "us"), ("Vancouver, WA", "other"), ("Dublin or NYC", "eu"), ("Baku", "other"), ("UK", "eu"),
    ("Tokyo, Japan", "other"), ("Austin, TX", "us"),
]


def case(column, mapping, default=None):
    out = None
    for key, value in mapping.items():
        out = F.when(F.col(column) == key, value) if out is None else out.when(F.col(column) == key, value)
    return out if default is None else out.otherwise(default)


def titled(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    title = F.concat(case("o_orderpriority", GRADE_WORD), F.lit(" "), case("c_mktsegment", ROLE),
                     case("o_orderstatus", LEVEL))
    place = F.element_at(F.array(*[F.lit(p) for p, _ in PLACES]), F.col("c_nationkey") % 25 + 1)
    return o.select("o_orderkey", "o_totalprice", "o_orderpriority", "o_orderstatus", "c_mktsegment", title.alias("title"),
                    place.alias("place"), case("o_orderstatus", TEAM).alias("team"))


T = "t AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey)"
TARGET = "c_mktsegment NOT IN ('FURNITURE') AND (c_mktsegment <> 'HOUSEHOLD' OR (o_orderstatus = 'F' AND o_orderpriority <> '4-NOT SPECIFIED'))"


@check("region_bucket", rows(T, select="SELECT o_orderkey, [" + ", ".join(f"'{b}'" for _, b in PLACES)
                             + "][c_nationkey % 25 + 1] AS region FROM t"))
def region_bucket(spark, sf):
    return titled(spark, sf).select("o_orderkey", classify.region_bucket("place").alias("region"))


@check("seniority_bucket", rows(T, select="""
  SELECT o_orderkey, CASE
    WHEN c_mktsegment = 'MACHINERY' THEN CASE WHEN o_orderpriority = '1-URGENT' THEN 'senior' ELSE 'unspecified' END
    WHEN o_orderpriority = '2-HIGH' THEN 'staff+' WHEN o_orderpriority = '1-URGENT' THEN 'senior'
    WHEN o_orderpriority = '3-MEDIUM' THEN 'junior' WHEN o_orderpriority = '5-LOW' THEN 'mid'
    WHEN o_orderstatus = 'F' AND c_mktsegment IN ('AUTOMOBILE', 'BUILDING') THEN 'mid'
    ELSE 'unspecified' END AS seniority FROM t"""))
def seniority_bucket(spark, sf):
    return titled(spark, sf).select("o_orderkey", classify.seniority_bucket("title").alias("seniority"))


@check("role_filter", rows(T, select=f"SELECT o_orderkey FROM t WHERE {TARGET}"))
def role_filter(spark, sf):
    return titled(spark, sf).where(classify.is_target_role("title", "team")).select("o_orderkey")


@check("mgmt_flag", rows(T, select="SELECT o_orderkey, o_orderstatus = 'P' AS is_management FROM t"))
def mgmt_flag(spark, sf):
    return titled(spark, sf).select("o_orderkey", classify.is_management("title").alias("is_management"))


# -- pay ---------------------------------------------------------------------------------------------------------

N = """n AS (SELECT *, CAST(floor(o_totalprice) AS BIGINT) AS lo, CAST(floor(o_totalprice) AS BIGINT) * 2 AS hi
  FROM orders JOIN customer ON o_custkey = c_custkey)"""
FORM = {"1-URGENT": "USD", "2-HIGH": "GBP", "3-MEDIUM": "EUR", "5-LOW": "USD"}
CURRENCY_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN '{c}'" for k, c in FORM.items()) + " END"


def numbered(spark, sf):
    o = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    lo = F.floor("o_totalprice")
    return o.withColumns({"lo": lo, "hi": lo * 2})


def range_text():
    lo, hi = F.format_number("lo", 0), F.format_number("hi", 0)
    thousand = F.floor(F.col("lo") / 1000).cast("string"), F.floor(F.col("hi") / 1000).cast("string")
    return (F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("$"), lo, F.lit(" - $"), hi))
            .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("gbp "), lo, F.lit(" to "), hi))
            .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.lit("€"), thousand[0], F.lit("–"), thousand[1], F.lit("K")))
            .when(F.col("o_orderpriority") == "5-LOW", F.concat(lo, F.lit(" до "), hi))
            .otherwise(F.concat(F.lit("from "), lo)))


LOW = "CASE WHEN o_orderpriority = '3-MEDIUM' THEN (lo // 1000) * 1000.0 ELSE lo * 1.0 END"
HIGH = "CASE WHEN o_orderpriority = '3-MEDIUM' THEN (hi // 1000) * 1000.0 ELSE hi * 1.0 END"


@check("pay_pair", rows(N, select=f"""
  SELECT o_orderkey, CAST(CASE WHEN {CURRENCY_SQL} IS NOT NULL THEN {LOW} END AS DOUBLE) AS min,
         CAST(CASE WHEN {CURRENCY_SQL} IS NOT NULL THEN {HIGH} END AS DOUBLE) AS max,
         {CURRENCY_SQL} AS currency FROM n"""))
def pay_pair(spark, sf):
    found = money.first_range(F.concat(F.col("c_name"), F.lit(": "), range_text(), F.lit(" and more")))
    return numbered(spark, sf).select("o_orderkey", found.alias("r")).select("o_orderkey", "r.*")


@check("pay_anchor", rows(N, f"""
w AS (SELECT o_orderkey, o_orderstatus, c_mktsegment, {CURRENCY_SQL} AS cur, {LOW} AS a, {HIGH} AS b,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 12 ELSE 1 END AS unit FROM n)""", """
g AS (SELECT *, o_orderstatus <> 'F' AND cur IS NOT NULL AND a * unit >= 20000 AND b * unit <= 1500000
  AND a > 0 AND b / nullif(a, 0) <= 3 AS ok FROM w)""", select="""
  SELECT o_orderkey, CAST(CASE WHEN ok THEN a END AS DOUBLE) AS min, CAST(CASE WHEN ok THEN b END AS DOUBLE) AS max,
         CASE WHEN ok THEN cur END AS currency,
         CASE WHEN ok THEN CASE WHEN unit = 12 THEN 'month' ELSE 'year' END END AS interval,
         CAST(CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 + CASE WHEN NOT ok AND cur IS NOT NULL THEN 1 ELSE 0 END END
           AS INT) AS rejected FROM g"""))
def pay_anchor(spark, sf):
    """An implausible range near the first anchor, far away from it the real one; status F has no anchor at all."""
    far = F.repeat(F.lit("lorem ipsum "), 40)
    month = F.when(F.col("c_mktsegment") == "BUILDING", " per month").otherwise("")
    body = F.concat(F.lit("Annual report: raised $1,000 - $2,000. "), far, F.lit("\U0001f4b0 Base pay: "), range_text(),
                    month, F.lit(". "), far)
    text = F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("Offer: "), range_text())).otherwise(body)
    spread = numbered(spark, sf).repartition("o_orderkey")  # thin rows move, the long texts are built after it
    return spread.select("o_orderkey", money.anchored_range(text).alias("r")).select("o_orderkey", "r.*")


@check("pay_tiers", rows(N, select="""
  SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'F' THEN 100000 WHEN o_orderstatus = 'P' THEN least(lo, 70000)
    ELSE lo END AS DOUBLE) AS min,
    CAST(CASE WHEN o_orderstatus = 'F' THEN 120000 WHEN o_orderstatus = 'P' THEN greatest(hi, 80000)
    ELSE hi END AS DOUBLE) AS max,
    CASE WHEN o_orderstatus = 'O' THEN 'EUR' ELSE 'USD' END AS currency,
    CASE WHEN o_orderstatus = 'F' THEN 'year' ELSE '1 YEAR' END AS interval, o_orderstatus <> 'F' AS conflict FROM n"""))
def pay_tiers(spark, sf):
    def part(kind, currency, low, high):
        return F.struct(F.lit(kind).alias("compensationType"), F.lit("1 YEAR").alias("interval"),
                        F.lit(currency).alias("currencyCode"), low.cast("double").alias("minValue"),
                        high.cast("double").alias("maxValue"))

    def tiers(*parts):
        return F.array(*[F.struct(F.array(p).alias("components")) for p in parts])
    lo, hi = F.col("lo"), F.col("hi")
    value = (F.when(F.col("o_orderstatus") == "F", tiers(part("Equity", "USD", lo, hi)))
             .when(F.col("o_orderstatus") == "P", tiers(part("Salary", "JPY", lo * 150, hi * 150), part("Salary", "usd", lo, hi),
                                                       part("Salary", "USD", F.lit(70000), F.lit(80000))))
             .otherwise(tiers(part("Salary", "EUR", lo, hi), part("Salary", "JPY", lo * 150, hi * 150))))
    comp = F.struct(value.alias("compensationTiers"), F.lit("$100K - $120K").alias("scrapeableCompensationSalarySummary"))
    return numbered(spark, sf).select("o_orderkey", comp.alias("c")).select(
        "o_orderkey", money.tier_range("c").alias("r")).select("o_orderkey", "r.*")


@check("pay_range", rows(N, select="""
  SELECT o_orderkey, CAST(CASE WHEN o_orderstatus <> 'F' THEN 0 END AS DOUBLE) AS min,
         CAST(CASE WHEN o_orderstatus = 'O' THEN hi WHEN o_orderstatus = 'P' THEN lo END AS DOUBLE) AS max,
         CASE WHEN o_orderstatus <> 'F' THEN 'USD' END AS currency,
         CASE WHEN o_orderstatus <> 'F' THEN 'year' END AS interval FROM n"""))
def pay_range(spark, sf):
    """A zero counts as absent: status F has only zeros and gives nothing, the others keep the raw zero."""
    high = F.when(F.col("o_orderstatus") == "F", 0.0).when(F.col("o_orderstatus") == "O", F.col("hi")).otherwise(F.col("lo"))
    pay = F.struct(F.lit(0.0).alias("min"), high.cast("double").alias("max"), F.lit(None).cast("string").alias("currency"),
                   F.lit("").alias("interval"))
    return numbered(spark, sf).select("o_orderkey", pay.alias("p")).select(
        "o_orderkey", money.given_range("p").alias("r")).select("o_orderkey", "r.*")


INTERVAL = {"1-URGENT": "1 HOUR", "2-HIGH": "per-week-salary", "3-MEDIUM": "monthly", "4-NOT SPECIFIED": "DAY",
            "5-LOW": "1 YEAR"}
UNITS = {"1-URGENT": 2080, "2-HIGH": 52, "3-MEDIUM": 12, "4-NOT SPECIFIED": 260, "5-LOW": 1}
UNIT_SQL = "CASE o_orderpriority " + " ".join(f"WHEN '{k}' THEN {u}" for k, u in UNITS.items()) + " END"


@check("annualise", f"SELECT o_orderkey, round(o_totalprice * {UNIT_SQL}, 2) AS annual FROM orders")
def annualise(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", F.round(
        money.annualise("o_totalprice", case("o_orderpriority", INTERVAL)), 2).alias("annual"))


# Units per dollar come from the data: the mean balance of each market segment, in thousands.
RATES_SQL = "fx AS (SELECT c_mktsegment AS cur, round(avg(c_acctbal) / 1000, 6) AS per_usd FROM customer GROUP BY 1)"


def segment_rates(spark, sf):
    return table(spark, sf, "customer").groupBy(F.col("c_mktsegment").alias("currency")).agg(
        F.round(F.avg("c_acctbal") / 1000, 6).alias("per_usd"))


@check("fx_convert", rows(N, RATES_SQL, select="""
  SELECT o_orderkey, round(CASE WHEN o_orderstatus = 'O' THEN o_totalprice WHEN o_orderstatus = 'F' THEN NULL
    ELSE o_totalprice / per_usd END, 2) AS usd FROM n JOIN fx ON c_mktsegment = cur"""))
def fx_convert(spark, sf):
    code = (F.when(F.col("o_orderstatus") == "O", "usd").when(F.col("o_orderstatus") == "F", "unknown")
            .otherwise(F.lower("c_mktsegment")))
    done = money.with_usd(numbered(spark, sf), {"usd": F.col("o_totalprice")}, code, segment_rates(spark, sf))
    return done.select("o_orderkey", F.round("usd", 2).alias("usd"))


@check("pay_normalise", rows(N, RATES_SQL, f"""
a AS (SELECT o_orderkey, o_totalprice * {UNIT_SQL} / per_usd AS lo,
  CASE WHEN o_orderstatus <> 'F' THEN o_totalprice * CASE WHEN o_orderstatus = 'P' THEN 25 ELSE 2 END * {UNIT_SQL} / per_usd END AS hi
  FROM n JOIN fx ON c_mktsegment = cur)""", "b AS (SELECT *, coalesce((lo + hi) / 2, lo) AS mid FROM a)", """
c AS (SELECT *, mid BETWEEN 10000 AND 1500000 AND coalesce(hi / lo <= 20, true) AS ok FROM b)""", select="""
  SELECT o_orderkey, round(CASE WHEN ok THEN lo END, 2) AS salary_min_usd, round(CASE WHEN ok THEN hi END, 2) AS salary_max_usd,
         round(CASE WHEN ok THEN mid END, 2) AS salary_mid_usd, ok AS has_salary, NOT ok AS dropped_oob,
         coalesce(hi / lo > 20, false) AS ratio_dropped FROM c"""))
def pay_normalise(spark, sf):
    factor = F.when(F.col("o_orderstatus") == "F", None).when(F.col("o_orderstatus") == "P", 25.0).otherwise(2.0)
    pay = F.struct(F.col("o_totalprice").alias("min"), (F.col("o_totalprice") * factor).alias("max"),
                   F.col("c_mktsegment").alias("currency"), case("o_orderpriority", INTERVAL).alias("interval"))
    done = money.normalise_pay(numbered(spark, sf).withColumn("pay", pay), segment_rates(spark, sf))
    return done.select("o_orderkey", *[F.round(c, 2).alias(c) for c in ("salary_min_usd", "salary_max_usd", "salary_mid_usd")],
                       "has_salary", "dropped_oob", "ratio_dropped")


@check("rate_freshness", rows("d AS (SELECT max(o_orderdate)::DATE AS last FROM orders)", """
r AS (SELECT c_mktsegment AS currency, max(o_orderdate)::DATE AS as_of, round(avg(c_acctbal) / 1000, 6) AS per_usd
  FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)""", select="""
  SELECT currency, as_of, CAST(DATE '2001-08-04' - as_of AS INT) AS age_days, DATE '2001-08-04' - as_of > 3 AS stale,
         round(1 / per_usd, 4) AS usd FROM r WHERE currency IN ('AUTOMOBILE', 'BUILDING', 'MACHINERY')"""))
def rate_freshness(spark, sf):
    rates = numbered(spark, sf).groupBy(F.col("c_mktsegment").alias("currency")).agg(
        F.max(F.to_date("o_orderdate")).alias("as_of"), F.round(F.avg("c_acctbal") / 1000, 6).alias("per_usd"))
    return reports.rate_freshness(rates, "2001-08-04", ("AUTOMOBILE", "BUILDING", "MACHINERY"))


@check("epoch_to_timestamp", """
  SELECT event_id, strftime(date_trunc('second', ts), '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN ms % 1000 = 0 THEN '' ELSE '.' || lpad(CAST(ms % 1000 AS VARCHAR), 3, '0') || '000' END
    || '+00:00' AS iso, ms FROM (SELECT event_id, ts, epoch_us(ts) // 1000 AS ms FROM events)""")
def epoch_to_timestamp(spark, sf):
    ms = F.expr("cast(floor(unix_micros(cast(ts as timestamp)) / 1000) as bigint)")
    e = table(spark, sf, "events").select("event_id", ms.alias("ms"))
    return e.select("event_id", dates.epoch_to_iso("ms").alias("iso"), F.unix_millis(dates.epoch_to_timestamp("ms")).alias("ms"))


@check("run_counters", rows(T, "twice AS (SELECT t.*, copy FROM t, (SELECT unnest([1, 2]) AS copy) "
                              "WHERE copy = 1 OR o_orderpriority = '1-URGENT')", select=f"""
  SELECT count(*) AS raw_jobs, count(*) FILTER (NOT ({TARGET})) AS filtered_non_tech,
         count(*) FILTER (({TARGET}) AND copy = 1) AS snapshot_rows,
         count(*) FILTER (({TARGET}) AND copy = 1 AND o_totalprice > 100000) AS with_salary,
         count(*) FILTER (({TARGET}) AND copy = 1 AND o_totalprice < 10000) AS dropped_oob,
         count(*) FILTER (({TARGET}) AND o_totalprice < 5000) AS ratio_guard_dropped,
         CAST(coalesce(sum(CASE WHEN {TARGET} THEN c_nationkey END), 0) AS BIGINT) AS pairs_rejected,
         count(*) FILTER (({TARGET}) AND o_orderstatus = 'O') AS currency_conflicts
  FROM (SELECT *, o_orderstatus AS st FROM twice)"""))
def run_counters(spark, sf):
    """Urgent orders come twice: what is counted on raw or read rows counts both, the rest one."""
    copies = F.when(F.col("o_orderpriority") == "1-URGENT", F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    raw = titled(spark, sf).withColumn("department", F.col("team")).withColumn("copy", F.explode(copies))
    nations = table(spark, sf, "orders").join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("_k"), "c_nationkey")
    priced = raw.where(classify.is_target_role("title", "team")).join(nations, F.col("o_orderkey") == F.col("_k")).withColumns({
        "has_salary": F.col("o_totalprice") > 100000, "dropped_oob": F.col("o_totalprice") < 10000,
        "ratio_dropped": F.col("o_totalprice") < 5000, "pay_rejected": F.col("c_nationkey"),
        "pay_conflict": F.col("o_orderstatus") == "O"})
    return quality.run_counters(raw, priced, first_occurrence(priced, "o_orderkey", "copy"))
