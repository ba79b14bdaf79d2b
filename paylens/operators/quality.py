"""Volume guard, run counters and data-quality rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paylens.functions import vocab as v
from paylens.functions.classify import is_target_role
from paylens.operators.sizes import materialise


class VolumeGuardError(RuntimeError):
    """A source collapsed against its recent history; the day must not be written."""


def source_counts(df: DataFrame, source: str = "source") -> DataFrame:
    return df.groupBy(source).agg(F.count(F.lit(1)).alias("n"))


def volume_guard(history: DataFrame, today: DataFrame, source: str = "source", date: str = "snapshot_date",
                 floor: float = 0.5, total_floor: float = 0.6, days: int = 7, min_days: int = 3) -> DataFrame:
    """The guard over rows: ``history`` excludes today and is counted once, from its source and date columns."""
    per_day = materialise(history.groupBy(source, date).agg(F.count(F.lit(1)).alias("n")))
    return volume_problems(per_day, source_counts(today, source), source, date, floor, total_floor, days, min_days)


def volume_problems(per_day: DataFrame, today: DataFrame, source: str = "source", date: str = "dt", floor: float = 0.5,
                    total_floor: float = 0.6, days: int = 7, min_days: int = 3) -> DataFrame:
    """Problems as (scope, got, expected): a source below ``floor`` of the median of its latest ``days`` counts, or a
    total below ``total_floor`` of the summed medians. Silent until ``min_days`` days of history exist.

    ``per_day`` has (source, date, n) and excludes today, ``today`` has (source, n). Days on which a source has no rows
    are absent, not zero.
    """
    per_day = per_day.withColumnRenamed("n", "_n")
    recent = per_day.withColumn("_r", F.row_number().over(Window.partitionBy(source).orderBy(F.desc(date)))).where(
        F.col("_r") <= days)
    expected = recent.groupBy(source).agg(F.median("_n").alias("expected"))  # at most ``days`` numbers each
    now = today.withColumnRenamed("n", "_got")
    judged = expected.join(now, source, "full_outer").select(
        F.col(source).alias("scope"), F.coalesce("_got", F.lit(0)).alias("got"), "expected")
    total = judged.agg(F.sum("got").alias("got"), F.sum("expected").alias("expected")).select(
        F.lit("total").alias("scope"), "got", "expected")
    problems = judged.where(F.col("got") < floor * F.col("expected")).unionByName(
        total.where((F.col("expected") > 0) & (F.col("got") < total_floor * F.col("expected"))))
    enough = per_day.agg(F.count_distinct(date)).scalar() >= min_days
    return problems.where(enough)


def run_counters(raw: DataFrame, priced: DataFrame, kept: DataFrame, title: str = "title",
                 department: str = "department") -> DataFrame:
    """One row of run counters. Refused titles are counted on raw rows; rejected ranges, currency conflicts and dropped
    ratios on ``priced``, the target rows before duplicates go; pay out of bounds on the deduplicated rows."""
    refused = raw.agg(F.struct(
        F.count(F.lit(1)).alias("raw_jobs"),
        F.count_if(~is_target_role(title, department)).alias("filtered_non_tech"))).scalar()
    seen = kept.agg(
        F.count(F.lit(1)).alias("snapshot_rows"), F.count_if("has_salary").alias("with_salary"),
        F.count_if("dropped_oob").alias("dropped_oob"))
    read = priced.agg(F.struct(
        F.count_if("ratio_dropped").alias("ratio_guard_dropped"),
        F.coalesce(F.sum("pay_rejected"), F.lit(0)).alias("pairs_rejected"),
        F.count_if("pay_conflict").alias("currency_conflicts"))).scalar()
    return seen.withColumns({"_raw": refused, "_read": read}).select("_raw.*", *seen.columns, "_read.*")


def label_counters(labelled: DataFrame) -> DataFrame:
    """One row: postings handed to the labeller, labelled, labelled without a label, omitted, failed; and label rows."""
    answered = F.col("status") == "labelled"
    return labelled.agg(
        F.count(F.lit(1)).alias("label_queue"), F.count_if(answered).alias("labelled"),
        F.count_if(answered & (F.size("labels") == 0)).alias("labelled_empty"),
        F.count_if(F.col("status") == "omitted").alias("labels_omitted"),
        F.count_if(F.col("status") == "failed").alias("labels_failed"),
        F.coalesce(F.sum(F.when(answered, F.greatest(F.size("labels"), F.lit(1)))), F.lit(0)).alias("label_rows"))


def run_summary(raw: DataFrame, priced: DataFrame, kept: DataFrame, dt: str, new: DataFrame | None = None,
                labelled: DataFrame | None = None, source: str = "source", board: str = "company") -> DataFrame:
    """The counters with the day, a map of rows per source (one entry per job board system), the boards that had
    postings, the new rows and the labelling counters."""
    per_source = source_counts(kept, source).agg(
        F.map_from_entries(F.array_sort(F.collect_list(F.struct(source, "n")))).alias("by_source"))
    boards = raw.agg(F.count_distinct(source, board))
    out = run_counters(raw, priced, kept).select(
        F.lit(dt).cast("date").alias("date"), per_source.scalar().alias("by_source"), boards.scalar().alias("boards"), "*")
    if new is not None:
        out = out.withColumn("new_rows", new.agg(F.count(F.lit(1))).scalar())
    if labelled is not None:
        out = out.withColumn("_labels", labelled.select(F.struct("*")).scalar()).select(*out.columns, "_labels.*")
    return out


def assertions(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, violations): each rule is a violation predicate per row or an aggregate expression; one pass for all."""
    one = df.agg(*[rule.alias(name) for name, rule in rules.items()])
    return one.unpivot([], list(rules), "rule", "violations")


def pay_rules(key: str = "job_uid", value: str = "salary_mid_usd", low: str = "salary_min_usd",
              high: str = "salary_max_usd", has_pay: str = "has_salary",
              skills: str | None = None) -> dict[str, Column]:
    """The standing rules on a snapshot day; each must give zero."""
    wide = F.col(high) / F.nullif(F.col(low), F.lit(0.0)) > v.GUARD_MAX_RATIO
    outside = ~F.col(value).between(v.PAY_FLOOR_USD, v.PAY_CEILING_USD)
    rules = {
        "paid_without_mid": F.count_if(F.col(has_pay) & F.col(value).isNull()),
        "mid_out_of_range": F.count_if(outside),
        "duplicate_keys": F.count(F.lit(1)) - F.count_distinct(key),
        "range_too_wide": F.count_if(wide),
    }
    if skills is not None:
        rules["labelled_share_below_0_9"] = F.when(
            F.count_if(F.col(skills).isNotNull()) < 0.9 * F.count(F.lit(1)), 1).otherwise(0).cast("bigint")
    return rules
