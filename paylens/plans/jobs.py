"""The jobs a user runs: a day's ingest, the aggregates, the backfill and the interactive slice report."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens import schemas
from paylens.functions import classify
from paylens.functions.money import normalise_pay, with_pay_range
from paylens.operators import history, labels, quality, reports
from paylens.operators.groups import first_occurrence
from paylens.operators.premium import premium_with_ci
from paylens.operators.sizes import materialise, stage
from paylens.sources.boards import read_postings

LABEL_VERSION = "v1"


def target_postings(raw: DataFrame) -> DataFrame:
    """Individual technical roles with their key."""
    return raw.where(classify.is_target_role("title", "department")).withColumn(
        "job_uid", classify.posting_key("source", "company", "job_id"))


def priced_postings(targets: DataFrame, rates: DataFrame) -> DataFrame:
    """Every target posting, duplicates included, without the text and with annual pay in US dollars."""
    return normalise_pay(with_pay_range(targets).drop("description", "tier_pay", "range_pay"), rates)


def normalise_postings(raw: DataFrame, rates: DataFrame, dt: str) -> DataFrame:
    """One normalised row per key, without the text: buckets, flags and annual pay in US dollars.

    Pay is read from the text before duplicates go, so that the shuffle moves thin rows only.
    """
    return distinct_postings(priced_postings(target_postings(raw), rates), dt)


def distinct_postings(priced: DataFrame, dt: str) -> DataFrame:
    """The first posting of each key in ingest order, with its buckets."""
    return bucketed(first_occurrence(priced, "job_uid", "ingest_seq"), dt)


def bucketed(priced: DataFrame, dt: str) -> DataFrame:
    """Priced postings of a day with their buckets."""
    day = F.lit(dt).cast("date")
    return priced.withColumns({
        "snapshot_date": day, "first_seen": day,
        "region": classify.region_bucket("location_raw", "country"),
        "seniority": classify.seniority_bucket("title"),
        "is_management": classify.is_management("title"),
        "is_remote": F.coalesce(F.col("is_remote"), F.lit(False)),
    }).drop("pay")


def snapshot_rows(kept: DataFrame) -> DataFrame:
    return kept.select(*schemas.SNAPSHOTS.fieldNames())


def job_rows(kept: DataFrame) -> DataFrame:
    return kept.select(*schemas.JOBS.fieldNames())


def label_day(targets: DataFrame, kept: DataFrame, store: str, dt: str, labeller: labels.Labeller | None = None,
              limit: int | None = None, version: str = LABEL_VERSION) -> DataFrame:
    """Label every posting that the cache lacks, append the rows to the day and return the labelling counters.

    Without a labeller the literal one runs, which needs no queue. A custom one is called in the order of the queue, for
    at most ``limit`` postings if that is given.
    """
    spark = targets.sparkSession
    state = labels.cache_state(history.read_table(spark, store, "skills"), version)
    current, stale = state.where(F.col("state") == "current"), state.where(F.col("state") == "stale")
    waiting = targets.select("job_uid", "source", "title", "description", "published_at_raw", "ingest_seq")
    if labeller is None:
        thin = labels.pending(labels.worded(waiting).select("job_uid", "ingest_seq"), current)
        labelled = labels.literal_labeller(waiting.join(thin, ["job_uid", "ingest_seq"], "left_semi"))
    else:
        paid = kept.select("job_uid", "has_salary")
        labelled = labels.apply_labeller(labels.label_queue(waiting.join(paid, "job_uid", "left"), current, stale, limit),
                                         labeller)
    labelled = materialise(labelled)  # a labeller is called once
    rows = labels.label_rows(labelled, version, F.current_timestamp(), "literal" if labeller is None else "custom")
    history.write_day(rows, store, "skills", dt, append=True)
    return quality.label_counters(labelled)


def daily_run(spark: SparkSession, landing: str, store: str, dt: str, rates: DataFrame,
              registry: DataFrame | None = None, label: bool = True, labeller: labels.Labeller | None = None,
              limit: int | None = None, lines: bool = False) -> DataFrame:
    """Ingest one day and return its summary row. Nothing is written to the store if the volume guard objects; a re-run
    of the day replaces its snapshot and its new keys.

    The dumps are read and parsed once, into Parquet in the shared folder; whatever follows takes its columns from there.
    """
    raw = stage(read_postings(spark, landing, registry, lines))
    targets = target_postings(raw)
    priced = stage(priced_postings(targets, rates))
    kept = materialise(distinct_postings(priced, dt))
    counts = materialise(quality.source_counts(kept))
    problems = quality.volume_problems(history.day_counts(spark, store, dt), counts).collect()  # a row per source at most
    if problems:
        raise quality.VolumeGuardError("; ".join(f"{p.scope}: {p.got} rows, expected about {p.expected:.0f}"
                                                 for p in problems))
    history.forget_counts(spark, store, dt)
    history.replace_day(snapshot_rows(kept), store, "snapshots", dt)
    history.write_day(counts, store, "counts", dt, key="source")
    new = materialise(history.unseen_rows(job_rows(kept), store, "jobs", dt))
    history.replace_day(new, store, "jobs", dt)
    labelled = label_day(targets, kept, store, dt, labeller, limit) if label else None
    summary = quality.run_summary(raw, priced, kept, dt, new, labelled)
    summary.write.mode("overwrite").json(f"{store}/runs/dt={dt}")
    return spark.read.schema(summary.schema).json(f"{store}/runs/dt={dt}")


def backfill(spark: SparkSession, landing: str, store: str, today: str, rates: DataFrame,
             registry: DataFrame | None = None, lines: bool = False) -> DataFrame:
    """Rebuild the first-seen table with one partition per publish date; returns the summary row."""
    kept = materialise(normalise_postings(read_postings(spark, landing, registry, lines), rates, today))
    rows = job_rows(history.backfill_rows(kept, today))
    history.write_backfill(rows, store)
    history.rewrite_keys(spark, store, "jobs")
    return history.backfill_summary(history.read_table(spark, store, "jobs"))


@dataclass(frozen=True)
class Published:
    """Results of ``aggregate``; every field is a DataFrame, to be written or read on."""

    slice: DataFrame
    companies: DataFrame
    items: DataFrame
    rows: DataFrame
    series: DataFrame
    coverage: DataFrame
    counts: DataFrame
    top_companies: DataFrame
    premium: DataFrame
    freshness: DataFrame | None = None


def aggregate(spark: SparkSession, store: str, replicates: int = 1000, rates: DataFrame | None = None,
              dt: str | None = None) -> Published:
    """All published results of the history in ``store``; with the rates (as_of, currency, per_usd) and the day also
    whether the rates are out of date."""
    snap, jobs, marks = (history.read_table(spark, store, n) for n in ("snapshots", "jobs", "skills"))
    first = history.first_seen(jobs)
    today = classify.latest(snap, "dt")
    sets = labels.label_sets(marks.join(today.select("job_uid"), "job_uid", "left_semi"))
    current = materialise(labels.with_label_sets(reports.latest_slice(today, first), sets))
    companies, items, rows = reports.encode_slice(current)
    return Published(
        slice=current, companies=companies, items=items, rows=rows,
        series=reports.daily_series(snap, first), coverage=reports.coverage(current, marks),
        counts=reports.distinct_counts(snap, current), top_companies=reports.top_entities(current),
        premium=premium_with_ci(classify.paid(current, has_salary="has_salary"), replicates=replicates),
        freshness=None if rates is None or dt is None else reports.rate_freshness(rates, dt))


def write_published(result: Published, target: str) -> None:
    """Write every published result as JSON lines below ``target``; the rows of the slice also as positional arrays, one per
    line, below ``compact``."""
    reports.positional_rows(result.rows).write.mode("overwrite").text(f"{target}/compact")
    for name in ("companies", "items", "rows", "series", "coverage", "counts", "top_companies", "premium", "freshness"):
        if (frame := getattr(result, name)) is not None:
            frame.write.mode("overwrite").json(f"{target}/{name}")


def slice_report(df: DataFrame, premium: DataFrame, days: int, region: str = "all", seniority: str = "all",
                 employers: DataFrame | None = None, value: str = "salary_mid_usd", order: list[str] | None = None
                 ) -> dict[str, DataFrame]:
    """Every interactive aggregate of one slice. The grade chart ignores the grade filter and the place chart the
    region filter, so that both show all their groups. ``paylens.operators.cube`` has all slices at once."""
    picked = classify.slice_filter(df, region, seniority)
    paid = classify.paid(picked, value)
    return {
        "headline": reports.headline(picked, premium, days, value),
        "histogram": reports.histogram(paid, value),
        "marks": reports.distribution_marks(paid, value),
        "grades": reports.median_by_grade(classify.paid(classify.slice_filter(df, region), value), value, order=order),
        "places": reports.median_by_place(classify.paid(classify.slice_filter(df, "all", seniority), value), value),
        "demand": reports.item_demand(picked, value=value),
        "payers": reports.top_payers(paid, employers, value),
        "learn_next": reports.learn_next(premium, reports.item_shares(picked)),
    }


def one_table(report: dict[str, DataFrame]) -> DataFrame:
    """(chart, row): all parts of a slice report, each row as JSON."""
    return reduce(DataFrame.unionByName, [
        part.select(F.lit(name).alias("chart"), F.to_json(F.struct(*part.columns)).alias("row"))
        for name, part in report.items()])
