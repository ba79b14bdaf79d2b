"""Date-partitioned history: reading, first-seen keys, day writes and backfill."""

from __future__ import annotations

import datetime
import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens import schemas
from paylens.functions.dates import publish_date
from paylens.operators import keyfilter

_DAY = re.compile(r"/dt=(\d{4}-\d{2}-\d{2})/")


def read_table(spark: SparkSession, store: str, name: str) -> DataFrame:
    """A history table with its fixed schema; a table that does not exist yet is empty, not an error."""
    schema = schemas.with_day(schemas.TABLES[name])
    try:
        return spark.read.schema(schema).parquet(f"{store}/{name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def first_seen(jobs: DataFrame, key: str = "job_uid", day: str = "first_seen") -> DataFrame:
    return jobs.groupBy(key).agg(F.min(day).alias(day))


def new_rows(today: DataFrame, history: DataFrame, dt, key: str = "job_uid", day: str = "dt") -> DataFrame:
    """Rows of today whose key no other day holds. Today's own partition is pruned, so a re-run finds the same keys."""
    known = history.where(F.col(day) != F.lit(dt).cast("date")).select(key).distinct()
    return today.join(known, key, "left_anti")


def stored_days(spark: SparkSession, store: str, table: str) -> list[datetime.date]:
    """The days that a table has files for, from the file listing."""
    found = {m[1] for f in read_table(spark, store, table).inputFiles() if (m := _DAY.search(f))}
    return sorted(datetime.date.fromisoformat(day) for day in found)


def unseen_rows(rows: DataFrame, store: str, table: str, dt: str | None = None, only: str | None = None,
                key: str = "job_uid") -> DataFrame:
    """Rows whose key no day of ``table`` holds, other than ``dt`` if that is given; ``only`` looks at one day alone.

    The key filters of the days settle most keys; days are read only where a filter hits, or where they have none.
    """
    known = known_keys(rows, store, table, dt, only, key).known
    return rows if known.isEmpty() else rows.join(known, key, "left_anti")


def known_keys(rows: DataFrame, store: str, table: str, dt: str | None = None, only: str | None = None,
               key: str = "job_uid") -> keyfilter.Found:
    spark = rows.sparkSession
    days = F.lit(True) if dt is None else F.col("dt") != F.lit(dt).cast("date")
    if only is not None:
        days = days & (F.col("dt") == F.lit(only).cast("date"))
    covered = stored_days(spark, store, f"{table}_keys")
    return keyfilter.find_known(rows, read_table(spark, store, table).where(days),
                                read_table(spark, store, f"{table}_keys").where(days), covered, key)


def write_keys(rows: DataFrame, store: str, table: str, dt: str, append: bool = False, key: str = "job_uid") -> None:
    """Replace (or extend) the key filter of a day. A filter may cover more than the day's rows, never less: extend it
    before rows are written, and replace it after a day was replaced."""
    spark, keys = rows.sparkSession, rows.select(key)
    if append and datetime.date.fromisoformat(dt) not in stored_days(spark, store, f"{table}_keys"):
        keys = keys.unionByName(read_table(spark, store, table).where(F.col("dt") == F.lit(dt).cast("date")).select(key))
    filters = keyfilter.build(keys, key, keyfilter.slots_for(keys.count()))
    write_day(filters, store, f"{table}_keys", dt, append, "slot")


def replace_day(rows: DataFrame, store: str, table: str, dt: str, key: str = "job_uid") -> None:
    """Replace one day and its key filter; a job that is lost in between leaves a filter that covers both states."""
    write_keys(rows, store, table, dt, append=True, key=key)
    write_day(rows, store, table, dt, key=key)
    write_keys(rows, store, table, dt, key=key)


def extend_day(rows: DataFrame, store: str, table: str, dt: str, key: str = "job_uid") -> None:
    """Add rows to a day and to its key filter."""
    write_keys(rows, store, table, dt, append=True, key=key)
    write_day(rows, store, table, dt, append=True, key=key)


def write_day(df: DataFrame, store: str, table: str, dt: str, append: bool = False, key: str = "job_uid") -> None:
    """Replace (or extend) one day. Rows are dealt out by key and sorted by it in every file; an empty frame clears the
    day. A day is replaced when the job commits: files are staged until then, so a lost job leaves the old day."""
    rows = df.drop("dt").repartition(key).sortWithinPartitions(key)
    if append or rows.isEmpty():
        rows.write.mode("append" if append else "overwrite").option("compression", "zstd").parquet(
            f"{store}/{table}/dt={dt}")
        return
    (rows.withColumn("dt", F.lit(dt).cast("date")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("compression", "zstd").partitionBy("dt").parquet(f"{store}/{table}"))


def day_counts(spark: SparkSession, store: str, dt: str) -> DataFrame:
    """(source, dt, n) of every snapshot day but ``dt``, from the stored counts. Days that were never counted, or extended
    since, are counted now, and stored; no other day is read."""
    stored = read_table(spark, store, "counts")
    known = {r.dt for r in stored.groupBy("dt").agg(F.every(F.col("n").isNotNull()).alias("ok")).where("ok").collect()}
    missing = [d for d in stored_days(spark, store, "snapshots") if d not in known and str(d) != dt]
    if missing:
        counted = read_table(spark, store, "snapshots").where(F.col("dt").isin(missing)).groupBy("source", "dt").agg(
            F.count(F.lit(1)).alias("n"))
        (counted.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt")
         .parquet(f"{store}/counts"))
    return read_table(spark, store, "counts").where((F.col("dt") != F.lit(dt).cast("date")) & F.col("n").isNotNull())


def forget_counts(spark: SparkSession, store: str, dt: str) -> None:
    """The day's counts no longer hold; whoever needs them counts again."""
    write_day(spark.createDataFrame([(None, None)], schemas.COUNTS), store, "counts", dt, key="source")


def backfill_rows(df: DataFrame, today: str, published: str = "published_at_raw") -> DataFrame:
    """Set ``first_seen`` to the publish date in its own offset, or to today where it is unknown."""
    return df.withColumn("first_seen", F.coalesce(publish_date(published), F.lit(today).cast("date")))


def rewrite_keys(spark: SparkSession, store: str, table: str, key: str = "job_uid") -> None:
    """Build the key filters of all days of a table anew, all of the size that the largest day needs."""
    rows = read_table(spark, store, table)
    most = rows.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()[0] or 0
    (keyfilter.build(rows, key, keyfilter.slots_for(most), ["dt"]).hint("rebalance", "dt").write.mode("overwrite")
     .option("partitionOverwriteMode", "static").option("compression", "zstd").partitionBy("dt")
     .parquet(f"{store}/{table}_keys"))


def write_backfill(df: DataFrame, store: str, table: str = "jobs", key: str = "job_uid") -> None:
    """Rewrite a whole table, one partition per ``first_seen``. Rows are rebalanced by day: small days share a task, and
    a day that holds a third of all rows is split over many."""
    (df.withColumn("dt", F.col("first_seen")).hint("rebalance", "dt").sortWithinPartitions("dt", key)
     .write.mode("overwrite").option("partitionOverwriteMode", "static").option("compression", "zstd")
     .partitionBy("dt").parquet(f"{store}/{table}"))


def backfill_summary(df: DataFrame, day: str = "first_seen") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(day).alias("days"),
                  F.min(day).alias("first_day"), F.max(day).alias("last_day"))
