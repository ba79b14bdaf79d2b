"""Incremental ingest of newly landed dumps."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paylens import schemas
from paylens.operators import history
from paylens.operators.sizes import stage
from paylens.plans.jobs import bucketed, job_rows, priced_postings, snapshot_rows, target_postings
from paylens.sources.boards import stream_postings

STATE = "spark.sql.streaming.stateStore"
ON_DISK = {f"{STATE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
           f"{STATE}.rocksdb.boundedMemoryUsage": "true",  # for all partitions of an executor together
           f"{STATE}.rocksdb.maxMemoryUsageMB": "256",
           f"{STATE}.rocksdb.trackTotalNumberOfRows": "false"}
WANTED = {*schemas.JOBS.fieldNames(), *schemas.SNAPSHOTS.fieldNames(), "country"} - {"job_uid"}


@contextmanager
def state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, on disk and in bounded memory, unless the session names a
    provider of its own. A stream copies the settings when it starts, so the session gets its own back."""
    mine = {} if spark.conf.get(f"{STATE}.providerClass", None) else {
        k: v for k, v in ON_DISK.items() if spark.conf.get(k, None) is None}
    for k, v in mine.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k in mine:
            spark.conf.unset(k)


def keyed_state(priced: DataFrame, dt: str, keep: str) -> DataFrame:
    """(job_uid, posting, new_key, new_today) of every key that the current micro-batch touches.

    Streaming state holds, per key, when it was first and last seen and when it was first seen on its latest day, so a key
    is known again without a look into the history. ``posting`` is its first one of this micro-batch, in ingest order, with
    the columns that are stored. Keys leave the state at the end of a window of length ``keep``; when they come again they
    count as new here, and the history decides.
    """
    day, at = F.lit(dt).cast("date"), F.unix_micros("_at")
    seen = priced.withColumn("_at", F.current_timestamp()).withWatermark("_at", "1 day")  # one time per micro-batch
    state = seen.groupBy(F.window("_at", keep), "job_uid").agg(
        F.min("_at").alias("first"), F.max("_at").alias("last"),
        F.max(F.struct(day.alias("day"), (-at).alias("at"))).alias("newest"),
        F.min_by(F.struct(*[c for c in priced.columns if c in WANTED]), F.struct(-at, F.col("ingest_seq"))).alias("posting"))
    this_batch = F.struct(day.alias("day"), (-F.unix_micros("last")).alias("at"))
    return state.select("job_uid", "posting", (F.col("first") == F.col("last")).alias("new_key"),
                        ((F.col("newest") == this_batch) | (F.col("newest.day") > day)).alias("new_today"))


def absorb(batch: DataFrame, store: str, dt: str) -> None:
    """Add what is new in one micro-batch to the day. Key filters are extended before rows are written and hits are
    checked in the history, so replaying a batch after a failure adds nothing.

    The batch is evaluated once, into Parquet with its buckets; look-ups read the keys from there, the writes the rows.
    """
    rows = stage(bucketed(batch.where("new_key OR new_today").select("job_uid", "new_key", "new_today", "posting.*"), dt))
    if rows.isEmpty():
        return
    new = history.unseen_rows(job_rows(rows.where("new_key")), store, "jobs")
    history.extend_day(new, store, "jobs", dt)
    today = history.unseen_rows(snapshot_rows(rows.where("new_today")), store, "snapshots", only=dt)
    history.forget_counts(batch.sparkSession, store, dt)
    history.extend_day(today, store, "snapshots", dt)


def stream_ingest(spark: SparkSession, landing: str, store: str, dt: str, rates: DataFrame, checkpoint: str,
                  lines: bool = False, keep: str = "30 days") -> StreamingQuery:
    """Process every dump that landed since the last run, then stop. The checkpoint remembers which files were read and
    which keys were seen within ``keep``."""
    priced = priced_postings(target_postings(stream_postings(spark, landing, lines)), rates)
    writer = (keyed_state(priced, dt, keep).writeStream.outputMode("update").trigger(availableNow=True)
              .option("checkpointLocation", checkpoint).foreachBatch(lambda batch, _: absorb(batch, store, dt)))
    with state_on_disk(spark):
        return writer.start()
