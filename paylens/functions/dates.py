"""Dates of postings and runs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from paylens.functions import vocab as v
from paylens.functions.expr import col


def epoch_to_timestamp(ms: str | Column) -> Column:
    return F.timestamp_millis(col(ms))


def epoch_to_iso(ms: str | Column) -> Column:
    """UTC ISO text of an epoch in milliseconds, the raw form the other sources publish; zone-independent."""
    ms = col(ms)
    utc = F.expr("timestamp_ntz'1970-01-01 00:00:00'") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), (ms / 1000).cast("decimal(18,6)"))
    return F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"),
                    F.when(F.pmod(ms, F.lit(1000)) != 0,
                           F.concat(F.lit("."), F.lpad(F.pmod(ms, F.lit(1000)).cast("string"), 3, "0"), F.lit("000")))
                    .otherwise(""), F.lit("+00:00"))


def publish_date(raw: str | Column) -> Column:
    """Calendar date in the timestamp's own offset; NULL if the text is not a valid ISO date or timestamp."""
    raw = col(raw)
    shaped = raw.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$")
    return F.when(shaped & raw.try_cast("timestamp").isNotNull(), F.substring(raw, 1, 10).try_cast("date"))


def published_at(raw: str | Column) -> Column:
    return col(raw).try_cast("timestamp")


def day_in_zone(utc: str | Column, zone: str = v.DAY_ZONE) -> Column:
    """Calendar day in ``zone`` of a UTC timestamp without zone."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), col(utc).cast("timestamp_ntz")))


def today(zone: str = v.DAY_ZONE) -> Column:
    """Calendar day now in ``zone``; jobs prefer an explicit day."""
    return F.to_date(F.convert_timezone(F.current_timezone(), F.lit(zone), F.localtimestamp()))
