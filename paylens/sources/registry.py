"""Registry of job boards: loading, building from probe results, slug plausibility and a summary."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens import schemas
from paylens.functions import vocab as v
from paylens.functions.expr import blank, col
from paylens.operators.groups import first_occurrence


def read_registry(spark: SparkSession, path: str, only_active: bool = True) -> DataFrame:
    """(source, slug, name) of a registry file; the board system is ``ats``, else ``source``."""
    raw = spark.read.schema(schemas.REGISTRY).option("multiLine", True).json(path)
    if only_active:
        raw = raw.where(F.col("status") == "active")
    return raw.select(F.coalesce(F.nullif(F.col("ats"), F.lit("")), F.col("source")).alias("source"), "slug",
                      F.coalesce("name", "slug").alias("name"))


def board_registry(probes: DataFrame, sample: int | None = None, added: str | None = None) -> DataFrame:
    """One row per board name from probe results (ats, slug, http, pos, location): status, size and hints.

    ``pos`` is the 0-based place of a posting in its board, NULL for a board without postings. Hints look at all places,
    or at the first ``sample`` if that is given. ``added`` adds the day of the probe to every row. Boards whose names differ only by case are one board, the active one if any.
    """
    place = F.lower(blank(F.col("location")))
    seen = F.col("pos").isNotNull() if sample is None else F.col("pos") < sample
    european = reduce(lambda a, b: a | b, [place.contains(w) for w in v.BOARD_EU_HINTS])
    boards = probes.groupBy("ats", "slug").agg(
        F.max("http").alias("_http"), F.count("pos").alias("n_jobs"),
        F.coalesce(F.bool_or(seen & european), F.lit(False)).alias("has_eu"),
        F.coalesce(F.bool_or(seen & place.contains("remote")), F.lit(False)).alias("has_remote"))
    boards = boards.withColumn("status", F.when(F.col("_http") != 200, "dead").when(F.col("n_jobs") > 0, "active")
                               .otherwise("empty"))
    ranked = boards.withColumns({"_name": F.lower("slug"), "_idle": (F.col("status") != "active").cast("int")})
    day = [] if added is None else [F.lit(added).alias("added")]
    return first_occurrence(ranked, "_name", ["_idle", "ats", "slug"]).select(
        F.col("slug").alias("name"), "ats", "slug", "status", *day, "n_jobs", "has_eu", "has_remote")


def plausible_slug(slug: str | Column) -> Column:
    """Shape of a board slug: lower case, no long digit run, and mostly letters."""
    s = col(slug)
    letters = F.length(F.regexp_replace(s, "[^a-z]", ""))
    half = F.floor(F.length(s) * 0.5)
    return s.rlike("^[a-z][a-z0-9-]{2,30}$") & ~s.rlike(r"[0-9]{4,}") & (letters >= F.greatest(F.lit(3), half))


def fresh_candidates(candidates: DataFrame, known: DataFrame) -> DataFrame:
    """Plausible (ats, slug) pairs that the registry does not hold yet."""
    pairs = known.select("ats", "slug").distinct()
    return candidates.where(plausible_slug("slug")).join(pairs, ["ats", "slug"], "left_anti")


def registry_summary(registry: DataFrame) -> DataFrame:
    """(ats, boards, active, empty, dead, with_eu, with_remote, jobs) per board system, shares over active boards."""
    active = F.col("status") == "active"

    def share(flag: str) -> Column:
        hits = F.count_if(active & F.col(flag))
        return F.floor(100 * hits / F.greatest(F.count_if(active), F.lit(1))).cast("bigint")
    return registry.groupBy("ats").agg(
        F.count(F.lit(1)).alias("boards"), F.count_if(active).alias("active"),
        F.count_if(F.col("status") == "empty").alias("empty"), F.count_if(F.col("status") == "dead").alias("dead"),
        share("has_eu").alias("eu_pct"), share("has_remote").alias("remote_pct"),
        F.coalesce(F.sum(F.when(active, F.col("n_jobs"))), F.lit(0)).alias("jobs"))
