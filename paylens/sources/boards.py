"""Landed job-board dumps to the common posting record.

Layout: ``<landing>/source=<board system>/company=<slug>/*.json``. A file holds one document, or, with ``lines``, one
compact document per line, which keeps large landings from drowning in small files.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens import schemas
from paylens.functions import dates
from paylens.functions.expr import blank
from paylens.functions.text import strip_html

SOURCES = {"greenhouse": schemas.GREENHOUSE, "lever": T.ArrayType(schemas.LEVER), "ashby": schemas.ASHBY}


def _dumps(spark: SparkSession, landing: str, source: str, streaming: bool = False, lines: bool = False) -> DataFrame:
    """(company, origin, jobs) per landed document. A malformed document gives no jobs; ``bad_documents`` counts them."""
    reader = (spark.readStream if streaming else spark.read).schema("value string, company string")
    try:
        texts = reader.option("wholetext", not lines).text(f"{landing}/source={source}")
    except AnalysisException as e:
        if streaming or e.getCondition() != "PATH_NOT_FOUND":
            raise
        texts = spark.createDataFrame([], "value string, company string")
    array = F.col("value").rlike(r"^\s*\[")  # a single object, such as an error reply, would pass for a list of one
    jobs = F.from_json(F.when(array, F.col("value")) if source == "lever" else F.col("value"), SOURCES[source])
    return texts.select("company", _origin(texts, streaming).alias("origin"), "value",
                        (jobs if source == "lever" else jobs["jobs"]).alias("jobs"))


def _origin(texts: DataFrame, streaming: bool) -> Column:
    """File, block and running number inside the block, which orders the documents of a landing. A stream has no
    running number, so there the lines of one file count as one document."""
    if not streaming and not texts.inputFiles():
        return F.struct(F.lit("").alias("file"), F.lit(0).alias("block"), F.lit(0).alias("line"))
    line = F.lit(0) if streaming else F.monotonically_increasing_id()
    return F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    line.alias("line"))


def _jobs(dumps: DataFrame) -> DataFrame:
    """One row per posting of the documents, with its place as ``seq``."""
    jobs = dumps.select("company", "origin", F.posexplode("jobs").alias("place", "j"))
    return jobs.select("company", "j", F.struct("origin.*", F.col("place").cast("long").alias("place")).alias("seq"))


def bad_documents(spark: SparkSession, landing: str, lines: bool = False) -> DataFrame:
    """(source, company, documents): landed documents that hold no list of postings, by board."""
    found = [_dumps(spark, landing, s, lines=lines).where("jobs IS NULL").select(F.lit(s).alias("source"), "company")
             for s in SOURCES]
    return reduce(DataFrame.unionByName, found).groupBy("source", "company").agg(F.count(F.lit(1)).alias("documents"))


def _postings(df: DataFrame, source: str, **columns: Column) -> DataFrame:
    """Common record from named columns; what a source does not state is NULL."""
    columns["source"] = F.lit(source)
    columns["published_at"] = dates.published_at(columns["published_at_raw"])
    columns["title"] = blank(columns["title"])
    columns["location_raw"] = blank(columns["location_raw"])
    columns["description"] = blank(columns["description"])
    return df.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schemas.POSTING])


def greenhouse_postings(dumps: DataFrame, unescape_passes: int = 1) -> DataFrame:
    jobs = _jobs(dumps)
    place = blank(F.col("j.location.name"))
    return _postings(
        jobs, "greenhouse", company=F.col("company"), job_id=F.col("j.id"), title=F.col("j.title"), location_raw=place,
        is_remote=F.lower(place).contains("remote"),
        published_at_raw=F.coalesce(F.nullif(F.col("j.first_published"), F.lit("")), F.col("j.updated_at")),
        apply_url=F.col("j.absolute_url"), department=F.get("j.departments", F.lit(0))["name"],
        description=strip_html("j.content", unescape_passes), ingest_seq=F.col("seq"))


def lever_postings(dumps: DataFrame) -> DataFrame:
    jobs = _jobs(dumps)
    return _postings(
        jobs, "lever", company=F.col("company"), job_id=F.col("j.id"), title=F.col("j.text"),
        location_raw=F.col("j.categories.location"), is_remote=F.lower(blank(F.col("j.workplaceType"))) == "remote",
        employment_type=F.col("j.categories.commitment"), published_at_raw=dates.epoch_to_iso("j.createdAt"),
        apply_url=F.col("j.hostedUrl"), department=F.col("j.categories.team"),
        description=F.col("j.descriptionPlain"), range_pay=F.col("j.salaryRange"), ingest_seq=F.col("seq"))


def ashby_postings(dumps: DataFrame) -> DataFrame:
    jobs = _jobs(dumps)
    return _postings(
        jobs, "ashby", company=F.col("company"), job_id=F.col("j.id"), title=F.col("j.title"),
        location_raw=F.col("j.location"), is_remote=F.coalesce(F.col("j.isRemote"), F.lit(False)),
        employment_type=F.col("j.employmentType"), published_at_raw=F.col("j.publishedAt"),
        apply_url=F.col("j.jobUrl"), department=F.col("j.department"), description=F.col("j.descriptionPlain"),
        tier_pay=F.col("j.compensation"), ingest_seq=F.col("seq"))


PARSERS = {"greenhouse": greenhouse_postings, "lever": lever_postings, "ashby": ashby_postings}


def read_greenhouse(spark: SparkSession, landing: str, unescape_passes: int = 1) -> DataFrame:
    return greenhouse_postings(_dumps(spark, landing, "greenhouse"), unescape_passes)


def read_lever(spark: SparkSession, landing: str) -> DataFrame:
    return lever_postings(_dumps(spark, landing, "lever"))


def read_ashby(spark: SparkSession, landing: str) -> DataFrame:
    return ashby_postings(_dumps(spark, landing, "ashby"))


def read_postings(spark: SparkSession, landing: str, registry: DataFrame | None = None,
                  lines: bool = False) -> DataFrame:
    """All sources in one record; with a registry only its boards. A missing or empty dump gives no rows."""
    every = reduce(DataFrame.unionByName, [PARSERS[s](_dumps(spark, landing, s, lines=lines)) for s in SOURCES])
    if registry is None:
        return every
    boards = registry.select("source", F.col("slug").alias("company")).distinct()
    return every.join(boards, ["source", "company"], "left_semi")


def board_places(spark: SparkSession, landing: str, lines: bool = False) -> DataFrame:
    """Probe results (ats, slug, http, pos, location) of landed boards, one row per posting, one with neither place nor
    location for a board without postings. Lever's place ends with the workplace type, Ashby's with "remote" by its flag."""
    where = {"greenhouse": F.col("j.location.name"),
             "lever": F.concat_ws(" ", blank(F.col("j.categories.location")), blank(F.col("j.workplaceType"))),
             "ashby": F.concat(blank(F.col("j.location")), F.when(F.col("j.isRemote"), " remote").otherwise(""))}
    found = []
    for source, location in where.items():
        jobs = _dumps(spark, landing, source, lines=lines).select("company", F.posexplode_outer("jobs").alias("pos", "j"))
        found.append(jobs.select(F.lit(source).alias("ats"), F.col("company").alias("slug"), F.lit(200).alias("http"), "pos",
                                 F.when(F.col("pos").isNotNull(), location).alias("location")))
    return reduce(DataFrame.unionByName, found)


def stream_postings(spark: SparkSession, landing: str, lines: bool = False) -> DataFrame:
    """The same record as an unbounded table over newly landed files of the sources that have a directory."""
    found = []
    for source, parse in PARSERS.items():
        try:
            found.append(parse(_dumps(spark, landing, source, streaming=True, lines=lines)))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return reduce(DataFrame.unionByName, found)
