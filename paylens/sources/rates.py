"""Currency rates from landed provider files.

Layout: ``<path>/provider=primary|secondary/as_of=<day>/*.json``.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paylens import schemas


class RatesError(RuntimeError):
    """No provider has a usable table for the day or any day before it."""


def _provider(spark: SparkSession, path: str, name: str, schema: T.StructType, rank: int) -> DataFrame | None:
    dated = T.StructType([*schema.fields, T.StructField("as_of", T.DateType())])
    try:
        raw = spark.read.schema(dated).option("multiLine", True).json(f"{path}/provider={name}")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    if name == "primary":
        raw = raw.where(F.col("result") == "success")
    table = F.col("rates" if name == "primary" else "usd")
    return raw.select("as_of", F.lit(rank).alias("_rank"), F.explode(table).alias("currency", "per_usd"))


def read_rates(spark: SparkSession, path: str, dt: str) -> DataFrame:
    """(as_of, currency, per_usd): units per US dollar, codes in upper case, the dollar itself always 1.

    The first provider with a table for the day wins, then the second, then the newest earlier table.
    """
    found = [p for p in (_provider(spark, path, "primary", schemas.PRIMARY_RATES, 0),
                         _provider(spark, path, "secondary", schemas.SECONDARY_RATES, 1)) if p is not None]
    if not found:
        raise RatesError(f"no rate files below {path}")
    every = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    every = every.where((F.col("as_of") <= F.lit(dt).cast("date")) & F.col("per_usd").isNotNull())
    best = every.agg(F.min(F.struct(F.datediff(F.lit(dt).cast("date"), "as_of").alias("age"), "_rank"))).first()[0]
    if best is None:
        raise RatesError(f"no usable rates on or before {dt}")
    chosen = every.where((F.date_add("as_of", best.age) == F.lit(dt).cast("date")) & (F.col("_rank") == best._rank))
    code = F.upper("currency")
    table = chosen.where(code != "USD").groupBy("as_of", code.alias("currency")).agg(
        F.max("per_usd").alias("per_usd"))
    dollar = chosen.select("as_of").distinct().select(
        "as_of", F.lit("USD").alias("currency"), F.lit(1.0).alias("per_usd"))
    return table.unionByName(dollar)
