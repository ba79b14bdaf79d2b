"""Gold label sets: JSON lines of (id, title, text, expected)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens import schemas


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.GOLD).json(path).where(F.col("id").isNotNull())
