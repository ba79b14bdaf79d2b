"""Literal mentions of a catalogue of any size, by a hash join on tokens.

Names and texts are cut into the same tokens: runs of word characters, and every other character on its own. A name occurs
literally, with a word boundary where it begins or ends with a letter or digit, exactly where its tokens stand in a row.
Names are indexed by their first token and their number of tokens. A token of a text that begins some name gives one n-gram
for each length that such names have, and n-grams meet whole names in a hash join. So the cost grows with the texts and
the hits, not with the catalogue, and a name that many labels share is matched once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = r"(?U)\w+|\W"
CHUNK = 4096  # tokens of a text that are cut into windows at once


def tokens(text: Column) -> Column:
    """Tokens in any case alike."""
    return F.regexp_extract_all(F.lower(F.upper(F.coalesce(text, F.lit("")))), F.lit(TOKEN), F.lit(0))


def name_index(names: DataFrame, label: str = "label", name: str = "name") -> DataFrame:
    """(first, size, tokens, label). White space around a name does not count; empty names are left out.

    A name that begins or ends with an underscore would stand inside a run of word characters, so it is refused.
    """
    trimmed = F.regexp_replace(F.col(name), r"(?U)^\s+|\s+$", "")
    bad = F.raise_error(F.concat(F.lit("a name may not begin or end with an underscore: "), trimmed)).cast("boolean")
    cut = names.select(F.col(label).alias("label"), F.when(trimmed.rlike("^_|_$"), bad).otherwise(F.lit(True)).alias("ok"),
                       tokens(trimmed).alias("tokens"))
    return cut.where(F.col("ok") & (F.size("tokens") > 0)).select(
        F.get("tokens", F.lit(0)).alias("first"), F.size("tokens").alias("size"), "tokens", "label").distinct()


def token_windows(texts: DataFrame, key: str, text: str, width: int) -> DataFrame:
    """(key, first, window): every token that is not white space with the ``width`` - 1 that follow. Long texts are cut into
    overlapping chunks first, so no row holds more than a chunk's windows."""
    cut = texts.select(F.col(key).alias("key"), tokens(F.col(text)).alias("t")).where(F.size("t") > 0)
    chunks = cut.select("key", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("t"), F.lit(CHUNK)), lambda at: F.slice("t", at, F.lit(CHUNK + width - 1)))).alias("t"))
    starts = F.filter(F.sequence(F.lit(1), F.least(F.size("t"), F.lit(CHUNK))),
                      lambda at: ~F.element_at("t", at).rlike(r"(?U)^\s"))
    windows = chunks.select("key", F.explode(F.transform(starts, lambda at: F.slice("t", at, F.lit(width)))).alias("window"))
    return windows.select("key", F.get("window", F.lit(0)).alias("first"), "window")


def mention_join(texts: DataFrame, names: DataFrame, key: str = "job_uid", text: str = "description",
                 label: str = "label", name: str = "name") -> DataFrame:
    """Distinct (key, label) of all names that occur literally in the whole texts; ``names`` has one row per name."""
    index = name_index(names, label, name).withColumn("gram", F.array_join("tokens", ""))
    width = index.agg(F.max("size")).first()[0] or 1
    kind = texts.schema[key].dataType
    sizes = index.groupBy("first").agg(F.collect_set("size").alias("sizes"))
    begun = token_windows(texts, key, text, width).join(sizes, "first").select("key", "window", F.explode("sizes").alias("size"))
    grams = begun.where(F.size("window") >= F.col("size")).select(
        "key", F.array_join(F.slice("window", F.lit(1), F.col("size")), "").alias("gram"))
    hits = grams.join(index.select("gram").distinct(), "gram").distinct()
    found = hits.join(index.select("gram", "label").distinct(), "gram")
    return found.select(F.col("key").cast(kind).alias(key), F.col("label").alias(label)).distinct()


def grounded_labels(predicted: DataFrame, texts: DataFrame, names: DataFrame, key: str = "job_uid",
                    text: str = "description", label: str = "label", name: str = "name") -> DataFrame:
    """Predicted (key, label) with ``grounded``: does a name of the label occur in the text?"""
    found = mention_join(texts, names, key, text, label, name).withColumn("_found", F.lit(True))
    return predicted.join(found, [key, label], "left").withColumn("grounded", F.coalesce("_found", F.lit(False))).drop("_found")
