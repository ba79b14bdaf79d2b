"""Exact duplicates by a tree merge of sorted digest runs.

Texts are digested once, into thin entries: digest, length, a second hash, the id and the number of rows. The entries of
one input partition form a run, sorted and merged first. There are ``fan_in ** rounds`` runs, and in each round the runs that differ in one digit of
their number exchange entries, as in a butterfly: an entry moves to the run whose digit is that of its digest. A run
sorts what it got from its ``fan_in`` partners by digest and id and merges neighbours of one text, keeping the best id. After
the last round each text has one entry, in the run that its digest names. A text that a third of all rows share shrinks in
every round inside every run, so no run ever takes more than its share of it.

Entries merge only if SHA-256, byte length and a second, independent 64-bit hash all agree, at every level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paylens.llm.common import lower_ascii, pick
from paylens.operators.sizes import materialise

KEY = ("sha", "bytes", "second")
SALTS = 64


def rounds_for(partitions: int, fan_in: int) -> tuple[int, int]:
    """(rounds, fan-in): as few rounds as ``fan_in`` allows to have a run for every shuffle partition, and of these the
    least fan-in, so that there are not many more runs than partitions."""
    rounds = 1
    while fan_in**rounds < partitions:
        rounds += 1
    return rounds, next(k for k in range(2, fan_in + 1) if k**rounds >= min(partitions, fan_in**rounds))


def _digit(number: Column, place: int, fan_in: int) -> Column:
    return F.pmod(F.floor(number / fan_in**place), F.lit(fan_in)).cast("int")


def digests(rows: DataFrame, text: str) -> DataFrame:
    """Add the digest columns; a null text counts as empty."""
    plain = lower_ascii(F.coalesce(F.col(f"`{text}`"), F.lit("")))
    return rows.withColumn("_plain", plain).withColumns({
        "sha": F.unhex(F.sha2(F.col("_plain").cast("binary"), 256)), "bytes": F.octet_length("_plain"),
        "second": F.xxhash64("_plain")}).drop("_plain")


def thin_entries(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, digest columns, tag, salt): one row per row, written once. The tag names the row, whatever its id; its upper
    bits are the input partition."""
    tagged = digests(pick(docs, doc_id=doc_id, text=text), "text").drop("text").withColumn("tag", F.monotonically_increasing_id())
    return materialise(tagged.withColumn("salt", F.pmod(F.xxhash64("tag"), F.lit(SALTS)).cast("int")))


def merge_runs(entries: DataFrame, fan_in: int, rounds: int, last: list[Column]) -> DataFrame:
    """Entries (run, digest columns, best, tag, n) merged to one per text. ``last`` orders entries of one text, the one that
    stays at the end."""
    runs = fan_in**rounds
    home = F.pmod(F.xxhash64("sha"), F.lit(runs)).cast("int")
    text = W.partitionBy("run", *KEY).orderBy(*last)

    def merged(got: DataFrame) -> DataFrame:
        """Every run sorted, and the entries of one text merged into the last of them."""
        sums = {"n": F.sum("n").over(text.rowsBetween(W.unboundedPreceding, 0)), "next": F.lead("tag").over(text)}
        return got.repartitionById(runs, "run").withColumns(sums).filter("next IS NULL").drop("next")

    entries = merged(entries)
    for place in range(rounds):
        shift = (_digit(home, place, fan_in) - _digit(F.col("run"), place, fan_in)) * F.lit(fan_in**place)
        entries = merged(entries.withColumn("run", (F.col("run") + shift).cast("int")))
    return entries


def duplicate_groups(thin: DataFrame, keep: str = "largest", fan_in: int = 8) -> DataFrame:
    """(digest columns, best, tag, n) of every text of more than one row: id and tag of the row that stays, and the size
    of the group."""
    rounds, fan_in = rounds_for(int(thin.sparkSession.conf.get("spark.sql.shuffle.partitions")), fan_in)
    run = F.pmod(F.shiftright("tag", 33), F.lit(fan_in**rounds)).cast("int")
    entries = thin.select(*KEY, F.col("doc_id").alias("best"), "tag", run.alias("run"), F.lit(1).cast("long").alias("n"))
    order = {"largest": F.asc_nulls_first, "smallest": F.desc_nulls_first}[keep]("best")
    return materialise(merge_runs(entries, fan_in, rounds, [order, F.asc("tag")]).filter("n > 1").drop("run"))


def _salted(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """The groups once per salt that some row of theirs has, so that a join on (salt, digest) has no hot key."""
    return rows.select("salt", *KEY).distinct().join(groups, list(KEY))


def mark_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "largest",
                    fan_in: int = 8) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; a null text equals the empty one, and very long texts are
    digested whole. Of equal texts the row with the largest (or smallest) id stays; null ids lose against any id. If the
    winning id has several rows, one of them is kept; if all ids of a group are null, keep_id is null and one row is
    kept. An empty table gives an empty result, other columns are ignored.
    """
    thin = thin_entries(docs, doc_id, text)
    groups = duplicate_groups(thin, keep, fan_in).withColumnRenamed("tag", "winner")
    joined = thin.join(_salted(thin, groups), ["salt", *KEY], "left")
    single = F.col("n").isNull()
    return joined.select(
        "doc_id", F.when(single, F.col("doc_id")).otherwise(F.col("best")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"), (single | (F.col("tag") == F.col("winner"))).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def drop_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: str = "largest",
                    fan_in: int = 8) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; the same rules as ``mark_duplicates``. Here whole rows are
    digested again, as thin entries alone are written."""
    thin = thin_entries(docs, doc_id, text)
    groups = duplicate_groups(thin, keep, fan_in).drop("tag")
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         F.col(f"`{doc_id}`").alias("_id"), F.col(f"`{text}`").alias("_text"))
    rows = digests(packed, "_text").drop("_text").withColumn("salt", F.pmod(F.xxhash64("_id"), F.lit(SALTS)).cast("int"))
    by_id = thin.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    joined = rows.join(_salted(by_id, groups), ["salt", *KEY], "left").filter(F.col("n").isNull() | F.col("_id").eqNullSafe(F.col("best")))
    place = F.row_number().over(W.partitionBy("salt", *KEY, "_id").orderBy(F.lit(1)))  # rows of one id and one text
    return joined.withColumn("_place", place).filter("n IS NULL OR _place = 1").select("_row.*")


def mark_sql() -> str:
    """DuckDB SQL for ``mark_duplicates`` over ``documents``."""
    return """WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz')) AS sha FROM documents),
g AS (SELECT doc_id, sha, max(doc_id) OVER (PARTITION BY sha) AS keep_id, count(*) OVER (PARTITION BY sha) AS n,
    row_number() OVER (PARTITION BY sha ORDER BY doc_id DESC NULLS LAST) AS place FROM d)
SELECT doc_id, keep_id, n AS group_size, place = 1 AS kept, sha AS text_sha256 FROM g"""
