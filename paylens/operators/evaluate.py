"""Quality of predicted label sets: micro-F1 and a document bootstrap."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions import draws
from paylens.functions.expr import let

ACCEPTABLE_F1 = 0.75


def label_counts(pred: DataFrame, gold: DataFrame, key: str = "id", labels: str = "labels",
                 expected: str = "expected") -> DataFrame:
    """(key, tp, fp, fn) of every gold document; a document without a prediction counts as an empty one."""
    empty = F.array().cast("array<string>")
    both = gold.select(key, F.coalesce(expected, empty).alias("_want")).join(
        pred.select(key, F.col(labels).alias("_got")), key, "left").withColumn("_got", F.coalesce("_got", empty))
    return both.select(key, F.size(F.array_intersect("_got", "_want")).alias("tp"),
                       F.size(F.array_except("_got", "_want")).alias("fp"),
                       F.size(F.array_except("_want", "_got")).alias("fn"))


def f1(tp: Column, fp: Column, fn: Column) -> Column:
    return F.coalesce(F.try_divide(2.0 * tp, 2 * tp + fp + fn), F.lit(0.0))


def micro_f1(per_doc: DataFrame) -> DataFrame:
    sums = per_doc.agg(F.count(F.lit(1)).alias("docs"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c)
                                                         for c in ("tp", "fp", "fn")])
    return sums.withColumn("f1", f1(F.col("tp"), F.col("fp"), F.col("fn")))


def _resampled(name: Column, kinds: Column) -> Column:
    """Summed (tp, fp, fn) of as many draws with replacement as there are documents. The draws that fall on a kind, of
    those that fell on none before it, are binomial."""
    def add(s: Column, k: Column) -> Column:
        found = draws.binomial(draws.named(name, k["tp"], k["fp"], k["fn"]), s["left"], k["n"] / s["weight"])
        return let(found, lambda x: F.struct(
            (s["left"] - x).alias("left"), (s["weight"] - k["n"]).alias("weight"),
            *[(s[c] + x * k[c]).alias(c) for c in ("tp", "fp", "fn")]))

    zero = F.lit(0).cast("bigint")
    docs = F.aggregate(kinds, zero, lambda a, k: a + k["n"])
    return F.aggregate(kinds, F.struct(docs.alias("left"), docs.alias("weight"), zero.alias("tp"), zero.alias("fp"),
                                       zero.alias("fn")), add)


def f1_ci(per_doc: DataFrame, replicates: int = 1000, seed: int = 11) -> DataFrame:
    """One row (ci_lo, ci_hi): percentile interval (floor index) of micro-F1 over resampled documents.

    Documents with equal (tp, fp, fn) are interchangeable, so they are counted first. Resampling the documents is a
    multinomial draw over those kinds: the cost grows with the logarithm of the number of documents, and the kinds are
    bounded by the sizes of two label sets.
    """
    kinds = per_doc.groupBy("tp", "fp", "fn").agg(F.count(F.lit(1)).alias("n"))
    packed = kinds.agg(F.array_sort(F.collect_list(F.struct("tp", "fp", "fn", "n"))).alias("kinds"))
    reps = packed.where(F.size("kinds") > 0).select("kinds", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))).alias("rep"))
    tasks = per_doc.sparkSession.sparkContext.defaultParallelism
    sums = reps.repartition(tasks, "rep").select(_resampled(draws.named(seed, F.col("rep")), F.col("kinds")).alias("d"))
    drawn = sums.select(f1(F.col("d.tp"), F.col("d.fp"), F.col("d.fn")).alias("_f1"))
    scores = drawn.agg(F.array_sort(F.collect_list("_f1")).alias("_all"))  # one number per replicate

    def at(q: float) -> Column:
        return F.get("_all", F.floor(F.lit(q) * (F.size("_all") - 1)).cast("int"))
    return scores.select(at(0.025).alias("ci_lo"), at(0.975).alias("ci_hi"))


def evaluate_labels(pred: DataFrame, gold: DataFrame, replicates: int = 1000, seed: int = 11,
                    key: str = "id") -> DataFrame:
    """One row: document and label counts, micro-F1, its interval, and whether it clears the gate."""
    per_doc = label_counts(pred, gold, key)
    interval = f1_ci(per_doc, replicates, seed).select(F.struct("ci_lo", "ci_hi")).scalar()
    scored = micro_f1(per_doc)
    return scored.withColumn("_ci", interval).select(
        *scored.columns, "_ci.*", (F.col("f1") >= ACCEPTABLE_F1).alias("accepted"))
