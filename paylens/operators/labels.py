"""Label tables: versions, sets, queue, labelling and tallies."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.functions import vocab as v
from paylens.functions.text import add_implied, clean_labels, literal_mentions
from paylens.operators.groups import first_occurrence, interleave
from paylens.operators.sizes import small_batches

Labeller = Callable[[list[dict]], dict]


def label_sets(labels: DataFrame, key: str = "job_uid", item: str = "skill", version: str = "prompt_version",
               rank: Column | None = None) -> DataFrame:
    """(key, items): the label set of each key's newest version; empty if it was processed without a label.

    Versions compare as text unless ``rank`` gives another order. One aggregate that combines before the shuffle; what
    it holds per key is bounded by the catalogue times the versions in use.
    """
    order = F.col(version) if rank is None else rank
    known = labels.where(F.col(version).isNotNull()).withColumn("_order", order)
    per_key = known.groupBy(key).agg(F.collect_set(F.struct("_order", F.col(item).alias("_item"))).alias("_seen"),
                                     F.max("_order").alias("_newest"))
    current = F.filter("_seen", lambda s: (s["_order"] == F.col("_newest")) & s["_item"].isNotNull())
    return per_key.select(key, F.array_sort(F.transform(current, lambda s: s["_item"])).alias("items"))


def latest_labels(labels: DataFrame, key: str = "job_uid", item: str = "skill", version: str = "prompt_version",
                  rank: Column | None = None) -> DataFrame:
    """Distinct (key, item) of each key's newest version; item is NULL for a processed key without labels."""
    return label_sets(labels, key, item, version, rank).select(key, F.explode_outer("items").alias(item))


def with_label_sets(df: DataFrame, sets: DataFrame, key: str = "job_uid", name: str = "skills") -> DataFrame:
    """Add the label set: NULL where the key was never processed, empty where it was without result."""
    return df.join(sets.select(key, F.col("items").alias(name)), key, "left")


def cache_state(labels: DataFrame, current: str, key: str = "job_uid", version: str = "prompt_version") -> DataFrame:
    """(key, version, state): keys labelled with the current version against stale ones."""
    newest = labels.groupBy(key).agg(F.max(version).alias(version))
    return newest.withColumn("state", F.when(F.col(version) == current, "current").otherwise("stale"))


def processed_keys(labels: DataFrame, key: str = "job_uid") -> DataFrame:
    return labels.select(key).distinct()


def worded(df: DataFrame, description: str = "description") -> DataFrame:
    """Postings with a text that is not blank; the others have nothing to label."""
    return df.where(F.col(description).rlike(r"(?U)\S"))


def pending(df: DataFrame, processed: DataFrame, key: str = "job_uid", order: str = "ingest_seq") -> DataFrame:
    """First posting of each key that is not processed yet."""
    return first_occurrence(df, key, order).join(processed.select(key).distinct(), key, "left_anti")


def label_queue(df: DataFrame, processed: DataFrame, stale: DataFrame | None = None, limit: int | None = None, *,
                key: str = "job_uid", source: str = "source", description: str = "description",
                has_pay: str = "has_salary", published: str = "published_at_raw",
                order: str = "ingest_seq") -> DataFrame:
    """Postings to label next, with their ``position``: all that wait, or the first ``limit``.

    Never labelled before stale, with pay before without, newest first, then round-robin over sources. Publish dates
    compare as the raw text; an unknown date comes first. Only keys and sort columns are shuffled; the texts of the
    chosen keys are fetched at the end.
    """
    texts = worded(df, description)
    waiting = pending(texts.select(key, source, has_pay, published, order), processed, key, order)
    if stale is None:
        waiting = waiting.withColumn("_stale", F.lit(False))
    else:
        flags = stale.select(key).distinct().withColumn("_stale", F.lit(True))
        waiting = waiting.join(flags, key, "left").withColumn("_stale", F.coalesce("_stale", F.lit(False)))
    date = F.concat(F.coalesce(F.col(published), F.lit("")), F.lit("\uffff"))  # "2026" is newer than "2026-01"
    waiting = waiting.select(key, source, order, "_stale", F.coalesce(has_pay, F.lit(False)).alias("_pay"),
                             date.alias("_date"))
    by = [F.asc("_stale"), F.desc("_pay"), F.desc("_date"), F.asc(order), F.asc(key)]
    chosen = interleave(waiting, source, key, by, limit).select(key, order, "position")
    return first_occurrence(texts.join(chosen, [key, order]), key, order)


def batches(queue: DataFrame, size: int = 10, position: str = "position") -> DataFrame:
    """Add the batch number and the 0-based id inside the batch."""
    at = F.col(position) - 1
    return queue.withColumns({"batch": F.floor(at / size), "batch_id": (at % size).cast("int")})


def apply_labeller(df: DataFrame, call: Labeller, key: str = "job_uid", title: str = "title",
                   text: str = "description", size: int = 10, title_chars: int | None = None,
                   text_chars: int | None = None, max_failures: int = 5) -> DataFrame:
    """(key, labels, status) from a user's ``call([{id, title, text}]) -> {"items": [{id, skills}]}``, ``size`` rows a
    call.

    ``status`` is labelled, omitted (the reply leaves the id out) or failed (the call raised); only labelled rows have
    labels, so the others stay queued. After ``max_failures`` failed calls in a row a task gives up and the job fails with
    the last error. Texts go in whole unless a limit in characters is given. Rows reach Python in small batches; what is
    left of one is carried into the next, so only a task's last call may have fewer rows.
    """
    def parts(frames: Iterator[pd.DataFrame]) -> Iterator[list[pd.DataFrame]]:
        """The frames' rows in parts of ``size``, those of one frame together."""
        rest = None
        for frame in frames:
            rows = frame if rest is None else pd.concat([rest, frame])
            whole = len(rows) - len(rows) % size
            rest = rows.iloc[whole:].copy()
            yield [rows.iloc[k:k + size] for k in range(0, whole, size)]
        if rest is not None and len(rest):
            yield [rest]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        failures = 0
        for group in parts(frames):
            for part in group:
                payload = [{"id": i, "title": t, "text": x}
                           for i, (t, x) in enumerate(zip(part["_title"], part["_text"]))]
                try:
                    reply = {r["id"]: list(r.get("skills", [])) for r in call(payload).get("items", [])}
                    missing, failures = "omitted", 0
                except Exception:  # the labeller is foreign code: a failed call leaves its rows queued
                    reply, missing, failures = {}, "failed", failures + 1
                    if failures >= max_failures:
                        raise
                yield pd.DataFrame({key: part[key].to_numpy(),
                                    "labels": pd.Series([reply.get(i) for i in range(len(part))], dtype=object),
                                    "status": ["labelled" if i in reply else missing for i in range(len(part))]})

    def cut(name: str, chars: int | None) -> Column:
        whole = F.coalesce(F.col(name), F.lit(""))
        return whole if chars is None else F.substring(whole, 1, chars)

    sent = df.select(key, cut(title, title_chars).alias("_title"), cut(text, text_chars).alias("_text"))
    kind = df.schema[key].dataType.simpleString()
    labelled = small_batches(sent).mapInPandas(run, f"{key} {kind}, labels array<string>, status string")
    return labelled.withColumn("labels", clean_labels("labels"))


def literal_labeller(df: DataFrame, key: str = "job_uid", title: str = "title", text: str = "description",
                     catalog: dict[str, list[str]] = v.SKILLS,
                     implied: dict[str, list[str]] = v.IMPLIED_SKILLS) -> DataFrame:
    """(key, labels, status): catalogue names that occur literally, plus what they imply. It matches words, not meaning, so
    ordinary words that are also names ("go", "express", "helm") are over-labelled."""
    hay = F.concat_ws("\n", F.col(title), F.col(text))
    return df.select(key, add_implied(literal_mentions(hay, catalog), implied).alias("labels"),
                     F.lit("labelled").alias("status"))


def label_rows(labelled: DataFrame, version: str, at: Column, source: str = "literal",
               key: str = "job_uid") -> DataFrame:
    """Rows of the label table: one per label, one with NULL for an empty answer, none for a missing one."""
    return labelled.where(F.col("labels").isNotNull()).select(
        key, F.explode_outer("labels").alias("skill"), F.lit(source).alias("source"),
        F.lit(version).alias("prompt_version"), at.alias("extracted_at"))


def label_tally(labels: DataFrame, key: str = "job_uid", item: str = "skill") -> DataFrame:
    """One row: label rows, labelled keys, keys with at least one label and their share."""
    per_key = labels.groupBy(key).agg(F.count(item).alias("_n"))
    return per_key.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("label_rows"), F.count(F.lit(1)).alias("labelled_keys"),
        F.count_if(F.col("_n") > 0).alias("keys_with_label")).withColumn(
        "share_with_label", F.round(F.try_divide(F.col("keys_with_label"), F.col("labelled_keys")), 3))


def top_labels(labels: DataFrame, k: int = 10, item: str = "skill") -> DataFrame:
    counted = labels.where(F.col(item).isNotNull()).groupBy(item).agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), item).limit(k)
