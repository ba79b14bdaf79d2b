"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are the context, and only the reply is
trainable. Since each context is a prefix of the conversation, the formatted turns are kept once, as pieces with their
place in the conversation, and an example names its prefix and its target by places. So the output grows with the input,
not with the square of a conversation's length; ``example_texts`` writes examples out where that is wanted.

A turn is formatted as ``### Role:\\n`` text ``</turn>\\n``. Inside roles and texts a backslash, a ``#`` after a ``#`` and the
slash of ``</`` get a backslash in front, and in roles the line break after a colon, so no text can hold a header or an end
mark, and dropping those backslashes gives the text back. Places are sums over slices of turns first, then inside a slice, so a long conversation is no single task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paylens.llm.common import pick

TARGET = "assistant"
OPEN, MIDDLE, CLOSE = "### ", ":\n", "</turn>\n"
SLICE = 256


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\|(?<=#)#|(?<=<)/", r"\\$0")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"\\|(?<=#)#|(?<=<)/|(?<=:)\n", r"\\$0")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def pieces(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
           ) -> DataFrame:
    """One row per turn: conv_id, place, turn, role, piece (the formatted turn), start and end of the piece in the
    conversation, and target_start, target_end of the trainable text (null unless the assistant speaks), in characters.

    Null roles and texts count as empty. Turns go by number, null first; equal numbers by role, then text, and repeated
    rows are repeated turns. A null conv_id is a conversation of its own. Empty tables give empty results; other columns
    are ignored; texts are formatted whole.
    """
    rows = pick(turns, conv_id=conv_id, turn=turn, role=role, text=text).select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("slice", F.floor(F.col("turn") / SLICE))
    head, body = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit(MIDDLE)), escape(F.col("text"))
    rows = rows.withColumns({"piece": F.concat(head, body, F.lit(CLOSE)), "head": F.length(head).cast("long"),
                             "size": (F.length(head) + F.length(body) + len(CLOSE)).cast("long")})
    slices = rows.groupBy("conv_id", "slice").agg(F.sum("size").alias("s"), F.count("*").alias("c"))
    before = W.partitionBy("conv_id").orderBy(F.col("slice").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1)
    slices = slices.select(F.col("conv_id").alias("_conv"), F.col("slice").alias("_slice"),
                           F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_start"),
                           F.coalesce(F.sum("c").over(before), F.lit(0)).alias("_place"))
    inside = W.partitionBy("conv_id", "slice").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = rows.withColumns({"_at": F.coalesce(F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)),
                             "_no": F.row_number().over(inside) - 1}).drop("text")
    rows = rows.join(slices, F.col("conv_id").eqNullSafe(F.col("_conv")) & F.col("slice").eqNullSafe(F.col("_slice")))
    start = F.col("_start") + F.col("_at")
    spoken = F.col("role") == TARGET
    return rows.select(
        "conv_id", (F.col("_place") + F.col("_no")).alias("place"), "turn", "role", "piece", start.alias("start"),
        (start + F.col("size")).alias("end"), F.when(spoken, start + F.col("head")).alias("target_start"),
        F.when(spoken, start + F.col("size") - len(CLOSE)).alias("target_end"))


def examples(formatted: DataFrame) -> DataFrame:
    """One row per assistant turn: conv_id, place of the reply, its context [0, context_end) and the trainable characters
    [target_start, target_end) of the formatted conversation; the example ends with ``end``."""
    return formatted.filter(F.col("target_start").isNotNull()).select(
        "conv_id", "place", F.col("start").alias("context_end"), "target_start", "target_end", "end")


def example_texts(formatted: DataFrame, chosen: DataFrame) -> DataFrame:
    """Chosen examples written out: conv_id, place, text, target_start, target_end. The texts together are as long as
    the contexts, so choose few examples of very long conversations."""
    wanted = chosen.select(F.col("conv_id").alias("_conv"), F.col("place").alias("_upto"))
    found = formatted.join(wanted, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("place") <= F.col("_upto")))
    last = F.col("place") == F.col("_upto")
    return found.groupBy(F.col("_conv").alias("conv_id"), F.col("_upto").alias("place")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "piece"))), lambda p: p.piece), "").alias("text"),
        F.max(F.when(last, F.col("target_start"))).alias("target_start"),
        F.max(F.when(last, F.col("target_end"))).alias("target_end"))


def read_back(formatted: DataFrame, made: DataFrame) -> DataFrame:
    """(conv_id, place, role, text, size, context_end, end, loss): role and text of every turn parsed from its piece by the
    template, and, where an example of ``made`` ends with the turn, its context, its end and the text that its target
    marks as trainable."""
    form = r"(?s)^### (.*?):\n(.*)</turn>\n$"
    wanted = made.select(F.col("conv_id").alias("_conv"), F.col("place").alias("_place"), "context_end",
                         F.col("target_start").alias("_from"), F.col("target_end").alias("_to"), F.col("end").alias("_end"))
    both = formatted.join(wanted, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("place") == F.col("_place")), "left")
    part = F.substr("piece", (F.col("_from") - F.col("context_end") + 1).cast("int"), (F.col("_to") - F.col("_from")).cast("int"))
    return both.select("conv_id", "place", unescape(F.regexp_extract("piece", form, 1)).alias("role"),
                       unescape(F.regexp_extract("piece", form, 2)).alias("text"), F.length("piece").cast("long").alias("size"),
                       "context_end", F.col("_end").alias("end"), unescape(part).alias("loss"))


def _digest_stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Digests of conversations whose rows come in order, one after the other; holds one batch and one running digest. An
    example counts only if its context is all that was said before and it ends with its turn."""
    names = ["conv", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_examples",
             "example_chars"]
    now, n, turns, loss, chars, size, count, total = None, 0, None, None, 0, 0, 0, 0
    done: list[tuple] = []

    def close() -> None:
        if n:
            done.append((now, n, turns.hexdigest(), chars, loss.hexdigest(), size, count, total))

    for batch in batches:
        rows = zip(batch.conv, batch.role, batch.text, batch["size"], batch.context_end, batch.end, batch.loss, strict=True)
        for conv, role, text, length, context, end, part in rows:
            if n == 0 or conv != now:
                close()
                now, n, turns, loss, chars, size, count, total = conv, 0, hashlib.sha256(), hashlib.sha256(), 0, 0, 0, 0
            turns.update(f"{role}\n{text}\n".encode())
            if part is not None and context == size and end == size + length:
                chars, count, total = chars + len(part), count + 1, total + int(end)
                loss.update(part.encode())
            n, size = n + 1, size + int(length)
        yield pd.DataFrame(done, columns=names)
        done.clear()
    close()
    yield pd.DataFrame(done, columns=names)


def digests(formatted: DataFrame, made: DataFrame | None = None) -> DataFrame:
    """Per conversation, read back from the formatted pieces and the examples ``made`` of them (all, if not given):
    n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_examples and example_chars (the length of all
    examples if written out).

    SHA-256 of a whole conversation is one sequential pass, so its rows stream in order through one task, which holds
    one batch at a time; nothing is gathered."""
    kind = formatted.schema["conv_id"].dataType
    rows = read_back(formatted, examples(formatted) if made is None else made).withColumn("conv", F.when(
        F.col("conv_id").isNull(), "").otherwise(F.concat(F.lit("="), F.col("conv_id").cast("string"))))
    ordered = rows.drop("conv_id").repartition("conv").sortWithinPartitions("conv", "place").drop("place")
    found = ordered.mapInPandas(_digest_stream, "conv string, n_turns long, turns_sha256 string, loss_chars long, "
                                "loss_sha256 string, formatted_chars long, n_examples long, example_chars long")
    conv = F.when(F.col("conv") != "", F.substr("conv", F.lit(2))).cast(kind)
    return found.select(conv.alias("conv_id"), *found.columns[1:])
