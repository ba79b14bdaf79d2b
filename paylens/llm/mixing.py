"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks.

Every source is shuffled by a seeded hash and cut into blocks with the same number of words. Slot i of the schedule has
the golden-ratio point frac(i * phi); mapped through the cumulative weights it names a source, and the rank of the slot
among those of its source names the block: the source's blocks in order, and from the start again once all are used. Any
stretch of the schedule thus holds every source in its target share, within a few blocks.

Positions inside a source are sums over hash slices first and over the rows of one slice then, so a source with a third
of all rows is never one task. Slots are ranked the same way.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from paylens.llm.common import WORD, n_words, pick
from paylens.operators.sizes import materialise, stage

PHI = 0.6180339887498949
WEIGHTS = (5, 2, 1)
MAX_PASSES = 3
BLOCK_WORDS = 128
LEAST_BLOCKS = 64
CELLS = 1024
SLOT_SLICE = 1 << 16


@dataclass
class Mix:
    """``sources``: source_no, source, source_size, weight, target, length of a block, blocks, want (slots). ``rows``: the
    input's rows with source_no and start, the words of the source before them. ``pieces``: which words of a row lie in
    which block, and how often the mix takes it. ``schedule``: slot, source_no, pass, block, in the order of the mix."""

    sources: DataFrame
    rows: DataFrame
    pieces: DataFrame
    schedule: DataFrame


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, passes: int = MAX_PASSES,
            block_words: int = BLOCK_WORDS) -> DataFrame:
    """Targets in words for (source, source_size): all words are shared by weight, no source above ``passes`` times its
    size, what exceeds that is shared again by weight. In order of size per weight a source is full as long as its limit
    is at most its share of what the full ones leave, which running sums tell. One row per source, so one window."""
    order = W.orderBy(F.col("source").asc_nulls_last())
    cycle = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("source_no") - 1) % len(weights) + 1).cast("int"))
    s = sizes.withColumn("source_no", F.row_number().over(order)).withColumn("weight", cycle.cast("long"))
    s = s.withColumn("limit", F.col("source_size") * passes)
    by_ratio = W.orderBy(F.col("limit") / F.col("weight"), "source_no")
    before, every = by_ratio.rowsBetween(W.unboundedPreceding, -1), W.rowsBetween(
        W.unboundedPreceding, W.unboundedFollowing)
    s = s.withColumns({"used": F.coalesce(F.sum("limit").over(before), F.lit(0)), "total": F.sum("source_size").over(every),
                       "weight_left": F.sum("weight").over(every)
                       - F.coalesce(F.sum("weight").over(before), F.lit(0))})
    # full while limit / weight <= (total - used) / weight_left, in whole numbers
    left = F.col("total") - F.col("used")
    s = s.withColumn("full", F.col("limit").cast("decimal(38,0)") * F.col("weight_left")
                     <= left.cast("decimal(38,0)") * F.col("weight"))
    # the first source that is not full fixes the share per weight for itself and all that follow
    rate = F.min_by(F.struct(left.alias("l"), F.col("weight_left").alias("w")), F.struct("full", "place")).over(every)
    s = s.withColumn("place", F.row_number().over(by_ratio)).withColumn("rate", rate)
    target = F.when(F.col("full"), F.col("limit").cast("double")).otherwise(
        F.col("weight") * F.col("rate.l").cast("double") / F.col("rate.w"))
    length = F.greatest(F.least(F.lit(block_words), F.floor(F.col("source_size") / LEAST_BLOCKS)), F.lit(1)).cast("long")
    s = s.withColumn("target", target).withColumn("length", length)
    s = s.withColumn("blocks", F.ceil(F.col("source_size") / F.col("length")).cast("long"))
    return s.withColumn("want", F.when(F.col("source_size") > 0, F.col("target") * F.col("blocks") / F.col("source_size"))
                        .otherwise(F.lit(0.0))).select(
        "source_no", "source", "source_size", "weight", "target", "length", "blocks", "want")


def _prefix(rows: DataFrame, group: list[str], slice_by: str, order: list, amount: Column, name: str) -> DataFrame:
    """Sum of ``amount`` over the rows before, in each group, by slices: no task holds more than one slice of a group."""
    sums = rows.groupBy(*group, slice_by).agg(F.sum(amount).alias("_s"))
    at = W.partitionBy(*group).orderBy(slice_by).rowsBetween(W.unboundedPreceding, -1)
    starts = sums.withColumn("_start", F.coalesce(F.sum("_s").over(at), F.lit(0))).drop("_s")
    inside = W.partitionBy(*group, slice_by).orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    return (rows.withColumn("_in", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
            .join(starts, [*group, slice_by]).withColumn(name, F.col("_start") + F.col("_in")).drop("_in", "_start"))


def slots(sources: DataFrame) -> DataFrame:
    """(slot, source_no, rank): golden-ratio points mapped through the cumulative weights. Intervals meet points in cells
    of equal width, so a point is compared only with the sources of its cell, and cells hold equally many points."""
    spark = sources.sparkSession
    s = sources.filter("want > 0")
    total, count = s.agg(F.sum("want"), F.count("*")).first()
    if not count:
        return spark.createDataFrame([], "slot long, source_no int, rank long")
    cells, number = max(CELLS, 4 * count), int(round(total))
    upto = F.sum("want").over(W.orderBy("source_no"))
    spans = s.withColumn("hi", F.when(F.row_number().over(W.orderBy(F.desc("source_no"))) == 1, F.lit(1.0))
                         .otherwise(upto / total))
    spans = spans.withColumn("lo", F.coalesce(F.lag("hi").over(W.orderBy("source_no")), F.lit(0.0)))
    spans = spans.select("source_no", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))).alias("cell"))
    point = F.col("slot") * PHI - F.floor(F.col("slot") * PHI)
    named = (spark.range(number).withColumnRenamed("id", "slot").withColumn("u", point)
             .withColumn("cell", F.floor(F.col("u") * cells)).join(spans, "cell").filter("lo <= u AND u < hi")
             .select("slot", "source_no", F.floor(F.col("slot") / SLOT_SLICE).alias("slice")))
    return _prefix(named, ["source_no"], "slice", ["slot"], F.lit(1), "rank").select("slot", "source_no", "rank")


def _numbered(rows: DataFrame) -> DataFrame:
    """Add nth, which tells rows with the same id and text (``tie``) apart, and ``same``, the number of those. Texts take no
    part, so only thin rows move."""
    w = W.partitionBy("doc_id", "tie")
    return rows.withColumns({"nth": F.row_number().over(w.orderBy(F.col("source").asc_nulls_last())),
                             "same": F.count(F.lit(1)).over(w)})


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", seed: str = "mix",
        weights: tuple[int, ...] = WEIGHTS, passes: int = MAX_PASSES, block_words: int = BLOCK_WORDS) -> Mix:
    """Schedule all rows of ``docs``.

    Null texts have no words, a null source is a source of its own and comes last, a null id hashes as the empty text.
    Rows without words are in ``rows`` but in no piece. Equal rows are scheduled one after the other. Long texts span
    many blocks. Empty tables give empty frames. Other columns are ignored. The same input gives the same mix.
    """
    thin = pick(docs, doc_id=doc_id, text=text, source=source).select(
        "doc_id", "source", F.xxhash64("text").alias("tie"), n_words(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary")).alias("h"))
    thin = materialise(_numbered(thin))
    sources = materialise(targets(thin.groupBy("source").agg(F.sum("size").alias("source_size")), weights, passes,
                                  block_words))
    named = thin.join(sources.select("source_no", F.col("source").alias("_s")), F.col("source").eqNullSafe(F.col("_s"))
                      ).drop("_s").withColumn("slice", F.substring("h", 1, 3))
    rows = materialise(_prefix(named, ["source_no"], "slice", ["h", "doc_id", "tie", "nth"], F.col("size"), "start"))
    ranked = slots(sources).join(sources.select("source_no", "blocks"), "source_no")
    schedule = ranked.filter(F.col("rank") < F.col("blocks") * passes).select(
        "slot", "source_no", F.floor(F.col("rank") / F.col("blocks")).alias("pass"),
        (F.col("rank") % F.col("blocks")).alias("block"))
    taken = schedule.groupBy("source_no", "block").agg(F.count("*").alias("times"))
    return Mix(sources, rows, _pieces(rows, sources).join(taken, ["source_no", "block"], "left").withColumn(
        "times", F.coalesce("times", F.lit(0))), schedule)


def _pieces(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_no, start, block, first, last): words first..last-1 of the row that starts there lie in the block."""
    at = rows.filter("size > 0").join(sources.select("source_no", "length"), "source_no")
    at = at.select("source_no", "start", "size", "length", F.explode(F.sequence(
        F.expr("start div length"), F.expr("(start + size - 1) div length"))).alias("block"))
    return at.select("source_no", "start", "block",
                     F.greatest(F.col("block") * F.col("length") - F.col("start"), F.lit(0)).alias("first"),
                     F.least((F.col("block") + 1) * F.col("length") - F.col("start"), F.col("size")).alias("last"))


def taken_words(plan: Mix) -> DataFrame:
    """One row per row of the input: doc_id, tie and nth (which tell rows of one id apart), same, size, source_size, target, taken (repeats counted), and stretches, the
    runs of equally often taken blocks in it (first, last, times). A row with n words has n / length + 2 of its pieces,
    so they are gathered per row."""
    piece = F.struct("first", "last", "times")
    took = plan.pieces.groupBy("source_no", "start").agg(
        F.sum((F.col("last") - F.col("first")) * F.col("times")).alias("taken"),
        F.array_sort(F.collect_list(piece)).alias("stretches"))
    sized = plan.rows.join(plan.sources.select("source_no", "source_size", "target"), "source_no")
    columns = ["doc_id", "tie", "nth", "same", "size", "source_size", "target", "taken", "stretches"]
    some = sized.filter("size > 0").join(took, ["source_no", "start"]).select(*columns)
    none = sized.filter("size = 0").withColumn("taken", F.lit(0).cast("long")).withColumn(
        "stretches", F.array().cast("array<struct<first:bigint,last:bigint,times:bigint>>"))
    return some.unionByName(none.select(*columns))


def mixed_rows(docs: DataFrame, plan: Mix, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The rows of ``docs`` as the mix takes them, with all their columns. A row whose blocks are all taken n times at
    least comes n times whole; what is taken beyond that comes as further rows that hold just those words, with the
    white space between them. Rows without words are not in any block and leave the mix.

    Texts are shuffled once, to meet what is taken of them; only rows with the same id and text are numbered first."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{doc_id}`").alias("doc_id"),
                         F.col(f"`{text}`").alias("text"), F.col(f"`{source}`").alias("source"), F.xxhash64(F.col(f"`{text}`")).alias("tie"))
    took = materialise(taken_words(plan).filter("taken > 0").select(
        F.col("doc_id").alias("_id"), F.col("tie").alias("_tie"), F.col("nth").alias("_nth"), "same", "stretches"))
    this = packed.doc_id.eqNullSafe(F.col("_id")) & (packed.tie == F.col("_tie"))
    alone = packed.join(took.filter("same = 1"), this).select("_row", "text", "stretches")
    several = stage(took.filter("same > 1").select("_id", "_tie").distinct())  # a file's size is known, so few are broadcast
    again = packed.join(several, this, "left_semi")
    numbered = _numbered(again).drop("same")
    copies = numbered.join(took, numbered.doc_id.eqNullSafe(F.col("_id")) & (numbered.tie == F.col("_tie"))
                           & (numbered.nth == F.col("_nth"))).select("_row", "text", "stretches")
    both = alone.unionByName(copies)
    whole = F.array_min(F.col("stretches.times"))
    pieces = F.transform(F.filter("stretches", lambda s: s.times > whole), lambda s: F.struct(
        s.first.alias("first"), s["last"].alias("last"), (s.times - whole).alias("times")))
    parts = F.concat(F.array(F.struct(F.lit(-1).cast("long").alias("first"), F.lit(-1).cast("long").alias("last"),
                                      whole.alias("times"))), pieces)
    out = both.select("_row", "text", F.explode(parts).alias("p")).filter("p.times > 0")
    out = out.select("_row", "text", "p", F.explode(F.sequence(F.lit(1), F.col("p.times"))).alias("_copy"))
    words = F.regexp_extract_all("text", F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("p.first") + 1).cast("int"),
                               (F.col("p.last") - F.col("p.first")).cast("int")), "")
    taken = F.when(F.col("p.first") < 0, F.col("text")).otherwise(cut)
    return out.select(*[taken.alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in docs.columns])


def taken_sql(seed: str = "mix") -> str:
    """DuckDB SQL for doc_id, size, source_size, target, taken over ``documents`` with the default weights."""
    return f"""WITH d AS (SELECT doc_id, source, text,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('{seed}:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
z AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s0 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS no, {MAX_PASSES} * source_size AS lim FROM z),
s1 AS (SELECT *, [{", ".join(map(str, WEIGHTS))}][(no - 1) % {len(WEIGHTS)} + 1]::BIGINT AS w FROM s0),
s2 AS (SELECT *, row_number() OVER o AS place,
    sum(source_size) OVER () - coalesce(sum(lim) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wl
  FROM s1 WINDOW o AS (ORDER BY lim / w, no)),
s3 AS (SELECT *, lim * wl <= rest * w AS is_full FROM s2),
s4 AS (SELECT *, CASE WHEN is_full THEN lim::DOUBLE
    ELSE w * (first_value(rest) OVER f)::DOUBLE / (first_value(wl) OVER f) END AS target,
    greatest(least({BLOCK_WORDS}, source_size // {LEAST_BLOCKS}), 1)::BIGINT AS length
  FROM s3 WINDOW f AS (ORDER BY is_full, place)),
s AS (SELECT *, ceil(source_size / length)::BIGINT AS blocks FROM s4),
v AS (SELECT *, target * blocks / source_size AS want FROM s WHERE source_size > 0),
c AS (SELECT *, sum(want) OVER (ORDER BY no) / sum(want) OVER () AS hi, no = max(no) OVER () AS is_last FROM v),
e AS (SELECT *, CASE WHEN is_last THEN 1.0 ELSE hi END AS upto,
    coalesce(lag(hi) OVER (ORDER BY no), 0.0) AS lo FROM c),
i AS (SELECT range AS slot, range * {PHI}::DOUBLE - floor(range * {PHI}::DOUBLE) AS u
  FROM range((SELECT round_even(sum(want), 0)::BIGINT FROM v))),
k AS (SELECT no, blocks, row_number() OVER (PARTITION BY no ORDER BY slot) - 1 AS rank
  FROM i JOIN e ON u >= lo AND u < upto),
t AS (SELECT no, rank % blocks AS block, count(*) AS times FROM k WHERE rank < {MAX_PASSES} * blocks GROUP BY ALL),
r AS (SELECT doc_id, size, s.no, s.source_size, s.target, s.length,
    row_number() OVER () AS k, coalesce(sum(size) OVER (PARTITION BY s.no ORDER BY h, doc_id, size, hash(text), text
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source),
x AS (SELECT *, unnest(range(start // length, (start + size - 1) // length + 1)) AS block FROM r WHERE size > 0),
y AS (SELECT x.k, sum((least((x.block + 1) * length - start, size) - greatest(x.block * length - start, 0))
    * coalesce(times, 0)) AS taken FROM x LEFT JOIN t ON x.no = t.no AND x.block = t.block GROUP BY x.k)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM r LEFT JOIN y USING (k)"""
