"""Fill-in-middle examples, cut at unit ends found with arithmetic on 64-bit words.

A unit is a line with its line feed, or what stands behind the last one. A text's UTF-8 is viewed as 64-bit words. In
every word the high bit of each byte that is a line feed is set by a few additions and masks; the population count of
the marks, summed up over the words, tells in which word the wanted unit ends, and the mark is selected inside that word
by clearing the lower ones. Bytes that continue a code point are marked and counted the same way, for lengths in
code points. Texts are read whole; a text costs a few arrays of an eighth of its size.

Cuts and forms follow the SHA-256 of seed and id, so that they depend on nothing else and reruns agree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import pick, small_batches

_ONES, _LOW, _HIGH = (np.uint64(0x0101010101010101 * k) for k in (0x01, 0x7F, 0x80))
_FEEDS = np.uint64(0x0101010101010101 * 0x0A)


@dataclass(frozen=True)
class Layout:
    """Marks and rates of the examples. ``rate`` per cent of the texts are split, ``spm`` per cent of those put the suffix
    first. No mark may contain another, and all begin with a character that occurs nowhere else in them."""

    seed: int = 7
    rate: int = 100
    spm: int = 50
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def marks(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


class Units:
    """Places of the unit ends of a text, and lengths in code points, from its bytes."""

    def __init__(self, data: bytes | memoryview) -> None:
        whole = len(data) // 8
        rest = bytes(data[8 * whole:])
        words = np.frombuffer(data, "<u8", whole)
        last = np.frombuffer(rest.ljust(8, b"\0"), "<u8")
        self.words, self.size = np.concatenate([words, last]), len(data)
        other = self.words ^ _FEEDS  # a line feed becomes a zero byte
        self.marks = ~(((other & _LOW) + _LOW) | other) & _HIGH
        self.upto = np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)
        feeds = int(self.upto[-1])
        self.count = feeds + (self.size > 0 and bytes(data[self.size - 1:]) != b"\n")

    def end(self, k: int) -> int:
        """The byte behind the k-th unit; 0 for k = 0."""
        if k == 0:
            return 0
        if k == self.count:
            return self.size
        word = int(np.searchsorted(self.upto, k))
        mark = int(self.marks[word])
        for _ in range(k - (int(self.upto[word - 1]) if word else 0) - 1):
            mark &= mark - 1
        return 8 * word + ((mark & -mark).bit_length() - 1) // 8 + 1

    def chars(self, start: int, end: int) -> int:
        """Code points of a stretch of bytes: all bytes but those that continue one (high bit set, next one not)."""
        if end <= start:
            return 0
        first, last = start // 8, (end + 7) // 8
        some = self.words[first:last]
        more = (some >> np.uint64(7)) & ~(some >> np.uint64(6)) & _ONES
        skip, cut = start - 8 * first, 8 * last - end
        more[0] = more[0] >> np.uint64(8 * skip) << np.uint64(8 * skip)
        more[-1] = more[-1] << np.uint64(8 * cut) >> np.uint64(8 * cut)
        return end - start - int(np.bitwise_count(more).sum(dtype=np.int64))


def draws(doc_id: str | None, seed: int) -> list[int]:
    """The first four 32-bit groups of the SHA-256 of ``seed:id``; a null id counts as empty."""
    code = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(code[at:at + 8], 16) for at in range(0, 32, 8)]


def split(doc_id: str | None, data: bytes, layout: Layout) -> tuple[int, str, int | None, int | None, bytes]:
    """(units, form, code points of prefix and of middle, output) of one text."""
    units = Units(data)
    h1, h2, h3, h4 = draws(doc_id, layout.seed)
    if not data or any(m.encode() in data for m in layout.marks) or h3 % 100 >= layout.rate:
        return units.count, "plain", None, None, data
    low, high = sorted((h1 % (units.count + 1), h2 % (units.count + 1)))
    a, b = units.end(low), units.end(high)
    p, s, m = (mark.encode() for mark in layout.marks)
    form = "spm" if h4 % 100 < layout.spm else "psm"
    parts = (s, data[b:], p, data[:a], m, data[a:b]) if form == "spm" else (p, data[:a], s, data[b:], m, data[a:b])
    return units.count, form, units.chars(0, a), units.chars(a, b), b"".join(parts)


def transform(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", layout: Layout = Layout()) -> DataFrame:
    """One row per row of ``docs``: doc_id, n (units), form (plain, psm or spm), prefix_chars, middle_chars (null if plain)
    and output.

    A null text counts as empty; empty texts, and texts that contain a mark, stay plain. Long texts are whole, a null id
    draws as the empty one, repeated rows give repeated results, an empty table gives an empty result and other columns
    are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [split(key.as_py(), data.as_py(), layout) for key, data in zip(batch.column(1), batch.column(2), strict=True)]
            n, form, before, middle, out = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(before, pa.int64()),
                 pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    thin = small_batches(pick(docs, doc_id=doc_id, text=text))
    given = thin.select("doc_id", F.col("doc_id").cast("string").alias("key"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("data"))
    kind = thin.schema["doc_id"].dataType.simpleString()
    return given.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column, layout: Layout = Layout()) -> Column:
    """The original text, from an example and its form alone. Every mark occurs once, as texts that contain one stay plain."""
    def cut(first: str, second: str, third: str) -> list[Column]:
        """The three parts of an example whose marks come in this order."""
        body = F.substr(output, F.lit(len(first) + 1))
        a = F.substring_index(body, second, 1)
        rest = F.substr(body, F.length(a) + F.lit(len(second) + 1))
        b = F.substring_index(rest, third, 1)
        return [a, b, F.substr(rest, F.length(b) + F.lit(len(third) + 1))]

    prefix, suffix, middle = cut(layout.prefix, layout.suffix, layout.middle)
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = cut(layout.suffix, layout.prefix, layout.middle)
    return F.when(form == "psm", psm).when(form == "spm", F.concat(prefix, middle, suffix)).otherwise(output)


def digests(examples: DataFrame, layout: Layout = Layout()) -> DataFrame:
    """The examples with the SHA-256 of their output and of the text rebuilt from it, in place of the output."""
    def sha(c: Column) -> Column:
        return F.sha2(c.cast("binary"), 256)

    return examples.withColumns({
        "output_sha256": sha(F.col("output")),
        "restored_sha256": sha(restored(F.col("output"), F.col("form"), layout))}).drop("output")


def digests_sql(layout: Layout = Layout()) -> str:
    p, s, m = layout.marks
    group = "('0x' || substr(h, {}, 8))::BIGINT".format
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('{layout.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units FROM t),
c AS (SELECT *, len(units) AS n, least({group(1)} % (len(units) + 1), {group(9)} % (len(units) + 1)) AS a,
  greatest({group(1)} % (len(units) + 1), {group(9)} % (len(units) + 1)) AS b,
  CASE WHEN text = '' OR contains(text, '{p}') OR contains(text, '{s}') OR contains(text, '{m}')
    OR {group(17)} % 100 >= {layout.rate} THEN 'plain' WHEN {group(25)} % 100 < {layout.spm} THEN 'spm' ELSE 'psm' END AS form FROM u),
d AS (SELECT *, array_to_string(units[1:a], '') AS pre, array_to_string(units[a + 1:b], '') AS mid,
  array_to_string(units[b + 1:], '') AS suf FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '{p}' || pre || '{s}' || suf || '{m}' || mid
    ELSE '{s}' || suf || '{p}' || pre || '{m}' || mid END) AS output_sha256, sha256(text) AS restored_sha256 FROM d"""
