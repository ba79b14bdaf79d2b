"""What several corpus operators share."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.operators.sizes import small_batches  # noqa: F401  (shared with the labeller)

WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that further columns can never clash."""
    return df.select(*[F.col(f"`{c}`").alias(name) for name, c in columns.items()])


def n_words(text: Column) -> Column:
    """Number of words of a text as long; null counts as empty."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """True where crc32 of the id as text is divisible by ``folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == 0


def is_held_out(doc_id: int | None, folds: int = 5) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % folds == 0


def pieces(data: bytes, gap: re.Pattern[bytes], size: int = 1 << 20) -> Iterator[bytes]:
    """A long text in parts of about ``size`` bytes that end where ``gap`` matches, so that none cuts a word. A word
    longer than that stays whole."""
    at = 0
    while len(data) - at > size and (m := gap.search(data, at + size)):
        yield data[at:m.end()]
        at = m.end()
    yield data[at:] if at else data
