"""Ranked lexical search by scanning the documents with one Aho-Corasick automaton.

The terms of all items form one automaton. Every term is guarded by a blank on both sides, and so is every run of
separators in a text, so a hit is a whole term and term frequencies are counted straight from the text; there is no index
of the documents. A hit leads to its term, and the term to the items that hold it.

The first scan adds up what the weights need: the documents and terms in all, and the documents of each item term. Each
task reduces its rows to one number per term. The second scan counts again, scores every document for all items at
once, and each task keeps the best ``k`` per item; those lists are merged in two steps. What is broadcast are the items'
terms: at most MAX_PAIRS of (item, term) at a time, or one item; more items are searched in blocks, with two scans each.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import itemgetter
from typing import Any

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from paylens.llm.common import lower_ascii, pick, pieces, small_batches
from paylens.operators.groups import top_per_group
from paylens.operators.sizes import materialise

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MAX_PAIRS = 500_000
CELLS = 2_000_000  # scores held at once in a task
_GAP = re.compile(rb" ")
# Bytes of separators become blanks and A-Z small; everything else, all of UTF-8's multi-byte sequences included, stays.
_PLAIN = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()


@dataclass(frozen=True)
class Terms:
    """The terms of a block of items, and per term the items that hold it: items[start[t]:start[t + 1]]."""

    words: list[str]
    start: np.ndarray
    items: np.ndarray
    ids: list[Any]

    @staticmethod
    def of(rows: list[Row]) -> Terms:
        words: dict[str, list[int]] = {}
        for item, row in enumerate(rows):
            for term in row["terms"]:
                words.setdefault(term, []).append(item)
        sizes = np.fromiter(map(len, words.values()), np.int64, len(words))
        return Terms(list(words), np.concatenate([[0], sizes.cumsum()]),
                     np.fromiter((i for held in words.values() for i in held), np.int64, int(sizes.sum())),
                     [row["item_id"] for row in rows])


class Scanner:
    """Counts the terms of texts."""

    def __init__(self, words: list[str]) -> None:
        self.automaton = ahocorasick.Automaton()
        for k, word in enumerate(words):
            self.automaton.add_word(f" {word} ", k)
        self.automaton.make_automaton()
        self.empty = not words

    def __call__(self, text: str | None) -> tuple[int, Counter]:
        """(terms in all, term number to frequency)."""
        n, found = 0, Counter()
        if text:
            data = text.encode().translate(_PLAIN)
            for piece in pieces(data, _GAP):
                inside = np.frombuffer(piece, np.uint8) != 0x20
                n += int(np.count_nonzero(inside[1:] & ~inside[:-1])) + int(inside[0])
                if not self.empty:
                    found.update(map(itemgetter(1), self.automaton.iter(f" {piece.decode()} ")))
        return n, found


def _totals(docs: DataFrame, known) -> DataFrame:
    """(term, n): documents per term number; -1 has the documents with a term, -2 all their terms."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan, df, docs_n, terms_n = Scanner(known.value.words), Counter(), 0, 0
        for batch in batches:
            for text in batch.column(1):
                n, found = scan(text.as_py())
                df.update(found.keys())
                docs_n, terms_n = docs_n + (n > 0), terms_n + n
        df |= {-1: docs_n, -2: terms_n}
        yield pa.RecordBatch.from_arrays([pa.array(list(df), pa.int64()), pa.array(list(df.values()), pa.int64())], ["term", "n"])

    return docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The best ``k`` rows of each item among those seen so far."""

    def __init__(self, items: int, k: int) -> None:
        self.k, self.lists, self.least = k, [[] for _ in range(items)], np.ones(items, np.int64)

    @staticmethod
    def _order(row: tuple[int, Any]) -> tuple:
        score, key = row
        return (-score, key is None, 0 if key is None else key)

    def add(self, scores: np.ndarray, ids: list[Any]) -> None:
        """Scores by document and item."""
        least = self.least
        if len(ids) > self.k:
            least = np.maximum(least, np.partition(scores, len(ids) - self.k, axis=0)[len(ids) - self.k])
        fresh: dict[int, list] = {}
        for doc, item in np.argwhere(scores >= least).tolist():
            fresh.setdefault(item, []).append((int(scores[doc, item]), ids[doc]))
        for item, rows in fresh.items():
            self.lists[item] = kept = sorted(self.lists[item] + rows, key=self._order)[:self.k]
            if len(kept) == self.k:
                self.least[item] = max(1, kept[-1][0])


def _best(docs: DataFrame, known, weights: np.ndarray, n_docs: int, n_terms: int, k: int, item_type) -> DataFrame:
    """(place, item_id, doc_id, score): the best ``k`` documents per item of every task."""
    id_type = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms: Terms = known.value
        scan, items = Scanner(terms.words), len(terms.ids)
        sizes, best = np.diff(terms.start), Best(items, k)
        at_once = max(1, CELLS // max(1, items))
        held: list[tuple[Any, int, Counter]] = []

        def flush() -> None:
            size = np.array([len(found) for _, _, found in held])
            doc = np.repeat(np.arange(len(held)), size)
            term = np.fromiter((t for _, _, found in held for t in found), np.int64, len(doc))
            tf = np.fromiter((c for _, _, found in held for c in found.values()), np.int64, len(doc))
            m = np.array([100 - 90 + 90 * n * n_docs // n_terms for _, n, _ in held], np.int64)[doc]
            part = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            many = sizes[term]
            place = np.repeat(terms.start[term] - np.concatenate([[0], many.cumsum()[:-1]]), many) + np.arange(many.sum())
            scores = np.zeros(len(held) * items, np.int64)
            np.add.at(scores, np.repeat(doc, many) * items + terms.items[place], np.repeat(part, many))
            best.add(scores.reshape(len(held), items), [key for key, _, _ in held])
            held.clear()

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                n, found = scan(text.as_py())
                if found:
                    held.append((key, n, found))
                if len(held) >= at_once:
                    flush()
            if held:
                flush()
        rows = [(i, terms.ids[i], key, score) for i, some in enumerate(best.lists) for score, key in some]
        kinds = (pa.int64(), to_arrow_type(item_type), to_arrow_type(id_type), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)],
                                         ["place", "item_id", "doc_id", "score"])

    return docs.mapInArrow(run, f"place long, item_id {item_type.simpleString()}, doc_id {id_type.simpleString()}, score long")


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = 10, max_pairs: int = MAX_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents with the highest scores above 0 for every row of ``items``,
    ranked from 1, equal scores by ascending id, rows without an id last.

    A term's weight is floor(1000 * ln((2N + 2) / (2df + 1))); its share in a score is the weight times
    10**9 * tf div (1000 * tf + 8m), with m = 10 + 90 * n * N div L. Null and empty texts have no term; items without a
    term have no result; long texts are whole; repeated documents are ranked one by one, and repeated items each get
    their list. Empty tables give an empty result; other columns are ignored.
    """
    spark = docs.sparkSession
    thin = small_batches(pick(docs, doc_id=doc_id, text=text))
    asked = pick(items, item_id=item_id, text=item_text).select("item_id", F.array_distinct(F.regexp_extract_all(
        lower_ascii(F.coalesce("text", F.lit(""))), F.lit(TERM), F.lit(0))).alias("terms"))
    asked = materialise(asked.filter(F.size("terms") > 0).withColumn("row", F.monotonically_increasing_id()))
    pairs = asked.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    blocks = max(1, math.ceil(2 * pairs / max_pairs)) if pairs > max_pairs else 1
    kind, found = asked.schema["item_id"].dataType, None
    for block in range(blocks):
        rows = asked.filter(F.pmod(F.xxhash64("row"), F.lit(blocks)) == block).collect()  # bounded by max_pairs, or one item
        terms = Terms.of(rows)
        known = spark.sparkContext.broadcast(terms)
        counts = {r.term: r.n for r in _totals(thin, known).collect()} if rows else {}  # one row per term of the block
        n_docs, n_terms = counts.get(-1, 0), counts.get(-2, 0)
        weights = np.array([weight(n_docs, counts.get(t, 0)) for t in range(len(terms.words))], np.int64)
        best = _best(thin, known, weights, n_docs, n_terms, k, kind).withColumn("block", F.lit(block))
        found = best if found is None else found.unionByName(best)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    ranked = top_per_group(found, ["block", "place"], "doc_id", order, k)
    return ranked.select("item_id", F.col("_place").cast("int").alias("rank"), "doc_id", "score")


def search_sql(k: int = 10) -> str:
    big, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = f"unnest(regexp_extract_all(translate(text, '{big}', '{small}'), '{TERM}')) AS term"
    return f"""
WITH t AS (SELECT doc_id, {terms} FROM documents), tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY 1, 2),
d AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY 1),
a AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
w AS (SELECT term, CAST(floor(1000 * ln((2 * max(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, a GROUP BY term),
i AS (SELECT DISTINCT item_id, {terms} FROM benchmark),
s AS (SELECT item_id, tf.doc_id, CAST(sum(w * (1000000000 * tf // (1000 * tf + 8 * (10 + 90 * n * n_docs // n_terms)))) AS BIGINT)
    AS score FROM i JOIN tf USING (term) JOIN w USING (term) JOIN d ON d.doc_id = tf.doc_id, a GROUP BY 1, 2)
SELECT item_id, CAST(r AS INT) AS rank, doc_id, score FROM (SELECT *, row_number() OVER (
  PARTITION BY item_id ORDER BY score DESC, doc_id) AS r FROM s WHERE score > 0) WHERE r <= {k}"""
