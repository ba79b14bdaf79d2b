"""SimHash near-duplicates by anchor points of a covering code.

1. Every text becomes a 64-bit fingerprint: the majority vote, bit by bit, of the hashes of its word shingles. Equal
   fingerprints form one class, and everything below works on classes.
2. Anchors are the words of a covering code: two binary Golay codes side by side, over bits 0 to 22 and 23 to 45 of the
   fingerprint. They have 2**24 anchors, and as each is perfect with radius 3, every fingerprint lies within
   RADIUS = 6 of some anchor, counted on those 46 bits.
3. A fingerprint is at home at its nearest anchor and visits every anchor within RADIUS + threshold. Two fingerprints
   that differ in at most ``threshold`` bits differ in no more of the 46, so each visits the home of the other: no link
   is lost. At a threshold of 2 a fingerprint has 78 anchors on average, whatever the size of the table.
4. At every anchor, those at home are compared with the visitors on all 64 bits: one equi-join whose condition counts
   the differing bits, so only links leave it. A fingerprint has at most 2,080 neighbours within 2 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import pick, pieces, small_batches
from paylens.llm.components import components
from paylens.operators.sizes import materialise, stage

SALTS = 64
RADIUS = 6  # of the code: 3 for either block
LENGTH, CHECK = 23, 11  # of a block, and its check bits
POLYNOMIAL = 0b110001110101  # generator of the Golay code
AT_ONCE = 8192
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_MASK = np.uint64(2**LENGTH - 1)


def fingerprint(text: str | None, n: int = 3, seed: int = 42) -> int:
    """A bit is 1 if it is set in over half of the hashes (XXH64) of the shingles of n words, repeats included. A text of
    fewer words is one shingle; one without words gives 0. Long texts are hashed piece by piece."""
    ones, total, carry = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for piece in pieces((text or "").encode().lower(), _SPACE):
        words = carry + piece.split()
        carry = words[max(0, len(words) - n + 1):]
        if len(words) < n:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        h = np.fromiter([digest(joined[a:b], seed) for a, b in zip(starts.tolist(), ends[n - 1:].tolist())],  # noqa: B905
                        np.uint64, len(words) - n + 1)
        for at in range(0, len(h), AT_ONCE):
            bits = np.unpackbits(h[at:at + AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            ones += bits.sum(axis=0, dtype=np.int64)
        total += len(h)
    if not total and carry:  # fewer words than n
        return digest(b" ".join(carry), seed)
    return sum(1 << k for k in np.flatnonzero(2 * ones > total).tolist())


class Anchors:
    """Words of the code near fingerprints. Vectors of one syndrome are what leads from a block to the code words around
    it; they are kept by syndrome and weight, so the words within a distance are a prefix of a list."""

    def __init__(self, reach: int) -> None:
        self.reach = reach
        most = min(reach, LENGTH)
        vectors = np.arange(2**LENGTH, dtype=np.uint32)
        vectors = vectors[np.bitwise_count(vectors) <= most]
        weights = np.bitwise_count(vectors).astype(np.int64)
        low = [self._remainder(k) for k in range(2**12)]
        high = [self._remainder(k << 12) for k in range(2**(LENGTH - 12))]
        self.low, self.high = np.array(low, np.int64), np.array(high, np.int64)
        order = np.argsort(self.syndrome(vectors) * (most + 1) + weights, kind="stable")
        self.vectors = vectors[order].astype(np.uint64)
        per = np.zeros((2**CHECK, most + 1), np.int64)
        np.add.at(per, (self.syndrome(vectors), weights), 1)
        self.within = per.cumsum(axis=1)
        self.start = np.concatenate([[0], self.within[:, -1].cumsum()[:-1]])
        self.least = (per > 0).argmax(axis=1)
        self.most = most

    @staticmethod
    def _remainder(word: int) -> int:
        for k in range(LENGTH - 1, CHECK - 1, -1):
            if word >> k & 1:
                word ^= POLYNOMIAL << (k - CHECK)
        return word

    def syndrome(self, block: np.ndarray) -> np.ndarray:
        return self.low[(block & 0xFFF).astype(np.int64)] ^ self.high[(block >> 12).astype(np.int64)]

    def _blocks(self, fps: np.ndarray):
        a, b = fps & _MASK, (fps >> np.uint64(LENGTH)) & _MASK
        return a, b, self.syndrome(a.astype(np.uint32)), self.syndrome(b.astype(np.uint32))

    def home(self, fps: np.ndarray) -> np.ndarray:
        """The nearest anchor; both blocks have exactly one, as the codes are perfect."""
        a, b, sa, sb = self._blocks(fps)
        return (a ^ self.vectors[self.start[sa]]) | (b ^ self.vectors[self.start[sb]]) << np.uint64(LENGTH)

    def near(self, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``fps``, anchor) of every anchor within the reach."""
        def lists(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
            """Places starts[i], starts[i] + 1, ... for each i, counts[i] of them."""
            return np.repeat(starts - np.concatenate([[0], counts.cumsum()[:-1]]), counts) + np.arange(counts.sum())

        a, b, sa, sb = self._blocks(fps)
        first = self.within[sa, np.minimum(self.reach - self.least[sb], self.most)]
        row = np.repeat(np.arange(len(fps)), first)
        left = self.vectors[lists(self.start[sa], first)]
        over = self.reach - np.bitwise_count(left).astype(np.int64)
        second = self.within[sb[row], np.minimum(over, self.most)]
        right = self.vectors[lists(self.start[sb[row]], second)]
        row = np.repeat(row, second)
        return row, (a[row] ^ np.repeat(left, second)) | (b[row] ^ right) << np.uint64(LENGTH)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) of every row; the 64 bits as a signed long. Only A-Z is lower-cased."""
    @F.pandas_udf("long")
    def fp(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for some in texts:
            yield pd.Series(np.array([fingerprint(t, n, seed) for t in some], np.uint64).view(np.int64))

    thin = small_batches(pick(docs, doc_id=doc_id, text=text))
    return thin.select("doc_id", fp("text").alias("fp"))


def homes(classes: DataFrame) -> DataFrame:
    """(anchor, fp): the nearest anchor of every fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Anchors(RADIUS // 2)
        for batch in batches:
            anchor = code.home(batch.column(0).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([_signed(anchor), batch.column(0)], ["anchor", "fp"])

    return classes.select("fp").mapInArrow(run, "anchor long, fp long")


def visits(classes: DataFrame, threshold: int = 2) -> DataFrame:
    """(anchor, fp) for every anchor within reach of a fingerprint."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = Anchors(RADIUS + threshold)
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), AT_ONCE):
                some = fps[at:at + AT_ONCE]
                row, anchor = code.near(some)
                yield pa.RecordBatch.from_arrays([_signed(anchor), _signed(some[row])], ["anchor", "fp"])

    return classes.select("fp").mapInArrow(run, "anchor long, fp long")


def links(classes: DataFrame, threshold: int = 2) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints that differ in at most ``threshold`` bits."""
    home = homes(classes).select(F.col("anchor").alias("at"), F.col("fp").alias("other"))
    differ = F.bit_count(F.col("fp").bitwiseXOR(F.col("other")))
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = classes.select("fp").repartition(tasks, "fp")  # each row becomes many
    met = visits(spread, threshold).join(home, (F.col("anchor") == F.col("at")) & differ.between(1, threshold))
    return met.select(F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")).distinct()


def as_hex(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def cluster(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 3, seed: int = 42,
            threshold: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hexadecimal digits), component_id (smallest id of all documents
    that links chain to it, itself included), n_similar (distinct fingerprints linked to its own) and kept.

    Null, empty and blank texts have fingerprint zero and link like any other. Long texts are whole. A row without an id
    links too, but its id is never the smallest; a component without any id has null. Repeated rows are copies. An empty
    table gives an empty result; other columns are ignored.
    """
    salt = F.pmod(F.xxhash64("doc_id", F.spark_partition_id()), F.lit(SALTS)).cast("int")
    signed = stage(fingerprints(docs, doc_id, text, n, seed).withColumn("salt", salt))
    entries = signed.groupBy("salt", "fp").agg(F.min("doc_id").alias("first"))
    classes = materialise(entries.groupBy("fp").agg(F.min("first").alias("first")))
    edges = materialise(links(classes, threshold))
    linked = components(edges)
    degree = edges.select("a").union(edges.select(F.col("b"))).groupBy(F.col("a").alias("fp")).agg(
        F.count(F.lit(1)).alias("n_similar"))
    ids = linked.join(classes, F.col("node") == F.col("fp")).groupBy("root").agg(F.min("first").alias("component_id"))
    found = linked.join(ids, "root").select(F.col("node").alias("fp"), "component_id")
    verdict = classes.join(found, "fp", "left").join(degree, "fp", "left").select(
        "fp", F.coalesce("component_id", "first").alias("component_id"), F.coalesce("n_similar", F.lit(0)).alias("n_similar"))
    back = signed.select("salt", "fp").distinct().join(verdict, "fp")  # at most SALTS rows per fingerprint
    return signed.join(back, ["salt", "fp"]).select(
        "doc_id", as_hex(F.col("fp")).alias("fingerprint"), "component_id", "n_similar",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with all their columns, of each component only those with its smallest id. Rows without an id
    cannot be told apart and stay."""
    found = cluster(docs, doc_id, text, **settings).filter("NOT kept AND doc_id IS NOT NULL")
    dropped = found.select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, F.col(f"`{doc_id}`") == F.col("_dropped"), "left_anti")
