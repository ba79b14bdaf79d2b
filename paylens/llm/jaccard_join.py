"""N-gram Jaccard self-join by a MinHash LSH forest.

1. Texts become sets of hashed word shingles; equal sets form one class, and everything below works on classes.
2. A forest of ``trees`` MinHash keys of ``max_depth`` components each is built. Per tree the keys are sorted, which is a
   prefix trie: classes under one node share a prefix. Prefixes are shortened from the full depth until two sets at
   the threshold share one in some tree with probability ``recall``; that fixes the shallowest depth used.
3. At every depth from the full one to the shallowest, each class is tied to the first class of its node. That is one
   edge per level and class, however many classes share a node. Edges whose signatures agree far too little are dropped.
   A node at the shallowest depth that loses an edge is mixed: a passage that unrelated texts share has filled it. The
   signatures of its classes are then compared pair by pair, block by block, but for those already connected. So all
   classes that share a node and have similar signatures are connected, and what is connected is one candidate group.
   Groups hold all classes that are chained by similar signatures, so pairs that no tree put side by side are checked as
   well.
4. Inside each candidate group all pairs are verified exactly on their sets. Groups are cut into blocks, block pairs are
   dealt to tasks, and a task counts links by matrix products and returns one row per class, never pairs.

A candidate group of g classes costs g * g / 2 comparisons, as every class's number of links is asked for.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql.pandas.types import to_arrow_type

from paylens.llm.common import WORD, pick, small_batches
from paylens.llm.components import components
from paylens.operators.sizes import materialise

SALTS = 64
SEED = 20_240
BLOCK_SETS, BLOCK_SHINGLES = 128, 500_000
NODE_BLOCK = 2048  # classes of a mixed node that are compared at once
COLUMNS = 16_384
_WORD = re.compile(WORD)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def forest_depth(trees: int, max_depth: int, threshold: float, recall: float) -> int:
    """The longest prefix that two sets at the threshold share in some tree with probability ``recall`` or more."""
    for depth in range(max_depth, 0, -1):
        if 1 - (1 - threshold**depth) ** trees >= recall:
            return depth
    raise ValueError(f"{trees} trees cannot reach a recall of {recall} at similarity {threshold}")


class Shingler:
    """Sets of hashed n-word shingles; word hashes are remembered within a task."""

    def __init__(self, n: int) -> None:
        self.n, self.hash = n, {}
        rng = np.random.default_rng(SEED)
        self.factors = rng.integers(0, 2**63, n, np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, text: str | None) -> np.ndarray:
        """Sorted distinct shingle hashes. A text of fewer than n words, but at least one, is one shingle."""
        words = _WORD.findall(text or "")
        if not words:
            return np.empty(0, np.uint64)
        if len(self.hash) > 300_000:
            self.hash.clear()
        known = self.hash
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.n, len(h))
        count = len(h) - size + 1
        out = np.full(count, size, np.uint64)
        for k in range(size):
            out = out + h[k:k + count] * self.factors[k]
            out ^= out >> np.uint64(29)
        out = (out ^ (out >> np.uint64(30))) * _MIX[0]
        out = (out ^ (out >> np.uint64(27))) * _MIX[1]
        return np.unique(out ^ (out >> np.uint64(31)))


def node_of(shingles: np.ndarray) -> int:
    """The class of a set: equal sets, and only they, share it (64 bits)."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - 2**63


class MinHash:
    """Works in one small buffer: fresh arrays of this size would be mapped and unmapped for every text."""

    def __init__(self, size: int) -> None:
        rng = np.random.default_rng(SEED + 1)
        self.a = rng.integers(0, 2**63, (size, 1), np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 2**63, (size, 1), np.uint64)
        self.buffer = np.empty((size, 256), np.uint64)

    def __call__(self, shingles: np.ndarray) -> bytes:
        """16 bits of each component."""
        least = np.full(len(self.a), np.uint64(2**64 - 1))
        for at in range(0, len(shingles), self.buffer.shape[1]):
            some = shingles[at:at + self.buffer.shape[1]]
            values = self.buffer[:, :len(some)]
            np.multiply(some, self.a, out=values)
            np.add(values, self.b, out=values)
            np.minimum(least, values.min(axis=1), out=least)
        return ((least >> np.uint64(16)) & np.uint64(0xFFFF)).astype(">u2").tobytes()


def _signatures(docs: DataFrame, n: int, size: int) -> DataFrame:
    """(doc_id, node, shingles, sig) of rows that have an id and a word."""
    kind = docs.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, minhash = Shingler(n), MinHash(size)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = shingler(text.as_py())
                if doc_id is not None and len(found):
                    rows.append((doc_id, node_of(found), len(found), minhash(found)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((to_arrow_type(kind), pa.int64(), pa.int64(), pa.binary()))],
                ["doc_id", "node", "shingles", "sig"])

    return docs.mapInArrow(run, f"doc_id {kind.simpleString()}, node long, shingles long, sig binary")


def forest(classes: DataFrame, trees: int, max_depth: int, depth: int) -> DataFrame:
    """(tree, prefix, node, first0, first1, ...): every class that is not alone in its trie node, with the first class of
    its node at each depth from the shallowest on; the first class of a shallowest node itself has no row. One shuffle by
    (tree, shortest prefix) and one sort serve all levels; the trees spread a large group over as many nodes."""
    width = 2 * max_depth
    rows = classes.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    key = F.substring("sig", F.col("tree") * width + 1, F.lit(width))
    rows = rows.select("node", "tree", F.substring(key, 1, 2 * depth).alias(f"p{depth}"), *[
        F.substring(key, 2 * d - 1, 2).alias(f"p{d}") for d in range(depth + 1, max_depth + 1)])
    levels = [f"p{d}" for d in range(depth, max_depth + 1)]
    firsts = {f"first{k}": F.first("node").over(W.partitionBy("tree", *levels[:k + 1]).orderBy(*levels[k + 1:], "node"))
              for k in range(len(levels))}
    return rows.withColumns(firsts).filter("node <> first0").select("tree", F.col(f"p{depth}").alias("prefix"), "node", *firsts)


def forest_edges(trie: DataFrame) -> DataFrame:
    """Edges (a, b) from each class to the first class of its node, level by level, and to that of its shallowest node."""
    chain = ["node", *sorted((c for c in trie.columns if c.startswith("first")), reverse=True)]
    steps = F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b"))
                      for x, y in [*zip(chain, chain[1:], strict=False), ("node", "first0")]])
    pairs = trie.select(F.explode(steps).alias("e")).select("e.*").filter("a <> b")
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_edges(edges: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Edges whose signatures agree in at least the share ``least`` of their components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(k).to_pylist()), ">u2").reshape(batch.num_rows, -1)
                           for k in (2, 3)) if batch.num_rows else (np.empty((0, 1)), np.empty((0, 1)))
            yield batch.select(["a", "b"]).filter(pa.array((left == right).mean(axis=1) >= least))

    sig = classes.select("node", "sig")
    both = edges.join(sig.select(F.col("node").alias("a"), F.col("sig").alias("sa")), "a").join(
        sig.select(F.col("node").alias("b"), F.col("sig").alias("sb")), "b").select("a", "b", "sa", "sb")
    return both.mapInArrow(run, "a long, b long")


def spanning_links(sigs: np.ndarray, least: float, split: int | None) -> list[tuple[int, int]]:
    """Pairs of places that connect all rows whose signatures agree in the share ``least``; rows that are connected
    already are not compared again. With ``split`` only pairs of the first ``split`` rows and the others count."""
    label, found = np.arange(len(sigs)), []
    for i in range(len(sigs) if split is None else split):
        first = i + 1 if split is None else split
        others = first + np.flatnonzero(label[first:] != label[i])
        for j in others[(sigs[others] == sigs[i]).mean(axis=1) >= least].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                found.append((i, j))
    return found


def mixed_edges(trie: DataFrame, near: DataFrame, classes: DataFrame, least: float) -> DataFrame:
    """Edges (a, b) that connect all similar classes of the mixed nodes: those at the shallowest depth with a class that is
    not similar to the first one. ``near`` has the similar pairs among the forest's edges."""
    star = [F.least("node", "first0").alias("a"), F.greatest("node", "first0").alias("b")]
    mixed = trie.select("tree", "prefix", *star).join(near, ["a", "b"], "left_anti").select("tree", "prefix").distinct()
    held = trie.join(mixed, ["tree", "prefix"], "left_semi")
    members = held.select("tree", "prefix", "node").union(held.select("tree", "prefix", "first0").distinct())
    sizes = members.groupBy("tree", "prefix").agg(F.ceil(F.count(F.lit(1)) / NODE_BLOCK).cast("long").alias("blocks"))
    rows = members.join(sizes, ["tree", "prefix"]).join(classes.select("node", "sig"), "node").select(
        "tree", "prefix", "node", "sig", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), "blocks")
    dealt = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    dealt = dealt.select(
        "tree", "prefix", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "sig")
    grain = ["tree", "prefix", "i", "j"]

    def flush(now: tuple | None, group: list[tuple[int, int, bytes]]) -> list[tuple[int, int]]:
        group = sorted(group)
        split = None if now is None or now[2] == now[3] else [side for side, _, _ in group].count(0)
        if len(group) < 2 or split in (0, len(group)):
            return []
        sigs = np.frombuffer(b"".join(sig for _, _, sig in group), ">u2").reshape(len(group), -1)
        return [tuple(sorted((group[i][1], group[j][1]))) for i, j in spanning_links(sigs, least, split)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, found = None, [], []
        for batch in batches:
            for tree, prefix, i, j, side, node, sig in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (tree, prefix, i, j) != now:
                    found += flush(now, group)
                    now, group = (tree, prefix, i, j), []
                group.append((side, node, sig))
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in range(2)], ["a", "b"])
            found = []
        found = flush(now, group)
        yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in found], pa.int64()) for k in range(2)], ["a", "b"])

    return dealt.repartition(*grain).sortWithinPartitions(*grain).mapInArrow(run, "a long, b long")


def count_links(sets: list[np.ndarray], weights: np.ndarray, threshold: float, split: int | None
                ) -> tuple[np.ndarray, np.ndarray]:
    """Weighted number of links of each set and the smallest place it is connected with. With ``split`` only links
    between the first ``split`` sets and the others count."""
    sizes = np.array([len(s) for s in sets], float)
    row = np.repeat(np.arange(len(sets)), sizes.astype(int))
    _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = often > 1  # shingles of one set only meet nothing
    place = np.cumsum(shared) - 1
    keep = shared[column]
    row, column = row[keep], place[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for at in range(0, int(shared.sum()), COLUMNS):
        lo, hi = np.searchsorted(column, (at, at + COLUMNS))
        rows_here, row_no = np.unique(row[lo:hi], return_inverse=True)
        grid = np.zeros((len(rows_here), COLUMNS), np.float32)
        grid[row_no, column[lo:hi] - at] = 1
        common[np.ix_(rows_here, rows_here)] += grid @ grid.T
    linked = common / (sizes[:, None] + sizes[None, :] - common) >= threshold
    np.fill_diagonal(linked, False)
    if split is not None:
        linked[:split, :split] = linked[split:, split:] = False
    root = np.arange(len(sets))
    while True:
        told = np.minimum(root, np.where(linked, root[None, :], len(sets)).min(axis=1))
        told = told[told]
        if (told == root).all():
            return linked @ weights, root
        root = told


def _verify(dealt: DataFrame, n: int, threshold: float) -> DataFrame:
    """(node, links, root) per class and block pair, from rows sorted by block pair that carry texts."""

    def flush(pair: tuple[int, int, int] | None, group: dict[int, tuple]) -> list[tuple[int, int, int]]:
        """Links inside block i for the pair (i, i), else only those between i and j; a block may have no class."""
        rows = sorted(group.items(), key=lambda r: (r[1][0], r[0]))
        if len(rows) < 2:
            return []
        split = None
        if pair[1] != pair[2]:
            split = [side for _, (side, *_) in rows].count(0)
            if split in (0, len(rows)):
                return []
        links, root = count_links([r[1][2] for r in rows], np.array([r[1][1] for r in rows]), threshold, split)
        return [(rows[k][0], int(links[k]), rows[root[k]][0]) for k in np.flatnonzero(links)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, group, out = None, {}, []
        for batch in batches:
            for key, i, j, side, node, weight, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, i, j) != now:
                    out += flush(now, group)
                    now, group = (key, i, j), {}
                group[node] = (side, weight, np.frombuffer(data, np.uint64))
            yield _rows(out)
            out = []
        yield _rows(flush(now, group))

    def _rows(found: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in found], pa.int64()) for k in range(3)],
                                          ["node", "links", "root"])

    return dealt.mapInArrow(run, "node long, links long, root long")


def _sets(members: DataFrame, n: int) -> DataFrame:
    """Replace the text of (root, node, weight, blocks, text) by its set; rows whose text is not that of the class go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(n)
        for batch in batches:
            sets = [shingler(t.as_py()) for t in batch.column(4)]
            good = [bool(len(s)) and node_of(s) == node for s, node in zip(sets, batch.column(1).to_pylist(), strict=True)]
            kept = pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array([s.tobytes() for s in sets], pa.binary())],
                ["group", "node", "weight", "blocks", "data"])
            yield kept.filter(pa.array(good, pa.bool_()))

    return members.mapInArrow(run, "group long, node long, weight long, blocks long, data binary")


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 5, threshold: float = 0.8,
         trees: int = 18, max_depth: int = 6, recall: float = 0.9999) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id (smallest id of all documents chained to it by links, itself
    included), rep_id (smallest id with the same shingle set), n_links (other documents with a Jaccard similarity of
    ``threshold`` or more) and kept (doc_id = class_id).

    Words are runs of other characters than white space. A text of fewer than n words is one shingle; a null, empty or
    blank text has none and links to nothing, nor does a row without an id. Long texts are read whole. Repeated rows link
    to each other like any copies. An empty table gives an empty result; other columns are ignored.
    """
    depth = forest_depth(trees, max_depth, threshold, recall)
    thin = small_batches(pick(docs, doc_id=doc_id, text=text))
    signed = materialise(_signatures(thin, n, trees * max_depth).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")))
    entries = signed.groupBy("salt", "node").agg(
        F.min("doc_id").alias("rep_id"), F.count("*").alias("copies"), F.first("shingles").alias("shingles"),
        F.first("sig").alias("sig"))
    classes = materialise(entries.groupBy("node").agg(
        F.min("rep_id").alias("rep_id"), F.sum("copies").alias("copies"), F.first("shingles").alias("shingles"),
        F.first("sig").alias("sig")))

    spread = (threshold * (1 - threshold) / (trees * max_depth)) ** 0.5
    least = threshold - 5 * spread
    trie = materialise(forest(classes, trees, max_depth, depth))
    near = materialise(similar_edges(forest_edges(trie), classes, least))
    groups = components(materialise(near.union(mixed_edges(trie, near, classes, least)).distinct()))
    members = materialise(groups.join(classes.drop("sig"), "node"))
    sizes = members.groupBy("root").agg(F.greatest(
        F.ceil(F.count("*") / BLOCK_SETS), F.ceil(F.sum("shingles") / BLOCK_SHINGLES)).cast("long").alias("blocks"))
    wanted = members.join(sizes, "root").select("root", "node", F.col("copies").alias("weight"), "blocks", "rep_id")
    texts = thin.join(wanted, F.col("doc_id") == F.col("rep_id")).select("root", "node", "weight", "blocks", "text")
    sets = _sets(texts, n).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    dealt = sets.select("group", "node", "weight", "data", "block", F.explode(
        F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select(
        "group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
        (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "weight", "data")
    dealt = dealt.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j")
    found = materialise(_verify(dealt, n, threshold))

    linked = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    ids = linked.join(classes.select("node", "rep_id"), "node").groupBy("root").agg(F.min("rep_id").alias("class_id"))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    verdict = (classes.select("node", "rep_id", "copies").join(links, "node", "left").join(linked, "node", "left")
               .join(ids, "root", "left").select("node", "rep_id", F.coalesce("class_id", "rep_id").alias("class_id"),
                                                 (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    back = signed.select("salt", "node").distinct().join(verdict, "node")  # at most SALTS rows per class
    known = signed.select("doc_id", "salt", "node").join(back, ["salt", "node"]).select(
        "doc_id", "class_id", "rep_id", "n_links")
    blank = thin.filter(F.col("doc_id").isNull() | ~F.rlike(F.coalesce("text", F.lit("")), F.lit(WORD))).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("rep_id"), F.lit(0).cast("long").alias("n_links"))
    return known.unionByName(blank).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` with all their columns, of each class only those with the smallest id."""
    dropped = join(docs, doc_id, text, **settings).filter("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct()
    return docs.join(dropped, F.col(f"`{doc_id}`") == F.col("_dropped"), "left_anti")
