"""Pairs at the threshold whose texts share a long passage with thousands of others."""

import random

import numpy as np
import pytest

from paylens.llm import jaccard_join


def words(rng, n):
    return [f"{rng.getrandbits(40):x}" for _ in range(n)]


def test_no_pair_is_lost_behind_a_shared_passage(spark):
    """Each pair has 80 of 100 shingles in common, 65 of them from the passage: 0.57 between pairs."""
    rng = random.Random(6)
    passage, rows = words(rng, 69), []
    for k in range(3000):
        common = words(rng, 15)
        for side in (0, 1):
            rows.append((2 * k + side, " ".join([*words(rng, 10), *passage, *common])))
    shingles = [jaccard_join.Shingler(5)(t) for _, t in rows[:2]]
    shared = len(np.intersect1d(*shingles))
    assert shared / (sum(map(len, shingles)) - shared) == .8
    across = len(np.intersect1d(shingles[0], jaccard_join.Shingler(5)(rows[2][1])))
    assert .5 < across / (2 * len(shingles[0]) - across) < .66
    found = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect()
    assert [r.doc_id for r in found if r.n_links != 1] == []
    assert all(r.class_id == r.doc_id // 2 * 2 for r in found)


def test_spanning_links_connect_what_all_pairs_connect():
    rng = np.random.default_rng(1)
    for split in (None, 20):
        sigs = rng.integers(0, 3, (50, 12)).astype(">u2")
        want = {(i, j) for i in range(50) for j in range(i + 1, 50) if (sigs[i] == sigs[j]).mean() >= .6
                and (split is None or i < split <= j)}
        got = jaccard_join.spanning_links(sigs, .6, split)
        assert set(got) <= want

        def roots(pairs):
            root = list(range(50))
            for _ in range(50):
                for a, b in pairs:
                    root[a] = root[b] = min(root[a], root[b])
            return root
        assert roots(got) == roots(want) and len(got) < 50


@pytest.mark.parametrize("block", [2, 7])
def test_blocks_of_a_mixed_node(spark, monkeypatch, block):
    monkeypatch.setattr(jaccard_join, "NODE_BLOCK", block)
    rng = random.Random(2)
    passage, rows = words(rng, 69), []
    for k in range(15):
        common = words(rng, 15)
        rows += [(2 * k + side, " ".join([*words(rng, 10), *passage, *common])) for side in (0, 1)]
    found = jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string"))
    assert all(r.n_links == 1 and r.class_id == r.doc_id // 2 * 2 for r in found.collect())
