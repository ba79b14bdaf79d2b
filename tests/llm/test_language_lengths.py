"""Words of any length are scored over all segmentations, and many languages fit."""

import math
import random

import numpy as np
import pytest

from paylens.llm import language_id

PIECES = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab", "aab", "bbbb"]


def plain(word, theta):
    """Log-probability and expected counts of one word by a sum over its cuts, with exact fractions of the total."""
    marked, number = "▁" + word, {p: k for k, p in enumerate(PIECES)}

    def edges(j):
        for k in range(1, 5):
            if k <= j:
                part = marked[j - k:j]
                if part in number:
                    yield j - k, number[part], math.log(theta[number[part]])
                elif k == 1:
                    yield j - 1, None, math.log(language_id.UNSEEN)

    def add(values):
        top = max(values)
        return top + math.log(sum(math.exp(v - top) for v in values))

    size, alpha = len(marked), [0.0]
    for j in range(1, size + 1):
        alpha.append(add([alpha[i] + p for i, _, p in edges(j)]))
    beta = [None] * size + [0.0]
    back = [[] for _ in range(size + 1)]
    for j in range(size, 0, -1):
        if j < size:
            beta[j] = add(back[j])
        for i, _, p in edges(j):
            back[i].append(p + beta[j])
    counts = np.zeros(len(PIECES))
    for j in range(1, size + 1):
        for i, piece, p in edges(j):
            if piece is not None:
                counts[piece] += math.exp(alpha[i] + p + beta[j] - alpha[size])
    return alpha[size], counts


@pytest.mark.parametrize("stretch", [7, 50, 1024])
def test_long_words_by_brute_force(monkeypatch, stretch):
    monkeypatch.setattr(language_id, "STRETCH", stretch)
    rng = random.Random(1)
    theta = np.random.default_rng(3).dirichlet(np.ones(len(PIECES)), 2).T
    lattice, probs = language_id.Lattice(PIECES), language_id.scaled(theta, PIECES)
    words = ["".join(rng.choice("aaabbbx") for _ in range(n)) for n in (1, 6, 7, 8, 13, 14, 200, 200, 200, 3000)]
    got = language_id.log_probs(words, lattice, probs)
    for word, row in zip(words, got, strict=True):
        assert row == pytest.approx([plain(word, theta[:, lang])[0] for lang in (0, 1)], rel=1e-9)
    lang, weight = np.array([k % 2 for k in range(len(words))]), np.arange(1.0, len(words) + 1)
    counts = language_id.expected_counts(words, weight, lang, lattice, probs)
    want = np.zeros((len(PIECES), 2))
    for word, own, w in zip(words, lang, weight, strict=True):
        want[:, own] += w * plain(word, theta[:, own])[1]
    assert counts == pytest.approx(want, rel=1e-6, abs=1e-9)


def test_languages_are_scored_in_blocks(monkeypatch):
    theta = np.random.default_rng(3).dirichlet(np.ones(len(PIECES)), 11).T
    lattice, probs = language_id.Lattice(PIECES), language_id.scaled(theta, PIECES)
    words = ["ab", "ba", "aabbbb" * 30]
    whole = language_id.log_probs(words, lattice, probs)
    monkeypatch.setattr(language_id, "VALUES", 20)
    assert language_id.log_probs(words, lattice, probs) == pytest.approx(whole)


def test_a_long_word_takes_linear_time_and_little_memory():
    lattice = language_id.Lattice(PIECES)
    probs = language_id.scaled(np.full((len(PIECES), 4), 1 / len(PIECES)), PIECES)
    assert np.isfinite(language_id.log_probs(["abx" * 10_000], lattice, probs)).all()


def test_sums_are_merged(monkeypatch):
    monkeypatch.setattr(language_id, "VALUES", 5)
    sums, rng, want = language_id.Sums(), np.random.default_rng(2), np.zeros(20)
    for _ in range(30):
        keys, values = rng.integers(0, 20, 4), rng.random(4)
        sums.add(keys, values)
        np.add.at(want, keys, values)
    keys, values = sums.merge()
    assert values == pytest.approx(want[keys]) and want.sum() == pytest.approx(values.sum())


def small_model(path):
    def field(number, wire, payload):
        return bytes([number << 3 | wire]) + (bytes([len(payload)]) + payload if wire == 2 else payload)

    pieces = ["<unk>", "▁", *"abcdefghijklmnopqrstuvwxyz"]
    path.write_bytes(b"".join(field(1, 2, field(1, 2, p.encode()) + (field(3, 0, b"\x02") if p == "<unk>" else b"")) for p in pieces))
    return str(path)


def test_fifteen_hundred_languages_fit(spark, tmp_path):
    rng, rows = random.Random(5), []
    for k in range(1500):
        own = rng.sample("abcdefghijklmnopqrstuvwxyz", 6)
        for _ in range(3):
            rows.append((len(rows), " ".join("".join(rng.choices(own, k=12)) for _ in range(20)), f"l{k:04}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    model = language_id.fit(docs, vocabulary_path=small_model(tmp_path / "small.model"), rounds=1)
    found = language_id.identify(docs.join(spark.createDataFrame([(x,) for x in model.languages], "lang string"), "lang"), model)
    right = found.join(docs, "doc_id").filter("lang = lang_pred").count()
    assert len(model.languages) > 1400 and right > 0.9 * found.count()
    with pytest.raises(ValueError, match="more than 100 languages"):
        language_id.fit(docs, max_languages=100)
