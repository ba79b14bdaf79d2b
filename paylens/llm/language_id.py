"""Language identification by segmentation-marginalised unigrams.

Every language has probabilities over the pieces of one fixed public vocabulary. The probability of a word is the sum,
over all ways to cut it into pieces, of the product of the piece probabilities; a forward pass over the word gives it
without listing the cuts. A text's score is the sum over its words, and the language with the highest score wins.

Piece probabilities are fitted by expectation maximisation: expected piece counts over all segmentations (forward and
backward pass), on word counts per language from a sample of labelled rows whose size is a parameter. Expectations are
taken in Spark tasks; only one number per language and piece reaches the driver. Words are lower-cased runs of letters
behind a word mark, of any length: those of over STRETCH letters, such as in scripts without spaces, are passed over stretch
by stretch, each handing on the values at its last characters, so every segmentation of the whole word counts. Languages
are scored in blocks, and a model takes about 0.2 MB a language in a task.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paylens.llm import spm_model
from paylens.llm.common import held_out, pick, small_batches
from paylens.operators.sizes import materialise

STRETCH = 1024
CELLS = 262_144  # characters of words that are looked up at once
VALUES = 4_000_000  # forward values held at once
CACHE_WORDS = 300_000
SCALE = 64.0  # per character; keeps products of small probabilities inside the range of doubles
UNSEEN = 1e-7  # probability of a character that is no piece; the same for every language, so it favours none
SMOOTHING = 0.01

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> list[str]:
    """Lower-case words; empty if no character is a letter."""
    found = _LETTERS.findall(text.lower()) if text else []
    if not any(c.isalpha() for w in found for c in w):
        return []
    return found


def vocabulary(path: str = spm_model.VOCABULARY) -> list[str]:
    """Lower-case letter pieces, with and without the word mark, in the file's order."""
    model = spm_model.read(path)
    plain = [p.lower() for p, t in zip(model.pieces, model.types, strict=True) if t == spm_model.NORMAL]
    kept = [p for p in plain if p == spm_model.MARK or p.removeprefix(spm_model.MARK).isalpha()]
    return list(dict.fromkeys(kept))


class Lattice:
    """The pieces of words: ids[w, j, k] is the piece that ends at character j and has k + 1 characters, or that of no
    piece (size of the vocabulary), which has probability 0, or UNSEEN for a single character. Substrings of all words
    are looked up at once by a 64-bit hash: first in a table of hash prefixes, then among the sorted hashes of pieces."""

    def __init__(self, pieces: list[str]) -> None:
        self.none, self.unseen = len(pieces), len(pieces) + 1
        rng = np.random.default_rng(7)
        self.width = max(map(len, pieces), default=1)
        self.factors = rng.integers(0, 2**63, self.width, np.uint64) * np.uint64(2) + np.uint64(1)
        self.lengths = rng.integers(0, 2**63, self.width, np.uint64)
        keys = np.empty(len(pieces), np.uint64)
        for k, piece in enumerate(pieces):
            chars = np.array([piece]).view(np.uint32).astype(np.uint64)[::-1]
            total = (chars * self.factors[:len(chars)]).sum(keepdims=True, dtype=np.uint64)
            keys[k] = self._mix(total, len(chars) - 1)[0]
        self.order = np.argsort(keys).astype(np.int32)
        self.keys = keys[self.order]
        self.filter = np.zeros(1 << 20, bool)
        self.filter[keys >> np.uint64(44)] = True

    def _mix(self, h, k: int):
        h = (h ^ self.lengths[k]) * np.uint64(0x9E3779B97F4A7C15)
        return (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)

    def ids(self, words: list[str]) -> np.ndarray:
        """Words of one length."""
        size = len(words[0])
        chars = np.array(words, f"U{size}").view(np.uint32).reshape(len(words), size).astype(np.uint64)
        out = np.full((len(words), size, self.width), self.none, np.int32)
        out[:, :, 0] = self.unseen
        h = np.zeros_like(chars)
        for k in range(min(self.width, size)):
            h = h[:, 1:] if k else h  # ends from character k on
            h = h + chars[:, :size - k] * self.factors[k]
            mixed = self._mix(h, k)
            word, end = np.nonzero(self.filter[mixed >> np.uint64(44)])
            found = mixed[word, end]
            place = np.minimum(np.searchsorted(self.keys, found), len(self.keys) - 1)
            right = self.keys[place] == found
            out[word[right], end[right] + k, k] = self.order[place[right]]
        return out


def by_length(words: list[str]) -> Iterator[np.ndarray]:
    """Places of the words of one length, at most CELLS characters at a time."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    for size in np.unique(sizes):
        places, most = np.flatnonzero(sizes == size), max(1, min(4096, CELLS // int(size)))
        for at in range(0, len(places), most):
            yield places[at:at + most]


def ends(ids: np.ndarray, none: int) -> tuple[list[list[tuple[int, np.ndarray]]], int]:
    """By character: (k, words) for each length k + 1 that some piece ending there has; and the longest length."""
    used = ids != none
    lengths = [[(k, np.flatnonzero(used[:, j, k])) for k in np.flatnonzero(some)] for j, some in enumerate(used.any(axis=0))]
    return lengths, max(k for at in lengths for k, _ in at) + 1


def forward(ids: np.ndarray, probs: np.ndarray) -> np.ndarray:
    """Log of the scaled probability of words, over (word, language). ``probs`` has scaled probabilities by piece and
    language; pieces of k + 1 characters are scaled by SCALE ** (k + 1). The values that later characters need are
    divided by the newest one at every character and the log of it is kept, so no run of unlikely letters reaches 0."""
    count, size, _ = ids.shape
    alpha = np.zeros((size + 1, count, probs.shape[1]))
    alpha[0] = 1
    log = np.zeros(alpha.shape[1:])
    lengths, width = ends(ids, len(probs) - 2)
    for j in range(size):
        for k, at in lengths[j]:
            alpha[j + 1, at] += alpha[j - k, at] * probs[ids[at, j, k]]
        by = np.where(alpha[j + 1] > 0, alpha[j + 1], 1)
        alpha[max(0, j + 2 - width):j + 2] /= by
        log += np.log(by)
    return np.where(alpha[size] > 0, log, -np.inf)


def stretches(words: list[str], lattice: Lattice) -> Iterator[tuple[int, np.ndarray]]:
    """(start, ids) of words of one length, STRETCH characters at a time."""
    for start in range(0, len(words[0]), STRETCH):
        left = max(0, start - lattice.width + 1)
        yield start, lattice.ids([w[left:start + STRETCH] for w in words])[:, start - left:]


def forward_long(words: list[str], lattice: Lattice, probs: np.ndarray) -> np.ndarray:
    """``forward`` over words of one length, holding only the values that later characters need, in a ring."""
    size, turn = len(words[0]), lattice.width + 1
    ring = np.zeros((turn, len(words), probs.shape[1]))
    ring[0] = 1
    log = np.zeros(ring.shape[1:])
    for start, ids in stretches(words, lattice):
        for j, lengths in enumerate(ends(ids, lattice.none)[0]):
            end, new = start + j + 1, np.zeros(log.shape)
            for k, at in lengths:
                new[at] += ring[(end - 1 - k) % turn, at] * probs[ids[at, j, k]]
            by = np.where(new > 0, new, 1)
            ring[end % turn] = new
            ring /= by
            log += np.log(by)
    return np.where(ring[size % turn] > 0, log, -np.inf)


def scaled(theta: np.ndarray, pieces: list[str]) -> np.ndarray:
    """Piece probabilities (piece x language) times SCALE per character, with rows for no piece and an unseen one."""
    sizes = np.array([len(p) for p in pieces], float)
    extra = np.zeros((2, theta.shape[1]))
    extra[1] = UNSEEN * SCALE
    return np.vstack([theta * SCALE ** sizes[:, None], extra])


def log_probs(words: list[str], lattice: Lattice, probs: np.ndarray) -> np.ndarray:
    """Log-probability of every word in every language, summed over all segmentations."""
    words = [spm_model.MARK + w for w in words]
    out = np.empty((len(words), probs.shape[1]))
    for places in by_length(words):
        some = [words[p] for p in places]
        size = len(some[0])
        ids = lattice.ids(some) if size <= STRETCH else None
        block = max(1, VALUES // (len(some) * (min(size, STRETCH) + 1)))
        for lo in range(0, probs.shape[1], block):
            now = probs[:, lo:lo + block]
            found = forward_long(some, lattice, now) if ids is None else forward(ids, now)
            out[places, lo:lo + block] = found - size * np.log(SCALE)
    return out


class Sums:
    """Sums by number, kept as long as the numbers that occur."""

    def __init__(self) -> None:
        self.keys, self.values, self.size = [], [], 0

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.keys.append(keys)
        self.values.append(values)
        self.size += len(keys)
        if self.size > VALUES:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.keys:
            return np.empty(0, np.int64), np.empty(0)
        keys, place = np.unique(np.concatenate(self.keys), return_inverse=True)
        values = np.bincount(place, np.concatenate(self.values), len(keys))
        self.keys, self.values, self.size = [keys], [values], 0  # the size counts what came since
        return keys, values


def add_expected(sums: Sums, words: list[str], weight: np.ndarray, lang: np.ndarray, lattice: Lattice, probs: np.ndarray
                 ) -> None:
    """Add the expected uses of every piece in words of known language, each counted ``weight`` times, by the number piece *
    languages + language; words without any probability have none.

    Forward values are normalised as in ``forward``. Divided by the value they sum to, the terms are the shares of the
    last piece's lengths, and going back they hand on the chance of a cut. Only the values at the start of each stretch
    are kept; the shares of a stretch are computed again on the way back.
    """
    words = [spm_model.MARK + w for w in words]
    langs, width = probs.shape[1], lattice.width
    turn = width + 1

    def shares(start: int, ids: np.ndarray, own: np.ndarray, ring: np.ndarray) -> tuple[np.ndarray, list]:
        """word x end x length; moves ``ring`` on."""
        last, lengths = np.zeros(ids.shape), ends(ids, lattice.none)[0]
        for j, some in enumerate(lengths):
            end, new = start + j + 1, np.zeros(len(own))
            for k, at in some:
                last[at, j, k] = ring[(end - 1 - k) % turn, at] * probs[ids[at, j, k], own[at]]
                new += last[:, j, k]
            by = np.where(new > 0, new, 1)
            last[:, j] /= by[:, None]
            ring[end % turn] = new
            ring /= by
        return last, lengths

    for places in by_length(words):
        some, own = [words[p] for p in places], lang[places]
        ring = np.zeros((turn, len(some)))
        ring[0] = 1
        kept = []
        for start, ids in stretches(some, lattice):
            kept.append((start, ids if len(some[0]) <= STRETCH else None, ring.copy()))
            last, lengths = shares(start, ids, own, ring)
        cut = np.zeros((turn, len(some)))  # at the last characters up to the end of the stretch
        cut[width] = weight[places] * (ring[len(some[0]) % turn] > 0)
        for start, ids, ring in reversed(kept):
            if ids is None:
                left = max(0, start - width + 1)
                ids = lattice.ids([w[left:start + STRETCH] for w in some])[:, start - left:]
                last, lengths = shares(start, ids, own, ring)
            size = ids.shape[1]
            chance = np.concatenate([np.zeros((size, len(some))), cut])  # from ``width`` characters before the stretch
            for j in reversed(range(size)):
                for k, at in lengths[j]:
                    use = chance[j + 1 + width, at] * last[at, j, k]
                    chance[j - k + width, at] += use
                    sums.add(ids[at, j, k].astype(np.int64) * langs + own[at], use)
            cut = chance[:turn]


def expected_counts(words: list[str], weight: np.ndarray, lang: np.ndarray, lattice: Lattice, probs: np.ndarray
                    ) -> np.ndarray:
    """The same as a whole table (piece x language)."""
    sums = Sums()
    add_expected(sums, words, weight, lang, lattice, probs)
    total = np.zeros(probs.size)
    keys, values = sums.merge()
    total[keys] = values
    return total.reshape(probs.shape)[:-2]


@dataclass
class LanguageModel:
    languages: list[str]
    pieces: list[str]
    theta: np.ndarray  # piece x language

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    """Scores texts; remembers the words it has seen, up to CACHE_WORDS."""

    def __init__(self, model: LanguageModel) -> None:
        self.languages, self.lattice = model.languages, Lattice(model.pieces)
        self.probs = scaled(model.theta, model.pieces)
        self.place: dict[str, int] = {}
        self.table = np.empty((0, len(model.languages)))

    def __call__(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if not self.languages:
            return [("und", 0.0)] * len(texts)
        counted = [Counter(words_of(t)) for t in texts]
        wanted = set().union(*counted)
        if len(self.place) > CACHE_WORDS:
            self.place.clear()
            self.table = self.table[:0]
        if new := [w for w in wanted if w not in self.place]:
            self.table = np.vstack([self.table, log_probs(new, self.lattice, self.probs)])
            self.place |= {w: len(self.place) + k for k, w in enumerate(new)}
        out = []
        for words in counted:
            if not words:
                out.append(("und", 0.0))
                continue
            at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
            score = np.fromiter(words.values(), float, len(words)) @ self.table[at]
            best = int(np.argmax(score))
            out.append((self.languages[best], float(1 / np.exp(score - score[best]).sum())))
        return out


def word_counts(rows: DataFrame, languages: list[str]) -> DataFrame:
    """(lang_no, word, n) over labelled texts; words are counted per batch first, then summed."""
    number = {name: k for k, name in enumerate(languages)}

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            totals: dict[int, Counter] = {}
            for lang, text in zip(batch.lang, batch.text, strict=True):
                totals.setdefault(number[lang], Counter()).update(words_of(text))
            yield pd.DataFrame([(k, w, n) for k, c in totals.items() for w, n in c.items()], columns=["lang_no", "word", "n"])

    return (rows.select("lang", "text").mapInPandas(count, "lang_no int, word string, n long")
            .groupBy("lang_no", "word").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", vocabulary_path: str =
        spm_model.VOCABULARY, docs_per_language: int = 3000, rounds: int = 3, max_languages: int = 10_000) -> LanguageModel:
    """Learn from rows with a language whose crc32(doc_id as text) mod 5 is not 0.

    At most about ``docs_per_language`` rows of each language are used: those whose id hashes below the share wanted.
    A column with more than ``max_languages`` values is refused, as it will not be one of languages; the model's size is
    8 bytes per piece and language, so the limit also bounds what is broadcast.
    """
    spark = docs.sparkSession
    pieces = vocabulary(vocabulary_path)
    rows = small_batches(pick(docs, doc_id=doc_id, text=text, lang=lang)).filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy("lang").limit(
        max_languages + 1).collect()}
    if len(sizes) > max_languages:
        raise ValueError(f"more than {max_languages} languages")
    languages = sorted(sizes)
    flat = np.full((len(pieces), max(1, len(languages))), 1 / len(pieces))
    if not languages:
        return LanguageModel([], pieces, flat)
    shares = [(name, int(1_000_000 * min(1.0, docs_per_language / sizes[name]))) for name in languages]
    wanted = F.broadcast(spark.createDataFrame(shares, "lang string, wanted int"))  # at most max_languages rows
    sampled = rows.join(wanted, "lang").filter(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("wanted"))
    counted = materialise(word_counts(sampled, languages))
    theta = flat
    for _ in range(rounds):
        theta = _maximise(_expect(spark, counted, pieces, theta), theta.shape)
    return LanguageModel(languages, pieces, theta)


def _expect(spark, counted: DataFrame, pieces: list[str], theta: np.ndarray) -> pd.DataFrame:
    sent = spark.sparkContext.broadcast((pieces, theta))

    def expect(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, now = sent.value
        lattice, probs, sums = Lattice(names), scaled(now, names), Sums()
        for batch in batches:
            if len(batch):
                add_expected(sums, list(batch.word), batch.n.to_numpy(float), batch.lang_no.to_numpy(np.int64), lattice, probs)
        keys, n = sums.merge()
        seen = keys < now.size
        yield pd.DataFrame({"piece": keys[seen] // now.shape[1], "lang_no": keys[seen] % now.shape[1], "n": n[seen]})

    return (counted.mapInPandas(expect, "piece int, lang_no int, n double").groupBy("piece", "lang_no")
            .agg(F.sum("n").alias("n")).toPandas())  # one number per piece of the vocabulary and language at most


def _maximise(counts: pd.DataFrame, shape: tuple[int, int]) -> np.ndarray:
    total = np.full(shape, SMOOTHING)
    total[counts.piece.to_numpy(np.int64), counts.lang_no.to_numpy(np.int64)] += counts.n.to_numpy(float)
    return total / total.sum(axis=0)


def identify(docs: DataFrame, model: LanguageModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score (posterior under equal priors).

    A text that is null, empty or has no letter is ``und`` with score 0, as is every text if no language was learned.
    Ties go to the first language by code point. Texts are read whole; repeated rows get the same answer; an empty table
    gives an empty result; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = sent.value.scorer()
        for texts in batches:
            parts = [x for at in range(0, len(texts), 256) for x in scorer(list(texts.iloc[at:at + 256]))]
            yield pd.DataFrame(parts, columns=["lang_pred", "score"])

    udf = F.pandas_udf(predict, "lang_pred string, score double")
    return small_batches(pick(docs, doc_id=doc_id, text=text)).select("doc_id", udf(F.col("text")).alias("p")).select("doc_id", "p.*")
