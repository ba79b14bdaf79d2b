"""Fill-in-middle, SimHash anchors and lexical scan against brute force and round trips."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paylens.llm import fill_in_middle, lexical_scan, simhash_anchors

LINES = st.text(st.sampled_from("ab\n\n\r é🙂\x00\x89<>PSM"), max_size=60)


def plain_fim(doc_id, text):
    """The contract read off directly, over code points."""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    code = hashlib.sha256(f"7:{doc_id}".encode()).hexdigest()
    h = [int(code[k:k + 8], 16) for k in range(0, 32, 8)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return len(units), "plain", None, None, text
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    pre, mid, suf = ("".join(units[i:j]) for i, j in ((0, a), (a, b), (b, None)))
    form = "spm" if h[3] % 100 < 50 else "psm"
    out = f"<S>{suf}<P>{pre}<M>{mid}" if form == "spm" else f"<P>{pre}<S>{suf}<M>{mid}"
    return len(units), form, len(pre), len(mid), out


@settings(max_examples=400, deadline=None)
@given(st.integers(0, 10**9), LINES)
def test_fim_equals_the_plain_rule(doc_id, text):
    n, form, before, middle, out = fill_in_middle.split(str(doc_id), text.encode(), fill_in_middle.Layout())
    assert (n, form, before, middle, out.decode()) == plain_fim(doc_id, text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from("a\né🙂\x0b\x8a"), max_size=80), st.data())
def test_units_and_code_points(text, data):
    raw = text.encode()
    units = fill_in_middle.Units(raw)
    ends = [m.end() for m in re.finditer(rb"[^\n]*\n|[^\n]+", raw)]
    assert [units.end(k) for k in range(units.count + 1)] == [0, *ends]
    cuts = [len(text[:k].encode()) for k in range(len(text) + 1)]
    i, j = sorted((data.draw(st.integers(0, len(text))), data.draw(st.integers(0, len(text)))))
    assert units.chars(cuts[i], cuts[j]) == j - i


def test_fim_rows_are_rebuilt(spark):
    rng = random.Random(3)
    texts = ["", None, "no feed", "\n", "\n\n\n", "has <M> mark\nx", "<\n<P\n<S\nS>\n", "line\n" * 50_000, "é🙂" * 5000 + "\n"]
    texts += ["".join(rng.choice(["a", "\n", "ü", "<", "P>", "🙂 "]) for _ in range(rng.randrange(200))) for _ in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    made = fill_in_middle.transform(docs)
    got = {r.doc_id: r for r in made.withColumn("back", fill_in_middle.restored(F.col("output"), F.col("form"))).collect()}
    for k, text in enumerate(texts):
        r = got[k]
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plain_fim(k, text or "")
        assert r.back == (text or "")
    few = fill_in_middle.Layout(seed=1, rate=30, spm=0, prefix="[pre]", suffix="[suf]", middle="[mid]")
    some = fill_in_middle.transform(docs, layout=few)
    forms = Counter(r.form for r in some.collect())
    assert forms["spm"] == 0 and 0 < forms["psm"] < 40
    back = some.select("doc_id", fill_in_middle.restored(F.col("output"), F.col("form"), few).alias("back"))
    assert {r.doc_id: r.back for r in back.collect()} == {k: t or "" for k, t in enumerate(texts)}
    named = docs.select(F.concat(F.lit("d"), "doc_id").alias("key"), F.col("text").alias("body"))
    assert fill_in_middle.transform(named, "key", "body").filter("doc_id = 'd7'").count() == 1


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    size = min(3, len(words))
    h = [xxhash.xxh64_intdigest(" ".join(words[k:k + size]).encode(), 42) for k in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints(monkeypatch):
    rng = random.Random(5)
    texts = [None, "", " \t\n", "One", "One two", "one  TWO three", "Ä\x0bÖ\x0cÜ É", "a\xa0b c d"]
    texts += [" ".join(rng.choice(["A", "b", "çé", "dd"]) for _ in range(n)) for n in (3, 4, 10, 500, 3000)]
    want = [plain_fingerprint(t) for t in texts]
    assert [simhash_anchors.fingerprint(t) for t in texts] == want
    from paylens.llm import common
    monkeypatch.setattr(simhash_anchors, "pieces", lambda data, gap: common.pieces(data, gap, 7))
    assert [simhash_anchors.fingerprint(t) for t in texts] == want


@pytest.mark.parametrize("threshold", [0, 2])
def test_anchors_are_all_code_words_within_reach(threshold):
    every = np.arange(2**23, dtype=np.uint32)
    code = simhash_anchors.Anchors(simhash_anchors.RADIUS + threshold)
    words = every[code.syndrome(every) == 0].astype(np.uint64)
    assert len(words) == 2**12 and np.bitwise_count(words[1:]).min() == 7
    fps = np.random.default_rng(1).integers(0, 2**64, 4, np.uint64)
    fps[0] = 0
    row, anchor = code.near(fps)
    anchors = (words[:, None] | words[None, :] << np.uint64(23)).ravel()
    for k, fp in enumerate(fps):
        far = np.bitwise_count((fp & np.uint64(2**46 - 1)) ^ anchors)
        assert sorted(anchor[row == k].tolist()) == sorted(anchors[far <= code.reach].tolist())
        assert far[anchors == code.home(fps)[k]][0] == far.min() <= simhash_anchors.RADIUS


def test_links_are_exactly_the_close_pairs(spark):
    rng = random.Random(9)
    fps = {0, 2**64 - 1}
    for _ in range(150):
        x = rng.getrandbits(64)
        fps.add(x)
        for bits in (1, 2, 2, 3, 4):
            fps.add(x ^ sum(1 << b for b in rng.sample(range(64), bits)))
    dense = rng.getrandbits(64)
    fps |= {dense ^ (1 << a) ^ (1 << b) for a, b in itertools.combinations(range(0, 64, 4), 2)}
    signed = {x - 2**64 if x >= 2**63 else x: x for x in fps}
    classes = spark.createDataFrame([(s,) for s in signed], "fp long")
    want = {(min(a, b), max(a, b)) for a, b in itertools.combinations(signed, 2) if (signed[a] ^ signed[b]).bit_count() <= 2}
    got = [(r.a, r.b) for r in simhash_anchors.links(classes).collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_components_of_documents(spark):
    rng = random.Random(2)
    base = [[rng.choice("abcdefghij") * rng.randrange(1, 9) for _ in range(400)] for _ in range(12)]
    rows, texts = [], []
    for words in base:
        texts.append(" ".join(words))
        for at in (10, 100, 200, 399):
            texts.append(" ".join([*words[:at], "changed", *words[at + 1:]]))
    texts += texts[:7] + ["", None, "  "]
    rows = [(1000 - k, t) for k, t in enumerate(texts)]
    got = {r.doc_id: r for r in simhash_anchors.cluster(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    fps = {i: plain_fingerprint(t) for i, t in rows}
    root = {i: i for i in fps}
    for _ in fps:
        for a, b in itertools.combinations(fps, 2):
            if (fps[a] ^ fps[b]).bit_count() <= 2:
                root[a] = root[b] = min(root[a], root[b])
    assert {i: r.component_id for i, r in got.items()} == root
    assert {i: r.fingerprint for i, r in got.items()} == {i: f"{x:016x}" for i, x in fps.items()}
    assert len(set(root.values())) < len(rows) - 9
    near = {i: len({fps[j] for j in fps if 0 < (fps[i] ^ fps[j]).bit_count() <= 2}) for i in fps}
    assert {i: r.n_similar for i, r in got.items()} == near
    named = spark.createDataFrame([(f"d{k}", t) for k, t in enumerate(["a b c d", "a b c d", "x y z"])] + [(None, "a b c d")],
                                  "doc_id string, text string")
    found = sorted((str(r.doc_id), r.component_id, r.kept) for r in simhash_anchors.cluster(named).collect())
    assert found == [("None", "d0", False), ("d0", "d0", True), ("d1", "d0", False), ("d2", "d2", True)]
    assert simhash_anchors.keep_one(named).count() == 3


def plain_search(docs, items, k=10):
    def terms(text):
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)

    tfs = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in tfs), sum(c.total() for _, c in tfs)
    df = Counter(t for _, c in tfs for t in c)
    out = []
    for item, text in items:
        scores = []
        for key, c in tfs:
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                m = 100 - 90 + (90 * c.total() * n_docs) // n_terms
                score += w * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                scores.append((-score, key is None, key))
        out += [(item, r + 1, key, -s) for r, (s, _, key) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("max_pairs", [lexical_scan.MAX_PAIRS, 12])
def test_search_equals_brute_force(spark, monkeypatch, max_pairs):
    rng = random.Random(4)
    words = ["The", "the", "a", "é", "Éa", "b_c", "x1", "日本", "c-d", "q" * 30, "zz", "don't", "ß", "a.a.a"]
    docs = [(k, rng.choice([" ", "\n", "", "_"]).join(rng.choice(words) for _ in range(rng.randrange(40)))) for k in range(300)]
    docs += [(k, "tie tie breaker") for k in range(900, 930)] + [(None, "tie tie breaker"), (7, None), (8, ""), (9, "!?"), (900, "tie")]
    items = [(k, " ".join(rng.sample(words, rng.randrange(6)))) for k in range(12)]
    items += [(50, "TIE"), (51, ""), (52, None), (53, "nowhere"), (None, "zz zz"), (50, "TIE"), (54, "\x00 x1\x7fa")]
    given = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    asked = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.item_id, r["rank"], r.doc_id, r.score) for r in lexical_scan.search(given, asked, max_pairs=max_pairs).collect()]
    assert sorted(got, key=repr) == plain_search(docs, items)
    assert lexical_scan.search(given.limit(0), asked).count() == 0
    assert lexical_scan.search(given, asked.limit(0)).count() == 0


def test_scanner_cuts_long_texts_between_terms(monkeypatch):
    from paylens.llm import common
    text = "Ab ab  x" * 50 + "é" * 40 + " ab," + "y" * 33
    whole = lexical_scan.Scanner(["ab", "xab", "é" * 40, "y" * 33])(text)
    monkeypatch.setattr(lexical_scan, "pieces", lambda data, gap: common.pieces(data, gap, 5))
    assert lexical_scan.Scanner(["ab", "xab", "é" * 40, "y" * 33])(text) == whole
    assert whole[0] == len(re.findall(r"[^\W_]+", text))


def test_mix_of_rows_without_id_and_of_copies(spark):
    from paylens.llm import mixing
    rows = [(None, f"word{k} " * (k % 7 + 1), "a", k) for k in range(20_000)] + [(3, "one two three", "b", k) for k in range(60)]
    rows += [(3, "one two three", None, 99), (4, None, "b", 0), (5, "  ", "c", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").repartition(6)
    plan = mixing.mix(docs)
    taken = mixing.taken_words(plan)
    assert taken.count() == len(rows)
    per_source = {r.source_size: r.w for r in taken.groupBy("source_size").agg(F.sum("taken").alias("w")).collect()}
    out = mixing.mixed_rows(docs, plan)
    words = {r.source: r.w for r in out.groupBy("source").agg(F.sum(F.regexp_count("text", F.lit(r"\S+"))).alias("w")).collect()}
    assert words.get("a") == per_source[sum(k % 7 + 1 for k in range(20_000))]
    assert words.get("b") == per_source[180] and words.get(None) == per_source[3]
    assert out.filter("source = 'b'").select("extra").distinct().count() == 60
    spread = plan.rows.groupBy(F.xxhash64("doc_id", "tie") % 64).count().agg(F.max("count")).first()[0]
    assert spread < 1000  # windows are dealt by id and text, so rows without id are many tasks
