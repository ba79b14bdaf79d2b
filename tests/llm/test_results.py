"""Each operator against SQL, a brute-force formulation, an exact round trip or held-out accuracy."""

import hashlib
import math
import re
from collections import Counter
from itertools import combinations, product
from pathlib import Path

import duckdb
import numpy as np
import pytest
from conftest import prose

from pyspark.sql import functions as F

from paylens.llm import (
    chat,
    components,
    exact_dedup,
    jaccard_join,
    language_id,
    line_crf,
    mixing,
    pii,
    quality_rules,
    sentencepiece_codec,
    spm_model,
)
from paylens.llm.queries import QUERIES, SQL

DATA = Path("/root/testdata/sf0.001")
driver_tables = pytest.mark.skipif(not DATA.exists(), reason="no driver tables here")


def rows_of(columns, rows):
    places = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted(tuple(f"{r[k]:.6f}" if isinstance(r[k], float) else str(r[k]) for k in places) for r in rows)


@driver_tables
@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels", "pages", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{DATA}/{table}.parquet'")
    answer = con.execute(SQL[name])
    want = rows_of([d[0] for d in answer.description], answer.fetchall())
    df = QUERIES[name](spark, str(DATA))
    assert rows_of(df.columns, df.collect()) == want


def test_queries_cover_all_operators():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


# -- quality rules


def test_binomial_bound_and_fixed_sequence():
    exact = sum(math.comb(40, k) * 0.1**k * 0.9 ** (40 - k) for k in range(3))
    assert quality_rules.binomial_tail(2, 40, 0.1) == pytest.approx(exact)
    policy = quality_rules.Policy(strata=("en",), cutoffs=(0.9, 0.5, 0.1))
    none = {s: [0, 0, 0] for s in quality_rules.SIGNALS}
    lost = none | {"caps": [0, 3000, 0]}
    caught = none | {"caps": [10, 90, 99], "symbols": [5, 50, 50]}
    got = quality_rules.choose_cutoffs([("en", 10_000, 100, lost, caught), ("*", 50, 100, none, caught)], policy)
    assert got == {("en", "caps"): 0.9, ("en", "symbols"): 0.5}  # "*" has too few good texts to certify anything


def test_repeated_words():
    for seed in range(30):
        words = prose(seed, 60).replace("er", "").replace("ing", "").split()[: 5 + seed]
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        again = [windows[tuple(words[k:k + 3])] > 1 for k in range(max(0, len(words) - 2))]
        want = sum(any(again[max(0, k - 2):k + 1]) for k in range(len(words)))
        assert quality_rules.repeated_words(words) == want


# -- exact dedup


def test_dedup_in_many_runs(spark):
    texts = ["Hot"] * 400 + ["hOT"] * 200 + [f"t{k % 50}" for k in range(300)] + [None, ""]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(7)
    for keep, pick in (("largest", max), ("smallest", min)):
        for fan_in in (2, 3, 8):
            groups = {}
            for k, t in enumerate(texts):
                groups.setdefault((t or "").lower(), []).append(k)
            want = {k: (pick(g), len(g), k == pick(g)) for g in groups.values() for k in g}
            got = {r.doc_id: (r.keep_id, r.group_size, r.kept)
                   for r in exact_dedup.mark_duplicates(docs, keep=keep, fan_in=fan_in).collect()}
            assert got == want
    assert {r.doc_id for r in exact_dedup.drop_duplicates(docs).collect()} == {max(g) for g in groups.values()}


@pytest.mark.parametrize("fan_in", [2, 8])
def test_dedup_merges_sorted_runs(spark, fan_in):
    """Every level sorts its runs by digest, no hash of a digest places a row, and each text has one entry at the end."""
    rows = [(k if k % 9 else None, f"t{k % 40}" if k % 3 else "hot") for k in range(2000)]
    thin = exact_dedup.thin_entries(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), "doc_id", "text")
    entries = thin.select(*exact_dedup.KEY, F.col("doc_id").alias("best"), "tag", F.lit(1).cast("long").alias("n"),
                          F.pmod(F.shiftright("tag", 33), F.lit(fan_in**2)).cast("int").alias("run"))
    assert entries.select("run").distinct().count() > 1
    merged = exact_dedup.merge_runs(entries, fan_in, 2, [F.asc_nulls_first("best"), F.asc("tag")])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("shufflepartitionidpassthrough") == 3 and "hashpartitioning" not in plan
    assert plan.count("Sort [run") == 3 and "Aggregate" not in plan
    got = merged.collect()
    assert len(got) == len({r.sha for r in got}) == 41 and sum(r.n for r in got) == 2000
    want = {}
    for k, t in rows:
        want[t] = max(want.get(t, -1), -1 if k is None else k)
    assert sorted(r.best for r in got) == sorted(want.values())


def test_dedup_of_many_rows_without_id(spark):
    docs = spark.createDataFrame([(None, f"t{k % 3}") for k in range(900)] + [(5, "t1")], "doc_id long, text string").repartition(4)
    got = [(r.keep_id, r.group_size, r.kept) for r in exact_dedup.mark_duplicates(docs).collect()]
    assert sorted(Counter(got).items(), key=str) == sorted({
        (None, 300, False): 598, (None, 300, True): 2, (5, 301, False): 300, (5, 301, True): 1}.items(), key=str)
    assert sorted(str(r.doc_id) for r in exact_dedup.drop_duplicates(docs).collect()) == ["5", "None", "None"]


# -- language


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "ba", "▁ab"]
    theta = np.random.default_rng(3).dirichlet(np.ones(len(pieces)), 2).T
    number = {p: k for k, p in enumerate(pieces)}
    words = ["ab", "abab", "baab", "a"]
    got = language_id.log_probs(words, language_id.Lattice(pieces), language_id.scaled(theta, pieces))
    for word, row in zip(words, got, strict=True):
        marked, total = f"▁{word}", np.zeros(2)
        for cuts in product((False, True), repeat=len(marked) - 1):
            parts, part = [], marked[0]
            for cut, c in zip(cuts, marked[1:], strict=True):
                parts, part = (parts + [part], c) if cut else (parts, part + c)
            parts.append(part)
            if all(p in number for p in parts):
                total += np.prod([theta[number[p]] for p in parts], axis=0)
        assert row == pytest.approx(np.log(total))
    counts = language_id.expected_counts(["ab"], np.array([2.0]), np.array([0]), language_id.Lattice(pieces),
                                         language_id.scaled(theta, pieces))
    assert counts[:, 1].sum() == 0 and (counts[:, 0] @ [len(p) for p in pieces]) == pytest.approx(2 * len("▁ab"))


def test_long_runs_of_unknown_letters_keep_a_finite_score(spark):
    pieces = ["▁", "a", "b", "ab"]
    probs = language_id.scaled(np.array([[0.5, 0.3], [1e-9, 0.4], [0.3, 1e-9], [0.2, 0.3]]), pieces)
    lattice = language_id.Lattice(pieces)
    words = ["語" * 64, "b" * 64, "ab"]
    assert np.isfinite(language_id.log_probs(words, lattice, probs)).all()
    assert language_id.log_probs(words[:1], lattice, probs)[0] == pytest.approx(np.log([0.5, 0.3]) + 64 * np.log(language_id.UNSEEN))
    counts = language_id.expected_counts(words, np.array([3.0, 2.0, 0.0]), np.array([0, 1, 0]), lattice, probs)
    assert counts[:, 0] == pytest.approx([3, 0, 0, 0]) and counts[:, 1] == pytest.approx([2, 0, 128, 0])

    texts = [("hello there all", "en"), ("guten tag zusammen", "de")] * 20 + [("語" * 64, "en"), ("語" * 64 + " guten tag", None)]
    docs = spark.createDataFrame([(k, *r) for k, r in enumerate(texts)], "doc_id long, text string, lang string")
    model = language_id.fit(docs, rounds=2)
    assert np.isfinite(model.theta).all()
    got = {r.doc_id: r for r in language_id.identify(docs, model).collect()}
    assert all(0 <= r.score <= 1 for r in got.values()) and got[41].lang_pred == "de"


def test_long_pieces_count():
    long = "ab" * 6
    theta = np.array([[0.4], [0.2], [0.3], [0.1]])
    pieces = ["▁", "a", "b", long]
    got = language_id.log_probs([long], language_id.Lattice(pieces), language_id.scaled(theta, pieces))
    assert got[0, 0] == pytest.approx(np.log(0.4 * (0.1 + 0.2**6 * 0.3**6)))
    model = spm_model.read(spm_model.VOCABULARY)
    plain = {p.lower() for p, t in zip(model.pieces, model.types, strict=True) if t == spm_model.NORMAL}
    assert set(language_id.vocabulary()) == {p for p in plain if p == "▁" or p.removeprefix("▁").isalpha()}


@driver_tables
def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    found = QUERIES["op3_language_id"](spark, str(DATA)).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = [r.lang == r.lang_pred for r in found.collect()]
    assert len(right) > 20 and sum(right) >= 0.97 * len(right)


def test_languages_needs_letters(spark):
    docs = spark.createDataFrame([(k, t, "en") for k, t in enumerate(["hello there"] * 20 + ["12 34", None, "é"])],
                                 "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in language_id.identify(docs, language_id.fit(docs, rounds=1)).collect()}
    assert got[20] == got[21] == "und" and got[22] == got[0] == "en"


# -- personal data

KINDS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_by_regex(text):
    found = []
    for kind, pattern in KINDS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                    "card": 12 <= len(digits) <= 19 and pii.luhn(digits), "phone": 9 <= len(digits) <= 15}[kind]:
                found.append((kind, *m.span()))
    return sorted(found, key=lambda s: (s[1], list(KINDS).index(s[0])))


def test_base_spans_equal_the_patterns():
    rng = np.random.default_rng(5)
    parts = ["@", "a", "b1", ".", "com", "-", "+", "1", "23", " ", "(", ")", "4000000000000002", "192.168.1.1", "255", "٣", "é",
             "x@y.z", "\n", "%", "0", "00", "token = ", "account "]
    for size in rng.integers(1, 30, 4000):
        text = "".join(rng.choice(parts, size))
        assert [s[:3] for s in pii.find(text) if s[3]] == base_by_regex(text)


@pytest.mark.parametrize(("text", "want"), [
    ("pay to IBAN DE89 3704 0044 0532 0130 00 now", [("account", "DE89 3704 0044 0532 0130 00")]),
    ("IBAN DE89 3704 0044 0532 0130 01 is wrong", []),
    ("Account number: 12345678.", [("account", "12345678")]),
    ("live at 12 Long Street since", [("address", "12 Long Street")]),
    ("in der Lange Straße 7b wohnt", [("address", "Lange Straße 7b")]),
    ("the street is long and the token of love", []),
    ("TOKEN = \"9233A8ECF7C5B09F\" x", [("secret", "9233A8ECF7C5B09F")]),
    ("write to jo.do (at) mail (dot) org", [("email", "jo.do (at) mail (dot) org")]),
    ("see ftp://user:pw1@host/x", [("login", "user:pw1")])])
def test_added_spans(text, want):
    assert [(s[0], text[s[1]:s[2]]) for s in pii.find(text) if not s[3]] == want


@pytest.mark.parametrize(("text", "want"), [
    ("IBAN DE89370400440532013000 BIC COBADEFFXXX", ["DE89370400440532013000"]),
    ("IBAN: DE89 3704 0044 0532 0130 00 BIC COBADEFF", ["DE89 3704 0044 0532 0130 00"]),
    ("IBAN: DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32",
     ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"]),
    ("IBAN BIC XY12ABCDEFGHIJK, GB82WEST12345698765432 OK", ["GB82WEST12345698765432"]),
    ("IBAN of the account that the yearly membership fee is taken from: GB82 WEST 1234 5698 7654 32", ["GB82 WEST 1234 5698 7654 32"]),
    ("IBAN:\nDE89 3704 0044 0532 0130 00\n", ["DE89 3704 0044 0532 0130 00"]),
    ("IBAN " * 3 + "DE89 3704 0044 0532 0130 00", ["DE89 3704 0044 0532 0130 00"]),
    ("IBAN DE89 3704 0044 0532 0130 01 BIC COBADEFF", []), ("IBAN DE89370400440532013000BIC", []), ("IBAN DE89", [])])
def test_ibans_with_text_around(text, want):
    assert [text[s[1]:s[2]] for s in pii.find(text) if s[0] == "account"] == want


def test_redaction(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd or +1 (555) 555-1234 é"), (2, "nothing"), (3, None)], "doc_id long, text string")
    got = docs.select("doc_id", pii.redact(docs.text, pii.spans(docs.text)).alias("t")).orderBy("doc_id").collect()
    assert [r.t for r in got] == ["mail <email> or <phone> é", "nothing", None]


# -- SentencePiece


def test_encoding_equals_the_library():
    codec = sentencepiece_codec.load()
    coder, whole = codec.open(), sentencepiece_codec.build(codec.model)
    rng = np.random.default_rng(8)
    parts = ["a", "aa", " ", "  ", "\n", "é", "日本", "🙂", "<s>", "</s>", "<0x41>", "\t", "-", "==", " the", "hello", "\x00", "ﬁ"]
    texts = ["", " ", "x" * 5000, prose(3, 500)] + ["".join(rng.choice(parts, n)) for n in rng.integers(0, 25, 800)]
    for text, (ids, parity) in zip(texts, coder.encode(texts), strict=True):
        assert ids.tolist() == coder.exact.encode(text)
        assert coder.decode(ids) == text and coder.decode(ids) == whole.decode(ids.tolist(), skip_special_tokens=False)
        assert not parity or text.strip(" ") == "" or whole.encode(text, add_special_tokens=False).ids == ids.tolist()


def test_unigram_model_with_normaliser():
    """A hand-made unigram model: the parsed file, the tokenizers model and the library agree."""
    def field(number, wire, payload):
        return bytes([number << 3 | wire]) + (bytes([len(payload)]) + payload if wire == 2 else payload)

    scores = {"<unk>": 0, "▁": -2.0, "a": -2.5, "b": -2.6, "ab": -3.0, "▁a": -2.2, "▁ab": -3.5, "ba": -4.0}
    proto = b"".join(field(1, 2, field(1, 2, p.encode()) + field(2, 5, np.float32(s).tobytes())
                     + (field(3, 0, b"\x02") if p == "<unk>" else b"")) for p, s in scores.items())
    proto += field(2, 2, field(3, 0, b"\x01")) + field(3, 2, field(1, 2, b"identity") + field(3, 0, b"\x01") + field(4, 0, b"\x01"))
    model = spm_model.parse(proto)
    assert model.model_type == spm_model.UNIGRAM and model.unk_id == 0 and model.remove_extra_whitespaces
    coder = sentencepiece_codec.Coder(sentencepiece_codec.Codec(proto, model))
    texts = ["ab", "a b  ab", " aabb ", "baba ab", "", "  "]
    for text, (ids, parity) in zip(texts, coder.encode(texts), strict=True):
        assert parity and ids.tolist() == coder.exact.encode(text)
        assert coder.decode(ids) == re.sub(" +", " ", text.strip())


# -- line CRF


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(4)
    scores, trans = [rng.normal(size=n) for n in (5, 3, 1)], rng.normal(size=4)
    found, pairs, z = line_crf.marginals(scores, trans)
    total = np.zeros((2, 2))
    for s, good, logz in zip(scores, found, z, strict=True):
        weight = {y: math.exp(s @ y + sum(trans[2 * a + b] for a, b in zip(y, y[1:], strict=False)))
                  for y in product((0, 1), repeat=len(s))}
        mass = sum(weight.values())
        assert logz == pytest.approx(math.log(mass))
        assert good == pytest.approx([sum(w for y, w in weight.items() if y[k]) / mass for k in range(len(s))])
        for y, w in weight.items():
            for a, b in zip(y, y[1:], strict=False):
                total[a, b] += w / mass
    assert pairs == pytest.approx(total)


def test_crf_learns_junk_lines():
    good = [f"{prose(k, 60)}.\n{prose(k + 1, 40)}." for k in range(60)]
    bad = [f"{prose(k, 9)}.\n" + " | ".join(prose(k + 7, 50).split()) for k in range(60)]
    parts = [line_crf.line_features(t) for t in good[:40] + bad[:40]]
    model = line_crf.train(parts, np.array([1] * 40 + [0] * 40))
    held = model.scores([line_crf.line_features(t) for t in good[40:] + bad[40:]])
    assert held[:20].min() > 0.7 and held[20:].max() < 0.3
    assert (model.scores([line_crf.line_features(None)] * 3) > 0).all()


def test_lines_are_labelled(spark):
    bad = " | ".join(prose(3, 40).split())
    docs = spark.createDataFrame([(1, f"{prose(1, 40)}.\n{bad}"), (2, None), (None, "a\n\nb")], "doc_id long, text string")
    parts = [line_crf.line_features(t) for t in [f"{prose(k, 40)}." for k in range(40)] + [bad] * 40]
    model = line_crf.train(parts, np.array([1] * 40 + [0] * 40))
    got = {(r.doc_id, r.line): (r.chars, r.good) for r in line_crf.label_lines(docs, model).collect()}
    assert sorted(got, key=str) == sorted([(1, 0), (1, 1), (2, 0), (None, 0), (None, 1), (None, 2)], key=str)
    assert got[1, 1][0] == len(bad) and got[1, 0][1] > got[1, 1][1] and got[None, 1][0] == 0


# -- chat


@driver_tables
def test_chat_digests_against_plain_python(spark):
    turns = spark.read.parquet(f"{DATA}/conversations.parquet")
    said = r"\### Assistant: </turn> ok"
    rows = [(r.conv_id, r.turn, r.role, r.text or "") for r in turns.collect()] + [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    want = {}
    for conv, _, role, text in sorted(rows):
        n, full, loss = want.get(conv, (0, "", ""))
        want[conv] = (n + 1, full + f"{role}\n{text}\n", loss + text * (role == "assistant"))
    got = {r.conv_id: r for r in QUERIES["op7_prefix_chat"](spark, str(DATA)).collect()}
    assert set(got) == set(want)
    for conv, (n, full, loss) in want.items():
        r = got[conv]
        assert (r.n_turns, r.loss_chars) == (n, len(loss))
        assert r.turns_sha256 == hashlib.sha256(full.encode()).hexdigest()
        assert r.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_examples_are_prefixes_with_one_trainable_reply(spark, monkeypatch):
    monkeypatch.setattr(chat, "SLICE", 3)
    nasty = ["####", "</turn>\n### Assistant:\n", "\\", "\\\\#", "</", "<", "a#\\#", "", "/turn>"]
    rows = [(1, k, ("user", "assistant")[k % 2], nasty[k % len(nasty)]) for k in range(20)]
    formatted = chat.pieces(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    whole = "".join(r.piece for r in formatted.orderBy("place").collect())
    picked = chat.examples(formatted)
    spans = {r.place: r for r in picked.collect()}
    assert sorted(spans) == list(range(1, 20, 2))
    for r in chat.example_texts(formatted, picked).collect():
        assert r.text == whole[:spans[r.place].end] and r.text[r.target_end:] == chat.CLOSE
        target = r.text[r.target_start:r.target_end]
        assert re.sub(r"(?s)\\(.)", r"\1", target) == rows[r.place][3]
        assert whole.count(chat.CLOSE) == len(rows)


def test_digests_come_from_the_examples(spark):
    rows = [("c", 0, "user", "hi"), ("c", 1, "assistant", "yes"), ("c", 2, "user", "more"), ("c", 3, "assistant", "##no"),
            ("", 0, "assistant", "x"), (None, 0, "assistant", "y"), ("c", 4, "a:\nb", "t"), ("c", 5, "a:\n", "b:\nt"), ("c", 6, ":", "\n")]
    formatted = chat.pieces(spark.createDataFrame(rows, "conv_id string, turn long, role string, text string"))
    made = chat.examples(formatted)
    got = {r.conv_id: r for r in chat.digests(formatted, made).collect()}
    full = "".join(f"{role}\n{text}\n" for c, _, role, text in rows if c == "c")
    assert got["c"].turns_sha256 == hashlib.sha256(full.encode()).hexdigest()
    assert got["c"].loss_sha256 == hashlib.sha256(b"yes##no").hexdigest() and got["c"].n_examples == 2
    assert (got[""].loss_chars, got[None].loss_chars) == (1, 1)
    for broken in (made.withColumn("context_end", F.col("context_end") - 1), made.withColumn("target_end", F.col("target_end") - 1),
                   made.withColumn("target_start", F.col("target_start") + 1), made.filter("place <> 1"),
                   made.withColumn("end", F.col("end") + 1)):
        other = {r.conv_id: r for r in chat.digests(formatted, broken).collect()}["c"]
        assert other.loss_sha256 != got["c"].loss_sha256 and other.turns_sha256 == got["c"].turns_sha256


def test_text_ids(spark):
    """Ids need not be numbers."""
    long = " ".join(f"w{k}" for k in range(60))
    docs = spark.createDataFrame([(f"d{k}", t, "s") for k, t in enumerate([long, long + " end", "other words here", None])],
                                 "doc_id string, text string, source string")
    joined = {r.doc_id: (r.class_id, r.n_links) for r in jaccard_join.join(docs).collect()}
    assert joined == {"d0": ("d0", 1), "d1": ("d0", 1), "d2": ("d2", 0), "d3": ("d3", 0)}
    coded = sentencepiece_codec.encode(docs, sentencepiece_codec.load())
    assert {r.doc_id: r.text for r in sentencepiece_codec.decode(coded, sentencepiece_codec.load()).collect()}["d2"] == "other words here"
    y = docs.select("doc_id", F.lit(1).alias("quality"))
    assert line_crf.score(docs, line_crf.fit(docs, y)).count() == 4


# -- Jaccard join


def test_depth():
    assert jaccard_join.forest_depth(18, 6, 0.8, 0.9999) == 4
    with pytest.raises(ValueError, match="cannot reach"):
        jaccard_join.forest_depth(2, 6, 0.8, 0.9999)


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 60)] + [(100, 90), (90, 95), (200, 201), (201, 200), (300, 300)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | dict.fromkeys((90, 95, 100), 90) | dict.fromkeys((200, 201), 200)


def test_links_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 7)
    rng = np.random.default_rng(6)
    texts, base = [], prose(50, 150).split()
    for _ in range(60):  # one large group of near copies, edited in up to three places
        words = list(base)
        for at in rng.integers(0, 150, rng.integers(0, 4)):
            words[at] = f"w{rng.integers(9)}"
        texts.append(" ".join(words))
    texts += [prose(k, 120) for k in range(10)] + [texts[0]] * 5 + ["short text", "short text", "short", "", None, prose(9, 120)]
    sets = []
    for t in texts:
        w = (t or "").split()
        sets.append({tuple(w[k:k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set()))
    links, root = [0] * len(texts), list(range(len(texts)))
    for a, b in combinations(range(len(texts)), 2):
        if sets[a] and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
            links[a], links[b] = links[a] + 1, links[b] + 1
            root = [min(root[a], root[b]) if r in (root[a], root[b]) else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in jaccard_join.join(docs).collect()}
    assert [got[k].n_links for k in range(len(texts))] == links
    assert [got[k].class_id for k in range(len(texts))] == root
    assert {r.doc_id for r in jaccard_join.keep_one(docs).collect()} == set(root)


def test_links_are_counted_once_when_blocks_are_empty(spark, monkeypatch):
    """Few long texts: blocks follow the number of shingles, so most of them have no class."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 40)
    near = {k: [prose(1000 + k, 150) + end for end in (" one", " two", " six")[:2 + k % 2]] for k in range(8)}
    rows = [(10 * k + no, text) for k, texts in near.items() for no, text in enumerate(texts)]
    got = {r.doc_id: r for r in jaccard_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: (r.n_links, r.class_id) for d, r in got.items()} == {d: (len(near[d // 10]) - 1, d // 10 * 10) for d, _ in rows}


# -- mixing


def test_targets_and_taken_words(spark):
    sizes = {"a": 40, "b": 4000, "c": 9000, None: 300}
    rows = [(k, prose(k, 20), s) for s, n in sizes.items() for k in range(n // 20)]
    rows = [(k, text, s) for k, (_, text, s) in enumerate(rows)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    plan = mixing.mix(docs, block_words=16)
    target = {r.source: r.target for r in plan.sources.collect()}
    # weights 5, 2, 1, 5: "a" and null stop at three times their size, the rest goes 2 : 1 to "b" and "c"
    left = sum(sizes.values()) - 3 * 40 - 3 * 300
    assert target == pytest.approx({"a": 120, None: 900, "b": left * 2 / 3, "c": left / 3})
    taken = Counter()
    source = {k: s for k, _, s in rows}
    for r in mixing.taken_words(plan).collect():
        assert r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] += r.taken
    for s, want in target.items():
        assert abs(taken[s] - want) <= max(8 * 16, 0.05 * want)
    mixed = mixing.mixed_rows(docs, plan).collect()
    assert sum(len(r.text.split()) for r in mixed) == sum(taken.values())
    text = {k: t for k, t, _ in rows}
    assert all(r.text.strip() in text[r.doc_id] for r in mixed)
    again = mixing.taken_words(mixing.mix(docs.repartition(2), block_words=16)).drop("stretches").collect()
    assert sorted(map(repr, again)) == sorted(map(repr, mixing.taken_words(plan).drop("stretches").collect()))


def test_schedule_keeps_shares_in_every_stretch(spark):
    docs = spark.createDataFrame([(k, prose(k, 50), "ab"[k % 2]) for k in range(200)], "doc_id long, text string, source string")
    slots = mixing.mix(docs, block_words=10).schedule.orderBy("slot").collect()
    share = sum(s.source_no == 1 for s in slots) / len(slots)
    for at in range(0, len(slots) - 100, 100):
        assert abs(sum(s.source_no == 1 for s in slots[at:at + 100]) - 100 * share) <= 4


# -- pipeline


@driver_tables
def test_pipeline_stages_against_their_own_input(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, str(DATA)).collect(), docs.schema)
        assert docs.columns == columns, name
        sizes.append(docs.count())
    assert sizes[0] >= sizes[1] >= sizes[2] > 0
    out = corpus_pipeline.run(spark, str(DATA))
    assert out.count() == sizes[3] and out.filter("NOT round_trip OR NOT parity").count() == 0
