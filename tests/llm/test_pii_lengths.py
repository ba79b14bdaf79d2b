"""No parser of personal data has a length limit of its own, and all stay linear."""

import random
import time

import pytest
from pyspark.sql import functions as F

from paylens.llm import pii

LONG = [
    ("secret", "api_key = ", "a1" * 2500, " end"), ("secret", 'password: "', "Zx9_" * 1300, '" end'),
    ("login", "https://", "user:" + "p4s!" * 500, "@host.org/x"), ("login", "ftp://", "u" * 2000 + ":" + "x!" * 1000, "@h.de"),
    ("account", "account number ", "12345678" * 30, ""), ("account", "Kontonummer: ", "4711 " * 60 + "1", " x"),
    ("address", "at ", "12 " + "Long" * 100 + " Big Old Street", " now"), ("address", "", "Lang" * 90 + "straße 12", "."),
    ("address", "in ", "12 rue " + "Longue" * 80, ", ok"), ("address", "", "calle " + "Larga" * 70 + " 12", ""),
    ("account", "IBAN" + "\n" + " " * 300 + "\n" + "see ", "DE89 3704 0044 0532 0130 00", " BIC X"),
    ("account", "IBAN: " + "of the holder " * 30, "DE89370400440532013000", "\n"),
]


@pytest.mark.parametrize(("kind", "before", "value", "after"), LONG)
def test_whole_value_is_one_span(kind, before, value, after):
    found = [s for s in pii.find(before + value + after) if not s[3]]
    assert (kind, len(before), len(before) + len(value), False) in found


def test_redaction_leaves_nothing(spark):
    texts = [b + v + a for _, b, v, a in LONG]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = df.join(pii.find_spans(df), "doc_id").select("doc_id", pii.redact(F.col("text"), F.col("spans")).alias("text"))
    for r in out.collect():
        kind, before, value, after = LONG[r.doc_id]
        assert r.text == f"{before}<{kind}>{after}"


@pytest.mark.parametrize("unit", ["token=", "token = a1", "api_key:", "Street ", "A Street ", "Strasse", "Straße ", "rue A", "calle Larga ",
                                  "iban\n", "iban ", "IBAN DE89", "account ", "account 1", "://a:b", "://a:", "(at)", "a(at)b(dot)", "12 ", "1-", "1.1.",
                                  "a@", "a@b.", "+1 ", "Rue De La ", "x" * 50 + "straße 1 ", "1 A B C Street "])
def test_linear_time(unit):
    took = []
    for size in (100_000, 400_000):
        text = unit * (size // len(unit))
        start = time.process_time()
        pii.find(text)
        took.append(time.process_time() - start)
    assert took[1] < 12 * max(took[0], .05), took


def plain_secrets(text):
    """Cue by cue, without remembering anything."""
    out = []
    for cue in pii.SECRET_CUES:
        for form in {cue, cue.upper(), cue.capitalize(), cue.title()}:
            at = text.find(form)
            while at >= 0:
                if not (at and text[at - 1].isalnum()) and (m := pii._SECRET_TAIL.match(text, at + len(form))):
                    if any(c.isdigit() for c in m[1]):
                        out.append((m.start(1), m.end(1)))
                at = text.find(form, at + 1)
    kept, free = [], 0
    for s, e in sorted(set(out), key=lambda x: (x[0], -x[1])):
        if s >= free:
            kept.append((s, e))
            free = e
    return kept


def test_skipping_read_values_changes_nothing():
    rng = random.Random(3)
    parts = ["token", "=", ":", " ", "abc", "Password", "x1y2z3w4", "secret_", "api_key=", "\n", "'", "longword", "7"]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(25)))
        got = [(s, e) for kind, s, e, _ in pii.find(text) if kind == "secret"]
        others = [(s, e) for kind, s, e, _ in pii.find(text) if kind != "secret"]
        if not others:
            assert got == plain_secrets(text)
