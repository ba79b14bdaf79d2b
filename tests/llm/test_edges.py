"""Odd rows, clashing columns and empty tables for every operator."""

import pytest
from pyspark.sql import functions as F

from paylens.llm import (
    chat,
    exact_dedup,
    fill_in_middle,
    jaccard_join,
    language_id,
    lexical_scan,
    line_crf,
    mixing,
    pii,
    quality_rules,
    sentencepiece_codec,
    simhash_anchors,
    url_rules,
)

OPERATORS = {
    "rules": lambda d, y: quality_rules.judge(d, y),
    "rules kept": lambda d, y: quality_rules.keep_good(d, y).select(*d.columns[:5]),
    "dedup": lambda d, y: exact_dedup.mark_duplicates(d),
    "dedup kept": lambda d, y: exact_dedup.drop_duplicates(d).select(*d.columns[:5]),
    "language": lambda d, y: language_id.identify(d, language_id.fit(d, rounds=1)),
    "pii": lambda d, y: pii.find_spans(d),
    "encode": lambda d, y: sentencepiece_codec.encode(d, sentencepiece_codec.load()),
    "crf": lambda d, y: line_crf.score(d, line_crf.fit(d, y)),
    "jaccard": lambda d, y: jaccard_join.join(d),
    "jaccard kept": lambda d, y: jaccard_join.keep_one(d).select(*d.columns[:5]),
    "fim": lambda d, y: fill_in_middle.digests(fill_in_middle.transform(d)),
    "simhash": lambda d, y: simhash_anchors.cluster(d),
    "simhash kept": lambda d, y: simhash_anchors.keep_one(d).select(*d.columns[:5]),
    "search": lambda d, y: lexical_scan.search(d, d, item_id="doc_id"),
    "mix": lambda d, y: mixing.taken_words(mixing.mix(d)).drop("stretches"),
    "mix rows": lambda d, y: mixing.mixed_rows(d, mixing.mix(d)).select(*d.columns[:5]),
}
PER_ROW = set(OPERATORS) - {"rules kept", "dedup kept", "jaccard kept", "mix rows", "simhash kept", "search"}


def plain(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_clashing_columns_and_empty_tables(odd, crowded, labels, odd_rows, name):
    got = plain(OPERATORS[name](odd, labels))
    if name in PER_ROW:
        assert len(got) == len(odd_rows)
    assert got == plain(OPERATORS[name](crowded, labels))
    assert OPERATORS[name](odd.limit(0), labels.limit(0)).count() == 0


def test_pages(spark):
    rows = [(1, None, "x"), (2, "", None), (None, "https://a.org/x", ""), (3, "no scheme", ""), (3, "no scheme", ""),
            (4, "http://" + "a." * 5000 + "com/de/", ""), (5, "http://b.com/de/", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit(1)).withColumn(
        "token", F.lit(1))
    got = sorted((str(r.page_id), r.host[-5:], r.rule, r.verdict) for r in url_rules.judge(pages).collect())
    assert got == [("1", "", None, "allow"), ("2", "", None, "allow"), ("3", "", None, "allow"), ("3", "", None, "allow"),
                   ("4", "a.com", "com/de/", "block"), ("5", "b.com", "com/de/", "block"), ("None", "a.org", "org/", "allow")]
    assert url_rules.judge(pages.limit(0)).count() == 0


def test_turns(spark):
    rows = [(1, None, "user", "a"), (1, 0, None, None), (1, 0, "assistant", ""), (None, 5, "assistant", "x"), (2, 0, "user", "q"),
            (1, 0, "assistant", "")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("piece", F.lit(1))
    got = {r.conv_id: (r.n_turns, r.loss_chars, r.n_examples) for r in chat.digests(chat.pieces(turns)).collect()}
    assert got == {1: (4, 0, 2), None: (1, 1, 1), 2: (1, 0, 0)}
    assert chat.digests(chat.pieces(turns.limit(0))).count() == 0
