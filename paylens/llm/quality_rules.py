"""Quality rules with risk-controlled thresholds.

A rule rejects a text whose signal lies above a cutoff. Cutoffs come from a fixed list, per stratum and signal, and only
cutoffs that a labelled holdout certifies are eligible: the exact binomial (Clopper-Pearson) upper bound of the share of
good texts that the rule rejects must not exceed the rule's part of the allowed risk. Cutoffs of one rule are tested from
lax to strict up to the first failure, which needs no correction; the rules and strata share the error probability
(Bonferroni). So with probability 1 - ``delta`` no stratum loses more than ``risk`` of its good texts to the rules. Of
the certified cutoffs the rule takes that which catches most bad texts, less ``price`` times the good ones it costs.

Texts that fail the base rules (under 50 words, or more than half of the words in repeated 3-word windows) are rejected
before and take no part in the certification. Signals are counted in Arrow batches, one text at a time.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import WORD, pick, small_batches
from paylens.operators.sizes import materialise

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_caps", "n_bare")
#: Signals, each a share of two counts; more is worse.
SIGNALS = {"symbols": ("n_symbols", "word_chars"), "repeats": ("n_repeat_words", "n_words"),
           "dup_lines": ("n_dup_lines", "n_lines"), "caps": ("n_caps", "n_words"), "bare": ("n_bare", "n_words")}
#: Cutoffs from lax to strict.
CUTOFFS = (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.075, 0.05, 0.04, 0.03, 0.02, 0.01)
LANGUAGES = ("en", "fr", "de", "es")
LEAST_WORDS, MOST_REPEATS = 50, 50


@dataclass(frozen=True)
class Policy:
    strata: tuple[str, ...] = LANGUAGES  # values of the stratum column; all others, and null, form one more stratum
    risk: float = 0.05
    delta: float = 0.05
    price: float = 10.0
    cutoffs: tuple[float, ...] = CUTOFFS

    @property
    def tests(self) -> int:
        return (len(self.strata) + 1) * len(SIGNALS)


_WORD, _LOWER = re.compile(WORD), re.compile("[a-z]")
_UPPER, _MARKS = re.compile("[A-Z]"), re.compile(r"[!-/:-@\[-`{-~]+")


def repeated_words(words: list[str]) -> int:
    """Words in 3-word windows that occur twice or more, first occurrences included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[str, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    m = len(number)
    if m == n:
        return 0
    head = ids[:-2] * m + ids[1:-1]
    if m > 2_000_000:  # keep the packed key below 2**63
        head = np.unique(head, return_inverse=True)[1]
    _, where, often = np.unique(head * m + ids[2:], return_inverse=True, return_counts=True)
    again = often[where] > 1
    marked = np.zeros(n, bool)
    for shift in range(3):
        marked[shift:n - 2 + shift] |= again
    return int(marked.sum())


def count_text(text: str | None) -> tuple[int, ...]:
    """COUNTS of one text."""
    text = text or ""
    words = _WORD.findall(text)
    lines = [line for line in text.split("\n") if _WORD.search(line)]
    odd = [w for w in words if not _LOWER.search(w)]
    caps = sum(1 for w in odd if _UPPER.search(w))
    bare = sum(1 for w in odd if _MARKS.fullmatch(w))
    return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), caps, bare)


def _count_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for texts in batches:
        yield pd.DataFrame([count_text(t) for t in texts], columns=list(COUNTS), dtype="int64")


def counts(text: Column) -> Column:
    """The counts of a text as a struct of longs; a null text has none of anything."""
    udf = F.pandas_udf(_count_batches, ", ".join(f"{c} long" for c in COUNTS))
    return udf(text)


def _base_failed(c: Column) -> Column:
    return (c.n_words < LEAST_WORDS) | (c.n_repeat_words * 100 > c.n_words * MOST_REPEATS)


def _signal(c: Column, name: str) -> Column:
    top, bottom = SIGNALS[name]
    return F.coalesce(F.try_divide(c[top].cast("double"), c[bottom].cast("double")), F.lit(0.0))


def _stratum(value: Column, policy: Policy) -> Column:
    return F.when(value.isin(*policy.strata), value).otherwise(F.lit("*"))


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of n draws with chance p; the upper bound at level e is at most p exactly if this is at most e."""
    base = math.lgamma(n + 1)
    return sum(math.exp(base - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p))
               for i in range(k + 1))


def choose_cutoffs(tally: list[tuple[str, int, int, dict[str, list[int]], dict[str, list[int]]]], policy: Policy
                   ) -> dict[tuple[str, str], float]:
    """Cutoff by (stratum, signal), from (stratum, good, bad, good rejected by cutoff, bad rejected by cutoff)."""
    share, level = policy.risk / len(SIGNALS), policy.delta / policy.tests
    chosen = {}
    for stratum, good, bad, lost, caught in tally:
        for name in SIGNALS:
            best = 0.0
            for at, cutoff in enumerate(policy.cutoffs):
                k = lost[name][at]
                if k >= share * good or binomial_tail(k, good, share) > level:
                    break
                worth = caught[name][at] / bad - policy.price * k / good if bad else 0.0
                if worth > best:
                    best, chosen[stratum, name] = worth, cutoff
    return chosen


def certify(counted: DataFrame, labels: DataFrame, policy: Policy = Policy()) -> dict[tuple[str, str], float]:
    """Cutoffs by (stratum, signal) from labelled rows.

    ``counted`` has doc_id, stratum, digest and c (see ``counts``); ``labels`` has doc_id and quality (1 good, 0 bad, others
    and null ignored). The bounds hold for independent draws, so all labelled copies of a text in a stratum are one draw,
    a good one if any label says so. The result holds at most one number per stratum and signal, whatever the size of the tables. A stratum
    with too few good texts to certify anything gets no rule, as does a signal that catches nothing.
    """
    rows = (counted.filter(~_base_failed(F.col("c"))).join(labels.filter("quality IN (0, 1)"), "doc_id")
            .groupBy("stratum", "digest").agg(F.max("quality").alias("quality"), F.first("c").alias("c")).groupBy("stratum"))
    sums = [F.array(*[F.count_if((F.col("quality") == q) & (_signal(F.col("c"), name) > cutoff))
                      for cutoff in policy.cutoffs]).alias(f"{name}{q}") for name in SIGNALS for q in (0, 1)]
    tally = rows.agg(F.count_if(F.col("quality") == 1).alias("good"), F.count_if(F.col("quality") == 0).alias("bad"),
                     *sums).collect()  # one row per stratum of the policy
    return choose_cutoffs([(r.stratum, r.good, r.bad, {s: r[f"{s}1"] for s in SIGNALS},
                            {s: r[f"{s}0"] for s in SIGNALS}) for r in tally], policy)


def reasons(c: Column, stratum: Column, cutoffs: dict[tuple[str, str], float]) -> Column:
    """Names of the rules that reject a text."""
    fired = [F.when((stratum == F.lit(s)) & (_signal(c, name) > cutoff), F.lit(name))
             for (s, name), cutoff in sorted(cutoffs.items())]
    return F.array_compact(F.array(*fired)) if fired else F.array().cast("array<string>")


def _counted(docs: DataFrame, doc_id: str, text: str, stratum: str, policy: Policy) -> DataFrame:
    thin = small_batches(pick(docs, doc_id=doc_id, text=text, stratum=stratum))
    digest = F.md5(F.coalesce("text", F.lit("")).cast("binary"))
    return thin.select("doc_id", _stratum(F.col("stratum"), policy).alias("stratum"), digest.alias("digest"),
                       counts(F.col("text")).alias("c"))


def judge(docs: DataFrame, labels: DataFrame, policy: Policy = Policy(), doc_id: str = "doc_id", text: str = "text",
          stratum: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept, stratum and rules (those that reject it).

    A null or empty text has no words and fails the base. Whole texts are counted, however long. Repeated rows are each
    judged; if an id has several rows or labels, all combinations are looked at in the holdout, where copies of a text count
    once. A null id has no label. Without labels only the base rules hold. An empty table gives an empty result; other columns are ignored.
    """
    counted = materialise(_counted(docs, doc_id, text, stratum, policy))
    cutoffs = certify(counted, labels.select("doc_id", "quality"), policy)
    c = F.col("c")
    out = counted.select("doc_id", "stratum", "c.*", _base_failed(c).alias("base_failed"),
                         reasons(c, F.col("stratum"), cutoffs).alias("rules"))
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("rules") == 0))


def keep_good(docs: DataFrame, labels: DataFrame, policy: Policy = Policy(), doc_id: str = "doc_id",
              text: str = "text", stratum: str = "lang") -> DataFrame:
    """The rows of ``docs`` that pass, with all their columns. Texts are counted once for the certification and once
    for the verdict, so that they need not be shuffled."""
    cutoffs = certify(_counted(docs, doc_id, text, stratum, policy), labels.select("doc_id", "quality"), policy)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                         _stratum(F.col(f"`{stratum}`"), policy).alias("_stratum"), counts(F.col(f"`{text}`")).alias("_c"))
    c = F.col("_c")
    return packed.filter(~_base_failed(c) & (F.size(reasons(c, F.col("_stratum"), cutoffs)) == 0)).select("_row.*")


def judge_sql(policy: Policy = Policy()) -> str:
    """DuckDB SQL for ``judge`` over ``documents`` and ``labels``."""
    word, marks = "[^\\x20\\x09-\\x0D]+", "[!-/:-@\\[-`{-~]+"
    strata = ", ".join(f"'{s}'" for s in policy.strata)
    share = f"({policy.risk!r}::DOUBLE / {len(SIGNALS)})"
    names = ", ".join(f"'{s}'" for s in SIGNALS)
    values = ", ".join(f"coalesce({a}::DOUBLE / nullif({b}, 0), 0.0)" for a, b in SIGNALS.values())
    grid = ", ".join(f"({k}, {c!r}::DOUBLE)" for k, c in enumerate(policy.cutoffs))
    return f"""WITH d AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
    CASE WHEN lang IN ({strata}) THEN lang ELSE '*' END AS stratum, md5(coalesce(text, '')) AS digest FROM documents),
w AS (SELECT k, unnest(regexp_extract_all(text, '{word}')) AS w,
    generate_subscripts(regexp_extract_all(text, '{word}'), 1) AS i FROM d),
v AS (SELECT k, i, w, lead(w) OVER o AS w1, lead(w, 2) OVER o AS w2 FROM w WINDOW o AS (PARTITION BY k ORDER BY i)),
g AS (SELECT k, i, w, w2 IS NOT NULL AND count(*) OVER (PARTITION BY k, w, w1, w2) > 1 AS again FROM v),
h AS (SELECT k, w, again OR coalesce(lag(again) OVER o, false) OR coalesce(lag(again, 2) OVER o, false) AS rep
  FROM g WINDOW o AS (PARTITION BY k ORDER BY i)),
a AS (SELECT k, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars, count_if(rep)::BIGINT AS n_repeat_words,
    count_if(regexp_matches(w, '[A-Z]') AND NOT regexp_matches(w, '[a-z]'))::BIGINT AS n_caps,
    count_if(regexp_full_match(w, '{marks}'))::BIGINT AS n_bare FROM h GROUP BY k),
l AS (SELECT k, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{word}')) AS ls FROM d),
c AS (SELECT d.k, doc_id, stratum, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(ls)::BIGINT AS n_lines, coalesce(n_caps, 0) AS n_caps, coalesce(n_bare, 0) AS n_bare
  FROM d JOIN l ON d.k = l.k LEFT JOIN a ON d.k = a.k),
b AS (SELECT *, n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {MOST_REPEATS} * n_words AS base_failed FROM c),
s AS (SELECT k, doc_id, stratum, base_failed, unnest([{names}]) AS name, unnest([{values}]) AS value FROM b),
grid(place, cutoff) AS (VALUES {grid}),
y AS (SELECT b.stratum, digest, max(quality) AS quality, min(b.k) AS k FROM b JOIN d ON d.k = b.k
  JOIN labels l ON b.doc_id = l.doc_id AND quality IN (0, 1) WHERE NOT base_failed GROUP BY 1, 2),
t AS (SELECT s.stratum, name, place, cutoff, count_if(quality = 1) AS good, count_if(quality = 0) AS bad,
    count_if(quality = 1 AND value > cutoff) AS lost, count_if(quality = 0 AND value > cutoff) AS caught
  FROM s JOIN y ON s.k = y.k CROSS JOIN grid GROUP BY ALL),
p AS (SELECT *, lost < {share} * good AND list_sum(list_transform(range(lost::BIGINT + 1), lambda i:
    exp(lgamma(good + 1) - lgamma(i + 1) - lgamma(good - i + 1) + i * ln({share})
        + (good - i) * ln(1 - {share})))) <= {policy.delta!r}::DOUBLE / {policy.tests} AS sure FROM t WHERE good > 0),
e AS (SELECT *, bool_and(sure) OVER (PARTITION BY stratum, name ORDER BY place) AS certified,
    caught / bad - {policy.price!r}::DOUBLE * lost / good AS worth FROM p WHERE bad > 0),
cut AS (SELECT stratum, name, cutoff FROM e WHERE certified AND worth > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, name ORDER BY worth DESC, place) = 1),
r AS (SELECT k, list(name ORDER BY name) AS rules FROM s JOIN cut USING (stratum, name) WHERE value > cutoff GROUP BY k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_caps, n_bare, base_failed,
  NOT base_failed AND rules IS NULL AS kept, stratum, coalesce(array_to_string(rules, ','), '') AS rules
FROM b LEFT JOIN r USING (k)"""
