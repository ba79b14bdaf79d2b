"""URL filter: pattern rules indexed by their rarest literal token.

Every rule is a regular expression over host and path, with the literal tokens that any matching URL must hold as whole
tokens. The rule is filed under the token that the fewest URLs hold. The tokens of a URL fetch candidate rules by an
equi-join, and only those run their expression. All of it is DataFrame functions.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paylens.llm.common import lower_ascii, pick

MAX_RULES = 100_000  # the rule list travels to every executor; more rules than this are refused


@dataclass(frozen=True)
class Rule:
    """``label`` names the rule; of matching rules the highest tier wins, then the longest label, then the first label."""

    label: str
    pattern: str
    tokens: tuple[str, ...]
    verdict: str
    tier: int = 0


def site_rule(verdict: str, site: str) -> Rule:
    """A rule like ``example.org/es/``: the host or any subdomain, and a path that starts with the rule's path."""
    host, slash, rest = site.partition("/")
    path = slash + rest
    whole = path[: path.rfind("/") + 1]  # the last segment is a prefix, so only those before it are whole tokens
    tokens = tuple(dict.fromkeys(t for t in re.split(r"[^0-9a-z]+", f"{host}{whole}".lower()) if t))
    return Rule(site, f"^([^/]*[.])?{re.escape(host)}{re.escape(path)}", tokens, verdict, tier=1)


def word_rule(verdict: str, word: str) -> Rule:
    """A rule for a whole token anywhere in host or path."""
    return Rule(f"*{word}*", f"(?i)(^|[^0-9a-z]){word}([^0-9a-z]|$)", (word,), verdict)


SITES = (site_rule("allow", "org/"), site_rule("block", "example.org/es/"), site_rule("block", "example.org/en/1"),
         site_rule("allow", "com/fr/"), site_rule("block", "com/de/"))
#: The method's own rules: whole tokens that name advertising, tracking, gambling and adult sites.
WORDS = tuple(word_rule("block", w) for w in (
    "adserver", "adclick", "doubleclick", "banner", "tracker", "pixel", "casino", "poker", "betting", "jackpot",
    "porn", "xxx", "escort", "viagra", "torrent", "warez", "phishing", "malware"))
DEFAULT = SITES + WORDS


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return lower_ascii(F.regexp_extract(_after(url), r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after(url), r"^[^/?#]*([^?#]*)", 1)


def _after(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def _tokens(target: Column) -> Column:
    """The distinct tokens of a URL; the empty token fetches rules that have no literal."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(lower_ascii(target), "[^0-9a-z]+")))


def rule_index(tokens: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """One row per rule, filed under its rarest token. ``tokens`` has one row per URL and token it holds; the counts are
    restricted to tokens of rules, so the index is no larger than the rule list."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules, at most {MAX_RULES}")
    spark = tokens.sparkSession
    filed = spark.createDataFrame(
        [(k, t, r.label, r.pattern, r.verdict, r.tier) for k, r in enumerate(rules) for t in r.tokens or ("",)],
        "rule_no int, token string, label string, pattern string, verdict string, tier int")
    counts = (tokens.join(F.broadcast(filed.select("token").distinct()), "token").groupBy("token")
              .agg(F.count("*").alias("n")))
    return (filed.join(counts, "token", "left").groupBy("rule_no")
            .agg(F.min_by(F.struct("token", "label", "pattern", "verdict", "tier"),
                          F.struct(F.coalesce("n", F.lit(0)), "token")).alias("r")).select("r.*"))


def judge(pages: DataFrame, rules: tuple[Rule, ...] = DEFAULT, id_col: str = "page_id", url_col: str = "url",
          default: str = "allow") -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, and matched (label of the rule that decided).

    ``rule`` is the label of a site rule, else null; the verdict is the deciding rule's, else ``default``. Null, empty
    and malformed URLs have empty host and path, match nothing and get ``default``. Repeated rows are all returned; equal
    URLs are judged once. Long URLs are read whole. Host names compare without case, paths with case, and a rule with
    the path ``/`` does not fit a URL without any path. An empty table gives an empty result; other columns are ignored.
    """
    pages = pick(pages, page_id=id_col, url=url_col).withColumn("url", F.coalesce("url", F.lit("")))
    urls = pages.select("url").distinct()
    held = urls.select("url", F.concat(host(F.col("url")), path(F.col("url"))).alias("target")).select(
        "url", "target", F.explode(_tokens(F.col("target"))).alias("token"))
    index = F.broadcast(rule_index(held.select("token"), rules))  # no larger than the rule list, at most MAX_RULES
    best = (held.join(index, "token").filter(F.rlike(F.col("target"), F.col("pattern"))).groupBy("url")
            .agg(F.min_by(F.struct("label", "verdict", "tier"),
                          F.struct(-F.col("tier"), -F.length("label"), "label")).alias("r")))
    return pages.join(best, "url", "left").select(
        "page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"),
        F.when(F.col("r.tier") == 1, F.col("r.label")).alias("rule"),
        F.coalesce("r.verdict", F.lit(default)).alias("verdict"), F.col("r.label").alias("matched"))


def judge_sql(rules: tuple[Rule, ...] = DEFAULT, default: str = "allow") -> str:
    """The same rows for DuckDB over a table ``pages``, every rule tried on every URL."""
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    values = ",\n".join(f"('{r.label}', '{r.pattern}', '{r.verdict}', {r.tier})" for r in rules)
    return f"""WITH rules(label, pattern, verdict, tier) AS (VALUES {values}),
u AS (SELECT page_id, row_number() OVER () AS k, CASE WHEN strpos(url, '://') > 0
        THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, k, {lower.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
        regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
hits AS (SELECT k, label, verdict, tier,
    row_number() OVER (PARTITION BY k ORDER BY tier DESC, length(label) DESC, label) AS place
  FROM p JOIN rules ON regexp_matches(host || path, pattern))
SELECT page_id, host, path, CASE WHEN tier = 1 THEN label END AS rule, coalesce(verdict, '{default}') AS verdict,
  label AS matched
FROM p LEFT JOIN hits ON p.k = hits.k AND place = 1"""
