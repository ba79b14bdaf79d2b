"""One query per operator over its whole table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
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
from paylens.llm.common import held_out

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query("op1_quality_rules", quality_rules.judge_sql())
def quality_rules_query(spark: SparkSession, sf: str) -> DataFrame:
    judged = quality_rules.judge(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.withColumn("rules", F.array_join("rules", ","))


@query("op2_exact_dedup", exact_dedup.mark_sql())
def exact_dedup_query(spark: SparkSession, sf: str) -> DataFrame:
    return exact_dedup.mark_duplicates(table(spark, sf, "documents"))


@query("op3_language_id")
def language_id_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = language_id.identify(docs, language_id.fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


@query("op4_pii_anchors")
def pii_query(spark: SparkSession, sf: str) -> DataFrame:
    def joined(spans: str) -> Column:
        return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")

    found = pii.find_spans(table(spark, sf, "documents")).withColumn("base", F.filter("spans", lambda s: s.base))
    counts = [F.expr(f"CAST(size(filter(base, s -> s.kind = '{kind}')) AS long) AS n_{kind}") for kind in pii.BASE]
    added = [F.expr(f"CAST(size(filter(spans, s -> NOT s.base AND s.kind = '{kind}')) AS long) AS n_{name}")
             for kind, name in (("account", "account"), ("address", "address"), ("secret", "secret"), ("login", "login"),
                                ("email", "masked_email"))]
    return found.select("doc_id", *counts, F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"),
                        joined("spans").alias("spans"), *added)


@query("op5_sentencepiece")
def sentencepiece_query(spark: SparkSession, sf: str) -> DataFrame:
    return sentencepiece_codec.encode(table(spark, sf, "documents"), sentencepiece_codec.load())


@query("op6_line_crf")
def line_crf_query(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    found = line_crf.score(docs, line_crf.fit(docs, table(spark, sf, "labels")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op7_prefix_chat")
def chat_query(spark: SparkSession, sf: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    formatted = chat.pieces(turns)
    return chat.digests(formatted, chat.examples(formatted))


@query("op8_jaccard_join")
def jaccard_join_query(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf, "documents"))


@query("op9_source_mix", mixing.taken_sql())
def source_mix_query(spark: SparkSession, sf: str) -> DataFrame:
    plan = mixing.mix(table(spark, sf, "documents"))
    return mixing.taken_words(plan).select("doc_id", "size", "source_size", "target", "taken")


@query("op10_url_filter", url_rules.judge_sql())
def url_filter_query(spark: SparkSession, sf: str) -> DataFrame:
    return url_rules.judge(table(spark, sf, "pages"))


@query("op11_fill_in_middle", fill_in_middle.digests_sql())
def fill_in_middle_query(spark: SparkSession, sf: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transform(table(spark, sf, "documents")))


@query("op12_simhash_anchors")
def simhash_anchors_query(spark: SparkSession, sf: str) -> DataFrame:
    return simhash_anchors.cluster(table(spark, sf, "documents")).select("doc_id", "fingerprint", "component_id")


@query("op13_lexical_scan", lexical_scan.search_sql())
def lexical_scan_query(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_scan.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
