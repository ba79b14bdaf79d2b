import random

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from paylens.operators import evaluate as ev
from paylens.operators import groups, labels


def marks(spark, rows):
    return spark.createDataFrame(rows, "job_uid string, skill string, prompt_version string")


def test_newest_version_wins(spark):
    df = marks(spark, [("a", "Python", "v1"), ("a", "Go", "v2"), ("b", None, "v1"), ("c", "Go", "v9"), ("c", "C#", "v10"),
                       ("d", "Go", None), ("a", "Go", "v2")])
    assert {r.job_uid: r["items"] for r in labels.label_sets(df).collect()} == {"a": ["Go"], "b": [], "c": ["Go"]}
    number = F.substring("prompt_version", 2, 9).cast("int")
    assert {r.job_uid: r["items"] for r in labels.label_sets(df, rank=number).collect()}["c"] == ["C#"]
    assert {tuple(r) for r in labels.latest_labels(df).collect()} == {("a", "Go"), ("b", None), ("c", "Go")}
    state = {r.job_uid: r.state for r in labels.cache_state(df, "v2").collect()}
    assert state["a"] == "current" and state["b"] == "stale"


def queue_input(spark, rows):
    return spark.createDataFrame(rows, "job_uid string, source string, description string, has_salary boolean, "
                                       "published_at_raw string, ingest_seq int")


def test_queue_matches_ranks_in_sql(spark):
    rng = random.Random(9)
    rows = []
    for i in range(300):
        key = f"k{rng.randint(0, 220)}"
        rows.append((key, f"s{sum(map(ord, key)) % 4 // 2}", rng.choice(["text", "text", "  ", None]),
                     bool(rng.getrandbits(1)), rng.choice([None, "", "2026-01-01", "2026-01-02", "2026-01"]), i))
    done = {f"k{i}" for i in range(0, 220, 7)}
    old = {f"k{i}" for i in range(0, 220, 5)}
    con = duckdb.connect()
    posts = pd.DataFrame(rows, columns=["k", "source", "txt", "pay", "day", "seq"])  # noqa: F841  (read by DuckDB)
    done_, old_ = pd.DataFrame({"k": sorted(done)}), pd.DataFrame({"k": sorted(old)})  # noqa: F841
    want = [r[0] for r in con.execute("""
      WITH firsts AS (SELECT * FROM posts WHERE trim(coalesce(txt, '')) <> '' AND k NOT IN (SELECT k FROM done_)
        QUALIFY row_number() OVER (PARTITION BY k ORDER BY seq) = 1),
      ranked AS (SELECT *, rank() OVER (ORDER BY k IN (SELECT k FROM old_), NOT pay,
        CASE WHEN coalesce(day, '') = '' THEN 0 ELSE 1 END, rpad(coalesce(day, ''), 10, '~') DESC, seq) AS best FROM firsts),
      turns AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY best) AS turn,
        min(best) OVER (PARTITION BY source) AS lead FROM ranked)
      SELECT k FROM turns ORDER BY turn, lead""").fetchall()]
    assert len(want) > 80
    keys = lambda ks: spark.createDataFrame([(k,) for k in ks], "job_uid string")
    for limit in (None, 500, 25, 3):
        got = labels.label_queue(queue_input(spark, rows).repartition(5), keys(done), keys(old), limit).orderBy("position")
        found = got.collect()
        assert [r.job_uid for r in found] == want[:limit] and [r.position for r in found] == list(range(1, len(found) + 1))
    numbered = labels.batches(got.select("position")).collect()
    assert [(r.batch, r.batch_id) for r in sorted(numbered)] == [(0, 0), (0, 1), (0, 2)]


def test_labeller_contract(spark):
    df = spark.createDataFrame([(f"k{i}", "t" * 300, "x" * 5000 if i else "bad") for i in range(25)],
                               "job_uid string, title string, description string").coalesce(1)

    def call(payload):
        if any(p["text"] == "bad" for p in payload):
            raise RuntimeError("boom")
        assert len(payload) <= 10 and len(payload[0]["text"]) == 5000
        return {"items": [{"id": p["id"], "skills": ["react", "junk", "REACT"] if p["id"] else []}
                          for p in payload if p["id"] != 3]}

    answers = labels.apply_labeller(df, call).collect()
    assert sorted(r.status for r in answers) == ["failed"] * 10 + ["labelled"] * 13 + ["omitted"] * 2
    got = {r.job_uid: r.labels for r in answers if r.status == "labelled"}
    assert len(got) == 25 - 10 - 2 and got["k10"] == [] and got["k11"] == ["React"] and "k13" not in got
    rows = labels.label_rows(labels.apply_labeller(df, call), "v1", F.current_timestamp()).collect()
    assert sum(r.skill is None for r in rows) == 2 and {r.skill for r in rows} == {None, "React"}

    def short(payload):
        assert all(len(p["title"]) == 200 and len(p["text"]) <= 4000 for p in payload)
        return {"items": []}
    assert labels.apply_labeller(df, short, title_chars=200, text_chars=4000).where("labels IS NOT NULL").count() == 0
    with pytest.raises(Exception, match="boom"):
        labels.apply_labeller(df, call, size=1, max_failures=1).collect()


def test_tally(spark):
    df = marks(spark, [("a", "Go", "v1"), ("a", "C#", "v1"), ("b", None, "v1"), ("c", "Go", "v1")])
    assert tuple(labels.label_tally(df).first()) == (3, 3, 2, 0.667)
    assert [tuple(r) for r in labels.top_labels(df, 1).collect()] == [("Go", 2)]


def test_dictionary_and_samples(spark):
    names = [f"n{i}" for i in range(500)] * 3 + ["hot"] * 700
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, n string").repartition(7)
    got = {r.n: r.idx for r in groups.dictionary(df, "n").collect()}
    assert sorted(got.values()) == list(range(501))
    runs = [groups.capped_sample(df.repartition(k), "id", "n", 2, 25, 7).collect() for k in (1, 9)]
    assert runs[0] == runs[1] and len(runs[0]) == 25
    assert max(sum(r.n == x for r in runs[0]) for x in names) <= 2
    held = spark.createDataFrame([("hot",)], "n string")
    fresh = groups.distinct_sample(df, "id", "n", held, 600, 1).collect()
    assert len(fresh) == 500 and len({r.n for r in fresh}) == 500


def test_top_per_group_on_a_hot_group(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 10 = 0, 'cold', 'hot') g", "hash(id) v").repartition(6)
    got = groups.top_per_group(df, ["g"], "id", [F.col("v"), F.col("id")], 7, spread=16).collect()
    for g in ("hot", "cold"):
        want = sorted((r.v, r.id) for r in df.where(F.col("g") == g).collect())[:7]
        assert sorted((r.v, r.id) for r in got if r.g == g) == want


def test_f1_and_interval(spark):
    rng = random.Random(4)
    names = ["a", "b", "c", "d"]
    docs = [(i, rng.sample(names, rng.randint(0, 4)), rng.sample(names, rng.randint(0, 4))) for i in range(120)]
    gold = spark.createDataFrame([(i, e) for i, _, e in docs], "id int, expected array<string>")
    pred = spark.createDataFrame([(i, p) for i, p, _ in docs if i % 9], "id int, labels array<string>")
    counts = [(len(p & e), len(p - e), len(e - p)) for i, p, e in
              ((i, set(p) if i % 9 else set(), set(e)) for i, p, e in docs)]

    def f1(rows):
        tp, fp, fn = np.sum(rows, axis=0)
        return 2 * tp / (2 * tp + fp + fn)

    row = ev.evaluate_labels(pred, gold).first()
    assert row.docs == 120 and row.f1 == pytest.approx(f1(counts)) and row.accepted == (row.f1 >= .75)
    draw = np.random.default_rng(1)
    est = sorted(f1([counts[j] for j in draw.integers(0, 120, 120)]) for _ in range(2000))
    assert row.ci_lo == pytest.approx(est[50], abs=.015) and row.ci_hi == pytest.approx(est[1949], abs=.015)
    empty = ev.micro_f1(ev.label_counts(pred.limit(0), gold.limit(0))).first()
    assert empty.f1 == 0.0


def test_small_batches_still_make_full_calls(spark):
    """40 MB of texts in one task reach Python in many frames, and only the last call is short."""
    spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")

    def call(payload):
        return {"items": [{"id": p["id"], "skills": ["SQL" if len(payload) < 7 else "Go"]} for p in payload]}
    df = spark.range(0, 400, 1, 1).select(F.col("id").alias("job_uid"), F.lit("t").alias("title"),
                                          F.repeat(F.lit("x"), 100_000).alias("description"))
    found = labels.apply_labeller(df, call, size=7).select("job_uid", F.get("labels", F.lit(0)).alias("l")).collect()
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == "4m"
    assert sorted(r.job_uid for r in found) == list(range(400)) and [r.job_uid for r in found if r.l == "SQL"] == [399]
