"""Text, labels, evaluation and the board registry."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import replay
from checks.base import L, P, S, check, label_table, postings, rows, table
from paylens.functions import text
from paylens.operators import evaluate, groups, labels, mentions, quality
from paylens.sources import registry

PRIORITIES_BLANK = "4-NOT SPECIFIED"

# A small catalogue of words that the documents hold.
WORDS = {"Article": ["the", "der", "die", "la"], "And": ["und", "et", "and"], "Of": ["of", "de", "of the"],
         "Was": ["was", "is"], "Nope": ["zzzz"]}


def word_sql(column, name):
    edge = r"[^\p{L}\p{N}_]"
    names = "|".join([name.lower(), *WORDS[name]])
    return f"regexp_matches(lower({column}), '(^|{edge})({names})({edge}|$)')"


@check("strip_html", r"""
  SELECT page_id, trim(regexp_replace(regexp_replace(replace(replace(replace(replace(html, '&copy;', '©'), '&middot;', '·'),
    '&quot;', '"'), '&amp;', '&'), '<[^>]+>', ' ', 'g'), '\s+', ' ', 'g')) AS text FROM pages""")
def strip_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_html("html").alias("text"))


PART_WORDS = {"Economy": ["economy", "budget"], "Standard": ["promo"], "Size": ["small", "medium", "large"]}


@check("canonicalise", """
  SELECT CASE WHEN p_type IN ('ECONOMY') THEN 'Economy' WHEN p_type IN ('STANDARD', 'PROMO') THEN 'Standard'
    WHEN p_type IN ('SMALL', 'MEDIUM', 'LARGE') THEN 'Size' END AS name, count(*) AS n FROM part GROUP BY 1""")
def canonicalise(spark, sf):
    raw = F.concat(F.lit("\t "), F.initcap("p_type"), F.lit(" \u00a0\n"))
    return table(spark, sf, "part").groupBy(text.canonical(raw, PART_WORDS).alias("name")).agg(
        F.count(F.lit(1)).alias("n"))


@check("clean_labels", """
  SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN 'Economy' WHEN p_type IN ('STANDARD', 'PROMO') THEN 'Economy,Standard'
    ELSE 'Economy,Size' END AS names FROM part""")
def clean_labels(spark, sf):
    raw = F.array(F.lower("p_type"), F.lit("junk"), F.lit("BUDGET"), F.col("p_type"))
    return table(spark, sf, "part").select("p_partkey", F.array_join(text.clean_labels(raw, PART_WORDS), ",").alias("names"))


@check("literal_mentions", "\nUNION ALL ".join(
    f"SELECT doc_id, '{n}' AS label FROM documents WHERE {word_sql('text', n)}" for n in WORDS))
def literal_mentions(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(text.literal_mentions("text", WORDS)).alias("label"))


@check("mention_counts", "\nUNION ALL ".join(
    f"SELECT '{n}' AS label, count(*) FILTER ({word_sql('text', n)}) AS n FROM conversations" for n in WORDS))
def mention_counts(spark, sf):
    counts = table(spark, sf, "conversations").agg(*[F.count_if(text.mentions(n, "text", WORDS)).alias(n) for n in WORDS])
    return counts.unpivot([], list(WORDS), "label", "n")


# Names of three words, for every tenth item also of two, from the items of the benchmark.
NAMES = r"""w AS (SELECT item_id, regexp_extract_all(lower(text), '[a-z]+') AS ws FROM benchmark),
names AS (SELECT DISTINCT item_id AS label, unnest(list_concat(
  list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]),
  CASE WHEN item_id % 10 = 0 THEN list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) ELSE [] END)) AS name FROM w)"""


def benchmark_names(spark, sf):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), F.lit(0))

    def runs(n):
        return F.transform(F.sequence(F.lit(1), F.size("ws") - (n - 1)), lambda i: F.array_join(F.slice("ws", i, F.lit(n)), " "))
    w = table(spark, sf, "benchmark").select("item_id", words.alias("ws")).where(F.size("ws") > 2)
    pairs = F.when(F.col("item_id") % 10 == 0, runs(2)).otherwise(F.array().cast("array<string>"))
    return w.select(F.col("item_id").alias("label"), F.explode(F.concat(runs(3), pairs)).alias("name")).distinct()


@check("mention_join", rows(NAMES, r"""
t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}\p{M}_]+|[^\p{L}\p{N}\p{M}_]') AS t FROM documents),
g AS (SELECT doc_id, unnest(list_concat(list_transform(range(1, len(t) - 1), lambda i: array_to_string(t[i:i + 2], '')),
  list_transform(range(1, len(t) - 3), lambda i: array_to_string(t[i:i + 4], '')))) AS name FROM t)""",
                            select="SELECT DISTINCT doc_id, label FROM g JOIN names USING (name)"))
def mention_join(spark, sf):
    """Which documents mention a run of two or three words of which item."""
    return mentions.mention_join(table(spark, sf, "documents"), benchmark_names(spark, sf), "doc_id", "text")


def predicted():
    return F.when(F.col("lang") == "en", F.array(F.lit("Of"), F.lit("Nope"))).otherwise(
        F.array(F.lit("And"), F.lit("Article")))


@check("grounded_labels", rows("d AS (SELECT doc_id, text, unnest(CASE WHEN lang = 'en' THEN ['Of', 'Nope'] "
                               "ELSE ['And', 'Article'] END) AS label FROM documents)", select="""
  SELECT doc_id, label FROM d WHERE CASE label """ + " ".join(
    f"WHEN '{n}' THEN {word_sql('text', n)}" for n in WORDS) + " END"))
def grounded_labels(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(
        text.grounded(predicted(), "text", WORDS)).alias("label"))


@check("ungrounded_labels", rows("d AS (SELECT doc_id, text, unnest(CASE WHEN lang = 'en' THEN ['Of', 'Nope'] "
                                 "ELSE ['And', 'Article'] END) AS label FROM documents)", select="""
  SELECT doc_id, label FROM d WHERE NOT CASE label """ + " ".join(
    f"WHEN '{n}' THEN {word_sql('text', n)}" for n in WORDS) + " END"))
def ungrounded_labels(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.explode(
        text.ungrounded(predicted(), "text", WORDS)).alias("label"))


@check("implied_labels", rows(P, S, L, select="""
  SELECT job_uid, skill FROM l WHERE skill IS NOT NULL
  UNION SELECT job_uid, 'Brand#2' FROM l WHERE skill = 'Brand#1'
  UNION SELECT job_uid, unnest(['Brand#2', 'Brand#4']) FROM l WHERE skill = 'Brand#3'"""))
def implied_labels(spark, sf):
    implied = {"Brand#1": ["Brand#2"], "Brand#3": ["Brand#2", "Brand#4"]}
    sets = labels.label_sets(label_table(spark, sf))
    return sets.select("job_uid", F.explode(text.add_implied("items", implied)).alias("skill"))


# Queue over P and S: keys at version R are done, keys at an older version are stale.
QUEUE = """q AS (SELECT p.job_uid, p.source, n.job_uid IS NOT NULL AS stale, p.has_pay,
  CASE WHEN p.region = 'ASIA' THEN '' ELSE CAST(p.day AS VARCHAR) END AS published
  FROM p LEFT JOIN newest n ON p.job_uid = n.job_uid
  WHERE coalesce(n.v, '') <> 'R' AND p.seniority <> '4-NOT SPECIFIED'),
o AS (SELECT *, row_number() OVER (ORDER BY stale, has_pay DESC, CASE WHEN published = '' THEN '9' ELSE published END DESC,
  job_uid) AS k FROM q),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k) AS round, min(k) OVER (PARTITION BY source) AS first FROM o),
queue AS (SELECT *, row_number() OVER (ORDER BY round, first) AS position FROM r)"""


def queue_of(spark, sf, limit):
    p = postings(spark, sf).select(
        "job_uid", "source", "has_pay", F.col("job_uid").alias("ingest_seq"),
        F.when(F.col("seniority") == PRIORITIES_BLANK, " \n ").otherwise(F.col("company")).alias("description"),
        F.when(F.col("region") != "ASIA", F.col("day").cast("string")).alias("published_at_raw"))
    state = labels.cache_state(label_table(spark, sf), "R")
    return labels.label_queue(p, state.where("state = 'current'"), state.where("state = 'stale'"), limit, has_pay="has_pay")


@check("label_queue", rows(P, S, L, QUEUE, select="SELECT position, job_uid, source FROM queue WHERE position <= 5000"))
def label_queue(spark, sf):
    """The limit is the labelling budget of a day, 5,000 calls."""
    return queue_of(spark, sf, 5000).select("position", "job_uid", "source")


@check("label_queue_all", """
  WITH q AS (SELECT d.doc_id, source, text, coalesce(toxic = 1, false) AS stale, n_chars % 2 = 0 AS pay,
    CASE WHEN doc_id % 50 = 0 THEN 'x' ELSE CAST(doc_id * 7919 % 100000007 + 1000000000 AS VARCHAR) END AS published
    FROM documents d LEFT JOIN labels USING (doc_id) WHERE regexp_matches(text, '\\S') AND coalesce(quality, 1) = 1),
  o AS (SELECT *, row_number() OVER (ORDER BY stale, pay DESC, published DESC, doc_id) AS k FROM q),
  r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY k) AS round, min(k) OVER (PARTITION BY source) AS first FROM o)
  SELECT row_number() OVER (ORDER BY round, first) AS position, doc_id, source, md5(text) AS text_md5 FROM r""")
def label_queue_all(spark, sf):
    """Every document that waits, with its text, in turns over the sources; nearly all publish times differ, and some are
    unknown. Documents of low quality were processed, toxic ones are stale."""
    seen = table(spark, sf, "labels")
    d = table(spark, sf, "documents").select(
        "doc_id", "source", "text", (F.col("n_chars") % 2 == 0).alias("has_pay"),
        F.when(F.col("doc_id") % 50 != 0, (F.col("doc_id") * 7919 % 100000007 + 1000000000).cast("string")).alias("published"),
        F.col("doc_id").alias("ingest_seq"))
    queue = labels.label_queue(d, seen.where("quality <> 1"), seen.where("toxic = 1"), key="doc_id", description="text",
                               has_pay="has_pay", published="published")
    return queue.select("position", "doc_id", "source", F.md5(F.col("text").cast("binary")).alias("text_md5"))


@check("label_batches", rows(P, S, L, QUEUE, select="""
  SELECT CAST(floor((position - 1) / 10) AS BIGINT) AS batch, count(*) AS n, CAST(sum(job_uid) AS BIGINT) AS keys,
         CAST(max((position - 1) % 10) AS INT) AS last_id FROM queue WHERE position <= 5000 GROUP BY 1"""))
def label_batches(spark, sf):
    return labels.batches(queue_of(spark, sf, 5000)).groupBy("batch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("job_uid").alias("keys"), F.max("batch_id").alias("last_id"))


@check("capped_sample", """
  SELECT doc_id, source FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY h, doc_id) AS r FROM (
    SELECT doc_id, source, md5('42|' || doc_id) AS h FROM documents WHERE n_chars > 400)) WHERE r <= 9
  ORDER BY h, doc_id LIMIT 25""")
def capped_sample(spark, sf):
    d = table(spark, sf, "documents").where("n_chars > 400").select("doc_id", "source")
    return groups.capped_sample(d, "doc_id", "source", 9, 25, 42)


@check("distinct_sample", """
  SELECT doc_id, title FROM (SELECT *, row_number() OVER (PARTITION BY title ORDER BY h, doc_id) AS r FROM (
    SELECT doc_id, lang || '-' || source AS title, md5('7|' || doc_id) AS h FROM documents))
  WHERE r = 1 AND title NOT IN (SELECT 'en-' || source FROM documents) ORDER BY h, doc_id LIMIT 40""")
def distinct_sample(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.concat_ws("-", "lang", "source").alias("title"))
    held = table(spark, sf, "documents").select(F.concat(F.lit("en-"), F.col("source")).alias("title"))
    return groups.distinct_sample(d, "doc_id", "title", held, 40, 7)


def keyword_labeller(payload):
    """Stands in for a model: three keywords, no answer at all for a text that starts with an E."""
    words = {"the ": "golang", "der ": "SQL", " la ": "питон"}
    return {"items": [{"id": p["id"], "skills": [s for w, s in words.items() if w in p["text"]] + ["made up"]}
                      for p in payload if not p["text"].startswith("E")]}


@check("labeller_plugin", """
  SELECT doc_id, CASE WHEN contains(text, 'the ') THEN 'Go' END AS skill FROM documents
    WHERE NOT starts_with(text, 'E') AND contains(text, 'the ')
  UNION ALL SELECT doc_id, 'SQL' FROM documents WHERE NOT starts_with(text, 'E') AND contains(text, 'der ')
  UNION ALL SELECT doc_id, 'Python' FROM documents WHERE NOT starts_with(text, 'E') AND contains(text, ' la ')
  UNION ALL SELECT doc_id, NULL FROM documents WHERE NOT starts_with(text, 'E') AND NOT contains(text, 'the ')
    AND NOT contains(text, 'der ') AND NOT contains(text, ' la ')""")
def labeller_plugin(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.col("source").alias("title"), "text")
    done = labels.apply_labeller(d, keyword_labeller, "doc_id", text="text")
    return labels.label_rows(done, "v1", F.current_timestamp(), "model", "doc_id").select("doc_id", "skill")


def flaky_labeller(batch):
    """Fails on some documents, leaves others out of its reply, and finds nothing in the rest but for a few."""
    number = int(batch[0]["title"])
    if number % 11 == 0:
        raise ValueError("no answer")
    return {"items": [] if number % 7 == 0 else [{"id": 0, "skills": ["Go", "SQL"] if number % 5 == 0 else []}]}


@check("label_counters", """
  WITH s AS (SELECT CASE WHEN doc_id % 11 = 0 THEN 'failed' WHEN doc_id % 7 = 0 THEN 'omitted' WHEN doc_id % 5 = 0 THEN 'some'
    ELSE 'empty' END AS s FROM documents)
  SELECT count(*) AS label_queue, count(*) FILTER (s IN ('some', 'empty')) AS labelled,
    count(*) FILTER (s = 'empty') AS labelled_empty, count(*) FILTER (s = 'omitted') AS labels_omitted,
    count(*) FILTER (s = 'failed') AS labels_failed,
    CAST(2 * count(*) FILTER (s = 'some') + count(*) FILTER (s = 'empty') AS BIGINT) AS label_rows FROM s""")
def label_counters(spark, sf):
    """A labeller of the caller's own that fails, omits and answers, one document a call."""
    d = table(spark, sf, "documents").select("doc_id", F.col("doc_id").cast("string").alias("title"), "text")
    done = labels.apply_labeller(d, flaky_labeller, "doc_id", text="text", size=1, max_failures=10**9)
    return quality.label_counters(done)


@check("literal_labeller", "\nUNION ALL ".join(
    f"SELECT conv_id * 1000 + turn AS id, '{n}' AS label FROM conversations WHERE {word_sql('text', n)}"
    + (f" OR {word_sql('text', 'Of')}" if n == "Nope" else "") for n in WORDS))
def literal_labeller(spark, sf):
    c = table(spark, sf, "conversations").select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "role", "text")
    done = labels.literal_labeller(c, "id", "role", "text", WORDS, {"Of": ["Nope"]})
    return done.select("id", F.explode("labels").alias("label"))


# Gold: what the label table says; prediction: a rule on the documents.
GOLD = """g AS (SELECT d.doc_id, coalesce(quality, 0) = 1 AS gq, coalesce(toxic, 0) = 1 AS gt,
  n_chars > 1500 AS pq, lang IN ('de', 'fr') AS pt FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
c AS (SELECT doc_id, CAST(gq AND pq AS INT) + CAST(gt AND pt AS INT) AS tp,
  CAST(NOT gq AND pq AS INT) + CAST(NOT gt AND pt AS INT) AS fp,
  CAST(gq AND NOT pq AS INT) + CAST(gt AND NOT pt AS INT) AS fn FROM g)"""


def _flags(*pairs):
    return F.filter(F.array(*[F.when(c, F.lit(n)) for n, c in pairs]), lambda x: x.isNotNull())


def judged(spark, sf):
    gold = table(spark, sf, "labels").select(F.col("doc_id").alias("id"), _flags(
        ("quality", F.col("quality") == 1), ("toxic", F.col("toxic") == 1)).alias("expected"))
    pred = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), _flags(
        ("quality", F.col("n_chars") > 1500), ("toxic", F.col("lang").isin("de", "fr"))).alias("labels"))
    return pred, gold


@check("label_counts", rows(GOLD, select="SELECT doc_id AS id, tp, fp, fn FROM c"))
def label_counts(spark, sf):
    return evaluate.label_counts(*judged(spark, sf))


@check("micro_f1", rows(GOLD, select="""
  SELECT count(*) AS docs, CAST(sum(tp) AS BIGINT) AS tp, CAST(sum(fp) AS BIGINT) AS fp, CAST(sum(fn) AS BIGINT) AS fn,
         round(2.0 * sum(tp) / (2 * sum(tp) + sum(fp) + sum(fn)), 6) AS f1 FROM c"""))
def micro_f1(spark, sf):
    return evaluate.micro_f1(evaluate.label_counts(*judged(spark, sf))).withColumn("f1", F.round("f1", 6))


F1_NAME = "'11|' || st.rep || '|' || ks.tp || '|' || ks.fp || '|' || ks.fn || '|' || st.j"
F1_DRAWS = f"""ks AS (SELECT *, row_number() OVER (ORDER BY tp, fp, fn) AS k FROM (
  SELECT tp, fp, fn, count(*) AS n FROM c GROUP BY 1, 2, 3)),
t AS (SELECT CAST(sum(n) AS BIGINT) AS docs, max(k) AS k, CAST(sum(n * tp) AS BIGINT) AS tp, CAST(sum(n * fp) AS BIGINT) AS fp,
  CAST(sum(n * fn) AS BIGINT) AS fn FROM ks),
st AS (SELECT CAST(rep AS BIGINT) AS rep, CAST(1 AS BIGINT) AS k, CAST(0 AS BIGINT) AS j, docs AS n,
    CAST((SELECT n FROM ks WHERE k = 1) AS DOUBLE) / docs AS p, CAST(0 AS BIGINT) AS x, docs AS lft, docs AS weight,
    CAST(0 AS BIGINT) AS tp, CAST(0 AS BIGINT) AS fp, CAST(0 AS BIGINT) AS fn FROM t, (SELECT unnest(range(1000)) AS rep)
  UNION ALL
  SELECT rep, CASE WHEN n > 0 THEN k ELSE k + 1 END, CASE WHEN n > 0 THEN j + 1 ELSE 0 END,
    CAST(CASE WHEN n = 0 THEN lft - x WHEN b <= p THEN n - half ELSE half - 1 END AS BIGINT),
    CASE WHEN n = 0 THEN CAST(nxt AS DOUBLE) / (weight - kn) WHEN b <= p THEN least(1, (p - b) / (1 - b)) ELSE least(1, p / b) END,
    CAST(CASE WHEN n = 0 THEN 0 WHEN b <= p THEN x + half ELSE x END AS BIGINT), CASE WHEN n = 0 THEN lft - x ELSE lft END,
    CASE WHEN n = 0 THEN weight - kn ELSE weight END, CASE WHEN n = 0 THEN tp + x * ktp ELSE tp END,
    CASE WHEN n = 0 THEN fp + x * kfp ELSE fp END, CASE WHEN n = 0 THEN fn + x * kfn ELSE fn END
  FROM (SELECT st.*, (st.n + 1) // 2 AS half, ks.n AS kn, ks.tp AS ktp, ks.fp AS kfp, ks.fn AS kfn, nx.n AS nxt,
      CASE WHEN st.n > 0 THEN {replay.beta(F1_NAME, "(st.n + 1) // 2", "st.n + 1 - (st.n + 1) // 2")} END AS b
    FROM st JOIN ks ON ks.k = st.k LEFT JOIN ks nx ON nx.k = st.k + 1)),
f AS (SELECT list_sort(list(CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0 END)) AS l
  FROM st WHERE k = (SELECT k + 1 FROM t))"""


@check("micro_f1_bootstrap", rows(GOLD, F1_DRAWS, select="""
  SELECT docs, tp, fp, fn, round(2.0 * tp / (2 * tp + fp + fn), 6) AS f1, round(l[CAST(floor(0.025 * 999) AS INT) + 1], 6) AS ci_lo,
         round(l[CAST(floor(0.975 * 999) AS INT) + 1], 6) AS ci_hi, 2.0 * tp / (2 * tp + fp + fn) >= 0.75 AS accepted
  FROM t, f""").replace("WITH", "WITH RECURSIVE", 1))
def micro_f1_bootstrap(spark, sf):
    return evaluate.evaluate_labels(*judged(spark, sf)).withColumns({c: F.round(c, 6) for c in ("f1", "ci_lo", "ci_hi")})


# Boards: two orders share a board name that differs by case; line items are its postings.
PROBES = """b AS (SELECT o_orderpriority AS ats, CASE WHEN o_orderstatus = 'F' THEN 'BOARD-' ELSE 'board-' END
    || (o_orderkey // 2) AS slug, CASE WHEN o_orderstatus = 'P' THEN 404 ELSE 200 END AS http, o_orderkey FROM orders),
pr AS (SELECT b.ats, b.slug, http, CASE WHEN http = 200 THEN l_linenumber - 1 END AS pos,
  CASE p_type WHEN 'ECONOMY' THEN 'Berlin' WHEN 'PROMO' THEN 'Remote, NYC' ELSE 'Tokyo' END AS location
  FROM b LEFT JOIN lineitem ON l_orderkey = b.o_orderkey LEFT JOIN part ON p_partkey = l_partkey),
boards AS (SELECT ats, slug, max(http) AS http, count(pos) AS n_jobs,
  coalesce(bool_or(pos IS NOT NULL AND location = 'Berlin'), false) AS has_eu,
  coalesce(bool_or(pos IS NOT NULL AND location = 'Remote, NYC'), false) AS has_remote FROM pr GROUP BY 1, 2),
st AS (SELECT *, CASE WHEN http <> 200 THEN 'dead' WHEN n_jobs > 0 THEN 'active' ELSE 'empty' END AS status FROM boards),
reg AS (SELECT slug AS name, ats, slug, status, n_jobs, has_eu, has_remote FROM (SELECT *, row_number() OVER (
  PARTITION BY lower(slug) ORDER BY status <> 'active', ats, slug) AS r FROM st) WHERE r = 1)"""


def probes(spark, sf):
    o, li, p = (table(spark, sf, t) for t in ("orders", "lineitem", "part"))
    joined = o.join(li, F.col("o_orderkey") == F.col("l_orderkey"), "left").join(
        p, F.col("l_partkey") == F.col("p_partkey"), "left")
    http = F.when(F.col("o_orderstatus") == "P", 404).otherwise(200)
    name = F.concat(F.when(F.col("o_orderstatus") == "F", "BOARD-").otherwise("board-"), F.expr("o_orderkey div 2"))
    place = F.when(F.col("p_type") == "ECONOMY", "Berlin").when(F.col("p_type") == "PROMO", "Remote, NYC").otherwise("Tokyo")
    return joined.select(F.col("o_orderpriority").alias("ats"), name.alias("slug"), http.alias("http"),
                         F.when(http == 200, F.col("l_linenumber") - 1).alias("pos"), place.alias("location"))


@check("registry_status", rows(PROBES, select="SELECT * FROM reg"))
def registry_status(spark, sf):
    return registry.board_registry(probes(spark, sf))


@check("registry_summary", rows(PROBES, select="""
  SELECT ats, count(*) AS boards, count(*) FILTER (status = 'active') AS active, count(*) FILTER (status = 'empty') AS empty,
         count(*) FILTER (status = 'dead') AS dead,
         100 * count(*) FILTER (status = 'active' AND has_eu) // greatest(count(*) FILTER (status = 'active'), 1) AS eu_pct,
         100 * count(*) FILTER (status = 'active' AND has_remote) // greatest(count(*) FILTER (status = 'active'), 1) AS remote_pct,
         CAST(coalesce(sum(n_jobs) FILTER (status = 'active'), 0) AS BIGINT) AS jobs FROM reg GROUP BY ats"""))
def registry_summary(spark, sf):
    return registry.registry_summary(registry.board_registry(probes(spark, sf)))


@check("slug_filter", """
  SELECT p_brand AS ats, replace(lower(p_name), ' ', '-') || '-' || p_partkey AS slug FROM part t
  WHERE p_partkey < 1000 AND p_size >= 10""")
def slug_filter(spark, sf):
    """Four digits in a row look like an id; parts below size 10 are already known."""
    slug = F.concat(F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")), F.lit("-"), F.col("p_partkey").cast("string"))
    p = table(spark, sf, "part").select(F.col("p_brand").alias("ats"), slug.alias("slug"), "p_size")
    return registry.fresh_candidates(p.select("ats", "slug"), p.where("p_size < 10"))
