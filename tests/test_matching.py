"""HTML references against the standard library, and the mention join against the scan of the whole catalogue."""

import html
import random
import time
from html.entities import html5

from pyspark.sql import functions as F

from paylens.functions import text, vocab
from paylens.operators import mentions


def resolved(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(4)
    plan = df.select("i", text.unescape("t").alias("u"))
    return [r.u for r in plan.orderBy("i").collect()]


def test_every_named_reference(spark):
    texts = [f"a&{n}{after}" for name in html5 for n in {name, name.rstrip(";")} for after in ("", ";", "x;", " =", "1&lt")]
    assert resolved(spark, texts) == [html.unescape(t) for t in texts]


def test_numbers_and_odd_references(spark):
    codes = [*range(0, 300), 0xD7FF, 0xD800, 0xDFFF, 0xE000, 0xFDCF, 0xFDD0, 0xFDEF, 0xFDF0, 0xFFFD, 0xFFFE, 0xFFFF, 0x10000,
             0x1F642, 0x1FFFE, 0x10FFFD, 0x10FFFE, 0x10FFFF, 0x110000, 10**9, 2**40]
    texts = [f"x&#{c};y&#{c}" for c in codes] + [f"&#x{c:X};&#X{c:x}&#x000{c:x}z" for c in codes]
    texts += ["&#;", "&#x;", "&#xg", "& amp;", "&&amp;&", "&", "&amp", "", "no", "&notit;", "&notin;", "&" + "a" * 40, "&ampamp;lt;",
              "&#" + "0" * 30 + "65;", "&#" + "9" * 50 + ";", "&é;", "🙂&copy🙂", "&lt;p&gt;&amp;amp;", "&#13;\r", "&hellip&#8230;"]
    assert resolved(spark, texts) == [html.unescape(t) for t in texts]
    assert spark.createDataFrame([(None,)], "t string").select(text.unescape("t")).first()[0] is None


def test_random_references(spark):
    rng = random.Random(4)
    parts = ["&", "amp", ";", "lt", "not", "in", "#", "x", "12", "8364", "copy", " ", "<", "é", "euro", "acute", "frac12", "\n", "🙂"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(4000)]
    assert resolved(spark, texts) == [html.unescape(t) for t in texts]
    plan = spark.createDataFrame([("a",)], "t string").select(text.strip_html("t"))._jdf.queryExecution().toString()
    assert "Python" not in plan


def catalogue(spark, catalog):
    return spark.createDataFrame([(k, n) for k, names in catalog.items() for n in (k, *names)], "label string, name string")


def test_join_equals_the_scan(spark, monkeypatch):
    monkeypatch.setattr(mentions, "CHUNK", 7)
    rng = random.Random(3)
    names = [n for k, a in vocab.SKILLS.items() for n in (k, *a)]
    glue = [" ", "", ", ", "-", "_", "/", ".", "é", "1", "\n"]
    texts = ["".join(rng.choice(names) + rng.choice(glue) for _ in range(rng.randint(0, 25))) for _ in range(400)]
    texts += ["gitlab ci", "React Native app", "ASP.NET Core", "C++/C#", "my.net", "ВЁРСТКА", "1С:Предприятие", "rest.", None, ""]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, t string").repartition(3)
    want = {(r.id, r.m) for r in df.select("id", F.explode(text.literal_mentions("t")).alias("m")).collect()}
    got = mentions.mention_join(df, catalogue(spark, vocab.SKILLS), "id", "t").collect()
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    pred = spark.createDataFrame([(k, s) for k in range(len(texts)) for s in ("Go", "SQL")], "id int, label string")
    marked = mentions.grounded_labels(pred, df, catalogue(spark, vocab.SKILLS), "id", "t").collect()
    assert all(r.grounded == ((r.id, r.label) in want) for r in marked) and len(marked) == 2 * len(texts)
    assert mentions.mention_join(df, catalogue(spark, {}), "id", "t").count() == 0


def test_time_does_not_grow_with_the_catalogue(spark):
    rng = random.Random(7)
    words = [f"{rng.getrandbits(30):x}" for _ in range(3000)]
    texts = spark.createDataFrame([(k, " ".join(rng.choices(words, k=300))) for k in range(400)], "id int, t string").repartition(4)
    took = {}
    for size in (70, 70, 50_000):  # the first run warms up
        some = spark.createDataFrame([(f"l{k}", " ".join(rng.choices(words, k=2)) if k % 2 else f"{rng.getrandbits(40):x}q")
                                      for k in range(size)], "label string, name string").cache()
        some.count()
        start = time.perf_counter()
        found = mentions.mention_join(texts, some, "id", "t").count()
        took[size] = time.perf_counter() - start
    assert found > 100 and took[50_000] < 4 * took[70] + 2, took
