import html
import random
import re

from pyspark.sql import functions as F

from paylens.functions import dates, text, vocab


def test_strip_html(spark):
    cases = ["&lt;p&gt;A &amp; B&lt;/p&gt;", "<b>x</b> \n y", "a &#39;b&#x27; &eacute; &nosuch;", None, "",
             "&amp;mdash; <br/>", "plain"]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(text.strip_html("t")).collect()]
    want = [re.sub(r"\s+", " ", re.sub(r"<[^>]+>", " ", html.unescape(c or ""))).strip() for c in cases]
    assert got == want
    twice = df.where("i = 5").select(text.strip_html("t", unescape_passes=2)).first()[0]
    assert twice == "—"


def test_canonical_and_clean(spark):
    raw = ["питон", " REACT ", "pythonic", None, "c++", "K8S"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, t string")
    assert [r[0] for r in df.orderBy("i").select(text.canonical("t")).collect()] == [
        "Python", "React", None, None, "C++", "Kubernetes"]
    arrays = spark.createDataFrame([(["react", "python", "junk", "Python3"],), ([],), (None,)], "a array<string>")
    assert [r[0] for r in arrays.select(text.clean_labels("a")).collect()] == [["Python", "React"], [], None]


def test_implied(spark):
    df = spark.createDataFrame([(["Django", "SQL"],), (["Python", "Flask"],), ([],)], "a array<string>")
    assert [r[0] for r in df.select(text.add_implied("a")).collect()] == [
        ["Django", "Python", "SQL"], ["Flask", "Python"], []]


def python_mentions(label, hay):
    for name in (label, *vocab.SKILLS[label]):
        left = r"\b" if name[0].isalnum() else ""
        right = r"\b" if name[-1].isalnum() else ""
        if re.search(left + re.escape(name) + right, hay, re.I):
            return True
    return False


def test_literal_mentions_agree_with_one_search_per_label(spark):
    rng = random.Random(3)
    names = [n for k, a in vocab.SKILLS.items() for n in (k, *a)]
    glue = [" ", "", ", ", "-", "_", "/", ".", "é", "1"]
    texts = ["".join(rng.choice(names) + rng.choice(glue) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    texts += ["gitlab ci", "React Native app", "ASP.NET Core", "C++/C#", "my.net", "ВЁРСТКА", "1С:Предприятие", "rest."]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.m for r in df.select("i", text.literal_mentions("t").alias("m")).collect()}
    for i, t in enumerate(texts):
        assert got[i] == sorted(s for s in vocab.SKILLS if python_mentions(s, t)), t


def test_single_mention_and_grounding(spark):
    df = spark.createDataFrame([("We use C++ and helm", ["C++", "Kubernetes", "Go"])], "t string, a array<string>")
    row = df.select(text.mentions("C++", "t"), text.mentions("Go", "t"), text.grounded("a", "t"),
                    text.ungrounded("a", "t")).first()
    assert tuple(row) == (True, False, ["C++", "Kubernetes"], ["Go"])


def test_dates(spark):
    raw = ["2026-04-17T23:49:03-04:00", "2026-07-17T08:48:22Z", "2026-07-17", "2026-13-01", "soon", None, "",
           "2026-07-17T08:48:22.123+00:00", "2026-07-17T99:00:00Z"]
    df = spark.createDataFrame(list(enumerate(raw)), "i int, t string")
    got = [str(r[0]) if r[0] else None for r in df.orderBy("i").select(dates.publish_date("t")).collect()]
    assert got == ["2026-04-17", "2026-07-17", "2026-07-17", None, None, None, None, "2026-07-17", None]
    iso = spark.sql("select 1700000000123L a, 1700000000000L b, cast(null as bigint) c").select(
        dates.epoch_to_iso("a"), dates.epoch_to_iso("b"), dates.epoch_to_iso("c"),
        F.unix_millis(dates.epoch_to_timestamp("a"))).first()
    assert tuple(iso) == ("2023-11-14T22:13:20.123000+00:00", "2023-11-14T22:13:20+00:00", None, 1700000000123)
    assert spark.range(1).select(dates.today()).first()[0] is not None


def test_common_references_come_first_and_agree_with_the_standard(spark):
    from paylens.functions import entities
    assert all(html.unescape(f"&{n}") == text for n, text in entities.COMMON.items())
    texts = ["&lt;b&gt; &amp;amp; &quot;x&quot; &apos;&nbsp;|", "&ltx &amp &AMP; &Lt; &lt", "&#60;&#x3e; &notit; &unknown;"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(entities.unescape(F.col("t"))).collect()] == [html.unescape(t) for t in texts]
