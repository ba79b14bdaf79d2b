import json

import pytest
from pyspark.sql import functions as F

from paylens.operators import history, quality
from paylens.plans import jobs
from paylens.sources import boards, gold, rates, registry
from paylens.streaming.ingest import stream_ingest

GREENHOUSE = {"jobs": [
    {"id": 11, "title": "Backend Engineer II", "location": {"name": "Remote, Berlin"},
     "content": "&lt;p&gt;Python &amp;amp; Go. Salary range: &lt;b&gt;$150,000 - $190,000&lt;/b&gt;&lt;/p&gt;",
     "first_published": "2026-04-17T23:58:03-04:00", "updated_at": "2026-06-30T12:00:00-04:00",
     "absolute_url": "https://x/11", "departments": [{"id": 1, "name": "Eng"}]},
    {"id": 11, "title": "Backend Engineer II (copy)", "location": {"name": "Paris"}, "content": "none",
     "updated_at": "2026-06-30T12:00:00-04:00"},
    {"id": 12, "title": "Account Executive", "location": None, "content": None, "departments": []}]}
LEVER = [{"id": "aa", "text": "Senior Data Engineer", "categories": {"commitment": "Full-time", "location": "NYC",
          "team": "Data"}, "createdAt": 1700000000000, "descriptionPlain": "Spark and Kafka", "workplaceType": "hybrid",
          "salaryRange": {"min": 150000, "max": 180000, "currency": "USD", "interval": "per-year-salary"},
          "hostedUrl": "https://x/aa"},
         {"id": "bb", "text": "Staff ML Engineer", "categories": None, "createdAt": None, "descriptionPlain": "  ",
          "workplaceType": "Remote"}]
ASHBY = {"jobs": [
    {"id": "z1", "title": "Software Engineer", "location": "London", "isRemote": True, "department": "R&D",
     "publishedAt": "2026-07-01T00:00:00.000+00:00", "descriptionPlain": "Nothing listed", "employmentType": "FullTime",
     "compensation": {"compensationTiers": [{"components": [
         {"compensationType": "Salary", "interval": "1 YEAR", "currencyCode": "GBP", "minValue": 80000,
          "maxValue": 96000}]}]}}]}


def land(root, source, company, doc, name="a.json"):
    path = root / f"source={source}" / f"company={company}"
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(json.dumps(doc))


@pytest.fixture
def landing(tmp_path):
    root = tmp_path / "landing"
    land(root, "greenhouse", "007", GREENHOUSE)
    land(root, "lever", "acme", LEVER)
    land(root, "lever", "empty", [])
    land(root, "ashby", "linea", ASHBY)
    land(root, "ashby", "broken", "not a board")
    return root


@pytest.fixture
def fx(spark):
    return spark.createDataFrame([("USD", 1.0), ("GBP", 0.8)], "currency string, per_usd double")


def test_readers(spark, landing):
    firsts = boards.read_postings(spark, str(landing)).where("ingest_seq.place != 1 or source != 'greenhouse'")
    got = {r.job_id: r for r in firsts.collect()}
    assert set(got) == {"11", "12", "aa", "bb", "z1"}
    g, lv, a = got["11"], got["aa"], got["z1"]
    assert (g.company, g.is_remote, g.department, g.published_at_raw) == ("007", True, "Eng", "2026-04-17T23:58:03-04:00")
    assert g.description == "Python &amp; Go. Salary range: $150,000 - $190,000"
    assert (lv.location_raw, lv.is_remote, lv.employment_type) == ("NYC", False, "Full-time")
    assert lv.published_at_raw == "2023-11-14T22:13:20+00:00" and got["bb"].is_remote and got["bb"].location_raw == ""
    assert a.is_remote and a.tier_pay.compensationTiers[0].components[0].maxValue == 96000
    assert boards.read_greenhouse(spark, str(landing / "nowhere")).count() == 0
    only = spark.createDataFrame([("lever", "acme")], "source string, slug string")
    assert boards.read_postings(spark, str(landing), only).count() == 2


def test_daily_run_is_idempotent_and_labels(spark, landing, fx, tmp_path):
    store = str(tmp_path / "store")
    for _ in range(2):
        summary = jobs.daily_run(spark, str(landing), store, "2026-08-20", fx).first()
    assert (summary.raw_jobs, summary.filtered_non_tech, summary.snapshot_rows, summary.with_salary) == (6, 1, 4, 3)
    assert {k: v for k, v in summary.by_source.items()} == {"ashby": 1, "greenhouse": 1, "lever": 2}
    assert (summary.boards, summary.new_rows, summary.labelled) == (3, 4, 0)  # the second run finds all labelled
    snap = {r.job_uid: r for r in history.read_table(spark, store, "snapshots").collect()}
    assert len(snap) == 4 and history.read_table(spark, store, "jobs").count() == 4
    g = snap["greenhouse:007:11"]
    assert (g.region, g.seniority, g.salary_mid_usd, str(g.dt)) == ("eu", "mid", 170000.0, "2026-08-20")
    assert snap["ashby:linea:z1"].salary_min_usd == 100000.0
    marks = history.read_table(spark, store, "skills").groupBy("job_uid").agg(
        F.sort_array(F.collect_list("skill")).alias("s")).collect()
    assert {r.job_uid: r.s for r in marks} == {
        "greenhouse:007:11": ["Go", "Python"], "lever:acme:aa": ["Kafka", "Spark"], "ashby:linea:z1": []}


def test_next_day_only_adds_new_keys_and_aggregates(spark, landing, fx, tmp_path):
    store = str(tmp_path / "store")
    jobs.daily_run(spark, str(landing), store, "2026-08-20", fx)
    land(landing, "ashby", "fresh", {"jobs": [dict(ASHBY["jobs"][0], id="z9")]})
    jobs.daily_run(spark, str(landing), store, "2026-08-21", fx)
    new = history.read_table(spark, store, "jobs").where("dt = '2026-08-21'").collect()
    assert [r.job_uid for r in new] == ["ashby:fresh:z9"]
    out = jobs.aggregate(spark, store, replicates=20)
    assert [(str(r.snapshot_date), r.active, r.new) for r in out.series.collect()] == [
        ("2026-08-20", 4, 4), ("2026-08-21", 5, 1)]
    cover = out.coverage.first()
    assert (cover.total, cover.paid, cover.labelled, cover.paid_share) == (5, 4, 4, 0.8)
    companies = {r.idx: r.company for r in out.companies.collect()}
    assert sorted(companies) == [0, 1, 2, 3] and len(set(companies.values())) == 4
    items = {r.idx: r.item for r in out.items.collect()}
    rows = {r.job_uid: r for r in out.rows.collect()}
    assert [items[i] for i in rows["greenhouse:007:11"].item_idx] == ["Go", "Python"]
    assert rows["lever:acme:bb"].item_idx is None and rows["ashby:linea:z1"].item_idx == []
    assert rows["ashby:fresh:z9"].is_new == 1 and rows["lever:acme:aa"].is_new == 0
    assert out.premium.count() == 0
    jobs.write_published(out, str(tmp_path / "site"))
    assert spark.read.json(str(tmp_path / "site" / "series")).count() == 2
    report = jobs.slice_report(out.slice, out.premium, 2)
    assert report["headline"].first().postings == 5
    assert all(frame.count() >= 0 for frame in report.values())


def test_every_waiting_posting_is_labelled(spark, tmp_path, fx):
    board = [{"id": f"k{k}", "text": "Data Engineer", "descriptionPlain": "Kafka"} for k in range(5200)]
    land(tmp_path / "landing", "lever", "big", board)
    done = jobs.daily_run(spark, str(tmp_path / "landing"), str(tmp_path / "store"), "2026-08-20", fx).first()
    assert (done.labelled, done.label_rows) == (5200, 5200)
    assert history.read_table(spark, str(tmp_path / "store"), "skills").count() == 5200


def test_bad_documents_are_counted(spark, landing):
    assert [tuple(r) for r in boards.bad_documents(spark, str(landing)).collect()] == [("ashby", "broken", 1)]


def snapshot_days(spark, days, n=100):
    return spark.range(n).crossJoin(spark.createDataFrame([(d,) for d in days], "d string")).selectExpr(
        "concat('greenhouse:c:', d, id) job_uid", "cast(d as date) snapshot_date", "'greenhouse' source", "'c' company",
        "'us' region", "false is_remote", "'senior' seniority", "false is_management",
        "cast(null as double) salary_min_usd", "cast(null as double) salary_max_usd",
        "cast(null as double) salary_mid_usd", "false has_salary", "cast(null as string) employment_type",
        "cast(null as timestamp) published_at")


def test_guard_blocks_before_any_write(spark, landing, fx, tmp_path):
    store = str(tmp_path / "store")
    days = ["2026-08-17", "2026-08-18", "2026-08-19"]
    for d in days:
        history.write_day(snapshot_days(spark, [d]), store, "snapshots", d)
    with pytest.raises(quality.VolumeGuardError, match="greenhouse"):
        jobs.daily_run(spark, str(landing), store, "2026-08-20", fx)
    assert not (tmp_path / "store" / "snapshots" / "dt=2026-08-20").exists()


def test_guard_thresholds(spark):
    past = snapshot_days(spark, ["2026-08-17", "2026-08-18", "2026-08-19"])
    day = lambda n: snapshot_days(spark, ["2026-08-20"], n)
    assert quality.volume_guard(past, day(95)).count() == 0
    assert {r.scope for r in quality.volume_guard(past, day(30)).collect()} == {"greenhouse", "total"}
    assert {r.scope for r in quality.volume_guard(past, day(55)).collect()} == {"total"}
    assert {r.scope for r in quality.volume_guard(past, day(0)).collect()} == {"greenhouse", "total"}
    assert quality.volume_guard(past.where("snapshot_date > '2026-08-17'"), day(1)).count() == 0


def test_write_day_replaces_appends_and_clears(spark, tmp_path):
    store = str(tmp_path)
    row = lambda k: spark.sql(f"select '{k}' job_uid, 'Go' skill, 'x' source, 'v1' prompt_version, "  # noqa: E731
                              "timestamp'2026-01-01' extracted_at")
    history.write_day(row("a"), store, "skills", "2026-01-01", append=True)
    history.write_day(row("b"), store, "skills", "2026-01-01", append=True)
    history.write_day(row("c"), store, "skills", "2026-01-02")
    keys = lambda: sorted(r.job_uid for r in history.read_table(spark, store, "skills").collect())
    assert keys() == ["a", "b", "c"]
    history.write_day(row("d"), store, "skills", "2026-01-02")
    assert keys() == ["a", "b", "d"]
    history.write_day(row("d").where("false"), store, "skills", "2026-01-02")
    assert keys() == ["a", "b"]
    assert history.read_table(spark, store, "jobs").count() == 0


def test_backfill(spark, landing, fx, tmp_path):
    got = jobs.backfill(spark, str(landing), str(tmp_path / "s"), "2026-08-20", fx).first()
    assert (got["rows"], got.days, str(got.first_day), str(got.last_day)) == (4, 4, "2023-11-14", "2026-08-20")
    parts = {p.name for p in (tmp_path / "s" / "jobs").iterdir() if p.is_dir()}
    assert parts == {"dt=2023-11-14", "dt=2026-04-17", "dt=2026-07-01", "dt=2026-08-20"}


def test_stream_ingest(spark, landing, fx, tmp_path):
    store, mark = str(tmp_path / "s"), str(tmp_path / "mark")
    run = lambda: stream_ingest(spark, str(landing), store, "2026-08-20", fx, mark).awaitTermination()
    run()
    assert history.read_table(spark, store, "jobs").count() == 4
    land(landing, "ashby", "linea", {"jobs": [ASHBY["jobs"][0], dict(ASHBY["jobs"][0], id="z2")]}, "b.json")
    run()
    run()
    assert history.read_table(spark, store, "jobs").count() == 5
    assert history.read_table(spark, store, "snapshots").count() == 5


def test_rates(spark, tmp_path):
    def put(provider, day, doc):
        path = tmp_path / f"provider={provider}" / f"as_of={day}"
        path.mkdir(parents=True)
        (path / "r.json").write_text(json.dumps(doc))

    with pytest.raises(rates.RatesError):
        rates.read_rates(spark, str(tmp_path), "2026-01-03")
    put("primary", "2026-01-01", {"result": "success", "rates": {"usd": 1.0, "EUR": 0.9}})
    put("primary", "2026-01-02", {"result": "error"})
    put("secondary", "2026-01-02", {"usd": {"eur": 0.8, "usd": 1.1}})
    read = lambda d: {r.currency: r.per_usd for r in rates.read_rates(spark, str(tmp_path), d).collect()}
    assert read("2026-01-01") == {"USD": 1.0, "EUR": 0.9}
    assert read("2026-01-02") == {"USD": 1.0, "EUR": 0.8}
    assert read("2026-01-09") == {"USD": 1.0, "EUR": 0.8}
    with pytest.raises(rates.RatesError):
        rates.read_rates(spark, str(tmp_path), "2025-12-31")


def test_registry(spark, tmp_path):
    path = tmp_path / "seed.json"
    path.write_text(json.dumps([{"ats": "lever", "slug": "a", "status": "active"},
                                {"source": "ashby", "slug": "b", "name": "Bee", "status": "active"},
                                {"ats": "lever", "slug": "c", "status": "dead"}]))
    got = registry.read_registry(spark, str(path)).collect()
    assert {tuple(r) for r in got} == {("lever", "a", "a"), ("ashby", "b", "Bee")}
    probes = spark.createDataFrame(
        [("lever", "acme", 200, i, "Berlin" if i == 1 else "NYC") for i in range(3)]
        + [("lever", "far", 200, i, "Remote" if i == 30 else "X") for i in range(40)]
        + [("ashby", "ACME", 200, None, None), ("ashby", "gone", 404, None, None), ("greenhouse", "nil", 200, None, None)],
        "ats string, slug string, http int, pos int, location string")
    boards_ = registry.board_registry(probes)
    assert {(r.slug, r.status, r.n_jobs, r.has_eu, r.has_remote) for r in boards_.collect()} == {
        ("acme", "active", 3, True, False), ("far", "active", 40, False, True), ("gone", "dead", 0, False, False),
        ("nil", "empty", 0, False, False)}
    summary = {r.ats: r for r in registry.registry_summary(boards_).collect()}
    assert (summary["lever"].active, summary["lever"].eu_pct, summary["lever"].jobs) == (2, 50, 43)
    slugs = spark.createDataFrame([("lever", s) for s in ("acme", "ab", "x12345", "a1-2-3-4", "good-one", "9abc")],
                                  "ats string, slug string")
    assert [r.slug for r in registry.fresh_candidates(slugs, boards_.select("ats", "slug")).collect()] == ["good-one"]


def test_gold(spark, tmp_path):
    (tmp_path / "g.jsonl").write_text('{"id": 1, "title": "t", "text": "x", "expected": ["Go"]}\n\n')
    assert gold.read_gold(spark, str(tmp_path / "g.jsonl")).collect()[0].expected == ["Go"]
