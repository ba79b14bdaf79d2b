"""The stored history: key filters, staged days, kept counts and keyed streaming state."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from paylens.operators import history, keyfilter, quality
from paylens.plans import jobs
from paylens.streaming import ingest

DAYS = [datetime.date(2026, 8, d) for d in range(10, 16)]


def keyed(spark, pairs):
    return spark.createDataFrame(pairs, "job_uid string, dt date")


def test_filters_never_miss_and_seldom_hit(spark):
    held = keyed(spark, [(f"k{k}", DAYS[k % 3]) for k in range(3000)] + [(None, DAYS[0])])
    filters = keyfilter.build(held, "job_uid", keyfilter.LEAST_SLOTS, ["dt"]).unionByName(
        keyfilter.build(held.where(F.lit(False)), "job_uid", 1024, ["dt"])).unionByName(
        keyfilter.build(keyed(spark, [("late", DAYS[4])]), "job_uid", 1024, ["dt"]))
    assert {(r.slots, len(r.bits)) for r in filters.collect()} == {(256, 4096), (1024, 4096)}
    asked = keyed(spark, [(f"k{k}", None) for k in range(0, 6000, 2)] + [("late", None), (None, None)])
    history_ = held.unionByName(keyed(spark, [("late", DAYS[4])]))
    found = keyfilter.find_known(asked, history_, filters)
    assert {r.job_uid for r in found.known.collect()} == {f"k{k}" for k in range(0, 3000, 2)} | {"late"}
    report = found.report().first()
    assert 1501 <= report.candidates <= 1520 and report.known == 1501
    assert (report.days_read, report.rows_read) == (4, 3002)
    one = keyfilter.find_known(keyed(spark, [("late", None), ("x1", None)]), history_, filters)
    assert one.report().collect()[0][1:] == (1, 1, 1)  # one known key, one day, one row read
    none = keyfilter.find_known(keyed(spark, [("nobody", None)]), history_, filters).report().first()
    assert (none.known, none.days_read, none.rows_read) == (0, 0, 0)


def test_a_false_hit_is_checked_exactly(spark):
    held = keyed(spark, [("a", DAYS[0]), ("b", DAYS[1])])
    full = keyfilter.build(held, "job_uid", 256, ["dt"]).select("dt", "slots", F.explode(F.sequence(F.lit(0), F.lit(255)).cast(
        "array<bigint>")).alias("slot"), F.unhex(F.repeat(F.lit("FF"), 4096)).alias("bits"))
    found = keyfilter.find_known(keyed(spark, [("a", None), ("c", None)]), held, full)
    assert [r.job_uid for r in found.known.collect()] == ["a"]
    report = found.report().first()
    assert (report.candidates, report.days_read, report.rows_read) == (2, 2, 2)


def test_days_without_filter_are_read(spark):
    held = keyed(spark, [("a", DAYS[0]), ("b", DAYS[1]), ("c", DAYS[2])])
    filters = keyfilter.build(held.where(F.col("dt") == DAYS[0]), "job_uid", 256, ["dt"])
    found = keyfilter.find_known(keyed(spark, [("a", None), ("b", None), ("d", None)]), held, filters, DAYS[:1])
    assert sorted(r.job_uid for r in found.known.collect()) == ["a", "b"] and found.days_read == DAYS[:3]
    bare = keyfilter.find_known(keyed(spark, [("c", None)]), held, filters.limit(0), [])
    assert bare.known.count() == 1


def test_slots_grow_with_the_keys():
    assert keyfilter.slots_for(0) == keyfilter.slots_for(500_000) == 256
    assert keyfilter.slots_for(10**9) * keyfilter.SLOT_BITS >= 16 * 10**9
    assert bin(keyfilter.slots_for(123_456_789)).count("1") == 1


def marks(spark, keys):
    return spark.createDataFrame([(k, "Go", "x", "v1", datetime.datetime(2026, 1, 1)) for k in keys],
                                 "job_uid string, skill string, source string, prompt_version string, extracted_at timestamp")


def test_a_lost_job_leaves_the_old_day(spark, tmp_path):
    store = str(tmp_path)
    history.write_day(marks(spark, "ab"), store, "skills", "2026-01-01")
    history.write_day(marks(spark, "z"), store, "skills", "2026-01-02")
    broken = marks(spark, "cde").withColumn("skill", F.when(F.col("job_uid") == "d", F.raise_error(F.lit("lost"))).otherwise("x"))
    with pytest.raises(Exception, match="lost"):
        history.write_day(broken, store, "skills", "2026-01-01")
    assert sorted(r.job_uid for r in history.read_table(spark, store, "skills").collect()) == ["a", "b", "z"]
    history.write_day(marks(spark, "qrs"), store, "skills", "2026-01-01")
    day = history.read_table(spark, store, "skills").where("dt = '2026-01-01'")
    assert sorted(r.job_uid for r in day.collect()) == ["q", "r", "s"]


def snapshots(spark, day, counts):
    rows = [(f"{s}:c:{day}{k}", s) for s, n in counts.items() for k in range(n)]
    return spark.createDataFrame(rows, "job_uid string, source string").selectExpr(
        "job_uid", f"date'{day}' snapshot_date", "source", "'c' company", "'us' region", "false is_remote",
        "'senior' seniority", "false is_management", "cast(null as double) salary_min_usd",
        "cast(null as double) salary_max_usd", "cast(null as double) salary_mid_usd", "false has_salary",
        "cast(null as string) employment_type", "cast(null as timestamp) published_at")


def spoil(path):
    """Make the files of a day unreadable."""
    for f in path.glob("*.parquet"):
        f.write_bytes(b"spoilt")


def test_guard_reads_counts_and_a_replaced_day_retracts_its_own(spark, tmp_path):
    store = str(tmp_path)
    for d in DAYS[:4]:
        history.write_day(snapshots(spark, str(d), {"lever": 100, "ashby": 40}), store, "snapshots", str(d))
    got = history.day_counts(spark, store, "2026-08-20")  # days from before counts were kept are counted once
    assert got.count() == 8 and {r.n for r in got.where("source = 'lever'").collect()} == {100}
    for d in DAYS[:3]:
        spoil(tmp_path / "snapshots" / f"dt={d}")
    history.write_day(snapshots(spark, str(DAYS[3]), {"lever": 10}), store, "snapshots", str(DAYS[3]))
    history.forget_counts(spark, store, str(DAYS[3]))
    again = {(r.source, r.dt): r.n for r in history.day_counts(spark, store, "2026-08-20").collect()}
    assert again == {(s, d): n for d in DAYS[:3] for s, n in (("lever", 100), ("ashby", 40))} | {("lever", DAYS[3]): 10}
    today = spark.createDataFrame([("lever", 50), ("ashby", 39)], "source string, n bigint")
    assert {r.scope for r in quality.volume_problems(history.day_counts(spark, store, "2026-08-20"), today).collect()} == set()
    low = spark.createDataFrame([("lever", 49)], "source string, n bigint")
    problems = {r.scope: r.got for r in quality.volume_problems(history.day_counts(spark, store, "2026-08-20"), low).collect()}
    assert problems == {"lever": 49, "ashby": 0, "total": 49}


def land(root, name, ids, company="acme"):
    path = root / "source=lever" / f"company={company}"
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text(json.dumps([{"id": i, "text": f"Data Engineer {name}", "descriptionPlain": "Spark"} for i in ids]))


@pytest.fixture
def fx(spark):
    return spark.createDataFrame([("USD", 1.0)], "currency string, per_usd double")


def titles(spark, store):
    return {r.job_uid.split(":")[-1]: (r.title, str(r.dt)) for r in history.read_table(spark, store, "jobs").collect()}


def test_daily_runs_read_no_old_snapshot_and_no_keys_without_a_hit(spark, tmp_path, fx):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    for k, day in enumerate(DAYS[:3]):
        land(landing, "a.json", [f"{k}-{i}" for i in range(20)])
        assert jobs.daily_run(spark, str(landing), store, str(day), fx, label=False).first().new_rows == 20
        spoil(tmp_path / "store" / "snapshots" / f"dt={day}")
        spoil(tmp_path / "store" / "jobs" / f"dt={day}")
    land(landing, "a.json", [f"3-{i}" for i in range(5)])
    with pytest.raises(quality.VolumeGuardError):
        jobs.daily_run(spark, str(landing), store, str(DAYS[3]), fx, label=False)


def test_stream_state_over_batches_restart_and_late_keys(spark, tmp_path, fx, monkeypatch):
    landing, store, mark = tmp_path / "landing", str(tmp_path / "store"), str(tmp_path / "mark")
    asked = []
    real = history.unseen_rows
    monkeypatch.setattr(ingest.history, "unseen_rows", lambda rows, s, table, *a, **k: asked.append(
        (table, rows.count())) or real(rows, s, table, *a, **k))

    def run(day="2026-08-20"):
        asked.clear()
        ingest.stream_ingest(spark, str(landing), store, day, fx, mark).awaitTermination()
        return sum(n for table, n in asked if table == "jobs")

    land(landing, "old.json", ["h1", "h2"])
    jobs.daily_run(spark, str(landing), store, "2026-08-19", fx, label=False)
    (landing / "source=lever" / "company=acme" / "old.json").unlink()
    land(landing, "a.json", ["x", "y", "x", "h1"])  # h1 comes from a day before the stream
    assert run() == 3
    assert titles(spark, store) == {"h1": ("Data Engineer old.json", "2026-08-19"), "h2": ("Data Engineer old.json", "2026-08-19"),
                                    "x": ("Data Engineer a.json", "2026-08-20"), "y": ("Data Engineer a.json", "2026-08-20")}
    land(landing, "b.json", ["x", "z", "z", "h2"])
    assert run() == 2  # x is in the state; z is new; h2 is late and found in the history
    land(landing, "c.json", ["x", "y", "z"])
    assert run() == 0  # a restart from the checkpoint knows them all
    assert run() == 0
    snap = history.read_table(spark, store, "snapshots").where("dt = '2026-08-20'")
    assert sorted(r.job_uid[-2:].strip(":") for r in snap.collect()) == ["h1", "h2", "x", "y", "z"]
    land(landing, "d.json", ["x", "n"])
    assert run("2026-08-21") == 1
    snap = history.read_table(spark, store, "snapshots").where("dt = '2026-08-21'")
    assert sorted(r.job_uid[-1] for r in snap.collect()) == ["n", "x"]
    assert titles(spark, store)["n"][1] == "2026-08-21" and history.read_table(spark, store, "jobs").count() == 6
    counts = history.day_counts(spark, store, "2026-08-22")
    assert {str(r.dt): r.n for r in counts.collect()} == {"2026-08-19": 2, "2026-08-20": 5, "2026-08-21": 2}


def test_a_replayed_batch_adds_nothing(spark, tmp_path, fx):
    landing, store = tmp_path / "landing", str(tmp_path / "store")
    land(landing, "a.json", ["x", "y"])
    for mark in ("m1", "m2"):  # a second stream without state replays everything
        ingest.stream_ingest(spark, str(landing), store, "2026-08-20", fx, str(tmp_path / mark)).awaitTermination()
    assert history.read_table(spark, store, "jobs").count() == 2
    assert history.read_table(spark, store, "snapshots").count() == 2


def test_stream_keeps_its_state_on_disk_and_only_what_is_stored(spark, tmp_path, fx):
    provider = f"{ingest.STATE}.providerClass"
    land(tmp_path / "landing", "a.json", ["x", "y", "x"])
    for own in (None, "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"):
        if own:
            spark.conf.set(provider, own)
        stream = ingest.stream_ingest(spark, str(tmp_path / "landing"), str(tmp_path / f"store{own}"), "2026-08-20", fx,
                                      str(tmp_path / f"mark{own}"))
        assert spark.conf.get(provider, None) == own and not any(spark.conf.get(k, None) for k in ingest.ON_DISK if k != provider)
        stream.awaitTermination()
        spark.conf.unset(provider)
        used = stream.recentProgress[0]["stateOperators"][0]["customMetrics"]
        assert any(k.startswith("rocksdb") for k in used) != bool(own)
        assert history.read_table(spark, str(tmp_path / f"store{own}"), "jobs").count() == 2
    raw = jobs.target_postings(ingest.stream_postings(spark, str(tmp_path / "landing")))
    state = ingest.keyed_state(jobs.priced_postings(raw, fx), "2026-08-20", "30 days")
    kept = set(state.schema["posting"].dataType.fieldNames())
    assert not kept & {"ingest_seq", "pay", "published_at_raw", "job_id"} and {"title", "salary_mid_usd", "country"} <= kept


def test_a_look_up_that_can_find_nothing_moves_no_rows(spark, tmp_path):
    rows = snapshots(spark, str(DAYS[1]), {"lever": 3})
    assert history.unseen_rows(rows, str(tmp_path), "snapshots") is rows
    history.extend_day(rows, str(tmp_path), "snapshots", str(DAYS[1]))
    assert history.unseen_rows(rows, str(tmp_path), "snapshots").count() == 0
    assert history.unseen_rows(rows, str(tmp_path), "snapshots", only=str(DAYS[2])) is rows
    more = rows.unionByName(snapshots(spark, str(DAYS[2]), {"lever": 2}))
    assert history.unseen_rows(more, str(tmp_path), "snapshots").count() == 2
