"""Every slice of the cube equals the slice report, and cells of parts merge to those of the whole."""

import datetime
import random
import re

import pytest
from pyspark.sql import functions as F

from checks import base, pay, slices
from paylens.operators import cube as c
from paylens.operators.reports import top_entities
from paylens.plans.jobs import slice_report

SCHEMA = ("job_uid string, source string, company string, region string, seniority string, is_remote boolean, "
          "is_management boolean, salary_mid_usd double, is_new int, skills array<string>")


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(8)
    out = []
    for k in range(1500):
        pay = None if rng.random() < .2 else rng.choice([90000.0, 120000.0, rng.uniform(20000, 600000)])
        skills = None if rng.random() < .1 else rng.choices(["Go", "SQL", "Python", "Rust", None], k=rng.randrange(4))
        out.append((f"u{k}", "lever", f"c{rng.randrange(12)}", rng.choice(["us", "us", "us", "eu", "other", None]),
                    rng.choice(["senior", "staff+", "mid", "junior", "unspecified", "odd", None]), rng.choice([True, False, None]),
                    rng.random() < .1, pay, rng.choice([0, 1, None]), skills))
    return spark.createDataFrame(out, SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def premium(spark):
    return spark.createDataFrame([("Go", 40, 12.0, 1.0, 20.0), ("SQL", 90, 15.5, -3.0, 30.0), ("Rust", 9, 50.0, 5.0, 90.0),
                                  ("Cobol", 20, 3.0, None, None)], "item string, n bigint, premium_pct double, ci_lo double, ci_hi double")


def plain(frame):
    columns = sorted(frame.columns)
    return sorted(repr([(x, round(r[x], 6) if isinstance(r[x], float) else r[x]) for x in columns]) for r in frame.collect())


def test_slices_equal_the_slice_report(rows, premium):
    employers = top_entities(rows)
    charts = {k: v.cache() for k, v in c.slice_cube(c.build_cube(rows), premium, 2, employers).items()}
    for region, seniority in (("all", "all"), ("remote", "senior"), ("eu", "junior")):
        want = slice_report(rows, premium, 2, region, seniority, employers)
        got = c.one_slice(charts, region, seniority)
        assert set(got) == set(want)
        for name in want:
            assert plain(got[name]) == plain(want[name].select(*got[name].columns)), (name, region, seniority)
            assert set(got[name].columns) == set(want[name].columns)


def test_cells_of_parts_merge(rows):
    whole = plain(c.build_cube(rows).cells)
    parts = [c.build_cube(rows.where(F.hash("job_uid") % 3 == k)).cells for k in (0, 1, 2, -1, -2)]
    assert plain(c.merge_cells(*parts)) == whole


def scans(frame, capsys):
    """Columns read from every stored table in the plan of ``frame``."""
    frame.explain("simple")
    return re.findall(r"ReadSchema: struct<([^>]*(?:array<\w+>)?[^>]*)>", capsys.readouterr().out)


def test_a_quantile_reads_the_columns_it_needs(spark, tmp_path, capsys, rows):
    rows.write.parquet(str(tmp_path / "rows"))
    cube = c.build_cube(spark.read.parquet(str(tmp_path / "rows")))
    for kind, by, other in (("row", c.SLICE, ["skills", "company"]), ("company", [*c.SLICE, "name"], ["skills"]),
                            ("item", [*c.SLICE, "name"], ["company"])):
        read = [x for x in scans(cube.median(kind, by, c.slices), capsys) if "salary_mid_usd" in x]
        assert read and not [x for x in read for column in other if column in x], (kind, read)


def test_slices_of_rare_names_are_never_counted(spark, monkeypatch):
    often = [(f"o{k}", "big" if k < 12 else None, "us", "mid", True, False, 100.0 + k, 0, ["Go", "Go", None]) for k in range(24)]
    rare = [(f"r{k}", f"c{k // 9}", "eu", "mid", False, False, 200.0 + k, 0, None) for k in range(900)]
    unpaid = [(f"u{k}", "boss", "us", "mid", False, k % 2 == 0, None if k % 2 else 5.0, 0, ["Go"]) for k in range(40)]
    names = "job_uid string, company string, region string, seniority string, is_remote boolean, is_management boolean, " \
            "salary_mid_usd double, is_new int, skills array<string>"
    cube = c.build_cube(spark.createDataFrame(often + rare + unpaid, names))
    counted = []
    locate = c.locate
    monkeypatch.setattr(c, "locate", lambda histogram, *a: counted.append(histogram) or locate(histogram, *a))
    got = cube.median("company", [*c.SLICE, "name"], c.slices, 10).collect()
    assert {(r.region, r.seniority, r.name): (r.n, r["median"]) for r in got} == {
        (region, grade, name): (12, middle) for name, middle in (("big", 105.5), (None, 117.5))
        for region in ("us", "remote", "all") for grade in ("mid", "all")}
    assert {r.name for r in counted[0].select("name").distinct().collect()} == {"big", None}
    item = cube.median("item", [*c.SLICE, "name"], c.slices, 10).collect()
    assert {(r.name, r.n, r["median"]) for r in item} == {("Go", 24, 111.5)}


def test_postings_are_labelled_once(spark, tmp_path, monkeypatch):
    tables = {
        "region": ("r_regionkey int, r_name string", [(0, "ASIA")]),
        "nation": ("n_nationkey int, n_regionkey int", [(1, 0)]),
        "customer": ("c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(1, "a", 1, "x"), (2, None, 1, "y")]),
        "orders": ("o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, "
                   "o_orderpriority string",
                   [(k, k % 2 + 1, "OPF"[k % 3], 5e4 * k, datetime.datetime(1998, 1, 1 + k), "5-LOW") for k in range(9)] * 2),
        "lineitem": ("l_orderkey long, l_partkey long, l_returnflag string", [(k % 7, k % 3, "NAR"[k % 3]) for k in range(20)]),
        "part": ("p_partkey long, p_brand string, p_size int", [(0, "A", 1), (1, "B", 9), (2, None, 9)])}
    for name, (schema, some) in tables.items():
        spark.createDataFrame(some, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    made, label_sets = [], base.labels.label_sets
    monkeypatch.setattr(base.labels, "label_sets", lambda *a: made.append(a) or label_sets(*a))
    want = plain(pay.paid_members(spark, str(tmp_path)))
    made.clear()
    assert plain(pay.paid_members(spark, str(tmp_path), slices.stored(spark, str(tmp_path)))) == want and len(want) > 4
    assert len(made) == 1
