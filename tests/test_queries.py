"""Every registered query of the document operators against its SQL in DuckDB."""

import math
import os

import duckdb
import pytest
from conftest import DATA

import __spark_entry__
from sheafline.queries import ORACLES, QUERIES


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)) or str(v) == "<NA>":
        return "null"
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return f"{v:.9g}" if v != int(v) else str(int(v))
    return str(v)


def rows(frame):
    names = sorted(frame.columns)
    return names, sorted(tuple(plain(x) for x in r) for r in frame[names].itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(DATA):
        con.execute(f"create view {file.removesuffix('.parquet')} as select * from '{DATA}/{file}'")
    return con


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, duck, name):
    names, got = rows(QUERIES[name](spark, DATA).toPandas())
    expected_names, expected = rows(duck.sql(ORACLES[name]).df())
    assert names == expected_names
    assert got == expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_sql(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_images_hold_whole_pages(spark, tmp_path):
    from sheafline.functions import imaging

    pages = {1: "", 2: "é", 3: "ab" * 32, 4: "a" * 4096, 5: "a" * 4096 + "b" * 70, 6: "é" * 3000 + "a", 7: "<p>x</p>\n" * 5000}
    spark.createDataFrame(list(pages.items()), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {r["page_id"]: r for r in QUERIES["image_measures"](spark, str(tmp_path)).collect()}
    assert set(got) == set(pages)
    for page, html in pages.items():
        raw = html.encode()
        raw = raw.ljust(max(1, math.ceil(len(raw) / 64)) * 64, b"\xff")
        told = imaging.measured(imaging.pixels(raw, 64, len(raw) // 64, 1))
        names = [c.split()[0] for c in imaging.MEASURED.split(", ")]
        expected = dict(zip(names, told))
        for name in set(names) - {"regions"}:
            assert plain(got[page][name]) == plain(expected[name]), (page, name)


def test_file_numbers_of_long_and_odd_ids(spark, tmp_path):
    ids = [0, 3, 9, 999, 1002, 1500, 2499, 12345, 1000, 1001, -3, -6, -4, 10**18 + 2, 9 * 10**18 + 1, 9223372036854775807, None]
    spark.createDataFrame([(i, "") for i in ids], "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = QUERIES["file_numbers"](spark, str(tmp_path)).select("page_id", "n").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, con.sql(ORACLES["file_numbers"]).fetchall()))
