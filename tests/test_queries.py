"""Every query against its SQL twin, on the smallest data."""

import os

import duckdb
import pytest

import __spark_entry__ as contract

FOLDER = "/root/testdata/sf0.001"
QUERIES, TWINS = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(FOLDER):
        if file.endswith(".parquet"):
            con.execute(f"create view {file[:-8]} as select * from '{FOLDER}/{file}'")
    return con


def plain(rows):
    return sorted(tuple(str(v) for v in row) for row in rows)


@pytest.mark.parametrize("name", sorted(TWINS))
def test_query_equals_twin(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    names = sorted(df.columns)
    got = plain([tuple(r[n] for n in names) for r in df.collect()])
    assert got, "an empty result shows nothing"
    result = duck.execute(TWINS[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == names
    places = [columns.index(n) for n in names]
    assert got == plain([tuple(r[i] for i in places) for r in result.fetchall()])


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns[0] == "prompt_id" and df.count() > 0


def test_both_sides_of_each_filter(spark):
    """Filters keep some rows and drop some."""
    n = 1500
    for name in ("foreign_marker_hits", "dialect_files", "autogen_header", "migration_filter",
                 "suffix_filter", "kept_files", "metadata_prefilter"):
        assert 0 < QUERIES[name](spark, FOLDER).count() < n, name
    outcomes = {r["outcome"] for r in QUERIES["generation_totals"](spark, FOLDER).collect()}
    assert outcomes == {"accepted", "error", "missing", "short_chunk", "unparsable"}
