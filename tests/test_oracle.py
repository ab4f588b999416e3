"""Every registered query against its DuckDB twin on the small test tables,
plus the driver's smoke check of ``entry``."""

import pytest

import __spark_entry__ as entry_mod
from geoindicators.plans.registry import all_queries, all_sql
from tests.conftest import SF_ORACLE, SF_SMALL
from tests.oracle_harness import compare, duck

# the corpus queries have tests of their own
QUERIES = all_queries()
SQLS = all_sql()


# the datasets need some rows in every year and sub-district (strict sums fail on gaps)
FOLDER = {name: SF_ORACLE if name.startswith("dataset_") else SF_SMALL for name in QUERIES}


@pytest.fixture(scope="module")
def con():
    return {folder: duck(folder) for folder in {SF_SMALL, SF_ORACLE}}


ROWS_ONLY = {"latest_snapshot"}   # file modification times are not visible to SQL


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(SQLS) - ROWS_ONLY)
    assert missing == [], missing


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, con[FOLDER[name]], name, QUERIES[name], SQLS.get(name), FOLDER[name])
    if name in ROWS_ONLY:
        assert r["rows"] >= 1
    else:
        assert r["ok"], r.get("why")


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert [f.name for f in df.schema.fields] == ["id", "district", "data", "meta"]
