"""Heavy-hitter joins, bucketed tables, roll-up state, age prefixes and the newest-year aggregate."""

import os

import pytest
from pyspark.sql import functions as F

from geoindicators.keys import Keys
from geoindicators.operators import align, hot_join, population, rollup
from geoindicators.operators.rollup_state import RollupState
from geoindicators.operators.scale import scale_min_max
from geoindicators.plans import catalog_state
from geoindicators.sources import bucketed
from tests.conftest import SF_ORACLE, rows
from tests.test_plans import _plan


def test_a_hot_key_is_found_and_no_salt_holds_twice_the_median(spark):
    facts = catalog_state.hot_orders(spark, SF_ORACLE)
    share = 0.02
    found = hot_join.frequent_keys(facts, ["custkey"], share)
    assert len(found) == 1 and 0.32 < next(iter(found.values())) < 0.36
    salts = hot_join.salts_of(found, share)
    salted = hot_join.with_salt(facts, ["custkey"], salts, ["o_orderkey"])
    hot = [r["count"] for r in salted.where("custkey = 1").groupBy("_salt").count().collect()]
    assert len(hot) >= 16 and max(hot) <= 2 * sorted(hot)[len(hot) // 2]
    assert {r["_salt"] for r in salted.where("custkey <> 1").select("_salt").distinct().collect()} == {0}


def test_hot_join_equals_the_plain_join(spark):
    facts = spark.createDataFrame([(i, "x" if i % 3 == 0 else f"k{i}" if i % 5 else None, i) for i in range(300)], "id long, k string, v long")
    other = spark.createDataFrame([("x", 1), ("x", 2), ("k1", 3), (None, 4)], "k string, w long")
    for how in ("inner", "left"):
        for null_safe in ((), ("k",)):
            cond = facts.k.eqNullSafe(other.k) if null_safe else facts.k == other.k
            want = rows(facts.join(other, cond, how).select(facts.id, facts.k, "v", "w"))
            assert rows(hot_join.hot_join(facts, other, ["k"], how, null_safe=null_safe).select("id", "k", "v", "w")) == want
    empty = facts.limit(0)
    assert hot_join.frequent_keys(empty, ["k"]) == {} and hot_join.hot_join(empty, other, ["k"]).count() == 0
    assert "_salt" not in _plan(hot_join.hot_join(facts.where("id % 3 <> 0 and id % 5 <> 0"), other, ["k"]))  # no key is frequent
    with pytest.raises(ValueError):
        hot_join.frequent_keys(facts, ["k"], 0.001)
    with pytest.raises(ValueError):
        hot_join.hot_join(facts, other, ["k"], "full")


def test_bucketed_tables_join_and_sum_without_an_exchange(spark):
    a = spark.createDataFrame([(2020 + i % 3, "01", f"010{i % 4}" if i % 4 else None, i) for i in range(60)], "date int, district_id string, sub_id string, x long")
    b = a.groupBy("date", "district_id", "sub_id").agg(F.sum("x").alias("y"))
    keys = ["date", "district_id", "sub_id"]
    left, right = bucketed.write_bucketed(a, keys, 4), bucketed.write_bucketed(b, keys, 4)
    joined = bucketed.join_bucketed(spark, left, right)
    plan = _plan(joined)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert joined.columns == [*keys, "x", "y"] and joined.count() == 60  # null sub-districts match
    summed = bucketed.sum_bucketed(spark, left, ["x"])
    assert "Exchange" not in _plan(summed) and rows(summed.select(*keys, "x")) == rows(b)
    c = bucketed.write_bucketed(b, keys[:2], 4)
    with pytest.raises(ValueError):
        bucketed.join_bucketed(spark, left, c)


def _facts(spark, data):
    return spark.createDataFrame(data, "date int, district_id string, district_name string, sub_id string, sub_name string, n long")


def test_state_recomputes_only_the_years_that_changed(spark, tmp_path):
    k = Keys()
    base = [(y, "01", "A", s, f"S{s}" if s else None, y - 2000 + i) for y in (2020, 2021, 2022) for i, s in enumerate(["0101", "0102", None])]
    state = RollupState(spark, str(tmp_path / "state"), ["n"], k)
    full = lambda data: rows(rollup.aggregate(_facts(spark, data), "sum", k))

    def files():
        return {y: sorted(f for f in os.listdir(tmp_path / "state" / "base" / y) if f.startswith("part")) for y in os.listdir(tmp_path / "state" / "base") if y.startswith("date=")}

    with pytest.raises(ValueError):
        state.base()
    assert state.refresh(_facts(spark, base)) == [2020, 2021, 2022] and rows(state.rolled_up()) == full(base)
    before = files()
    assert state.refresh(_facts(spark, base[::-1])) == [] and files() == before  # the order of rows doesn't matter
    newer = [*base[:3], (2021, "01", "A", "0101", "S0101", 100), *base[4:], (2023, "02", "B", "0201", "T", 7), (None, "02", "B", "0201", "T", 7)]
    assert state.refresh(_facts(spark, newer)) == [2021, 2023]
    after = files()
    assert after["date=2020"] == before["date=2020"] and after["date=2022"] == before["date=2022"] and after["date=2021"] != before["date=2021"]
    assert rows(state.rolled_up()) == full(newer)
    gone = [r for r in newer if r[0] != 2020]
    assert state.refresh(_facts(spark, gone)) == [] and rows(state.rolled_up()) == full(gone)
    assert state.refresh(_facts(spark, newer)) == [2020] and rows(state.rolled_up()) == full(newer)
    twice = [*newer, newer[0]]  # a repeated row is a change
    assert state.refresh(_facts(spark, twice)) == [2020] and rows(state.rolled_up()) == full(twice)


def test_bands_of_one_prefix_table_equal_single_bands(spark):
    k = Keys()
    data = [(2020, "01", "A", s, s, age, n) for s, ages in {"a": [(0, 1), (5, 2), (30, None), (120, 4), (121, 9)], "b": [(60, 5), (60, 6)]}.items() for age, n in ages]
    data += [(2020, "01", "A", "c", "c", 200, 1), (2020, "01", "A", None, None, 3, 1), (2020, "01", "A", "a", "a", None, 8)]
    df = spark.createDataFrame(data, "date int, district_id string, district_name string, sub_id string, sub_name string, age int, count long")
    wanted = {"child": (0, 15), "mid": (16, 59), "old": (60, 300), "every": (0, 300), "gap": (6, 29)}
    got = population.bands(population.age_prefix(df, keys=k), wanted, k)
    for name, (lo, hi) in wanted.items():
        one = rows(population.band_population(df, min_age=lo, max_age=hi, keys=k))
        assert rows(got.where(F.col(name).isNotNull()).select(*k.all(), name)) == one


def test_newest_year_in_one_pass(spark):
    k = Keys()
    df = spark.createDataFrame([(2020, "01", 5.0, 0.1), (2021, "01", 1.0, 0.2), (2021, "02", 3.0, None), (None, "02", 99.0, 9.0), (2022, k.non_residential[0], 50.0, 0.5)],
                               "date int, district_id string, a double, a_ratio double")
    assert align.newest_of(df.where("date < 2022"), F.sum("a").alias("s"), F.count(F.lit(1)).alias("n")).first()[:] == (4.0, 2)
    scale = scale_min_max(df, "a", k)
    assert scale.first()[:] == (1.0, 3.0, 0.2, 0.2) and _plan(scale).count("Scan") == 1 and "Subquery" not in _plan(scale)
    assert scale_min_max(df, "nope", k).first()[:] == (0.0,) * 4 and scale_min_max(df.limit(0), "a", k).first()[:] == (None,) * 4
