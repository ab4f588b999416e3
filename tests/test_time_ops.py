import pytest
from pyspark.sql import functions as F

from geoindicators.keys import Keys
from geoindicators.operators import align, change, scale


def _years(spark, start, end):
    return spark.createDataFrame([(y, "some_value") for y in range(start, end + 1)], "date int, value string")


def test_historic_and_status(spark):
    dfs = [_years(spark, *r) for r in [(2000, 2022), (2002, 2018), (2008, 2033), (1999, 2017), (1999, 2033)]]
    for d in align.historic(*dfs):
        assert sorted(r.date for r in d.collect()) == list(range(2008, 2018))
    for d in align.status(*dfs):
        assert [r.date for r in d.collect()] == [2017]


def test_status_no_overlap(spark):
    with pytest.raises(Exception, match="No overlapping years"):
        align.status(_years(spark, 2010, 2015), _years(spark, 2002, 2008))[0].collect()


def test_keep_newest(spark):
    df = spark.createDataFrame([(2019, 1), (2020, 2), (2020, 3)], "date int, value int")
    out = align.keep_newest(df)
    assert out.columns == ["value"] and sorted(r.value for r in out.collect()) == [2, 3]


def test_horizon_set(spark):
    df = spark.createDataFrame([(y, f"d1_{y}") for y in range(2008, 2020)], "date int, d1 string")
    assert sorted(r.date for r in change.horizon_set(df, 10).collect()) == [2009, 2019]
    with pytest.raises(Exception, match="does not contain"):
        change.horizon_set(df.filter("date > 2013"), 10).collect()


def _pop(spark, years, values):
    return spark.createDataFrame([(y, "01", "D", "0101", "S", v) for y, v in zip(years, values)],
                                 "date int, district_id string, district_name string, sub_id string, sub_name string, "
                                 "population long")


def test_yoy_change(spark):
    out = change.yoy_change(_pop(spark, [2009, 2010], [100, 105]), "population").orderBy("date").collect()
    assert [r.change for r in out] == [None, 5]
    one = change.yoy_change(_pop(spark, [2009], [100]), "population").collect()
    assert one[0].change is None


def test_change_ratios(spark):
    years = list(range(2008, 2020))
    df = _pop(spark, years, list(range(10, 22)))
    df = df.withColumns({"change": F.when(F.col("date") > 2008, F.lit(1.0)),
                         "change_10y": F.when(F.col("date") == 2019, F.lit(10.0))})
    out = {r.date: r for r in change.change_ratios(df, horizon=10).collect()}
    assert out[2009].change_ratio == 0.1 and out[2019].change_ratio == 0.05
    assert all(out[y].change_10y_ratio is None for y in years if y < 2019)
    assert abs(out[2019].change_10y_ratio - 0.909091) < 1e-6


def test_change_ratio_missing_years(spark):
    df = _pop(spark, [2017, 2018, 2019], [19, 20, 21]).withColumns(
        {"change": F.lit(1.0), "change_10y": F.lit(None).cast("double")})
    out = {r.date: r for r in change.change_ratios(df, horizon=10).collect()}
    assert out[2017].change_ratio is None and abs(out[2019].change_ratio - 0.05) < 1e-12
    assert all(r.change_10y_ratio is None for r in out.values())


def test_scale_latest_year_without_non_residential(spark):
    df = spark.createDataFrame([(2025, 1, 0.7, "0"), (2025, 2, 0.2, "0"), (2025, 3, 0.5, "0"), (2025, 20, 0.05, "99"),
                                (2024, 10, 0.9, "0")], "date int, value long, value_ratio double, district_id string")
    r = scale.scale_struct(df, "value", Keys()).first().scale
    assert (r.value, r.ratio) == ([1.0, 3.0], [0.2, 0.7])
    missing = scale.scale_struct(df, "nothing", Keys()).first().scale
    assert (missing.value, missing.ratio) == ([0.0, 0.0], [0.0, 0.0])
