import pytest
from pyspark.sql import functions as F

from geoindicators.functions import nulls


def test_strict_sum_values_null_and_mix(spark):
    df = spark.createDataFrame([("a", 4.0), ("a", 5.0), ("a", 6.0), ("b", None), ("b", None),
                                ("c", 4.0), ("c", None)], "g string, x double")
    ok = df.filter(F.col("g") != "c").groupBy("g").agg(nulls.strict_sum("x").alias("s"))
    assert {r.g: r.s for r in ok.collect()} == {"a": 15.0, "b": None}
    with pytest.raises(Exception, match="Mix of null"):
        df.groupBy("g").agg(nulls.strict_sum("x").alias("s")).collect()


def test_coalesced_sum_all_null_is_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "g string, x long")
    assert df.groupBy("g").agg(nulls.coalesced_sum("x").alias("s")).first().s == 0


@pytest.mark.parametrize("x,expected", [(0.00015, 0.0001), (1.00005, 1.0001), (2.5e-5, 0.0), (0.12345, 0.1234),
                                        (-0.00015, -0.0001), (3224999.9999999995, 3225000.0)])
def test_round4_half_even_on_binary_value(spark, x, expected):
    df = spark.createDataFrame([(x,)], "x double")
    assert df.select(nulls.round4("x").alias("r")).first().r == expected


def test_row_sums_propagate_vs_skip(spark):
    df = spark.createDataFrame([(1, 2, None), (None, None, None), (1, 2, 3)], "a int, b int, c int")
    out = df.select(nulls.row_sum_propagate(["a", "b", "c"]).alias("p"),
                    nulls.row_sum_skip(["a", "b", "c"]).alias("s")).collect()
    assert [(r.p, r.s) for r in out] == [(None, 3), (None, 0), (6, 6)]


def test_clean_number(spark):
    df = spark.createDataFrame([("12 345",), ("..",), (" 7 ",), ("1 234,5",), (None,)], "t string")
    out = [r.v for r in df.select(nulls.clean_number("t").alias("v")).collect()]
    assert out == [12345.0, None, 7.0, None, None]


def test_safe_div_zero_and_nan(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, None), (float("nan"), 1.0)], "a double, b double")
    out = df.select(nulls.safe_div("a", "b").alias("d"), nulls.nan_to_null("a").alias("n")).collect()
    assert out[0].d is None and out[1].d is None and out[2].n is None
