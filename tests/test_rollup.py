import pytest
from pyspark.sql import functions as F

from geoindicators.keys import Keys
from geoindicators.operators import rollup
from tests.conftest import rows

SCHEMA = "date int, district_id string, district_name string, sub_id string, sub_name string, a long, b long"

DATA = [
    (2020, "01", "D1", "0101", "S1", 1, 10),
    (2020, "01", "D1", "0101", "S1", 2, 20),   # duplicate key: summed
    (2020, "01", "D1", "0102", "S2", 3, None),
    (2020, "01", "D1", None, None, 4, 40),     # no sub-district: counts for district + city only
    (2020, "02", "D2", "0201", "S3", 5, 50),
    (2021, "02", "D2", "0201", "S3", 6, 60),
    (None, "02", "D2", "0201", "S3", 100, 100),  # null year: ignored
]


def test_three_levels(spark):
    df = spark.createDataFrame(DATA, SCHEMA)
    out = rows(rollup.aggregate(df, "sum", Keys()))
    assert out == sorted([
        (2020, "01", "D1", "0101", "S1", 3, 30),
        (2020, "01", "D1", "0102", "S2", 3, 0),     # all-null sum is 0
        (2020, "02", "D2", "0201", "S3", 5, 50),
        (2021, "02", "D2", "0201", "S3", 6, 60),
        (2020, "01", "D1", None, None, 10, 70),
        (2020, "02", "D2", None, None, 5, 50),
        (2021, "02", "D2", None, None, 6, 60),
        (2020, "00", "Oslo i alt", None, None, 15, 120),
        (2021, "00", "Oslo i alt", None, None, 6, 60),
    ], key=lambda t: tuple((x is None, x) for x in t))


def test_extra_dimension_and_ratios(spark):
    df = spark.createDataFrame([(2020, "01", "D1", "0101", "S1", "m", 1, 3), (2020, "01", "D1", "0101", "S1", "f", 2, 2)],
                               SCHEMA.replace("sub_name string,", "sub_name string, g string,"))
    out = rollup.add_ratios(rollup.aggregate(df, "sum", Keys(), extra=["g"]), ["a"], ["a", "b"])
    got = {(r.district_id, r.sub_id, r.g): (r.a, r.a_ratio) for r in out.collect()}
    assert got[("0101"[:2], "0101", "m")] == (1, 0.25)
    assert got[("00", None, "f")] == (2, 0.5)
    assert len(got) == 6


def test_strict_staged_city_from_districts(spark):
    df = spark.createDataFrame([(2020, "01", "D1", "0101", "S1", 1.0), (2020, "02", "D2", "0201", "S2", None)],
                               "date int, district_id string, district_name string, sub_id string, sub_name string, x double")
    with pytest.raises(Exception, match="Mix of null"):
        rollup.aggregate(df, {"x": "strict"}, Keys()).collect()
    ok = rollup.aggregate(df.filter(F.col("district_id") == "01"), {"x": "strict"}, Keys())
    assert rows(ok, "district_id", "sub_id", "x") == [("00", None, 1.0), ("01", "0101", 1.0), ("01", None, 1.0)]


def test_exclude_city_rows(spark):
    df = spark.createDataFrame(DATA[:1] + [(2020, "00", "Oslo i alt", None, None, 99, 99)], SCHEMA)
    out = rollup.aggregate(df, "sum", Keys(), exclude_city=True)
    assert rows(out.filter(F.col("district_id") == "00"), "a") == [(1,)]


def test_district_city_totals_and_city_total(spark):
    df = spark.createDataFrame([(2020, "01", "D1", "x", 1), (2020, "02", "D2", "x", 2), (2020, "02", "D2", "y", 5)],
                               "date int, district_id string, district_name string, cat string, v long")
    t = rows(rollup.district_city_totals(df, Keys(), extra=["cat"]), "district_id", "cat", "v")
    assert ("00", "x", 3) in t and ("00", "y", 5) in t and len(t) == 5
    c = rows(rollup.add_city_total(df, "cat", Keys()), "district_id", "cat", "v")
    assert ("00", "x", 3) in c and len(c) == 5


def test_hot_geography_with_a_third_of_the_rows(spark):
    """One sub-district holds a third of the facts: the roll-up still combines map-side and sums right."""
    n = 30_000
    df = spark.range(n).select(
        F.lit(2020).alias("date"),
        F.when(F.col("id") % 3 == 0, F.lit("01")).otherwise(F.lpad((F.col("id") % 7 + 2).cast("string"), 2, "0"))
        .alias("district_id"),
        F.lit("D").alias("district_name"),
        F.when(F.col("id") % 3 == 0, F.lit("0101")).otherwise(F.concat(F.lit("09"), (F.col("id") % 50).cast("string")))
        .alias("sub_id"),
        F.lit("S").alias("sub_name"),
        F.lit(1).cast("long").alias("a"))
    out = rollup.aggregate(df.repartition(8), "sum", Keys())
    hot = out.filter((F.col("sub_id") == "0101")).first().a
    city = out.filter(F.col("district_id") == "00").first().a
    assert hot == n // 3 and city == n


def test_salted_join_equals_plain_join_on_a_hot_key(spark):
    from geoindicators.operators.joins import salted_join
    facts = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k"),
                                     F.col("id").alias("v"))
    dim = spark.range(50).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    plain = sorted(tuple(r) for r in facts.join(dim, "k").collect())
    salted = sorted(tuple(r) for r in salted_join(facts, dim, ["k"], salts=8).select("k", "v", "w").collect())
    assert salted == plain and len(plain) == 3000
    left = salted_join(facts, dim.filter("k < 10"), ["k"], salts=4, how="left")
    assert left.count() == 3000
