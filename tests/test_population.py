"""Population by age band (golden values: 112 ages x 2 genders of 1 person each)."""

from pyspark.sql import functions as F

from geoindicators.keys import Keys
from geoindicators.operators import pivot, population

AGES = [str(a) for a in range(0, 113) if a != 110]


def _wide(spark):
    rows = []
    for year in (2008, 2009):
        for sub, name in (("0102", "Grønland"), ("0103", "Enerhaugen")):
            for gender in (1, 2):
                rows.append((year, sub, name, "01", "Bydel Gamle Oslo", gender, *[1] * len(AGES)))
    schema = ("date int, sub_id string, sub_name string, district_id string, district_name string, kjonn int, "
              + ", ".join(f"`{a}` int" for a in AGES))
    return spark.createDataFrame(rows, schema)


def _long(spark):
    keys = ["date", "sub_id", "sub_name", "district_id", "district_name", "kjonn"]
    long = pivot.unpivot(_wide(spark), keys, AGES, "age", "count")
    return long.withColumn("age", F.col("age").cast("int"))


def test_population_total(spark):
    out = population.band_population(_long(spark), "age", "count", keys=Keys()).collect()
    assert len(out) == 4 and {r.population for r in out} == {224}


def test_population_30_to_59(spark):
    out = population.band_population(_long(spark), "age", "count", 30, 59, Keys()).collect()
    assert {r.population for r in out} == {60}


def test_max_age_is_clamped_to_120(spark):
    out = population.band_population(_long(spark), "age", "count", 100, 500, Keys()).collect()
    assert {r.population for r in out} == {2 * 12}   # ages 100..112 without 110
