"""Edge cases listed in FIXTURES.md §4 that the other tests do not already pin."""

import pytest

from geoindicators.keys import Keys
from geoindicators.operators import change, pivot, population, topn
from geoindicators.publish import document as doc
from geoindicators.publish.templates import TemplateA

K = Keys()
ROW = "date int, district_id string, district_name string, sub_id string, sub_name string"


def test_gap_year_compares_with_last_year_present(spark):
    df = spark.createDataFrame([(2010, "01", "D", "0101", "S", 100), (2012, "01", "D", "0101", "S", 130)],
                               f"{ROW}, population long")
    out = {r.date: r.change for r in change.yoy_change(df, "population").collect()}
    assert out == {2010: None, 2012: 30}


def test_sub_district_created_mid_series_breaks_strict_city_sum(spark):
    from geoindicators.operators import rollup
    df = spark.createDataFrame([(2010, "01", "D", "0101", "S1", 1.0), (2011, "01", "D", "0101", "S1", 1.0),
                                (2011, "01", "D", "0102", "S2", None)], f"{ROW}, change double")
    with pytest.raises(Exception, match="Mix of null"):
        rollup.aggregate(df, {"change": "strict"}, K).collect()


def test_tied_top_n_breaks_ties_by_category(spark):
    df = spark.createDataFrame([(2020, "01", "b", 5.0), (2020, "01", "a", 5.0), (2020, "01", "c", 9.0)],
                               "date int, district_id string, category string, total double")
    out = [r.category for r in topn.top_n_categories(df, "category", "total", 2, K).orderBy("rank").collect()]
    assert out == ["c", "a"]


def test_category_missing_everywhere_is_zero_but_missing_cell_is_null(spark):
    df = spark.createDataFrame([(2020, "01", "D", "0101", "S", "x", 1), (2020, "01", "D", "0102", "S2", "y", 2)],
                               f"{ROW}, cat string, n long")
    out = {r.sub_id: (r.x, r.y, r.z) for r in
           pivot.pivot_sum(df, K.all(), "cat", "n", ["x", "y", "z"], fill=None, zero_absent_columns=True).collect()}
    assert out == {"0101": (1, None, 0), "0102": (None, 2, 0)}


def test_two_names_for_one_id_is_an_error(spark):
    df = spark.createDataFrame([(2020, "01", "D", "0101", "Name A", 1), (2021, "01", "D", "0101", "Name B", 1)],
                               f"{ROW}, v long")
    with pytest.raises(Exception, match="Multiple names"):
        doc.build_documents(df, TemplateA(), ["v"], doc.Metadata("H"), K).collect()


def test_age_120_present_counts_in_all_ages(spark):
    df = spark.createDataFrame([(2020, "01", "D", "0101", "S", 120, 3), (2020, "01", "D", "0101", "S", 5, 2)],
                               f"{ROW}, age int, count long")
    assert population.band_population(df, "age", "count", keys=K).first().population == 5
