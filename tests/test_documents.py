import json

from geoindicators.keys import Keys
from geoindicators.operators import rollup
from geoindicators.publish import document as doc
from geoindicators.publish.templates import TemplateA, TemplateC, TemplateK

SCHEMA = "date int, district_id string, district_name string, sub_id string, sub_name string, d1 long, d2 long"
DATA = [
    (2017, "01", "Bydel A", "0101", "Sub 1", 1, 0),
    (2018, "01", "Bydel A", "0101", "Sub 1", 2, 0),
    (2018, "01", "Bydel A", "0102", "Sub 2", 3, 1),
    (2018, "02", "Bydel B", "0201", "Sub 3", 4, 1),
    (2018, "16", "Sentrum", "1601", "Sentrum", 5, 0),
]
META = doc.Metadata(heading="H", series=[{"heading": "One", "subheading": ""}], published_date="2020-01-01")


def _docs(spark, template=TemplateA(), series=("d1",)):
    df = spark.createDataFrame(DATA, SCHEMA)
    r = rollup.add_ratios(rollup.aggregate(df, "sum", Keys()), ["d1"], ["d1", "d2"])
    return {d.id: d for d in doc.build_documents(r, template, list(series), META, Keys()).collect()}


def test_district_document_entries(spark):
    docs = _docs(spark)
    assert set(docs) == {"01", "02", "00"}          # 16 gets no document
    d1 = docs["01"]
    assert d1.district == "Bydel A"
    assert [(e.id, e.avgRow, e.totalRow) for e in d1.data] == [
        ("0101", False, False), ("0102", False, False), ("01", True, False), ("00", False, True)]
    sub1 = d1.data[0]
    assert [(v.value, v.date) for v in sub1.values] == [(1, 2017), (2, 2018)]
    assert sub1.values[0].ratio == 1.0
    assert d1.data[3].geography == "Oslo i alt"


def test_city_document(spark):
    city = _docs(spark)["00"]
    assert city.meta.scope == "oslo i alt"
    assert [(e.id, e.avgRow, e.totalRow) for e in city.data] == [
        ("01", False, False), ("02", False, False), ("00", False, True)]


def test_template_c_lists_per_series(spark):
    d = _docs(spark, TemplateC(), ("d1", "d2"))["01"]
    sub1 = d.data[0]
    assert len(sub1.values) == 2 and [v.value for v in sub1.values[1]] == [0, 0]
    assert sub1.values[1][0].ratio is None


def test_json_omits_missing_ratio_keeps_zero(spark):
    df = spark.createDataFrame([(2018, "01", "A", "0101", "S", 0, 5)], SCHEMA)
    r = rollup.add_ratios(rollup.aggregate(df, "sum", Keys()), ["d1"], ["d1", "d2"])
    docs = doc.build_documents(r, TemplateA(), ["d1", "d2"], META, Keys())
    js = {row.name: json.loads(row.json) for row in doc.to_json_documents(docs).collect()}
    values = js["01"]["data"][0]["values"]
    assert values[0] == {"value": 0, "ratio": 0.0, "date": 2018}
    assert values[1] == {"value": 5, "date": 2018}


def test_template_k(spark):
    df = spark.createDataFrame([(2018, "01", "A", "0101", "S", 0.5, 2.0), (2018, "01", "A", None, None, 0.25, 1.0),
                                (2018, "00", "Oslo i alt", None, None, 1.0, 1.0)],
                               "date int, district_id string, district_name string, sub_id string, sub_name string, "
                               "d1_ratio_district double, d1_ratio_oslo double")
    d = {x.id: x for x in doc.build_documents(df, TemplateK(), ["d1"], META, Keys()).collect()}["01"]
    assert [(v.districtRatio, v.osloRatio) for v in d.data[0].values] == [(0.5, 2.0)]
