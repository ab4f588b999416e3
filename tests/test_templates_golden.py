"""The reference's template goldens: marker strings as values make every value's
origin visible (``<series>_<geography>_<year>``), so the tests pin which row
feeds which entry and in which order."""

import json

import pytest

from geoindicators.keys import OSLO_KEYS as K
from geoindicators.publish import document as doc
from geoindicators.publish.templates import TemplateA, TemplateC, TemplateK

GEOS = [("01", "Bydel Gamle Oslo", "0101", "Lodalen"), ("01", "Bydel Gamle Oslo", "0102", "Grønland"),
        ("01", "Bydel Gamle Oslo", None, None), ("02", "Bydel Grünerløkka", "0201", "Grünerløkka vest"),
        ("02", "Bydel Grünerløkka", "0202", "Grünerløkka øst"), ("02", "Bydel Grünerløkka", None, None),
        ("00", "Oslo i alt", None, None), ("16", "Sentrum", None, None)]
SCHEMA = "bydel_id string, bydel_navn string, delbydel_id string, delbydel_navn string, date int"


def _geo(g):
    return g[2] or g[0]


@pytest.fixture(scope="module")
def marker_df(spark):
    rows = [(*g, y, f"d1_{_geo(g)}_{y}", f"d2_{_geo(g)}_{y}", f"d1_{_geo(g)}_{y}_ratio")
            for g in GEOS for y in (2017, 2018)]
    return spark.createDataFrame(rows, f"{SCHEMA}, d1 string, d2 string, d1_ratio string")


def _docs(df, template, series):
    docs = doc.build_documents(df, template, series, doc.Metadata("", []), K, materialize_rows=False)
    return {r.name: json.loads(r.json) for r in doc.to_json_documents(docs).collect()}


def _entry(d, geo_id):
    return next(e for e in d["data"] if e["id"] == geo_id)


def test_template_a_latest(marker_df):
    out = _docs(marker_df.filter("date = 2018"), TemplateA(), ["d1", "d2"])
    assert set(out) == {"01", "02", "00"}                      # no document for Sentrum (16)
    d = out["01"]
    for geo_id, name, avg, total in [("0101", "Lodalen", False, False), ("01", "Bydel Gamle Oslo", True, False),
                                     ("00", "Oslo i alt", False, True)]:
        assert _entry(d, geo_id) == {
            "id": geo_id, "geography": name, "avgRow": avg, "totalRow": total,
            "values": [{"value": f"d1_{geo_id}_2018", "ratio": f"d1_{geo_id}_2018_ratio", "date": 2018},
                       {"value": f"d2_{geo_id}_2018", "date": 2018}]}
    assert [e["id"] for e in d["data"]] == ["0101", "0102", "01", "00"]
    assert len(_entry(d, "0101")["values"]) == 2


def test_template_c_all_years(marker_df):
    out = _docs(marker_df, TemplateC(), ["d1", "d2"])
    values = _entry(out["02"], "0202")["values"]
    assert values == [
        [{"value": f"d1_0202_{y}", "ratio": f"d1_0202_{y}_ratio", "date": y} for y in (2017, 2018)],
        [{"value": f"d2_0202_{y}", "date": y} for y in (2017, 2018)],
    ]
    city_doc = out["00"]
    assert city_doc["district"] == "Oslo i alt" and city_doc["meta"]["scope"] == "oslo i alt"
    assert [e["id"] for e in city_doc["data"]] == ["01", "02", "00"]


def test_template_k(spark):
    rows = [(*g, 2018, *[f"{s}_{_geo(g)}_2018_ratio_{kind}" for s in ("d1", "d2") for kind in ("district", "oslo")])
            for g in GEOS]
    df = spark.createDataFrame(rows, f"{SCHEMA}, d1_ratio_district string, d1_ratio_oslo string, "
                                     "d2_ratio_district string, d2_ratio_oslo string")
    out = _docs(df, TemplateK(), ["d1", "d2"])
    assert set(out) == {"01", "02", "00"}
    for geo_id, avg, total in [("0101", False, False), ("01", True, False), ("00", False, True)]:
        e = _entry(out["01"], geo_id)
        assert (e["avgRow"], e["totalRow"]) == (avg, total)
        assert e["values"] == [{"districtRatio": f"{s}_{geo_id}_2018_ratio_district",
                                "osloRatio": f"{s}_{geo_id}_2018_ratio_oslo"} for s in ("d1", "d2")]
