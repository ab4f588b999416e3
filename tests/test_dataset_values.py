"""Hand-computed values of a few datasets on the synthetic snapshots."""

import json

import pytest

from geoindicators import datasets
from geoindicators.publish.document import to_json_documents
from tests.dataset_fixtures import SUBS, _v, raw_inputs


@pytest.fixture(scope="module")
def geo(spark):
    from geoindicators.geo.oslo import oslo_geography
    return oslo_geography(spark)


def _docs(spark, geo, name, variant):
    spec = datasets.get(name)
    docs = datasets.run(spec, variant, raw_inputs(spark, spec.sources), geo, published_date="2024-01-01")
    return {r.name: json.loads(r.json) for r in to_json_documents(docs).collect()}


def _entry(doc, geo_id):
    [e] = [e for e in doc["data"] if e["id"] == geo_id]
    return e


def test_rooms_per_person_ratios_over_the_four_bands(spark, geo):
    docs = _docs(spark, geo, "trangboddhet", "alle_status")
    bands = {sid: [_v(2022, sid, k) for k in range(4)] for sid, _, _ in SUBS}
    sub = _entry(docs["01"], "0101")["values"]
    a = bands["0101"]
    assert [v["value"] for v in sub] == a
    assert sub[0]["ratio"] == round(a[0] / sum(a), 4)
    city = _entry(docs["01"], "00")["values"]
    # the city row already in the source is not counted twice
    assert city[0]["value"] == sum(b[0] for b in bands.values())
    assert docs["01"]["meta"]["heading"] == "Husstander fordelt på personer per rom"


def test_tenure_percent_to_ratio_and_dropped_districts(spark, geo):
    docs = _docs(spark, geo, "eieform", "status")
    leier = _entry(docs["01"], "0101")["values"][0]
    assert leier == {"value": 30.0, "ratio": 0.3, "date": 2022}
    assert docs["01"]["meta"]["scale"]["value"] == [27.0, 30.0]
    assert "16" not in docs and "17" not in docs


def test_age_distribution_lists_every_age(spark, geo):
    docs = _docs(spark, geo, "alder_distribusjon_status", "status")
    ages = _entry(docs["01"], "0101")["values"]
    assert [a["age"] for a in ages] == [str(i) for i in range(121)]
    assert abs(sum(a["ratio"] for a in ages) - 1.0) < 1e-3
    assert ages[1] == {"age": "1", "mann": 0, "kvinne": 0, "value": 0, "ratio": 0.0, "date": 2022}


def test_living_conditions_relative_ratios(spark, geo):
    docs = _docs(spark, geo, "levekar_totalt", "status")
    values = _entry(docs["01"], "0101")["values"]
    assert len(values) == 6
    neets = values[4]   # sub 0101: 0.07, district 01: 0.06, city: 0.07
    assert neets == {"districtRatio": round(0.07 / 0.06, 4), "osloRatio": 1.0}


def test_largest_groups_top_n(spark, geo):
    docs = _docs(spark, geo, "landbakgrunn_innvandringsgrupper", "status")
    d = docs["01"]
    assert len(d["data"]) == 5 and set(d["meta"]) == {"series", "heading"}
    totals = [e["values"][0]["value"] + e["values"][1]["value"] for e in d["data"]]
    assert totals == sorted(totals, reverse=True)
