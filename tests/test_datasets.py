"""Every variant of every dataset runs end to end on small synthetic snapshots."""

import json

import pytest

from geoindicators import datasets
from geoindicators.datasets.spec import run
from geoindicators.geo.oslo import oslo_geography
from geoindicators.publish.document import to_json_documents
from tests.dataset_fixtures import raw_inputs

CASES = [(name, variant) for name, spec in sorted(datasets.registry().items()) for variant in spec.variants]


@pytest.fixture(scope="module")
def geo(spark):
    return oslo_geography(spark)


@pytest.mark.parametrize("name,variant", CASES)
def test_variant_runs(spark, geo, name, variant):
    spec = datasets.get(name)
    docs = run(spec, variant, raw_inputs(spark, spec.sources), geo, published_date="2024-01-01")
    out = {r.name: json.loads(r.json) for r in to_json_documents(docs).collect()}
    assert out, "no documents"
    for d in out.values():
        assert d["data"], d
        if not spec.variants[variant].top_n:
            assert d["meta"]["publishedDate"] == "2024-01-01"


def test_unknown_variant():
    with pytest.raises(ValueError, match="Unknown dataset type"):
        datasets.get("utdanning").variant("nope")
