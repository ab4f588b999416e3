"""Plan-shape guards for the scale properties the design relies on."""

import contextlib
import io

from geoindicators.keys import Keys
from geoindicators.operators import rollup
from geoindicators.plans import star
from geoindicators.publish import document as doc
from geoindicators.publish.templates import TemplateA
from geoindicators.session import materialize
from tests.conftest import SF_SMALL


def _plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def test_rollup_is_one_scan_and_one_shuffle(spark):
    f = star.order_facts(spark, SF_SMALL).select(*star.KEYS.all(), "n_orders", "revenue")
    plan = _plan(rollup.aggregate(f, "sum", star.KEYS))
    assert plan.count("Expand") == 1
    assert plan.count("Scan parquet") == 4            # orders, customer, nation, region: each read once
    assert "partial_sum" in plan                      # map-side combine before the shuffle
    # the only shuffles are the aggregate's and (at most) the fact join's
    assert plan.count("Exchange hashpartitioning") <= 3


def test_projection_and_filters_reach_the_scan(spark):
    f = star.order_facts(spark, SF_SMALL).select(*star.KEYS.all(), "n_orders")
    plan = _plan(rollup.aggregate(f, "sum", star.KEYS))
    assert "ReadSchema: struct<o_custkey:bigint,o_orderdate:timestamp_ntz>" in plan
    assert "PushedFilters: [IsNotNull(o_orderdate), IsNotNull(o_custkey)]" in plan


def test_geography_lookups_share_one_broadcast_dictionary(spark):
    from geoindicators.geo import resolve as R
    from geoindicators.plans.star_geo import star_geography
    geo = star_geography(spark, SF_SMALL)
    df = spark.createDataFrame([("Africa",), ("NATION_3",)], "v string")
    # one lookup for each thing that is looked up: a parent or another spelling needs none of its own
    for out, lookups in ((R.district_by_name(df, "v", geo), 1), (R.resolve_one_column(df, "v", geo), 2), (R.sub_by_legacy_id(df, "v", geo), 1),
                         (R.resolve_sub_name_with_fallback(df, "v", "v", geo), 2), (R.resolve_mixed(df, "v", geo), 4)):
        plan = _plan(out)
        joins = [line for line in plan.splitlines() if "Join" in line]
        assert len(joins) == lookups and all("BroadcastHashJoin" in line and "LeftOuter" in line for line in joins)
        assert "Exchange hashpartitioning" not in plan
        assert out.columns == ["v", "district_id", "district_name", "sub_id", "sub_name"]


def test_documents_read_materialized_rows_only(spark):
    f = star.order_facts(spark, SF_SMALL).select(*star.KEYS.all(), "n_orders")
    rows = materialize(rollup.aggregate(f, "sum", star.KEYS))
    docs = doc.build_documents(rows, TemplateA(), ["n_orders"], doc.Metadata("H"), star.KEYS,
                               materialize_rows=False)
    plan = _plan(docs)
    assert "Scan parquet" not in plan                 # the fact scan and roll-up are not re-run
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_top_n_uses_a_group_limit(spark):
    from geoindicators.operators.topn import top_n_categories
    df = spark.createDataFrame([(2020, "01", f"c{i}", float(i)) for i in range(20)],
                               "date int, district_id string, category string, total double")
    plan = _plan(top_n_categories(df, "category", "total", 3, Keys()))
    assert "WindowGroupLimit" in plan
