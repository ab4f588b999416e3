"""All registered queries and their SQL twins, plus the flagship query."""

from __future__ import annotations

import importlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_MODULES = ["geoindicators.plans.catalog_core", "geoindicators.plans.catalog_more",
            "geoindicators.plans.catalog_docs", "geoindicators.plans.catalog_docs2",
            "geoindicators.plans.catalog_geo", "geoindicators.plans.catalog_datasets",
            "geoindicators.plans.catalog_rules", "geoindicators.plans.catalog_state",
            "geoindicators.plans.catalog_variants"]


def _load():
    qs, sql = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(m)
        qs.update(mod.Q)
        sql.update(mod.SQL)
    return qs, sql


def all_queries() -> dict:
    return _load()[0]


def all_sql() -> dict:
    return _load()[1]


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """Share of urgent orders per sub-district, district and city, as published
    documents: roll-up -> ratios -> latest common year -> template A -> documents."""
    from geoindicators.operators import align, rollup
    from geoindicators.plans.common import K, KEY_COLS, facts
    from geoindicators.publish.document import Metadata, build_documents
    from geoindicators.publish.templates import TemplateA
    from geoindicators.session import materialize

    f = facts(spark, sf, "o_orderpriority")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    f = f.select(*KEY_COLS, F.when(urgent, 1).otherwise(0).cast("long").alias("n_urgent"),
                 F.when(urgent, 0).otherwise(1).cast("long").alias("n_other"))
    r = rollup.add_ratios(rollup.aggregate(f, "sum", K), ["n_urgent"], ["n_urgent", "n_other"])
    # the indicator rows are small: computed once, then aligned and assembled from the checkpoint
    [latest] = align.status(materialize(r))
    meta = Metadata(heading="Urgent orders", series=[{"heading": "Urgent", "subheading": ""}],
                    published_date="2026-01-01")
    return build_documents(latest, TemplateA(), ["n_urgent"], meta, K, materialize_rows=False)
