"""Registered queries, part 5: age pyramid (E), key numbers (G), moves (F/Fs),
top-N documents (N/Nh, D6) and the newest-snapshot source (S1)."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from geoindicators.operators import align, change, joins, pivot, rollup, topn
from geoindicators.plans.catalog_docs import META, membership_sql
from geoindicators.plans.common import FACT_SQL, K, KEY_COLS, conform, facts, line_facts, line_sql, r4, rollup_sql
from geoindicators.publish import document as doc
from geoindicators.publish.templates import TemplateE, TemplateFlow, TemplateG
from geoindicators.session import materialize
from geoindicators.sources import snapshots

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def _flags(doc_col="doc_id") -> str:
    return f"(kind = 1 AND {doc_col} <> '00') AS avg_row, (kind = 2) AS total_row"


def _explode_entries(docs):
    return docs.select(F.col("id").alias("doc_id"), F.explode("data").alias("e")).select(
        "doc_id", F.col("e.id").alias("geo_id"), F.col("e.geography").alias("geography"),
        F.col("e.avgRow").alias("avg_row"), F.col("e.totalRow").alias("total_row"), F.col("e.values").alias("vals"))


# --- T-E: age pyramid ----------------------------------------------------------------------

_E_SQL = f"""
WITH l AS ({line_sql(0)}),
ly AS (SELECT * FROM l WHERE date = (SELECT max(date) FROM l)),
p AS (SELECT date, district_id, district_name, sub_id, sub_name, age,
             coalesce(sum(quantity) FILTER (WHERE line_status = 'O'), 0) AS mann,
             coalesce(sum(quantity) FILTER (WHERE line_status = 'F'), 0) AS kvinne
      FROM ly GROUP BY date, district_id, district_name, sub_id, sub_name, age),
r AS ({rollup_sql("SELECT * FROM p", {"mann": "coalesce(sum(mann), 0)", "kvinne": "coalesce(sum(kvinne), 0)"},
                  extra=["age"])}),
{membership_sql("r", "date, age, mann, kvinne")}
SELECT doc_id, geo_id, geography, {_flags()},
       CAST(row_number() OVER (PARTITION BY doc_id, geo_id ORDER BY age) - 1 AS BIGINT) AS ordinal,
       CAST(age AS BIGINT) AS age, {r4("mann")} AS mann, {r4("kvinne")} AS kvinne, {r4("mann + kvinne")} AS value,
       {r4("(mann + kvinne) / nullif(sum(mann + kvinne) OVER (PARTITION BY doc_id, geo_id), 0)")} AS ratio, date
FROM m
"""


@register("template_e", _E_SQL)
def template_e(spark, sf):
    """Template E on the newest year: quantity per part size ("age") split by
    line status ("gender"), with each size's share of the geography's total."""
    wide = pivot.pivot_sum(line_facts(spark, sf), [*KEY_COLS, "age"], "line_status", "quantity", {"O": "mann", "F": "kvinne"}, fill=0)
    # rolled up first: the newest year is then found, and picked, among small rows
    [r] = align.status(materialize(rollup.aggregate(wide, "sum", K, extra=["age"])))
    docs = doc.build_documents(r, TemplateE(), [], META, K)
    e = _explode_entries(docs)
    v = e.select("doc_id", "geo_id", "geography", "avg_row", "total_row", F.posexplode("vals").alias("ordinal", "v"))
    return conform(v.select("doc_id", "geo_id", "geography", "avg_row", "total_row", "ordinal",
                            *[F.col(f"v.{c}").alias(c) for c in ("age", "mann", "kvinne", "value", "ratio", "date")]))


# --- T-G: key numbers (status + growth history) ---------------------------------------------

_G_SQL = f"""
WITH r AS ({rollup_sql(FACT_SQL, {"n_orders": "CAST(coalesce(sum(n_orders), 0) AS BIGINT)"})}),
mx AS (SELECT max(date) AS mx FROM r),
latest AS (SELECT * FROM r WHERE date = (SELECT mx FROM mx)),
h AS (SELECT district_id AS hd, sub_id AS hs, n_orders AS hv,
             row_number() OVER (PARTITION BY district_id, sub_id ORDER BY date) - 1 AS ord
      FROM r WHERE date > (SELECT mx FROM mx) - 5),
{membership_sql("latest", "date, n_orders, district_id, sub_id")}
SELECT doc_id, geo_id, geography, {_flags()}, 'status' AS part, CAST(0 AS BIGINT) AS ordinal,
       CAST(n_orders AS DOUBLE) AS value, date FROM m
UNION ALL
SELECT doc_id, geo_id, geography, {_flags()}, 'history', CAST(h.ord AS BIGINT), CAST(h.hv AS DOUBLE), m.date
FROM m JOIN h ON m.district_id = h.hd AND m.sub_id IS NOT DISTINCT FROM h.hs
"""


@register("template_g", _G_SQL)
def template_g(spark, sf):
    """Template G: the newest value and the last five years' history of every geography."""
    r = materialize(rollup.aggregate(facts(spark, sf).select(*KEY_COLS, "n_orders"), "sum", K))
    hist = change.growth_history(r, "n_orders", 5, K)
    latest = align.keep_newest(r, drop_date=False)
    rows = joins.join_on(latest, hist, [K.district_id, K.sub_id], "left", null_safe=[K.sub_id])
    docs = doc.build_documents(rows, TemplateG(), ["n_orders"], META, K, materialize_rows=False)
    e = _explode_entries(docs)
    base = ["doc_id", "geo_id", "geography", "avg_row", "total_row"]
    status = e.select(*base, F.lit("status").alias("part"), F.posexplode("vals.status").alias("ordinal", "value"),
                      F.col("vals.date").alias("date"))
    history = e.select(*base, F.lit("history").alias("part"), F.posexplode("vals.history").alias("ordinal", "value"),
                       F.col("vals.date").alias("date"))
    return conform(status.unionByName(history))


# --- T-F / T-Fs: moves by age group ---------------------------------------------------------

AGE_GROUP = ("lpad(CAST(CAST(floor((age - 1) / 10) * 10 + 1 AS BIGINT) AS STRING), 2, '0') || '-' || "
             "lpad(CAST(CAST(floor((age - 1) / 10) * 10 + 10 AS BIGINT) AS STRING), 2, '0')")
FLOWS = {"OA": "in_between", "ON": "in_within", "OR": "in_city", "FA": "out_between", "FN": "out_within",
         "FR": "out_city"}
FLOW_SERIES = {"in": ["in_between", "in_within", "in_city"], "out": ["out_between", "out_within", "out_city"]}

_F_SQL = f"""
WITH l AS (SELECT *, {AGE_GROUP} AS age_group, line_status || flag AS kind FROM ({line_sql(0)})),
d AS (SELECT date, district_id, district_name, age_group,
        {", ".join(f"coalesce(sum(quantity) FILTER (WHERE kind = '{k}'), 0) AS {v}" for k, v in FLOWS.items())}
      FROM l GROUP BY date, district_id, district_name, age_group),
t AS (SELECT date, district_id, district_name, CAST(NULL AS VARCHAR) AS sub_id, CAST(NULL AS VARCHAR) AS sub_name,
             age_group, {", ".join(FLOWS.values())} FROM d
      UNION ALL
      SELECT date, '00', 'Oslo i alt', NULL, NULL, age_group, {", ".join(f"sum({v})" for v in FLOWS.values())}
      FROM d GROUP BY date, age_group),
{membership_sql("t", "date, age_group, " + ", ".join(FLOWS.values()))},
y AS (SELECT *, dense_rank() OVER (PARTITION BY doc_id, geo_id ORDER BY date) - 1 AS year_pos,
             row_number() OVER (PARTITION BY doc_id, geo_id, date ORDER BY age_group) - 1 AS age_pos FROM m)
SELECT doc_id, geo_id, geography, {_flags()}, CAST(year_pos AS BIGINT) AS year_pos, date AS year,
       'immigration' AS direction, CAST(age_pos AS BIGINT) AS age_pos, age_group AS alder,
       {r4("in_between")} AS mellomBydeler, {r4("in_within")} AS innenforBydelen, {r4("in_city")} AS tilFraOslo
FROM y
UNION ALL
SELECT doc_id, geo_id, geography, {_flags()}, CAST(year_pos AS BIGINT), date, 'emigration', CAST(age_pos AS BIGINT),
       age_group, {r4("out_between")}, {r4("out_within")}, {r4("out_city")}
FROM y
"""


def _flow_rows(spark, sf):
    lf = line_facts(spark, sf).withColumns({"age_group": F.expr(AGE_GROUP),
                                            "kind": F.concat("line_status", "flag")})
    d = pivot.pivot_sum(lf, [K.date, K.district_id, K.district_name, "age_group"], "kind", "quantity", FLOWS,
                        fill=0)
    t = rollup.district_city_totals(d, K, extra=["age_group"])
    return t.withColumns({K.sub_id: F.lit(None).cast("string"), K.sub_name: F.lit(None).cast("string")})


@register("template_flow", _F_SQL)
def template_flow(spark, sf):
    """Moves template: per year, in- and out-moves by age group and kind, for
    districts and the city (a source without sub-districts)."""
    docs = doc.build_documents(_flow_rows(spark, sf), TemplateFlow(), FLOW_SERIES, META, K)
    e = _explode_entries(docs)
    base = ["doc_id", "geo_id", "geography", "avg_row", "total_row"]
    y = e.select(*base, F.posexplode("vals").alias("year_pos", "y"))
    out = None
    for direction in ("immigration", "emigration"):
        part = y.select(*base, "year_pos", F.col("y.year").alias("year"), F.lit(direction).alias("direction"),
                        F.posexplode(f"y.{direction}").alias("age_pos", "a"))
        part = part.select(*base, "year_pos", "year", "direction", "age_pos", F.col("a.alder").alias("alder"),
                           *[F.col(f"a.{c}").alias(c) for c in ("mellomBydeler", "innenforBydelen", "tilFraOslo")])
        out = part if out is None else out.unionByName(part)
    return conform(out)


@register("template_flow_status", f"""
WITH s AS ({_F_SQL.replace("SELECT doc_id, geo_id, geography,", "SELECT doc_id, kind, geo_id, geography,")})
SELECT doc_id, geo_id, geography, avg_row, total_row, year, direction, age_pos, alder,
       mellomBydeler, innenforBydelen, tilFraOslo
FROM s WHERE year = (SELECT max(year) FROM s s2 WHERE s2.doc_id = s.doc_id AND s2.geo_id = s.geo_id)
""")
def template_flow_status(spark, sf):
    """Status moves template: only the newest year's object per geography."""
    docs = doc.build_documents(_flow_rows(spark, sf), TemplateFlow(status=True), FLOW_SERIES, META, K)
    e = _explode_entries(docs)
    base = ["doc_id", "geo_id", "geography", "avg_row", "total_row"]
    out = None
    for direction in ("immigration", "emigration"):
        part = e.select(*base, F.col("vals.year").alias("year"), F.lit(direction).alias("direction"),
                        F.posexplode(f"vals.{direction}").alias("age_pos", "a"))
        part = part.select(*base, "year", "direction", "age_pos", F.col("a.alder").alias("alder"),
                           *[F.col(f"a.{c}").alias(c) for c in ("mellomBydeler", "innenforBydelen", "tilFraOslo")])
        out = part if out is None else out.unionByName(part)
    return conform(out)


# --- T-N / T-Nh / D6: top-N documents --------------------------------------------------------

_N_BASE = f"""
l AS ({line_sql(0)}),
d0 AS (SELECT date, district_id, district_name, category, sum(quantity) AS quantity FROM l
       GROUP BY date, district_id, district_name, category),
d1 AS (SELECT * FROM d0 UNION ALL
       SELECT date, '00', 'Oslo i alt', category, sum(quantity) FROM d0 GROUP BY date, category),
tot AS (SELECT date, district_id, sum(quantity) AS total FROM d1 GROUP BY date, district_id),
d AS (SELECT d1.*, d1.quantity / nullif(tot.total, 0) AS quantity_ratio FROM d1
      JOIN tot ON d1.date = tot.date AND d1.district_id = tot.district_id),
lt AS (SELECT *, max(date) OVER (PARTITION BY district_id) AS mx FROM d),
rk AS (SELECT district_id, category,
              row_number() OVER (PARTITION BY district_id ORDER BY quantity DESC, category) AS rank
       FROM lt WHERE date = mx),
top AS (SELECT d.*, rk.rank FROM d JOIN rk ON d.district_id = rk.district_id AND d.category = rk.category
        WHERE rk.rank <= 3)"""


@register("template_topn", f"""
WITH {_N_BASE}
SELECT district_id AS doc_id, district_name AS district, CAST(rank - 1 AS BIGINT) AS entry_pos,
       category AS geography, CAST(0 AS BIGINT) AS series,
       CAST(row_number() OVER (PARTITION BY district_id, category ORDER BY date) - 1 AS BIGINT) AS ordinal,
       date, {r4("quantity")} AS value, {r4(r4("quantity_ratio"))} AS ratio
FROM top
""")
def template_topn(spark, sf):
    """Top-N documents (historic): per district its three largest part types, each
    with its yearly quantity and share of the district's total."""
    d = materialize(_topn_rows(spark, sf))
    ranking = topn.top_n_categories(d, "category", "quantity", 3, K)
    docs = doc.top_n_documents(d, "category", ["quantity"], ranking, META, K, status=False)
    e = docs.select(F.col("id").alias("doc_id"), "district", F.posexplode("data").alias("entry_pos", "e"))
    s = e.select("doc_id", "district", "entry_pos", F.col("e.geography").alias("geography"),
                 F.posexplode("e.values").alias("series", "vals"))
    v = s.select("doc_id", "district", "entry_pos", "geography", "series", F.posexplode("vals").alias("ordinal", "v"))
    return conform(v.select("doc_id", "district", "entry_pos", "geography", "series", "ordinal",
                            F.col("v.date").alias("date"), F.col("v.value").alias("value"),
                            F.col("v.ratio").alias("ratio")))


@register("template_topn_status", f"""
WITH {_N_BASE}
SELECT district_id AS doc_id, CAST(rank - 1 AS BIGINT) AS entry_pos, category AS geography,
       date, {r4("quantity")} AS value, {r4(r4("quantity_ratio"))} AS ratio
FROM top WHERE date = (SELECT max(date) FROM top t2 WHERE t2.district_id = top.district_id
                       AND t2.category = top.category)
""")
def template_topn_status(spark, sf):
    """Top-N documents (status): the newest value of each top category."""
    d = materialize(_topn_rows(spark, sf))
    ranking = topn.top_n_categories(d, "category", "quantity", 3, K)
    docs = doc.top_n_documents(d, "category", ["quantity"], ranking, META, K, status=True)
    e = docs.select(F.col("id").alias("doc_id"), F.posexplode("data").alias("entry_pos", "e"))
    v = e.select("doc_id", "entry_pos", F.col("e.geography").alias("geography"), F.explode("e.values").alias("v"))
    return conform(v.select("doc_id", "entry_pos", "geography", F.col("v.date").alias("date"),
                            F.col("v.value").alias("value"), F.col("v.ratio").alias("ratio")))


def _topn_rows(spark, sf):
    lf = line_facts(spark, sf)
    d = (lf.groupBy(K.date, K.district_id, K.district_name, "category").agg(F.sum("quantity").alias("quantity")))
    d = rollup.add_city_total(d, "category", K)
    tot = d.groupBy(K.date, K.district_id).agg(F.sum("quantity").alias("_total"))
    return (d.join(tot, [K.date, K.district_id])
            .withColumn("quantity_ratio", F.try_divide(F.col("quantity"), F.col("_total"))).drop("_total"))


# --- S1: newest snapshot ----------------------------------------------------------------------

@register("latest_snapshot")
def latest_snapshot(spark, sf):
    """The newest table file in the source directory (by modification time, then
    name) and its row count; the listing reads no file contents."""
    path = snapshots.resolve_input(spark, sf, "*.parquet")
    return (spark.read.parquet(path).agg(F.count(F.lit(1)).alias("n_rows"))
            .select(F.lit(os.path.basename(path)).alias("snapshot"), "n_rows"))
