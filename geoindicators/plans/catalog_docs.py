"""Registered queries, part 3: templates and documents, flattened to rows.

Documents are nested; to compare them with SQL each query explodes them to one
row per (document, entry, value) with explicit ordinals, so entry and value
order are checked too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators.operators import align, relative, rollup
from geoindicators.plans.catalog_more import URGENT_RATIO_SQL, _urgent_rollup
from geoindicators.plans.common import FACT_SQL, K, KEY_COLS, conform, facts, r4, rollup_sql
from geoindicators.publish import document as doc
from geoindicators.publish.templates import TemplateA, TemplateC, TemplateH, TemplateK

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


META = doc.Metadata(heading="Urgent orders",
                    series=[{"heading": "Urgent", "subheading": ""}, {"heading": "Other", "subheading": ""}],
                    published_date="2026-01-01")


def membership_sql(src: str, cols: str) -> str:
    """SQL twin of ``document.entry_rows`` + the city entry of every district document."""
    res = "district_id IS NOT NULL AND district_id NOT IN ('05', '00')"
    return f"""
m AS (
  SELECT district_id AS doc_id, 0 AS kind, sub_id AS geo_id, sub_name AS geography, {cols}
  FROM {src} WHERE {res} AND sub_id IS NOT NULL
  UNION ALL
  SELECT district_id, 1, district_id, district_name, {cols} FROM {src} WHERE {res} AND sub_id IS NULL
  UNION ALL
  SELECT d.doc_id, 2, '00', 'Oslo i alt', {", ".join("s." + c.strip() for c in cols.split(","))}
  FROM (SELECT DISTINCT district_id AS doc_id FROM {src} WHERE {res}) d, {src} s WHERE s.district_id = '00'
  UNION ALL
  SELECT '00', CASE WHEN district_id = '00' THEN 2 ELSE 1 END, district_id,
         CASE WHEN district_id = '00' THEN 'Oslo i alt' ELSE district_name END, {cols}
  FROM {src} WHERE sub_name IS NULL AND district_id IS NOT NULL AND district_id NOT IN ('05')
)"""


def _entry_flags() -> str:
    return "(kind = 1 AND doc_id <> '00') AS avg_row, (kind = 2) AS total_row"


# --- T-A ----------------------------------------------------------------------------------

_R_ROUNDED = f"""r AS (SELECT {", ".join(KEY_COLS)}, n_urgent, n_other, {r4("n_urgent_ratio")} AS n_urgent_ratio
               FROM ({URGENT_RATIO_SQL}))"""


@register("template_a", f"""
WITH {_R_ROUNDED}, {membership_sql("r", "date, n_urgent, n_other, n_urgent_ratio")},
v AS (SELECT doc_id, kind, geo_id, geography, 0 AS s, date, n_urgent AS value, n_urgent_ratio AS ratio FROM m
      UNION ALL
      SELECT doc_id, kind, geo_id, geography, 1 AS s, date, n_other, CAST(NULL AS DOUBLE) FROM m)
SELECT doc_id, geo_id, geography, {_entry_flags()},
       CAST(row_number() OVER (PARTITION BY doc_id, geo_id ORDER BY s, date) - 1 AS BIGINT) AS ordinal,
       value, ratio, date
FROM v
""")
def template_a(spark, sf):
    """Template A documents (flat value list, series-major then year), flattened."""
    docs = doc.build_documents(_urgent_rollup(spark, sf), TemplateA(), ["n_urgent", "n_other"], META, K,
                               materialize_rows=False)
    return conform(doc.flatten_values(docs))


# --- T-C ----------------------------------------------------------------------------------

@register("template_c", f"""
WITH {_R_ROUNDED}, {membership_sql("r", "date, n_urgent, n_other, n_urgent_ratio")},
v AS (SELECT doc_id, kind, geo_id, geography, 0 AS s, date, n_urgent AS value, n_urgent_ratio AS ratio FROM m
      UNION ALL
      SELECT doc_id, kind, geo_id, geography, 1 AS s, date, n_other, CAST(NULL AS DOUBLE) FROM m)
SELECT doc_id, geo_id, geography, {_entry_flags()}, CAST(s AS BIGINT) AS series,
       CAST(row_number() OVER (PARTITION BY doc_id, geo_id, s ORDER BY date) - 1 AS BIGINT) AS ordinal,
       value, ratio, date
FROM v
""")
def template_c(spark, sf):
    """Template C documents (one value list per series), flattened."""
    docs = doc.build_documents(_urgent_rollup(spark, sf), TemplateC(), ["n_urgent", "n_other"], META, K,
                               materialize_rows=False)
    e = docs.select(F.col("id").alias("doc_id"), F.explode("data").alias("e"))
    s = e.select("doc_id", F.col("e.id").alias("geo_id"), F.col("e.geography").alias("geography"),
                 F.col("e.avgRow").alias("avg_row"), F.col("e.totalRow").alias("total_row"),
                 F.posexplode("e.values").alias("series", "vals"))
    v = s.select("doc_id", "geo_id", "geography", "avg_row", "total_row", "series",
                 F.posexplode("vals").alias("ordinal", "v"))
    return conform(v.select("doc_id", "geo_id", "geography", "avg_row", "total_row", "series", "ordinal",
                            F.col("v.value").alias("value"), F.col("v.ratio").alias("ratio"),
                            F.col("v.date").alias("date")))


# --- T-H ----------------------------------------------------------------------------------

_LATE_ROLLUP_SQL = rollup_sql(
    f"SELECT *, CASE WHEN date >= 1997 THEN revenue END AS late_revenue FROM ({FACT_SQL})",
    {"n_orders": "CAST(coalesce(sum(n_orders), 0) AS BIGINT)",
     "late_revenue": r4("CASE WHEN count(late_revenue) = 0 THEN NULL ELSE sum(late_revenue) END")})


@register("template_h", f"""
WITH r AS ({_LATE_ROLLUP_SQL}), {membership_sql("r", "date, n_orders, late_revenue")},
v AS (SELECT doc_id, kind, geo_id, geography, 0 AS s, date, n_orders, late_revenue FROM m
      UNION ALL
      SELECT doc_id, kind, geo_id, geography, 1 AS s, date, NULL, late_revenue FROM m WHERE late_revenue IS NOT NULL)
SELECT doc_id, geo_id, geography, {_entry_flags()}, CAST(s AS BIGINT) AS series,
       CAST(row_number() OVER (PARTITION BY doc_id, geo_id, s ORDER BY date) - 1 AS BIGINT) AS ordinal,
       date, CAST(n_orders AS BIGINT) AS n_orders, late_revenue
FROM v
""")
def template_h(spark, sf):
    """Template H: per series, per-year objects holding only non-null measures;
    objects with nothing but a year are dropped (late revenue starts in 1997)."""
    f = facts(spark, sf).withColumn("late_revenue", F.when(F.col(K.date) >= 1997, F.col("revenue")))
    r = rollup.aggregate(f.select(*KEY_COLS, "n_orders", "late_revenue"),
                         {"n_orders": "sum", "late_revenue": "strict"}, K)
    docs = doc.build_documents(r, TemplateH(), [["n_orders", "late_revenue"], ["late_revenue"]], META, K)
    e = docs.select(F.col("id").alias("doc_id"), F.explode("data").alias("e"))
    s = e.select("doc_id", F.col("e.id").alias("geo_id"), F.col("e.geography").alias("geography"),
                 F.col("e.avgRow").alias("avg_row"), F.col("e.totalRow").alias("total_row"),
                 F.posexplode("e.values").alias("series", "vals"))
    v = s.select("doc_id", "geo_id", "geography", "avg_row", "total_row", "series",
                 F.posexplode("vals").alias("ordinal", "v"))
    return conform(v.select("doc_id", "geo_id", "geography", "avg_row", "total_row", "series", "ordinal",
                            F.col("v.date").alias("date"), F.col("v.n_orders").alias("n_orders"),
                            F.col("v.late_revenue").alias("late_revenue")))


# --- T-K ----------------------------------------------------------------------------------

_REL_SQL = f"""
rr AS ({URGENT_RATIO_SQL}),
f AS (SELECT * FROM rr WHERE district_id IS NULL OR district_id NOT IN ('05')),
d AS (SELECT date, district_id, first(n_urgent_ratio) AS dref FROM f WHERE sub_id IS NULL GROUP BY date, district_id),
c AS (SELECT date, first(n_urgent_ratio) AS cref FROM f WHERE district_id = '00' GROUP BY date),
k0 AS (SELECT f.date, f.district_id, f.district_name, f.sub_id, f.sub_name,
              f.n_urgent_ratio / nullif(d.dref, 0) AS n_urgent_ratio_district,
              f.n_urgent_ratio / nullif(c.cref, 0) AS n_urgent_ratio_oslo
       FROM f JOIN d ON f.date = d.date AND f.district_id = d.district_id JOIN c ON f.date = c.date),
r AS (SELECT * FROM k0 WHERE date = (SELECT max(date) FROM k0))"""


@register("template_k", f"""
WITH {_REL_SQL}, {membership_sql("r", "date, n_urgent_ratio_district, n_urgent_ratio_oslo")}
SELECT doc_id, geo_id, geography, {_entry_flags()}, CAST(0 AS BIGINT) AS ordinal,
       {r4("n_urgent_ratio_district")} AS districtRatio, {r4("n_urgent_ratio_oslo")} AS osloRatio
FROM m
""")
def template_k(spark, sf):
    """Template K on the newest year: ratios relative to the district and to the city."""
    rel = align.keep_newest(relative.add_relative_ratio(_urgent_rollup(spark, sf), "n_urgent_ratio", K),
                            drop_date=False)
    docs = doc.build_documents(rel, TemplateK(), ["n_urgent"], META, K, materialize_rows=False)
    return conform(doc.flatten_values(docs, ("districtRatio", "osloRatio")))


# --- D1..D4 documents -------------------------------------------------------------------

@register("documents_district", f"""
WITH {_R_ROUNDED}, {membership_sql("r", "date")},
e AS (SELECT doc_id, kind, geo_id, geography, count(*) AS n FROM m GROUP BY doc_id, kind, geo_id, geography),
names AS (SELECT district_id AS doc_id, max(district_name) AS district FROM r
          WHERE district_id NOT IN ('05', '00') AND sub_id IS NULL GROUP BY district_id)
SELECT e.doc_id, coalesce(names.district, 'Oslo i alt') AS district,
       CAST(row_number() OVER (PARTITION BY e.doc_id ORDER BY kind, geo_id) - 1 AS BIGINT) AS entry_pos,
       geo_id, geography, (kind = 1 AND e.doc_id <> '00') AS avg_row, (kind = 2) AS total_row,
       CAST(2 * n AS BIGINT) AS n_values,
       CASE WHEN e.doc_id = '00' THEN 'oslo i alt' ELSE 'bydel' END AS scope
FROM e LEFT JOIN names ON e.doc_id = names.doc_id
""")
def documents_district(spark, sf):
    """Entry list of every document: sub-districts by id, the district, the city."""
    docs = doc.build_documents(_urgent_rollup(spark, sf), TemplateA(), ["n_urgent", "n_other"], META, K,
                               materialize_rows=False)
    e = docs.select(F.col("id").alias("doc_id"), "district", F.col("meta.scope").alias("scope"),
                    F.posexplode("data").alias("entry_pos", "e"))
    return conform(e.select("doc_id", "district", "entry_pos", F.col("e.id").alias("geo_id"),
                            F.col("e.geography").alias("geography"), F.col("e.avgRow").alias("avg_row"),
                            F.col("e.totalRow").alias("total_row"),
                            F.size("e.values").cast("long").alias("n_values"), "scope"))


@register("documents_city", f"""
WITH {_R_ROUNDED}, {membership_sql("r", "date, n_urgent")}
SELECT geo_id, geography, {_entry_flags()}, CAST(count(*) AS BIGINT) AS n_values,
       CAST(sum(n_urgent) AS BIGINT) AS urgent_total
FROM m WHERE doc_id = '00' GROUP BY geo_id, geography, kind, doc_id
""")
def documents_city(spark, sf):
    """The city document: every residential district at district level, then the city."""
    docs = doc.build_documents(_urgent_rollup(spark, sf), TemplateA(), ["n_urgent"], META, K,
                               materialize_rows=False)
    city = docs.filter(F.col("id") == K.city_id).select(F.explode("data").alias("e"))
    return conform(city.select(
        F.col("e.id").alias("geo_id"), F.col("e.geography").alias("geography"),
        F.col("e.avgRow").alias("avg_row"), F.col("e.totalRow").alias("total_row"),
        F.size("e.values").cast("long").alias("n_values"),
        F.aggregate("e.values", F.lit(0).cast("long"), lambda acc, x: acc + x["value"]).alias("urgent_total")))
