"""Registered queries, part 2: top-N, relative ratios, scale, joins, totals, row rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators.functions import nulls
from geoindicators.operators import align, filters, joins, relative, rollup, scale, topn
from geoindicators.plans.catalog_core import SUM_ORDERS, _URGENT_SQL
from geoindicators.session import materialize
from geoindicators.plans.common import (FACT_SQL, K, KEY_COLS, conform, facts, line_facts, line_sql, r4,
                                        rollup_sql, table)

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


KEYS_SQL = "date, district_id, district_name, sub_id, sub_name"
NON_RES = "'05'"


def _urgent_rollup(spark, sf):
    f = facts(spark, sf, "o_orderpriority")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    f = f.select(*KEY_COLS, F.when(urgent, 1).otherwise(0).cast("long").alias("n_urgent"),
                 F.when(urgent, 0).otherwise(1).cast("long").alias("n_other"))
    return materialize(rollup.add_ratios(rollup.aggregate(f, "sum", K), ["n_urgent"], ["n_urgent", "n_other"]))


URGENT_RATIO_SQL = f"""
WITH r0 AS ({rollup_sql(_URGENT_SQL, {"n_urgent": "CAST(coalesce(sum(n_urgent), 0) AS BIGINT)",
                                      "n_other": "CAST(coalesce(sum(n_other), 0) AS BIGINT)"})})
SELECT *, n_urgent / nullif(coalesce(n_urgent, 0) + coalesce(n_other, 0), 0) AS n_urgent_ratio FROM r0
"""


# --- W6 top-N ------------------------------------------------------------------

@register("top_n_categories", f"""
WITH d AS (SELECT date, district_id, district_name, category, sum(quantity) AS total
           FROM ({line_sql(0)}) GROUP BY date, district_id, district_name, category),
l AS (SELECT *, max(date) OVER (PARTITION BY district_id) AS mx FROM d),
k AS (SELECT *, row_number() OVER (PARTITION BY district_id ORDER BY total DESC, category ASC) AS top_rank
      FROM l WHERE date = mx)
SELECT date, district_id, district_name, category, {r4("total")} AS total, CAST(top_rank AS BIGINT) AS top_rank
FROM k WHERE top_rank <= 3
""")
def top_n_categories(spark, sf):
    """Three largest part types (by quantity) per district on its newest year."""
    lf = line_facts(spark, sf)
    d = materialize(lf.groupBy(K.date, K.district_id, K.district_name, "category")
                    .agg(F.sum("quantity").alias("total")))
    return conform(topn.top_n_categories(d, "category", "total", 3, K, rank_col="top_rank"))


# --- W7 relative ratios --------------------------------------------------------

@register("relative_to_district_and_city", f"""
WITH r AS ({URGENT_RATIO_SQL}),
f AS (SELECT * FROM r WHERE district_id IS NULL OR district_id NOT IN ({NON_RES})),
d AS (SELECT date, district_id, first(n_urgent_ratio) AS dref FROM f WHERE sub_id IS NULL GROUP BY date, district_id),
c AS (SELECT date, first(n_urgent_ratio) AS cref FROM f WHERE district_id = '00' GROUP BY date)
SELECT f.date, f.district_id, f.district_name, f.sub_id, f.sub_name,
       {r4("f.n_urgent_ratio / nullif(d.dref, 0)")} AS n_urgent_ratio_district,
       {r4("f.n_urgent_ratio / nullif(c.cref, 0)")} AS n_urgent_ratio_oslo
FROM f JOIN d ON f.date = d.date AND f.district_id = d.district_id JOIN c ON f.date = c.date
""")
def relative_to_district_and_city(spark, sf):
    r = _urgent_rollup(spark, sf)
    return conform(relative.add_relative_ratio(r, "n_urgent_ratio", K))


# --- A12 scale -------------------------------------------------------------------

@register("scale_min_max", f"""
WITH r AS ({URGENT_RATIO_SQL}),
f AS (SELECT * FROM r WHERE district_id IS NULL OR district_id NOT IN ({NON_RES}))
SELECT CAST(min(n_urgent) AS DOUBLE) AS value_min, CAST(max(n_urgent) AS DOUBLE) AS value_max,
       {r4("min(n_urgent_ratio)")} AS ratio_min, {r4("max(n_urgent_ratio)")} AS ratio_max
FROM f WHERE date = (SELECT max(date) FROM f)
""")
def scale_min_max(spark, sf):
    return conform(scale.scale_min_max(_urgent_rollup(spark, sf), "n_urgent", K))


@register("scale_missing_column", f"""
WITH r AS ({URGENT_RATIO_SQL}),
f AS (SELECT * FROM r WHERE district_id IS NULL OR district_id NOT IN ({NON_RES}))
SELECT CAST(min(n_other) AS DOUBLE) AS value_min, CAST(max(n_other) AS DOUBLE) AS value_max,
       CAST(0 AS DOUBLE) AS ratio_min, CAST(0 AS DOUBLE) AS ratio_max
FROM f WHERE date = (SELECT max(date) FROM f)
""")
def scale_missing_column(spark, sf):
    """``n_other`` has no ratio column: its ratio range is [0, 0]."""
    return conform(scale.scale_min_max(_urgent_rollup(spark, sf), "n_other", K))


# --- J1 / J2 / J4 natural joins ------------------------------------------------------

_A_SQL = rollup_sql(FACT_SQL, {"n_orders": "CAST(coalesce(sum(n_orders), 0) AS BIGINT)"})


def _b_sql(shift):
    return rollup_sql(line_sql(shift, parts=False), {"quantity": r4("coalesce(sum(quantity), 0)")})


_PROMO_SQL = rollup_sql(f"SELECT * FROM ({line_sql(0)}) WHERE category = 'PROMO'",
                        {"promo_quantity": r4("coalesce(sum(quantity), 0)")})
_NS = " AND ".join(f"{{a}}.{c} IS NOT DISTINCT FROM {{b}}.{c}" for c in KEY_COLS)


def _a(spark, sf):
    return rollup.aggregate(facts(spark, sf).select(*KEY_COLS, "n_orders"), "sum", K)


def _b(spark, sf, shift=0):
    return rollup.aggregate(line_facts(spark, sf, shift, parts=False).select(*KEY_COLS, "quantity"), "sum", K)


def _promo(spark, sf):
    lf = line_facts(spark, sf).filter(F.col("category") == "PROMO")
    return rollup.aggregate(lf.select(*KEY_COLS, F.col("quantity").alias("promo_quantity")), "sum", K)


@register("natural_join_inner", f"""
WITH a AS ({_A_SQL}), b AS ({_b_sql(0)}), c AS ({_PROMO_SQL})
SELECT a.*, b.quantity, c.promo_quantity FROM a
JOIN b ON {_NS.format(a="a", b="b")}
JOIN c ON {_NS.format(a="a", b="c")}
""")
def natural_join_inner(spark, sf):
    """Three indicators joined on all common columns; district and city rows
    (NULL sub-district) match each other."""
    return conform(joins.natural_join(_a(spark, sf), _b(spark, sf), _promo(spark, sf), how="inner"))


@register("natural_join_outer", f"""
WITH a AS ({_A_SQL}), b AS ({_b_sql(1)})
SELECT {", ".join(f"coalesce(a.{c}, b.{c}) AS {c}" for c in KEY_COLS)}, a.n_orders, b.quantity
FROM a FULL OUTER JOIN b ON {_NS.format(a="a", b="b")}
""")
def natural_join_outer(spark, sf):
    """Years present on one side only survive with NULL measures on the other."""
    return conform(joins.natural_join(_a(spark, sf), _b(spark, sf, 1), how="full_outer"))


# --- P7 / J5 / J6 / J10 ------------------------------------------------------------------

_POP_SUB_SQL = (f"SELECT {KEYS_SQL}, CAST(sum(n_orders) AS BIGINT) AS population FROM ({FACT_SQL}) "
                f"GROUP BY {KEYS_SQL}")


@register("shifted_year_join", f"""
WITH p AS ({_POP_SUB_SQL}),
e AS (SELECT date - 1 AS date, sub_id, sum(quantity) AS quantity FROM ({line_sql(0, parts=False)}) GROUP BY date, sub_id)
SELECT p.date, p.sub_id, p.district_id, p.population, {r4("e.quantity")} AS quantity,
       {r4("e.quantity / nullif(p.population, 0)")} AS per_capita
FROM p JOIN e ON p.date = e.date AND p.sub_id = e.sub_id
""")
def shifted_year_join(spark, sf):
    """A year-end measure moved one year back, joined on (year, sub-district)."""
    pop = rollup.presum(facts(spark, sf).select(*KEY_COLS, F.col("n_orders").alias("population")), K)
    e = (align.shift_years(line_facts(spark, sf, parts=False), -1)
         .groupBy(K.date, K.sub_id).agg(F.sum("quantity").alias("quantity")))
    j = pop.join(e, [K.date, K.sub_id])
    return conform(j.select(K.date, K.sub_id, K.district_id, "population", "quantity",
                            nulls.safe_div(F.col("quantity"), F.col("population")).alias("per_capita")))


@register("semi_join_present", f"""
WITH a AS ({_A_SQL}),
b AS (SELECT DISTINCT sub_id FROM ({line_sql(0)}) WHERE category = 'PROMO' AND age > 45)
SELECT * FROM a WHERE sub_id IN (SELECT sub_id FROM b)
""")
def semi_join_present(spark, sf):
    """Keep indicator rows whose sub-district occurs in another source."""
    b = line_facts(spark, sf).filter((F.col("category") == "PROMO") & (F.col("age") > 45)).select(K.sub_id)
    return conform(joins.semi_join_present(_a(spark, sf), b, K.sub_id))


@register("join_rolled_population", f"""
WITH a AS ({_A_SQL}), c AS ({_PROMO_SQL})
SELECT c.date, c.district_id, c.district_name, c.sub_id, c.sub_name, c.promo_quantity, a.n_orders,
       {r4("c.promo_quantity / nullif(a.n_orders, 0)")} AS promo_per_order
FROM c JOIN a ON c.date = a.date AND c.district_id = a.district_id AND c.sub_id IS NOT DISTINCT FROM a.sub_id
""")
def join_rolled_population(spark, sf):
    """Indicator joined to the rolled-up population at all three levels."""
    a = _a(spark, sf).drop(K.district_name, K.sub_name)
    c = _promo(spark, sf)
    j = joins.join_on(c, a, [K.date, K.district_id, K.sub_id], "inner", null_safe=[K.sub_id])
    return conform(j.select(*KEY_COLS, "promo_quantity", "n_orders",
                            nulls.safe_div(F.col("promo_quantity"), F.col("n_orders")).alias("promo_per_order")))


# --- A9 / A10 ----------------------------------------------------------------------------------

_DISTRICT_CAT_SQL = (f"SELECT date, district_id, district_name, category, sum(quantity) AS quantity "
                     f"FROM ({line_sql(0)}) GROUP BY date, district_id, district_name, category")


@register("category_city_total", f"""
WITH d AS ({_DISTRICT_CAT_SQL})
SELECT date, district_id, district_name, category, {r4("quantity")} AS quantity FROM d
UNION ALL
SELECT date, '00', 'Oslo i alt', category, {r4("sum(quantity)")} FROM d GROUP BY date, category
""")
def category_city_total(spark, sf):
    d = (line_facts(spark, sf).groupBy(K.date, K.district_id, K.district_name, "category")
         .agg(F.sum("quantity").alias("quantity")))
    return conform(rollup.add_city_total(d, "category", K))


@register("flow_totals", f"""
WITH d AS (SELECT date, district_id, district_name, line_status, quantity FROM ({line_sql(0, parts=False)}))
SELECT date, district_id, district_name, line_status, {r4("sum(quantity)")} AS quantity FROM d
GROUP BY date, district_id, district_name, line_status
UNION ALL
SELECT date, '00', 'Oslo i alt', line_status, {r4("sum(quantity)")} FROM d GROUP BY date, line_status
""")
def flow_totals(spark, sf):
    """District and city totals for a source without a sub-district level."""
    d = line_facts(spark, sf, parts=False).select(K.date, K.district_id, K.district_name, "line_status", "quantity")
    return conform(rollup.district_city_totals(d, K, extra=["line_status"]))


# --- A13, P3/P4, P8, clean number, round4 -------------------------------------------------------

@register("dedup_rows", f"""
SELECT DISTINCT date, district_id, sub_id, o_orderstatus, o_orderpriority FROM ({FACT_SQL})
""")
def dedup_rows(spark, sf):
    f = facts(spark, sf, "o_orderstatus", "o_orderpriority")
    return conform(filters.dedup(f.select(K.date, K.district_id, K.sub_id, "o_orderstatus", "o_orderpriority")))


@register("not_in_keeps_null", f"""
WITH r AS ({rollup_sql(FACT_SQL.replace("n.n_name AS sub_name", "n.n_name AS sub_name"), SUM_ORDERS)})
SELECT * FROM r WHERE sub_name IS NULL OR sub_name NOT IN ('NATION_0', 'NATION_1')
""")
def not_in_keeps_null(spark, sf):
    """Anti-membership on literals keeps the NULL (district and city) rows."""
    r = rollup.aggregate(facts(spark, sf).select(*KEY_COLS, "n_orders", "revenue"), "sum", K)
    return conform(r.filter(filters.not_in_keep_null(K.sub_name, ["NATION_0", "NATION_1"])))


_PRIO3 = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium"}


@register("row_sum_propagate_vs_skip", f"""
WITH p AS (
  SELECT date, sub_id, o_orderstatus,
    {", ".join(f"CASE WHEN count(*) FILTER (WHERE o_orderpriority = '{c}') > 0 "
               f"THEN coalesce(sum(revenue) FILTER (WHERE o_orderpriority = '{c}'), 0) END AS {o}"
               for c, o in _PRIO3.items())}
  FROM ({FACT_SQL}) GROUP BY date, sub_id, o_orderstatus)
SELECT date, sub_id, o_orderstatus, {", ".join(r4(o) + " AS " + o for o in _PRIO3.values())},
       {r4("urgent + high + medium")} AS total_strict,
       {r4("coalesce(urgent, 0) + coalesce(high, 0) + coalesce(medium, 0)")} AS total_skip
FROM p
""")
def row_sum_propagate_vs_skip(spark, sf):
    """``a + b + c`` (NULL if one is missing) next to the null-skipping row sum."""
    from geoindicators.operators import pivot
    f = facts(spark, sf, "o_orderstatus", "o_orderpriority")
    p = pivot.pivot_sum(f, [K.date, K.sub_id, "o_orderstatus"], "o_orderpriority", "revenue", _PRIO3, fill=None)
    cols = list(_PRIO3.values())
    return conform(p.withColumns({"total_strict": nulls.row_sum_propagate(cols),
                                  "total_skip": nulls.row_sum_skip(cols)}))


_TEXT_SQL = ("CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '..' ELSE CAST(c_custkey AS VARCHAR) || ' ' || "
             "lpad(CAST(c_nationkey AS VARCHAR), 3, '0') END")


@register("clean_number", f"""
SELECT c_custkey, {_TEXT_SQL} AS text,
       TRY_CAST(regexp_replace({_TEXT_SQL}, '\\s', '', 'g') AS DOUBLE) AS value
FROM customer
""")
def clean_number(spark, sf):
    """Counts published as text with blanks as thousand separators and '..' for
    suppressed values become numbers or NULL."""
    c = table(spark, sf, "customer")
    text = (F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(".."))
            .otherwise(F.concat(F.col("c_custkey").cast("string"), F.lit(" "),
                                F.lpad(F.col("c_nationkey").cast("string"), 3, "0"))))
    out = c.select("c_custkey", text.alias("text"))
    return conform(out.withColumn("value", nulls.clean_number("text")))


@register("round4", f"""
SELECT o_orderkey, {r4("o_totalprice / 7")} AS price_7th, {r4("o_totalprice * 0.00015")} AS tiny,
       {r4("CAST(o_orderkey AS DOUBLE) / 20000 + 0.00005")} AS edge
FROM orders
""")
def round4(spark, sf):
    """Round-half-even on the binary value, 4 decimals."""
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", nulls.round4(F.col("o_totalprice") / 7).alias("price_7th"),
                    nulls.round4(F.col("o_totalprice") * 0.00015).alias("tiny"),
                    nulls.round4(F.col("o_orderkey").cast("double") / 20000 + 0.00005).alias("edge"))


# --- P10 / P13 / A8 / A11 / A14 ------------------------------------------------------------------

@register("drop_null_rows", f"""
SELECT date, sub_id, o_orderkey AS order_key, {r4("late_revenue")} AS late_revenue
FROM (SELECT *, CASE WHEN date >= 1997 THEN revenue END AS late_revenue
      FROM ({FACT_SQL.replace("o.o_orderpriority, o.o_custkey", "o.o_orderpriority, o.o_custkey, o.o_orderkey")}))
WHERE late_revenue IS NOT NULL
""")
def drop_null_rows(spark, sf):
    """Rows with a missing measure are dropped (``dropna`` on a subset)."""
    f = facts(spark, sf, "o_orderkey").withColumn(
        "late_revenue", F.when(F.col(K.date) >= 1997, F.col("revenue")))
    kept = filters.drop_nulls(f.select(K.date, K.sub_id, F.col("o_orderkey").alias("order_key"), "late_revenue"),
                              "any", ["late_revenue"])
    return conform(kept)


@register("population_totals", f"""
SELECT date, district_id, sub_id, CAST(sum(n_orders) AS BIGINT) AS population
FROM ({FACT_SQL}) GROUP BY date, district_id, sub_id
""")
def population_totals(spark, sf):
    """Totals per (year, district, sub-district) over every category."""
    from geoindicators.operators import population
    f = facts(spark, sf).select(*KEY_COLS, "n_orders")
    return conform(population.total_population(f, "n_orders", K))


@register("district_level_only", f"""
WITH r AS ({rollup_sql(f"SELECT * FROM ({FACT_SQL}) WHERE district_id NOT IN ('05')",
                       {"n_orders": "CAST(coalesce(sum(n_orders), 0) AS BIGINT)"})})
SELECT * FROM r WHERE sub_id IS NULL
""")
def district_level_only(spark, sf):
    """Roll up without the non-residential district, keep district and city rows."""
    f = facts(spark, sf).select(*KEY_COLS, "n_orders")
    return conform(rollup.district_only(f, "sum", K, ignore_districts=["05"]))


@register("distinct_geographies", f"""
SELECT DISTINCT district_id, sub_id FROM ({FACT_SQL})
""")
def distinct_geographies(spark, sf):
    """The district / sub-district pairs present in the facts."""
    return filters.distinct_keys(facts(spark, sf), [K.district_id, K.sub_id])
