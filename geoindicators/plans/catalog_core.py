"""Registered queries, part 1: roll-up, ratios, alignment, pivots, population, changes.

Every query reads the driver tables in ``sf`` and returns a DataFrame whose
columns and types match the DuckDB SQL next to it.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators.functions.nulls import round4
from geoindicators.operators import align, change, pivot, population, rollup
from geoindicators.session import materialize
from geoindicators.plans.common import (FACT_SQL, K, KEY_COLS, conform, facts, line_facts, line_sql, r4,
                                        rollup_sql)

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


SUM_ORDERS = {"n_orders": "CAST(coalesce(sum(n_orders), 0) AS BIGINT)",
              "revenue": r4("coalesce(sum(revenue), 0)")}
KEYS_SQL = "date, district_id, district_name, sub_id, sub_name"


# --- A1 / A2: three-level roll-up -------------------------------------------

@register("rollup_three_level", rollup_sql(FACT_SQL, SUM_ORDERS))
def rollup_three_level(spark, sf):
    f = facts(spark, sf).select(*KEY_COLS, "n_orders", "revenue")
    return conform(rollup.aggregate(f, "sum", K))


@register("rollup_extra_dim", rollup_sql(FACT_SQL, SUM_ORDERS, extra=["o_orderstatus"]))
def rollup_extra_dim(spark, sf):
    f = facts(spark, sf, "o_orderstatus").select(*KEY_COLS, "o_orderstatus", "n_orders", "revenue")
    return conform(rollup.aggregate(f, "sum", K, extra=["o_orderstatus"]))


_NULL_SUB_SQL = f"""
SELECT date, district_id, district_name,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE sub_id END AS sub_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN NULL ELSE sub_name END AS sub_name,
       n_orders, revenue
FROM ({FACT_SQL})
"""


@register("rollup_null_subdistrict", rollup_sql(_NULL_SUB_SQL, SUM_ORDERS))
def rollup_null_subdistrict(spark, sf):
    """Orders of unknown address (lowest priority here) have no sub-district:
    they count for the district and the city only."""
    f = facts(spark, sf, "o_orderpriority")
    unknown = F.col("o_orderpriority") == F.lit("5-LOW")
    f = f.withColumns({K.sub_id: F.when(unknown, F.lit(None)).otherwise(F.col(K.sub_id)),
                       K.sub_name: F.when(unknown, F.lit(None)).otherwise(F.col(K.sub_name))})
    return conform(rollup.aggregate(f.select(*KEY_COLS, "n_orders", "revenue"), "sum", K))


_LATE_SQL = f"SELECT *, CASE WHEN date >= 1997 THEN revenue END AS late_revenue FROM ({FACT_SQL})"
_STRICT = ("CASE WHEN count(late_revenue) = 0 THEN NULL "
           "WHEN count(late_revenue) < count(*) THEN error('mix') ELSE sum(late_revenue) END")


@register("rollup_strict_sum", rollup_sql(_LATE_SQL, {
    "n_orders": "CAST(coalesce(sum(n_orders), 0) AS BIGINT)", "late_revenue": r4(_STRICT)}))
def rollup_strict_sum(spark, sf):
    """Strict sum (all null -> null, mix -> error), staged roll-up: the city from districts."""
    f = facts(spark, sf).withColumn("late_revenue", F.when(F.col(K.date) >= 1997, F.col("revenue")))
    f = f.select(*KEY_COLS, "n_orders", "late_revenue")
    return conform(rollup.aggregate(f, {"n_orders": "sum", "late_revenue": "strict"}, K))


# --- A5 ratios ---------------------------------------------------------------

_URGENT_SQL = f"""SELECT *, CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END AS BIGINT) AS n_urgent,
CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 0 ELSE 1 END AS BIGINT) AS n_other FROM ({FACT_SQL})"""


@register("ratios", f"""
WITH r AS ({rollup_sql(_URGENT_SQL, {"n_urgent": "CAST(coalesce(sum(n_urgent), 0) AS BIGINT)",
                                     "n_other": "CAST(coalesce(sum(n_other), 0) AS BIGINT)"})})
SELECT *, {r4("n_urgent / nullif(coalesce(n_urgent, 0) + coalesce(n_other, 0), 0)")} AS n_urgent_ratio FROM r
""")
def ratios(spark, sf):
    f = facts(spark, sf, "o_orderpriority")
    urgent = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    f = f.select(*KEY_COLS, F.when(urgent, 1).otherwise(0).cast("long").alias("n_urgent"),
                 F.when(urgent, 0).otherwise(1).cast("long").alias("n_other"))
    r = rollup.aggregate(f, "sum", K)
    return conform(rollup.add_ratios(r, ["n_urgent"], ["n_urgent", "n_other"]))


# --- Y1 / Y2 / Y3 year alignment --------------------------------------------

_ROLLED = rollup_sql(FACT_SQL, SUM_ORDERS)


def _line_rolled(shift: int) -> str:
    return rollup_sql(line_sql(shift, parts=False), {"quantity": r4("coalesce(sum(quantity), 0)")})


def _both_sql(where: str, shift: int) -> str:
    return f"""
WITH a AS ({_ROLLED}), b AS ({_line_rolled(shift)}), common AS (SELECT date FROM a INTERSECT SELECT date FROM b)
SELECT 'orders' AS source, {KEYS_SQL}, CAST(n_orders AS DOUBLE) AS value FROM a WHERE {where}
UNION ALL SELECT 'lines', {KEYS_SQL}, CAST(quantity AS DOUBLE) FROM b WHERE {where}
"""


def _two_sources(spark, sf, shift):
    """Orders and (year-shifted) shipments, each rolled up once: small rows, read again for their years."""
    a = materialize(rollup.aggregate(facts(spark, sf).select(*KEY_COLS, "n_orders"), "sum", K))
    b = materialize(rollup.aggregate(line_facts(spark, sf, shift, parts=False).select(*KEY_COLS, "quantity"), "sum", K))
    return a, b


def _both(a, b):
    return conform(a.select(F.lit("orders").alias("source"), *KEY_COLS, F.col("n_orders").cast("double").alias("value"))
                   .unionByName(b.select(F.lit("lines").alias("source"), *KEY_COLS, F.col("quantity").cast("double").alias("value"))))


@register("historic_common_years", _both_sql("date IN (SELECT date FROM common)", 1))
def historic_common_years(spark, sf):
    """Orders (1995..) aligned with shipments counted on next year's 1 January: both inputs, common years only."""
    return _both(*align.historic(*_two_sources(spark, sf, 1)))


@register("status_latest_common_year", _both_sql("date = (SELECT max(date) FROM common)", -1))
def status_latest_common_year(spark, sf):
    return _both(*align.status(*_two_sources(spark, sf, -1)))


_LINE_ROLLED = rollup_sql(line_sql(0, parts=False), {"quantity": r4("coalesce(sum(quantity), 0)"),
                                        "price": r4("coalesce(sum(price), 0)")})


@register("keep_newest", f"""
WITH r AS ({_LINE_ROLLED}) SELECT * EXCLUDE (date) FROM r WHERE date = (SELECT max(date) FROM r)
""")
def keep_newest(spark, sf):
    r = materialize(rollup.aggregate(line_facts(spark, sf, parts=False).select(*KEY_COLS, "quantity", "price"), "sum", K))
    return conform(align.keep_newest(r))


# --- V-P1 .. V-P5 pivots -----------------------------------------------------

PRIORITIES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium",
              "4-NOT SPECIFIED": "unspecified", "5-LOW": "low", "9-NONE": "none"}


def _pivot_cells(value: str, fill: bool, cast: str) -> str:
    cells = []
    for cat, out in PRIORITIES.items():
        total = f"coalesce(sum({value}) FILTER (WHERE o_orderpriority = '{cat}'), 0)"
        present = f"count(*) FILTER (WHERE o_orderpriority = '{cat}') > 0"
        cell = f"CASE WHEN {present} THEN {total} ELSE {'0' if fill else 'NULL'} END"
        cells.append(f"{r4(cell) if cast == 'DOUBLE' else f'CAST({cell} AS BIGINT)'} AS {out}")
    return ", ".join(cells)


@register("pivot_sum_filled", f"SELECT {KEYS_SQL}, {_pivot_cells('n_orders', True, 'BIGINT')} "
                              f"FROM ({FACT_SQL}) GROUP BY {KEYS_SQL}")
def pivot_sum_filled(spark, sf):
    f = facts(spark, sf, "o_orderpriority")
    return conform(pivot.pivot_sum(f, KEY_COLS, "o_orderpriority", "n_orders", PRIORITIES, fill=0))


@register("pivot_sum_unfilled", f"SELECT {KEYS_SQL}, {_pivot_cells('revenue', False, 'DOUBLE')} "
                                f"FROM ({FACT_SQL}) GROUP BY {KEYS_SQL}")
def pivot_sum_unfilled(spark, sf):
    f = facts(spark, sf, "o_orderpriority")
    return conform(pivot.pivot_sum(f, KEY_COLS, "o_orderpriority", "revenue", PRIORITIES, fill=None))


STATUSES = {"F": "f", "O": "o", "P": "p"}


@register("pivot_regroup", f"""
SELECT {KEYS_SQL},
  {", ".join(f"CAST(coalesce(sum(n_orders) FILTER (WHERE o_orderstatus = '{c}'), 0) AS BIGINT) AS n_orders_{o}, "
             f"{r4(f'coalesce(sum(revenue) FILTER (WHERE o_orderstatus = {chr(39)}{c}{chr(39)}), 0)')} AS revenue_{o}"
             for c, o in STATUSES.items())}
FROM ({FACT_SQL}) GROUP BY {KEYS_SQL}
""")
def pivot_regroup(spark, sf):
    f = facts(spark, sf, "o_orderstatus").select(*KEY_COLS, "o_orderstatus", "n_orders", "revenue")
    return conform(pivot.pivot_regroup(f, "o_orderstatus", ["n_orders", "revenue"], STATUSES))


@register("pivot_mean", f"""
SELECT {KEYS_SQL},
  {", ".join(f"{r4(f'avg(CAST(round(revenue) AS BIGINT)) FILTER (WHERE o_orderstatus = {chr(39)}{c}{chr(39)})')} AS mean_{o}"
             for c, o in STATUSES.items())}
FROM ({FACT_SQL}) GROUP BY {KEYS_SQL}
""")
def pivot_mean(spark, sf):
    """Mean order value (whole currency units, so the mean is exact) per status."""
    f = facts(spark, sf, "o_orderstatus").withColumn("units", F.round("revenue").cast("long"))
    return conform(pivot.pivot_mean(f, KEY_COLS, "o_orderstatus", "units",
                                    {c: f"mean_{o}" for c, o in STATUSES.items()}))


@register("pivot_events_by_type", """
SELECT CAST(user_id AS BIGINT) AS user_id,
  CAST(count(*) FILTER (WHERE event_type = 'view') AS BIGINT) AS view,
  CAST(count(*) FILTER (WHERE event_type = 'click') AS BIGINT) AS click,
  CAST(count(*) FILTER (WHERE event_type = 'purchase') AS BIGINT) AS purchase,
  CAST(count(*) FILTER (WHERE event_type = 'signup') AS BIGINT) AS signup,
  CAST(count(*) FILTER (WHERE event_type = 'error') AS BIGINT) AS error
FROM events WHERE user_id IS NOT NULL GROUP BY user_id
""")
def pivot_events_by_type(spark, sf):
    """Category pivot on the event stream table (count per user and type, absent -> 0)."""
    from geoindicators.plans.common import table
    ev = table(spark, sf, "events").select("user_id", "event_type", F.lit(1).cast("long").alias("one"))
    types = ["view", "click", "purchase", "signup", "error"]
    return conform(pivot.pivot_sum(ev, ["user_id"], "event_type", "one", types, fill=0))


# --- A7 population by band ---------------------------------------------------

@register("band_population", f"""
SELECT {KEYS_SQL}, {r4("coalesce(sum(quantity), 0)")} AS population
FROM ({line_sql(0)}) WHERE age BETWEEN 30 AND 49 GROUP BY {KEYS_SQL}
""")
def band_population(spark, sf):
    """p_size plays the age: quantity of parts sized 30..49 per (year, sub-district)."""
    lf = line_facts(spark, sf)
    return conform(population.band_population(lf, "age", "quantity", 30, 49, K))


# --- W1 .. W5, W9 changes ----------------------------------------------------

_POP_SQL = f"SELECT {KEYS_SQL}, CAST(sum(n_orders) AS BIGINT) AS population FROM ({FACT_SQL}) GROUP BY {KEYS_SQL}"


def _population(spark, sf):
    """Population per (year, sub-district): small, read by several change operators."""
    f = facts(spark, sf).select(*KEY_COLS, F.col("n_orders").alias("population"))
    return materialize(rollup.presum(f, K))


@register("yoy_change", f"""
SELECT *, population - lag(population) OVER (PARTITION BY sub_id ORDER BY date) AS change FROM ({_POP_SQL})
""")
def yoy_change(spark, sf):
    return conform(change.yoy_change(_population(spark, sf), "population", "change", K))


_H5_SQL = f"""
WITH p AS ({_POP_SQL}), y AS (SELECT max(date) AS mx FROM p)
SELECT date, district_id, sub_id,
       population - lag(population) OVER (PARTITION BY sub_id ORDER BY date) AS change_5y
FROM p WHERE date = (SELECT mx FROM y) OR date = (SELECT mx FROM y) - 5
"""


@register("horizon_change", _H5_SQL)
def horizon_change(spark, sf):
    """Five-year change (the test data spans seven years, so the horizon is 5)."""
    return conform(change.horizon_change(_population(spark, sf), "population", 5, "change_5y", K))


_STRICT_CH = ("CASE WHEN count({c}) = 0 THEN NULL WHEN count({c}) < count(*) THEN error('mix') "
              "ELSE CAST(sum({c}) AS DOUBLE) END")


@register("change_ratios", f"""
WITH p AS ({_POP_SQL}),
c AS (SELECT *, population - lag(population) OVER (PARTITION BY sub_id ORDER BY date) AS change FROM p),
h AS ({_H5_SQL}),
j AS (SELECT c.*, h.change_5y FROM c LEFT JOIN h ON c.date = h.date AND c.sub_id = h.sub_id),
r AS ({rollup_sql("SELECT * FROM j", {"population": "CAST(coalesce(sum(population), 0) AS BIGINT)",
                                      "change": _STRICT_CH.format(c="change"),
                                      "change_5y": _STRICT_CH.format(c="change_5y")})})
SELECT {KEYS_SQL}, population, {r4("change")} AS change, {r4("change_5y")} AS change_5y,
  {r4("change / nullif(lag(population, 1) OVER (PARTITION BY district_id, sub_id ORDER BY date), 0)")} AS change_ratio,
  {r4("change_5y / nullif(lag(population, 5) OVER (PARTITION BY district_id, sub_id ORDER BY date), 0)")} AS change_5y_ratio
FROM r
""")
def change_ratios(spark, sf):
    """Population with 1- and 5-year change, strict roll-up of the changes, then change ratios."""
    pop = _population(spark, sf)
    on = [K.date, K.district_id, K.sub_id]
    ch = change.yoy_change(pop, "population", "change", K).select(*on, "change")
    ch5 = change.horizon_change(pop, "population", 5, "change_5y", K)
    df = pop.join(ch, on, "left").join(ch5, on, "left")
    r = rollup.aggregate(df, {"population": "sum", "change": "strict", "change_5y": "strict"}, K)
    return conform(change.change_ratios(r, "population", "change", "change_5y", 5, K))


@register("pct_change_levels", f"""
WITH r AS ({rollup_sql(FACT_SQL, {"n_orders": "CAST(coalesce(sum(n_orders), 0) AS BIGINT)"})})
SELECT *, {r4("n_orders / nullif(lag(n_orders) OVER (PARTITION BY district_id, sub_id ORDER BY date), 0) - 1")} AS change
FROM r
""")
def pct_change_levels(spark, sf):
    r = rollup.aggregate(facts(spark, sf).select(*KEY_COLS, "n_orders"), "sum", K)
    return conform(change.pct_change_levels(r, "n_orders", "change", K))


@register("growth_history", f"""
WITH r AS ({rollup_sql(FACT_SQL, {"n_orders": "CAST(coalesce(sum(n_orders), 0) AS BIGINT)"})})
SELECT district_id, sub_id,
       CAST(row_number() OVER (PARTITION BY district_id, sub_id ORDER BY date) - 1 AS BIGINT) AS ordinal,
       date, n_orders AS value
FROM r WHERE date > (SELECT max(date) FROM r) - 5
""")
def growth_history(spark, sf):
    """Last five years per geography as an ordered array, flattened for comparison."""
    r = materialize(rollup.aggregate(facts(spark, sf).select(*KEY_COLS, "n_orders"), "sum", K))
    h = change.growth_history(r, "n_orders", 5, K)
    flat = h.select(K.district_id, K.sub_id, F.posexplode("history").alias("ordinal", "h"))
    return conform(flat.select(K.district_id, K.sub_id, "ordinal", F.col("h.date").alias("date"),
                               F.col("h.value").alias("value")))


