"""Registered queries: heavy-hitter joins, bucketed tables, roll-up state, age prefixes."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators.operators import population
from geoindicators.operators.hot_join import hot_join
from geoindicators.operators.rollup_state import RollupState
from geoindicators.plans import star
from geoindicators.plans.common import FACT_SQL, K, conform, facts, line_facts, line_sql, r4, rollup_sql, scratch, table
from geoindicators.session import materialize
from geoindicators.sources import bucketed

Q: dict = {}
SQL: dict = {}
KEYS_SQL = "date, district_id, district_name, sub_id, sub_name"


def register(name, sql):
    def deco(fn):
        Q[name], SQL[name] = fn, sql
        return fn
    return deco


def hot_orders(spark, sf):
    """Orders of which a third belong to one customer."""
    customer = F.when(F.col("o_orderkey") % 3 == 0, F.lit(1)).otherwise(F.col("o_custkey"))
    return table(spark, sf, "orders").select("o_orderkey", customer.cast("bigint").alias("custkey"), F.col("o_totalprice").cast("decimal(18,2)").alias("price"))


def hot_customers(spark, sf):
    return table(spark, sf, "customer").select(F.col("c_custkey").cast("bigint").alias("custkey"), F.col("c_nationkey").alias("nation"))


@register("hot_key_join", """
SELECT CAST(c.c_nationkey AS BIGINT) AS nation, count(*) AS n, CAST(sum(CAST(o.o_totalprice AS DECIMAL(18, 2))) AS DOUBLE) AS price
FROM orders o LEFT JOIN customer c ON c.c_custkey = CASE WHEN o.o_orderkey % 3 = 0 THEN 1 ELSE o.o_custkey END GROUP BY c.c_nationkey""")
def hot_key_join(spark, sf):
    """A key with a third of the fact rows is found by the sketch and split, the others are joined plainly."""
    joined = hot_join(hot_orders(spark, sf), hot_customers(spark, sf), ["custkey"], "left", salt_by=["o_orderkey"])
    out = joined.groupBy("nation").agg(F.count(F.lit(1)).alias("n"), F.sum("price").cast("double").alias("price"))
    return out.select(F.col("nation").cast("long").alias("nation"), "n", "price")


_ORDERS_SQL = f"SELECT date, district_id, sub_id, CAST(count(*) AS BIGINT) AS n_orders FROM ({FACT_SQL}) GROUP BY date, district_id, sub_id"
_LINES_SQL = f"SELECT date, district_id, sub_id, {r4('sum(quantity)')} AS quantity FROM ({line_sql(0, False)}) GROUP BY date, district_id, sub_id"


@register("bucketed_join", f"SELECT * FROM ({_ORDERS_SQL}) JOIN ({_LINES_SQL}) USING (date, district_id, sub_id)")
def bucketed_join(spark, sf):
    """Two sources stored in buckets are summed and joined by geography without an exchange."""
    keys = ["date", "district_id", "sub_id"]
    orders = facts(spark, sf).groupBy(*keys).agg(F.sum("n_orders").alias("n_orders"))
    lines = line_facts(spark, sf, parts=False).groupBy(*keys).agg(F.sum("quantity").alias("quantity"))
    left, right = (bucketed.write_bucketed(df, keys, 8) for df in (orders, lines))
    return conform(bucketed.join_bucketed(spark, left, right))


@register("rollup_from_state", rollup_sql(FACT_SQL, {"n_orders": "CAST(coalesce(sum(n_orders), 0) AS BIGINT)", "revenue": r4("coalesce(sum(revenue), 0)")}))
def rollup_from_state(spark, sf):
    """A first snapshot lacks the orders of three statuses in the later years; the second one brings only those years up to date."""
    full = star.order_facts(spark, sf, ("o_orderstatus",))
    early = full.where((F.col("date") < 1996) | (F.col("o_orderstatus") == "F"))
    state = RollupState(spark, scratch(spark, "rollup-state"), ["n_orders", "revenue"], K)
    for snapshot in (early, full):
        state.refresh(snapshot)
    return conform(state.rolled_up())


_BANDS = {"young": (0, 17), "grown": (18, 39), "old": (40, 200), "all_ages": (0, 200), "none": (150, 160)}


@register("population_bands", f"""SELECT {KEYS_SQL}, {", ".join(r4(f"sum(quantity) FILTER (age BETWEEN {lo} AND least({hi}, 120))") + f" AS {n}" for n, (lo, hi) in _BANDS.items())}
FROM ({line_sql(0)}) GROUP BY {KEYS_SQL}""")
def population_bands(spark, sf):
    """A7, V-P6: several age bands as differences of one table of prefix sums; the population is read once."""
    prefix = materialize(population.age_prefix(line_facts(spark, sf), "age", "quantity", K))
    return conform(population.bands(prefix, _BANDS, K))

