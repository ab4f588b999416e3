"""Shared pieces of the registered queries: fact builders, output conforming, SQL snippets."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoindicators.functions.nulls import round4
from geoindicators.plans import star
from geoindicators.plans.star import KEYS, FACT_SQL, table
from geoindicators.session import ensure_checkpoint_dir

K = KEYS
KEY_COLS = K.all()


def conform(df: DataFrame) -> DataFrame:
    """Integers as BIGINT, fractional numbers rounded to 4 decimals as DOUBLE."""
    cols = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            cols[f.name] = F.col(f.name).cast("long")
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)):
            cols[f.name] = round4(f.name)
    return df.withColumns(cols) if cols else df


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the cluster's checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def facts(spark: SparkSession, sf: str, *extra: str) -> DataFrame:
    return star.order_facts(spark, sf, tuple(extra))


def line_facts(spark: SparkSession, sf: str, shift: int = 0, parts: bool = True) -> DataFrame:
    """Sub-district rows per order line, dated by ship year (+ ``shift``).

    keys + ``quantity``, ``price``, ``line_status``, ``flag`` (= l_returnflag) and, with ``parts``, ``age``
    (= p_size) and ``category`` (= p_type).  Without it lineitem is shuffled once, to meet its order.
    """
    lineitem = table(spark, sf, "lineitem").select(
        "l_orderkey", *(["l_partkey"] if parts else []),
        (F.year("l_shipdate") + F.lit(shift)).cast("long").alias(K.date),
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").cast("decimal(18,2)").alias("price"),
        F.col("l_linestatus").alias("line_status"), F.col("l_returnflag").alias("flag"))
    part = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("age"),
                                           F.col("p_type").alias("category"))
    # orders get their geography first (an orders-sized shuffle), so lineitem is shuffled only twice:
    # once to meet its order, once to meet its part
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    order_geo = orders.join(star.customer_geo(spark, sf), F.col("o_custkey") == F.col("c_custkey"))
    joined = lineitem.join(order_geo, F.col("l_orderkey") == F.col("o_orderkey"))
    if not parts:
        return joined.select(*KEY_COLS, "quantity", "price", "line_status", "flag")
    joined = joined.join(part, F.col("l_partkey") == F.col("p_partkey"))
    return joined.select(*KEY_COLS, "quantity", "price", "line_status", "flag", "age", "category")


LINE_SQL = """
SELECT CAST(year(l.l_shipdate) + {shift} AS BIGINT) AS date,
       lpad(CAST(r.r_regionkey + 1 AS VARCHAR), 2, '0') AS district_id,
       r.r_name AS district_name,
       lpad(CAST(r.r_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS sub_id,
       n.n_name AS sub_name,
       l.l_quantity AS quantity, CAST(l.l_extendedprice AS DECIMAL(18, 2)) AS price, l.l_linestatus AS line_status, l.l_returnflag AS flag
       {part_columns}
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
{part_join}
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def line_sql(shift: int = 0, parts: bool = True) -> str:
    return LINE_SQL.format(shift=shift, part_columns=", p.p_size AS age, p.p_type AS category" if parts else "",
                           part_join="JOIN part p ON l.l_partkey = p.p_partkey" if parts else "")


def r4(expr: str) -> str:
    """DuckDB twin of ``round4``."""
    return f"(round_even(CAST({expr} AS DOUBLE) * 10000, 0) / 10000)"


def rollup_sql(src: str, measures: dict[str, str], extra: list[str] | None = None,
               city_from_district: bool = False) -> str:
    """Three-level roll-up in plain SQL: measures maps output -> aggregate over ``src`` rows."""
    extra = extra or []
    ex = "".join(f", {e}" for e in extra)
    sel = ", ".join(f"{agg} AS {name}" for name, agg in measures.items())
    keys_not_null = " AND ".join(["date IS NOT NULL", "district_id IS NOT NULL", "district_name IS NOT NULL",
                                  *[f"{e} IS NOT NULL" for e in extra]])
    sub = (f"SELECT date, district_id, district_name, sub_id, sub_name{ex}, {sel} FROM src "
           f"WHERE {keys_not_null} AND sub_id IS NOT NULL AND sub_name IS NOT NULL "
           f"GROUP BY date, district_id, district_name, sub_id, sub_name{ex}")
    dist = (f"SELECT date, district_id, district_name, CAST(NULL AS VARCHAR) AS sub_id, "
            f"CAST(NULL AS VARCHAR) AS sub_name{ex}, {sel} FROM src WHERE {keys_not_null} "
            f"GROUP BY date, district_id, district_name{ex}")
    city = (f"SELECT date, '00' AS district_id, 'Oslo i alt' AS district_name, CAST(NULL AS VARCHAR) AS sub_id, "
            f"CAST(NULL AS VARCHAR) AS sub_name{ex}, {sel} FROM src WHERE {keys_not_null} GROUP BY date{ex}")
    return f"WITH src AS ({src}) {sub} UNION ALL {dist} UNION ALL {city}"


__all__ = ["K", "KEY_COLS", "conform", "facts", "line_facts", "FACT_SQL", "line_sql", "r4", "rollup_sql",
           "scratch", "table", "star"]
