"""Indicator facts derived from the driver's star schema.

Mapping: region = district, nation = sub-district, ``year(o_orderdate)`` = date,
order measures = indicators, ``o_orderstatus`` / ``o_orderpriority`` = categories.

* district id = ``lpad(r_regionkey + 1, 2, '0')`` (the +1 keeps clear of the
  city id ``00``), sub-district id = district id || ``lpad(n_nationkey, 2, '0')``.

Plan shape (what ``explain`` shows): the two geography tables are joined and, being
under Spark's byte threshold, broadcast; customer is projected to (custkey, nationkey) and
joined to it map-side; orders are projected to the needed columns only (the
scan's ``ReadSchema``) and joined to customers by key - a shuffle join that AQE
turns into a broadcast when customers are small and splits when one customer is
hot.  Everything downstream aggregates map-side first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoindicators.keys import Keys

KEYS = Keys(non_residential=("05",))  # district 05 plays the non-residential one


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table ``name`` (read-only input)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _district_id(regionkey: Column) -> Column:
    return F.lpad((regionkey + F.lit(1)).cast("string"), 2, "0")


def geo_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per sub-district: (n_nationkey, district_id, district_name, sub_id, sub_name)."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    did = _district_id(F.col("r_regionkey"))
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("n_nationkey"),
            did.alias(KEYS.district_id),
            F.col("r_name").alias(KEYS.district_name),
            F.concat(did, F.lpad(F.col("n_nationkey").cast("string"), 2, "0")).alias(KEYS.sub_id),
            F.col("n_name").alias(KEYS.sub_name),
        )
    )


def district_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    return region.select(_district_id(F.col("r_regionkey")).alias(KEYS.district_id),
                         F.col("r_name").alias(KEYS.district_name))


def customer_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    dim = geo_dim(spark, sf_dir)
    return customer.join(dim, F.col("c_nationkey") == F.col("n_nationkey")).drop("c_nationkey", "n_nationkey")


def order_facts(spark: SparkSession, sf_dir: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Sub-district fact rows, one per order: keys + ``n_orders`` + ``revenue`` (+ extra columns)."""
    orders = table(spark, sf_dir, "orders").select(
        "o_custkey",
        F.year("o_orderdate").cast("long").alias(KEYS.date),
        F.lit(1).cast("long").alias("n_orders"),
        # money is summed exactly (decimal), so sums do not depend on the order of addition
        F.col("o_totalprice").cast("decimal(18,2)").alias("revenue"),
        *extra,
    )
    facts = orders.join(customer_geo(spark, sf_dir), F.col("o_custkey") == F.col("c_custkey"))
    return facts.select(*KEYS.all(), "n_orders", "revenue", *extra)


# --- the same facts as DuckDB SQL (for the oracle side) -------------------

FACT_SQL = """
SELECT CAST(year(o.o_orderdate) AS BIGINT) AS date,
       lpad(CAST(r.r_regionkey + 1 AS VARCHAR), 2, '0') AS district_id,
       r.r_name AS district_name,
       lpad(CAST(r.r_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS sub_id,
       n.n_name AS sub_name,
       CAST(1 AS BIGINT) AS n_orders,
       CAST(o.o_totalprice AS DECIMAL(18, 2)) AS revenue,
       o.o_orderstatus, o.o_orderpriority, o.o_custkey
FROM orders o
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""
