"""A geography dimension derived from the driver's region and nation tables,
plus a raw "messy" source to resolve: one row per order with its geography
written the ways statistics sources write it (names in odd case, codes,
prefixed labels, legacy ids, mixed text and numbers)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoindicators.geo.dim import MAX_ROWS, Geography, from_tables
from geoindicators.plans.star import _district_id, table

CITY = ("00", "Oslo i alt")
UNKNOWN = ("99", "Uten registrert adresse")
# labels every source uses for the city and the unknown district (fixed values)
FIXED_DISTRICT_ALIASES = [("oslo i alt", "00"), ("uoppgitt", "99"), ("uten registrert adresse", "99")]


def star_geography(spark: SparkSession, sf: str) -> Geography:
    """The dimension out of region and nation: both are read once, in one bounded read."""
    region, nation = table(spark, sf, "region"), table(spark, sf, "nation")
    joined = region.join(nation, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
        _district_id(F.col("r_regionkey")).alias("did"), "r_name", F.col("n_nationkey").cast("string").alias("nation"), "n_name")
    rows = joined.limit(MAX_ROWS + 1).toArrow().to_pylist()
    if len(rows) > MAX_ROWS:
        raise ValueError("region and nation hold more rows than a dimension may")
    regions = sorted({(r["did"], r["r_name"]) for r in rows})
    nations = [(r["did"] + r["nation"].rjust(2, "0"), r) for r in rows if r["nation"] is not None]
    aliases = {(f"bydel {x}", did) for did, name in regions for x in (name.lower(), name.lower().replace(" ", ""))}
    first = {}
    for sub_id, r in sorted(nations, key=lambda n: int(n[1]["nation"])):
        first.setdefault(r["did"], (r["r_name"].lower(), sub_id))
    # a sub-district sharing its district's name (sub-district wins)
    sub_aliases = {(x, sub_id) for sub_id, r in nations for x in (r["n_name"].lower(), r["n_name"].lower().replace("_", " "))} | set(first.values())
    return from_tables(spark, [*regions, CITY, UNKNOWN], sorted((sub_id, r["n_name"], r["did"]) for sub_id, r in nations),
                       sorted(aliases) + FIXED_DISTRICT_ALIASES, sorted(sub_aliases), sorted((r["nation"].rjust(3, "0"), sub_id) for sub_id, r in nations),
                       city_id=CITY[0], city_name=CITY[1], unknown_id=UNKNOWN[0], unknown_name=UNKNOWN[1])


def raw_orders(spark: SparkSession, sf: str) -> DataFrame:
    """One row per order: year, priority, status and the true geography parts."""
    orders = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.year("o_orderdate").cast("long").alias("date"),
        F.col("o_orderpriority").alias("prio"), F.col("o_orderstatus").alias("status"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf, "nation")
    region = table(spark, sf, "region")
    geo = (nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
           .select("n_nationkey", "n_name", "r_regionkey", "r_name",
                   _district_id(F.col("r_regionkey")).alias("did")))
    cg = customer.join(geo, F.col("c_nationkey") == F.col("n_nationkey"))
    return (orders.join(cg, F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "date", "prio", "status", "n_nationkey", "n_name", "r_regionkey", "r_name", "did")
            .withColumn("sub_num", F.when(F.col("prio") == "5-LOW", F.lit(9999))
                        .otherwise(F.concat(F.col("did"), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"))
                                   .cast("int"))))


GEO_SQL = """
rg AS (SELECT r_regionkey, r_name, lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') AS did FROM region),
districts_t AS (SELECT did AS district_id, r_name AS district_name FROM rg
                UNION ALL SELECT '00', 'Oslo i alt' UNION ALL SELECT '99', 'Uten registrert adresse'),
dalias_t AS (SELECT DISTINCT alias, district_id FROM (
    SELECT 'bydel ' || lower(r_name) AS alias, did AS district_id FROM rg
    UNION ALL SELECT 'bydel ' || replace(lower(r_name), ' ', ''), did FROM rg
    UNION ALL SELECT 'oslo i alt', '00' UNION ALL SELECT 'uoppgitt', '99'
    UNION ALL SELECT 'uten registrert adresse', '99')),
dlook_t AS (SELECT a.alias, d.district_id, d.district_name FROM dalias_t a JOIN districts_t d ON a.district_id = d.district_id),
nr AS (SELECT n.n_nationkey, n.n_name, n.n_regionkey, rg.r_name, rg.did,
              rg.did || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS sub_id
       FROM nation n JOIN rg ON n.n_regionkey = rg.r_regionkey),
subs_t AS (SELECT sub_id, n_name AS sub_name, did AS parent_id FROM nr),
salias_t AS (SELECT DISTINCT alias, sub_id FROM (
    SELECT lower(n_name) AS alias, sub_id FROM nr
    UNION ALL SELECT lower(replace(n_name, '_', ' ')), sub_id FROM nr
    UNION ALL SELECT lower(nr.r_name), nr.sub_id FROM nr
      JOIN (SELECT n_regionkey, min(n_nationkey) AS k FROM nation GROUP BY n_regionkey) m
      ON nr.n_nationkey = m.k)),
slook_t AS (SELECT a.alias, s.sub_id, s.sub_name, s.parent_id FROM salias_t a JOIN subs_t s ON a.sub_id = s.sub_id),
legacy_t AS (SELECT lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS old_id, s.sub_id, s.sub_name, s.parent_id
             FROM nr JOIN subs_t s ON nr.sub_id = s.sub_id),
raw AS (SELECT o.o_orderkey, CAST(year(o.o_orderdate) AS BIGINT) AS date, o.o_orderpriority AS prio,
               o.o_orderstatus AS status, nr.n_nationkey, nr.n_name, nr.n_regionkey AS r_regionkey, nr.r_name, nr.did,
               CASE WHEN o.o_orderpriority = '5-LOW' THEN 9999 ELSE CAST(nr.sub_id AS INTEGER) END AS sub_num
        FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nr ON c.c_nationkey = nr.n_nationkey)
"""
