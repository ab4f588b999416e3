"""Registered queries: single rules on rows with gaps (unresolved geographies, city rows, missing categories).

The rows are those of ``star_sources`` with their geography resolved.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators.geo import resolve
from geoindicators.operators import filters, joins, pivot, population, relative, rollup
from geoindicators.plans import star_sources as src
from geoindicators.plans.common import K, conform, r4, scratch
from geoindicators.plans.star_geo import star_geography
from geoindicators.plans.star_sources import BASE_SQL, KEYS_SQL, pick_sql
from geoindicators.publish import commit
from geoindicators.publish import document as doc
from geoindicators.publish.templates import TemplateA
from geoindicators.sources import sinks

Q: dict = {}
SQL: dict = {}
KEYS = "date, district_id, district_name, sub_id, sub_name"


def register(name, sql):
    def deco(fn):
        Q[name], SQL[name] = fn, f"WITH {BASE_SQL}, rows AS (SELECT CAST(date AS BIGINT) AS {KEYS_SQL}, {pick_sql(src.LAND, 6)} AS cat, antall, CAST(floor(ok / 7) AS BIGINT) % 123 AS age FROM f) {sql}"
        return fn
    return deco


def rows(spark, sf):
    f = src.base(spark, sf)
    city = F.col("kind") == "city"
    return f.select("date", F.when(city, "00").otherwise(F.col("did")).alias("district_id"), F.when(city, "Oslo i alt").otherwise(F.col("dname")).alias("district_name"),
                    F.col("sid").alias("sub_id"), F.col("sname").alias("sub_name"), src.pick(src.LAND, 6).alias("cat"), "antall", (F.floor(F.col("ok") / 7) % 123).alias("age"))


def _counted(df, *by):
    return conform(df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum("antall").alias("antall")))


_N = "count(*) AS n, CAST(sum(antall) AS BIGINT) AS antall"


@register("category_not_equal_keeps_null", f"SELECT cat, {_N} FROM rows WHERE cat IS NULL OR cat <> 'Norge' GROUP BY cat")
def category_not_equal_keeps_null(spark, sf):
    return _counted(rows(spark, sf).filter(filters.not_equal_keep_null("cat", "Norge")), "cat")


@register("drop_city_rows", f"SELECT district_id, {_N} FROM rows WHERE district_id IS NULL OR district_id <> '00' GROUP BY district_id")
def drop_city_rows(spark, sf):
    return _counted(filters.drop_city(rows(spark, sf), K), "district_id")


@register("drop_unresolved_rows", f"""SELECT district_id, sub_id, {_N}, (SELECT count(*) FROM rows WHERE district_id IS NULL OR sub_id IS NULL) AS rejected
FROM rows WHERE district_id IS NOT NULL AND sub_id IS NOT NULL GROUP BY district_id, sub_id""")
def drop_unresolved_rows(spark, sf):
    df = rows(spark, sf)
    rejected = filters.count_unresolved(df, ["district_id", "sub_id"]).scalar()
    return conform(_counted(filters.drop_unresolved(df, ["district_id", "sub_id"]), "district_id", "sub_id").withColumn("rejected", rejected))


@register("pivot_with_gaps", f"""SELECT {KEYS}, CAST(sum(antall) FILTER (WHERE cat = 'Norge') AS BIGINT) AS norge, CAST(0 AS BIGINT) AS nowhere,
CAST(coalesce(sum(antall), 0) AS BIGINT) AS total FROM (SELECT *, count(*) OVER () AS c FROM rows) WHERE sub_id IS NOT NULL AND cat IS NOT NULL GROUP BY {KEYS}""")
def pivot_with_gaps(spark, sf):
    """A category that occurs nowhere is 0 everywhere; one that is absent here stays null; rows without a category vanish."""
    df = rows(spark, sf)
    index = KEYS.split(", ")
    p = pivot.pivot_sum(df, index, "cat", "antall", {"Norge": "norge", "Ingensteds": "nowhere"}, fill=None, zero_absent_columns=True)
    t = pivot.group_sum(df.filter(F.col("cat").isNotNull()), index, ["antall"]).withColumnRenamed("antall", "total")
    return conform(joins.natural_join(p, t))


@register("pivot_mean_with_gaps", f"""SELECT date, district_id, {r4("avg(antall) FILTER (WHERE cat = 'Norge')")} AS norge FROM rows
WHERE date IS NOT NULL AND district_id IS NOT NULL AND cat IS NOT NULL GROUP BY date, district_id""")
def pivot_mean_with_gaps(spark, sf):
    return conform(pivot.pivot_mean(rows(spark, sf), ["date", "district_id"], "cat", "antall", {"Norge": "norge"}))


@register("group_sum_null_keys", "SELECT date, cat, CAST(sum(antall) AS BIGINT) AS antall FROM rows WHERE cat IS NOT NULL GROUP BY date, cat")
def group_sum_null_keys(spark, sf):
    return conform(pivot.group_sum(rows(spark, sf), ["date", "cat"], ["antall"]))


@register("population_null_keys", "SELECT date, district_id, sub_id, CAST(sum(antall) AS BIGINT) AS population FROM rows WHERE district_id IS NOT NULL AND sub_id IS NOT NULL GROUP BY ALL")
def population_null_keys(spark, sf):
    return conform(population.total_population(rows(spark, sf), "antall", K))


_ROLLED = f"""
r AS (SELECT {KEYS}, sum(antall) AS antall, sum(antall) / count(*) AS share FROM rows WHERE sub_id IS NOT NULL GROUP BY ALL
      UNION ALL SELECT date, district_id, district_name, NULL, NULL, sum(antall), sum(antall) / count(*) FROM rows WHERE district_id IS NOT NULL AND district_id <> '00' GROUP BY ALL
      UNION ALL SELECT date, '00', 'Oslo i alt', NULL, NULL, sum(antall), sum(antall) / count(*) FROM rows GROUP BY date
      UNION ALL SELECT date, NULL, NULL, NULL, NULL, sum(antall), sum(antall) / count(*) FROM rows WHERE district_id IS NULL GROUP BY date)"""


def _levels(spark, sf):
    """Every level, the city, and one unresolved row per year."""
    df = rows(spark, sf)
    agg = [F.sum("antall").alias("antall"), (F.sum("antall") / F.count(F.lit(1))).alias("share")]
    none = F.lit(None).cast("string")
    d = df.where("district_id is not null and district_id != '00'").groupBy("date", "district_id", "district_name").agg(*agg).withColumns({"sub_id": none, "sub_name": none})
    c = df.groupBy("date").agg(*agg).withColumns({"district_id": F.lit("00"), "district_name": F.lit("Oslo i alt"), "sub_id": none, "sub_name": none})
    u = df.where("district_id is null").groupBy("date").agg(*agg).withColumns({"district_id": none, "district_name": none, "sub_id": none, "sub_name": none})
    s = df.where("sub_id is not null").groupBy(*KEYS.split(", ")).agg(*agg)
    return s.unionByName(d).unionByName(c).unionByName(u)


@register("relative_with_unresolved_rows", f""", {_ROLLED}, k AS (SELECT * FROM r WHERE district_id IS NOT NULL AND district_id <> '05')
SELECT k.date, k.district_id, k.district_name, k.sub_id, k.sub_name, {r4("k.share / d.share")} AS share_district, {r4("k.share / c.share")} AS share_oslo
FROM k JOIN k d ON d.date = k.date AND d.district_id = k.district_id AND d.sub_id IS NULL JOIN k c ON c.date = k.date AND c.district_id = '00'""".replace(", \nr AS", ",\nr AS", 1))
def relative_with_unresolved_rows(spark, sf):
    """A row without a district takes no part; it doesn't fail the others."""
    return conform(relative.add_relative_ratio(_levels(spark, sf), "share", K))


@register("rollup_mapping_two_stage", f""", b AS (SELECT * FROM rows WHERE date IS NOT NULL AND district_id IS NOT NULL AND cat IS NOT NULL)
SELECT {KEYS}, cat, CAST(sum(antall) AS BIGINT) AS antall FROM b WHERE sub_id IS NOT NULL GROUP BY ALL
UNION ALL SELECT date, district_id, district_name, NULL, NULL, cat, CAST(sum(antall) AS BIGINT) FROM b GROUP BY ALL
UNION ALL SELECT date, '00', 'Oslo i alt', NULL, NULL, cat, CAST(sum(antall) AS BIGINT) FROM b GROUP BY date, cat""")
def rollup_mapping_two_stage(spark, sf):
    return conform(rollup.aggregate(rows(spark, sf), {"antall": "sum"}, K, extra=["cat"]))


_HALVES = "x AS (SELECT * FROM rows WHERE age < 60), y AS (SELECT * FROM rows WHERE age >= 50)"


def _halves(spark, sf):
    df = rows(spark, sf)
    return df.where("age < 60"), df.where("age >= 50")


def _join_sql(keys: list[str], how: str, null_safe=()) -> str:
    by = ", ".join(keys)
    on = " AND ".join(f"a.{k} {'IS NOT DISTINCT FROM' if k in null_safe else '='} b.{k}" for k in keys)
    cols = ", ".join(f"coalesce(a.{k}, b.{k}) AS {k}" for k in keys)
    return f""", {_HALVES}, a AS (SELECT {by}, CAST(sum(antall) AS BIGINT) AS young FROM x WHERE cat = 'Norge' GROUP BY ALL),
b AS (SELECT {by}, CAST(sum(antall) AS BIGINT) AS old FROM y WHERE cat = 'Vest-Europa' GROUP BY ALL) SELECT {cols}, young, old FROM a {how} JOIN b ON {on}"""


def _join(spark, sf, keys, how, null_safe=()):
    x, y = _halves(spark, sf)
    a = x.where("cat = 'Norge'").groupBy(*keys).agg(F.sum("antall").alias("young"))
    b = y.where("cat = 'Vest-Europa'").groupBy(*keys).agg(F.sum("antall").alias("old"))
    return conform(joins.join_on(a, b, keys, how, null_safe))


_J4, _J7, _J8, _J9 = ["district_id", "sub_id"], ["date", "sub_id", "district_id"], ["district_id", "date", "district_name"], ["date", "district_name", "district_id", "age"]


@register("join_outer_district_sub", _join_sql(_J4, "FULL OUTER", ["sub_id"]))
def join_outer_district_sub(spark, sf):
    return _join(spark, sf, _J4, "full_outer", ["sub_id"])


@register("join_date_sub_district", _join_sql(_J7, "INNER"))
def join_date_sub_district(spark, sf):
    return _join(spark, sf, _J7, "inner")


@register("join_district_date_name", _join_sql(_J8, "INNER"))
def join_district_date_name(spark, sf):
    return _join(spark, sf, _J8, "inner")


@register("join_migration", _join_sql(_J9, "INNER"))
def join_migration(spark, sf):
    return _join(spark, sf, _J9, "inner")


@register("geo_district_id_for_name", "SELECT district_name, district_id, count(*) AS n FROM rows WHERE district_id IS NOT NULL GROUP BY ALL UNION ALL SELECT NULL, NULL, count(*) FROM rows WHERE district_id IS NULL")
def geo_district_id_for_name(spark, sf):
    """District id by name, with and without the title, special names as they are; a missing name has none."""
    geo = star_geography(spark, sf)
    named = rows(spark, sf).withColumn("v", F.when((F.col("age") % 2 == 0) & (F.col("district_id") != "00"), F.concat(F.lit("Bydel "), F.col("district_name"))).otherwise(F.col("district_name")))
    out = resolve.district_id_for_name(named.drop("district_id"), "v", geo, "district_id")
    return conform(out.groupBy("district_name", "district_id").agg(F.count(F.lit(1)).alias("n")))


@register("geo_add_district_id_by_name", """SELECT CASE WHEN age % 2 = 0 AND sub_id IS NOT NULL THEN substr(sub_id, 1, 2) ELSE district_id END AS district, count(*) AS n
FROM rows GROUP BY ALL""")
def geo_add_district_id_by_name(spark, sf):
    """District from characters 5-6 of an id, else by the name column."""
    df = rows(spark, sf).withColumn("code", F.when(F.col("age") % 2 == 0, F.concat(F.lit("0301"), F.col("sub_id"))))
    out = resolve.add_district_id(df, "code", star_geography(spark, sf), "district_name")
    return conform(out.groupBy("district").agg(F.count(F.lit(1)).alias("n")))


_DOCUMENTS_SQL = f""", {_ROLLED}, k AS (SELECT * FROM r WHERE district_id IS NOT NULL)
SELECT d.district_id AS name, d.district_name AS district, CASE WHEN d.district_id = '00' THEN 'oslo i alt' ELSE 'bydel' END AS scope, '[]' AS scale,
  CASE WHEN d.district_id = '00' THEN (SELECT count(DISTINCT district_id) FROM k WHERE district_id <> '05') ELSE 2 + (SELECT count(DISTINCT sub_id) FROM k s WHERE s.district_id = d.district_id) END AS entries,
  'Oslo i alt' AS last_geography, CAST((SELECT k.antall FROM k WHERE k.district_id = '00' ORDER BY date DESC LIMIT 1) AS BIGINT) AS last_value
FROM (SELECT DISTINCT district_id, district_name FROM k WHERE district_id <> '05') d"""


def _fields(js):
    """The published JSON text, read back field by field."""
    last = F.expr("size(variant_get(v, '$.data', 'array<variant>')) - 1")
    data = F.expr("variant_get(v, '$.data', 'array<variant>')")
    values = F.variant_get(F.get(data, last), "$.values", "array<variant>")
    return conform(js.withColumn("v", F.parse_json("json")).select(
        "name", F.variant_get("v", "$.district", "string").alias("district"), F.variant_get("v", "$.meta.scope", "string").alias("scope"),
        F.to_json(F.variant_get("v", "$.meta.scale", "variant")).alias("scale"), F.size(data).alias("entries"),
        F.variant_get(F.get(data, last), "$.geography", "string").alias("last_geography"),
        F.variant_get(F.get(values, F.size(values) - 1), "$.value", "long").alias("last_value")))


def _documents(spark, sf):
    return doc.build_documents(_levels(spark, sf), TemplateA(), ["antall"], doc.Metadata("H", [], "2026-01-01"), K)


@register("documents_json", _DOCUMENTS_SQL)
def documents_json(spark, sf):
    return _fields(doc.to_json_documents(_documents(spark, sf)))


@register("documents_committed", _DOCUMENTS_SQL)
def documents_committed(spark, sf):
    """The documents published as a committed version and read back from their files."""
    root = scratch(spark, "published")
    commit.publish_documents({"status": _documents(spark, sf)}, root)
    return _fields(sinks.read_documents(spark, commit.published_dir(spark, root, "status")))
