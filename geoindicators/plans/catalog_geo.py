"""Registered queries, part 4: geography resolution.

Each query takes one row per order, writes its geography the way a statistics
source would (see the ``*_TEXT`` expressions, shared verbatim by the Spark side
and the SQL twin), resolves it back with a resolver and counts orders per
resolved geography.  Unresolved rows stay in the result as a NULL group, so the
count checks both what resolves and what does not.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators.geo import resolve as R
from geoindicators.plans.common import K
from geoindicators.plans.star_geo import GEO_SQL, raw_orders, star_geography

Q: dict = {}
SQL: dict = {}


def register(name, sql=None):
    def deco(fn):
        Q[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


# How the sources write the geography (fixed test inputs, valid in both dialects).
SUB_TEXT = ("CASE prio WHEN '1-URGENT' THEN '  ' || upper(n_name) || ' ' WHEN '2-HIGH' THEN replace(n_name, '_', ' ') "
            "WHEN '3-MEDIUM' THEN 'Unknown place' WHEN '4-NOT SPECIFIED' THEN r_name ELSE n_name END")
DIST_TEXT = "CASE status WHEN 'F' THEN r_name WHEN 'O' THEN 'Bydel ' || r_name ELSE 'Nowhere' END"
ONE_TEXT = ("CASE prio WHEN '1-URGENT' THEN n_name WHEN '2-HIGH' THEN 'Bydel ' || r_name WHEN '3-MEDIUM' THEN r_name "
            "WHEN '4-NOT SPECIFIED' THEN 'Oslo i alt' ELSE 'Nowhere' END")
LABEL_TEXT = ("CASE prio WHEN '1-URGENT' THEN 'Delbydel ' || n_name WHEN '2-HIGH' THEN 'Oslo i alt' "
              "WHEN '3-MEDIUM' THEN 'Uoppgitt' WHEN '4-NOT SPECIFIED' THEN 'Bydel ' || r_name "
              "ELSE 'Delbydel Nowhere' END")
CODE = "30101 + r_regionkey"
SINGLE_CODE = ("CASE status WHEN 'F' THEN 100000 WHEN 'O' THEN (CASE WHEN prio = '4-NOT SPECIFIED' THEN 30199 "
               "ELSE 30101 + r_regionkey END) ELSE sub_num END")
CITY_CODE = "CASE WHEN status = 'F' THEN 10000 ELSE sub_num END"
MIXED_TEXT = ("CASE prio WHEN '1-URGENT' THEN n_name WHEN '2-HIGH' THEN CAST(sub_num AS STRING) "
              "WHEN '3-MEDIUM' THEN '10000' WHEN '4-NOT SPECIFIED' THEN CAST(30101 + r_regionkey AS STRING) "
              "ELSE 'Bydel ' || r_name END")
LEGACY_NUM = "CASE WHEN prio = '5-LOW' THEN 999 ELSE n_nationkey END"
LONG_ID = "CASE WHEN prio = '5-LOW' THEN '0301' ELSE '0301' || did || lpad(CAST(n_nationkey AS STRING), 2, '0') END"
DID_TEXT = "CASE status WHEN 'O' THEN CAST(r_regionkey + 1 AS STRING) ELSE did END"

OUT = "date, district_id, district_name, sub_id, sub_name, CAST(count(*) AS BIGINT) AS n"
GROUP = "GROUP BY date, district_id, district_name, sub_id, sub_name"


def _count(df):
    return df.groupBy(K.date, K.district_id, K.district_name, K.sub_id, K.sub_name).agg(
        F.count(F.lit(1)).alias("n"))


def _raw(spark, sf, **texts):
    raw = raw_orders(spark, sf)
    return raw.withColumns({k: F.expr(v) for k, v in texts.items()})


# -- SQL building blocks -------------------------------------------------------------------

def _zf(e: str, w: int) -> str:
    return f"(CASE WHEN length({e}) >= {w} THEN {e} ELSE lpad({e}, {w}, '0') END)"


def _sub_key(e: str) -> str:
    return _zf(f"CAST(TRY_CAST(TRY_CAST(CAST({e} AS STRING) AS DOUBLE) AS BIGINT) AS STRING)", 4)


def _sub_by_name(e, a):
    return f"LEFT JOIN slook_t {a} ON {a}.alias = lower(trim({e}))"


def _sub_by_id(e, a):
    return f"LEFT JOIN subs_t {a} ON {a}.sub_id = {_sub_key(e)}"


def _dist_by_id(e, a):
    return f"LEFT JOIN districts_t {a} ON {a}.district_id = {e}"


def _dist_by_name(e, a):
    return (f"LEFT JOIN dlook_t {a}a ON {a}a.alias = lower(trim({e})) "
            f"LEFT JOIN dlook_t {a}b ON {a}b.alias = 'bydel ' || lower(trim({e}))")


def _name_id(a):
    return f"coalesce({a}a.district_id, {a}b.district_id)"


def _name_name(a):
    return f"CASE WHEN {a}a.district_id IS NOT NULL THEN {a}a.district_name ELSE {a}b.district_name END"


def _q(body: str) -> str:
    return f"WITH {GEO_SQL}, t AS ({body}) SELECT {OUT} FROM t {GROUP}"


# --- G1 ---------------------------------------------------------------------------------------

@register("geo_district_by_id", _q(f"""
SELECT raw.date, d.district_id, d.district_name, CAST(NULL AS STRING) AS sub_id, CAST(NULL AS STRING) AS sub_name
FROM raw {_dist_by_id(DID_TEXT, "d")}"""))
def geo_district_by_id(spark, sf):
    """G1: exact 2-character ids; "1" does not match "01"."""
    g = star_geography(spark, sf)
    return _count(R.district_by_id(_raw(spark, sf, code=DID_TEXT), "code", g, K))


# --- G2 / R10 -----------------------------------------------------------------------------------

@register("geo_district_by_name", _q(f"""
SELECT raw.date, {_name_id("x")} AS district_id, {_name_name("x")} AS district_name,
       CAST(NULL AS STRING) AS sub_id, CAST(NULL AS STRING) AS sub_name
FROM raw {_dist_by_name(DIST_TEXT, "x")}"""))
def geo_district_by_name(spark, sf):
    """District names with and without the district prefix, any case."""
    g = star_geography(spark, sf)
    return _count(R.district_by_name(_raw(spark, sf, dname=DIST_TEXT), "dname", g, K))


# --- G5 -------------------------------------------------------------------------------------------

@register("geo_legacy_id", _q(f"""
SELECT raw.date, l.parent_id AS district_id, p.district_name, l.sub_id, l.sub_name
FROM raw LEFT JOIN legacy_t l ON l.old_id = {_zf(f"CAST({LEGACY_NUM} AS STRING)", 3)}
{_dist_by_id("l.parent_id", "p")}"""))
def geo_legacy_id(spark, sf):
    """Numeric legacy ids are zero-padded to 3 and mapped to the current sub-district."""
    g = star_geography(spark, sf)
    return _count(R.sub_by_legacy_id(_raw(spark, sf, old=LEGACY_NUM), "old", g, K))


# --- G7 ------------------------------------------------------------------------------------------

@register("geo_substring", f"""
WITH {GEO_SQL}, t AS (SELECT date, substring({LONG_ID}, 5, 2) AS district FROM raw)
SELECT date, district, CAST(count(*) AS BIGINT) AS n FROM t WHERE length(district) > 0 GROUP BY date, district
""")
def geo_substring(spark, sf):
    """district = characters 5-6 of a long id; rows without one are dropped."""
    g = star_geography(spark, sf)
    df = R.add_district_id(_raw(spark, sf, long_id=LONG_ID), "long_id", g)
    return df.groupBy("date", "district").agg(F.count(F.lit(1)).alias("n"))


# --- R1 / R2 / R3 / R11 -----------------------------------------------------------------------

def _parent_else_name(s):
    return (f"CASE WHEN {s}.sub_id IS NOT NULL THEN p.district_id ELSE {_name_id('x')} END AS district_id, "
            f"CASE WHEN {s}.sub_id IS NOT NULL THEN p.district_name ELSE {_name_name('x')} END AS district_name, "
            f"{s}.sub_id, {s}.sub_name")


@register("geo_sub_id_fallback", _q(f"""
SELECT raw.date, {_parent_else_name("s")}
FROM raw {_sub_by_id("sub_num", "s")} {_dist_by_id("s.parent_id", "p")} {_dist_by_name(DIST_TEXT, "x")}"""))
def geo_sub_id_fallback(spark, sf):
    """Numeric sub-district id; its parent district, else the district-name column."""
    g = star_geography(spark, sf)
    df = R.resolve_sub_id_with_fallback(_raw(spark, sf, dname=DIST_TEXT), "sub_num", "dname", g, K)
    return _count(df)


@register("geo_sub_name_fallback", _q(f"""
SELECT raw.date, {_parent_else_name("s")}
FROM raw {_sub_by_name(SUB_TEXT, "s")} {_dist_by_id("s.parent_id", "p")} {_dist_by_name(DIST_TEXT, "x")}"""))
def geo_sub_name_fallback(spark, sf):
    """R2: sub-district names in any case and spelling; parent district, else by name."""
    g = star_geography(spark, sf)
    df = R.resolve_sub_name_with_fallback(_raw(spark, sf, sname=SUB_TEXT, dname=DIST_TEXT), "sname", "dname", g, K)
    return _count(df)


@register("geo_sub_name_district_column", _q(f"""
SELECT raw.date, {_name_id("x")} AS district_id, {_name_name("x")} AS district_name, s.sub_id, s.sub_name
FROM raw {_sub_by_name(SUB_TEXT, "s")} {_dist_by_name(DIST_TEXT, "x")}"""))
def geo_sub_name_district_column(spark, sf):
    """The district comes only from its own column, even when the sub-district resolves."""
    g = star_geography(spark, sf)
    df = R.resolve_sub_name_district_column(_raw(spark, sf, sname=SUB_TEXT, dname=DIST_TEXT), "sname", "dname",
                                            g, K)
    return _count(df)


@register("geo_names_parent_id", _q(f"""
SELECT raw.date, CASE WHEN s.sub_id IS NOT NULL THEN s.parent_id ELSE {_name_id("x")} END AS district_id,
       {_name_name("x")} AS district_name, s.sub_id, s.sub_name
FROM raw {_sub_by_name(SUB_TEXT, "s")} {_dist_by_name(DIST_TEXT, "x")}"""))
def geo_names_parent_id(spark, sf):
    """Id from the sub-district's parent, name from the district column."""
    g = star_geography(spark, sf)
    df = R.resolve_names_parent_id(_raw(spark, sf, sname=SUB_TEXT, dname=DIST_TEXT), "dname", "sname", g, K)
    return _count(df)


# --- R4 -------------------------------------------------------------------------------------------

@register("geo_one_column", _q(f"""
SELECT raw.date, {_parent_else_name("s")}
FROM raw {_sub_by_name(ONE_TEXT, "s")} {_dist_by_id("s.parent_id", "p")} {_dist_by_name(ONE_TEXT, "x")}"""))
def geo_one_column(spark, sf):
    """One column holding sub-district or district names; a sub-district wins
    when a name is both."""
    g = star_geography(spark, sf)
    return _count(R.resolve_one_column(_raw(spark, sf, geo=ONE_TEXT), "geo", g, K))


# --- R5 / R5b -----------------------------------------------------------------------------------

_LABEL_SUB = f"CASE WHEN starts_with({LABEL_TEXT}, 'Delbydel ') THEN substring({LABEL_TEXT}, 10) END"


@register("geo_prefixed", _q(f"""
SELECT raw.date,
  CASE WHEN {LABEL_TEXT} = 'Oslo i alt' THEN '00' WHEN {LABEL_TEXT} = 'Uoppgitt' THEN '99'
       WHEN s.sub_id IS NOT NULL THEN p.district_id ELSE {_name_id("x")} END AS district_id,
  CASE WHEN {LABEL_TEXT} = 'Oslo i alt' THEN 'Oslo i alt' WHEN {LABEL_TEXT} = 'Uoppgitt' THEN 'Uten registrert adresse'
       WHEN s.sub_id IS NOT NULL THEN p.district_name ELSE {_name_name("x")} END AS district_name,
  CASE WHEN {LABEL_TEXT} IN ('Oslo i alt', 'Uoppgitt') THEN NULL ELSE s.sub_id END AS sub_id,
  CASE WHEN {LABEL_TEXT} IN ('Oslo i alt', 'Uoppgitt') THEN NULL ELSE s.sub_name END AS sub_name
FROM raw {_sub_by_name(_LABEL_SUB, "s")} {_dist_by_id("s.parent_id", "p")} {_dist_by_name(LABEL_TEXT, "x")}"""))
def geo_prefixed(spark, sf):
    """R5: "Oslo i alt", "Uoppgitt", "Delbydel <name>" or a district name in one column."""
    g = star_geography(spark, sf)
    return _count(R.resolve_labelled(_raw(spark, sf, geo=LABEL_TEXT), "geo", g, K))


@register("geo_prefixed_sub_only", _q(f"""
SELECT raw.date,
  CASE WHEN s.sub_id IS NOT NULL THEN NULL ELSE {_name_id("x")} END AS district_id,
  CASE WHEN s.sub_id IS NOT NULL THEN NULL ELSE {_name_name("x")} END AS district_name,
  s.sub_id, s.sub_name
FROM raw {_sub_by_name(_LABEL_SUB, "s")} {_dist_by_name(LABEL_TEXT, "x")}"""))
def geo_prefixed_sub_only(spark, sf):
    """As R5 but a sub-district row keeps no district."""
    g = star_geography(spark, sf)
    return _count(R.resolve_labelled(_raw(spark, sf, geo=LABEL_TEXT), "geo", g, K, sub_keeps_district=False))


# --- R6 / R7 ----------------------------------------------------------------------------------

_CODE_ID = (f"(CASE WHEN starts_with(CAST({CODE} AS STRING), '301') THEN {_zf(f'substring(CAST({CODE} AS STRING), 4)', 2)} "
            f"ELSE {_zf(f'CAST({CODE} AS STRING)', 2)} END)")


@register("geo_code_and_sub", _q(f"""
SELECT raw.date, CASE WHEN s.sub_id IS NOT NULL THEN s.parent_id ELSE {_CODE_ID} END AS district_id,
       c.district_name, s.sub_id, s.sub_name
FROM raw {_dist_by_id(_CODE_ID, "c")} {_sub_by_id("sub_num", "s")}"""))
def geo_code_and_sub(spark, sf):
    """District code 301XX plus numeric sub-district id; id from the sub-district, name from the code."""
    g = star_geography(spark, sf)
    return _count(R.resolve_code_and_sub_id(_raw(spark, sf, code=CODE), "code", "sub_num", g, K))


@register("geo_code_name_from_code", _q(f"""
SELECT raw.date, c.district_id, c.district_name, s.sub_id, s.sub_name
FROM raw {_dist_by_id(_CODE_ID, "c")} {_sub_by_id("sub_num", "s")}"""))
def geo_code_name_from_code(spark, sf):
    """As R6, but district id and name both come from the code."""
    g = star_geography(spark, sf)
    return _count(R.resolve_code_and_sub_id(_raw(spark, sf, code=CODE), "code", "sub_num", g, K, id_from_code=True))


# --- R8 / R8b -------------------------------------------------------------------------------------

def _single_code_sql(code: str, city: int, districts: bool) -> str:
    n = f"CAST({code} AS STRING)"
    is_city = f"({code}) = {city}"
    is_d = f"(starts_with({n}, '301') AND length({n}) = 5)" if districts else "FALSE"
    cid = _zf(f"substring({n}, 4)", 2)
    return _q(f"""
SELECT raw.date,
  CASE WHEN {is_city} THEN '00' WHEN {is_d} THEN {cid} WHEN s.sub_id IS NOT NULL THEN s.parent_id END AS district_id,
  CASE WHEN {is_city} THEN 'Oslo i alt' WHEN {is_d} AND {cid} = '99' THEN 'Uten registrert adresse'
       WHEN {is_d} THEN c.district_name WHEN s.sub_id IS NOT NULL THEN p.district_name END AS district_name,
  s.sub_id, s.sub_name
FROM raw {_dist_by_id(f"CASE WHEN {is_d} THEN {cid} END", "c")}
{_sub_by_id(f"CASE WHEN NOT ({is_city}) AND NOT {is_d} THEN {code} END", "s")}
{_dist_by_id("s.parent_id", "p")}""")


@register("geo_single_code", _single_code_sql(SINGLE_CODE, 100000, True))
def geo_single_code(spark, sf):
    """One numeric code: 100000 = city, 301XX = district (30199 = unknown), else a sub-district id."""
    g = star_geography(spark, sf)
    return _count(R.resolve_single_code(_raw(spark, sf, code=SINGLE_CODE), "code", g, K, 100000))


@register("geo_single_code_city", _single_code_sql(CITY_CODE, 10000, False))
def geo_single_code_city(spark, sf):
    """One numeric code: 10000 = city, else a sub-district id; unknown -> NULL."""
    g = star_geography(spark, sf)
    return _count(R.resolve_single_code(_raw(spark, sf, code=CITY_CODE), "code", g, K, 10000, district_codes=False))


# --- R9 -----------------------------------------------------------------------------------------

_MIX_NUM = f"CAST(TRY_CAST(TRY_CAST({MIXED_TEXT} AS DOUBLE) AS BIGINT) AS STRING)"
_MIX_IS_CODE = f"(starts_with({_MIX_NUM}, '301') AND length({_MIX_NUM}) = 5)"


@register("geo_mixed", _q(f"""
SELECT raw.date,
  CASE WHEN coalesce(sn.sub_id, si.sub_id) IS NOT NULL THEN p.district_id
       WHEN {_name_id("x")} IS NOT NULL THEN {_name_id("x")}
       WHEN {_MIX_NUM} = '10000' THEN '00' WHEN {_MIX_IS_CODE} THEN c.district_id END AS district_id,
  CASE WHEN coalesce(sn.sub_id, si.sub_id) IS NOT NULL THEN p.district_name
       WHEN {_name_id("x")} IS NOT NULL THEN {_name_name("x")}
       WHEN {_MIX_NUM} = '10000' THEN 'Oslo i alt' WHEN {_MIX_IS_CODE} THEN c.district_name END AS district_name,
  coalesce(sn.sub_id, si.sub_id) AS sub_id, coalesce(sn.sub_name, si.sub_name) AS sub_name
FROM raw {_sub_by_name(MIXED_TEXT, "sn")}
LEFT JOIN subs_t si ON sn.sub_id IS NULL AND si.sub_id = {_sub_key(MIXED_TEXT)}
{_dist_by_id("coalesce(sn.parent_id, si.parent_id)", "p")} {_dist_by_name(MIXED_TEXT, "x")}
{_dist_by_id(f"CASE WHEN {_MIX_IS_CODE} THEN {_zf(f'substring({_MIX_NUM}, 4)', 2)} END", "c")}"""))
def geo_mixed(spark, sf):
    """Names, numeric ids, the city code and district codes mixed in one text column."""
    g = star_geography(spark, sf)
    return _count(R.resolve_mixed(_raw(spark, sf, geo=MIXED_TEXT), "geo", g, K, 10000))


# --- V9 -----------------------------------------------------------------------------------------

@register("geo_integrity", f"""
WITH {GEO_SQL}
SELECT
  CAST((SELECT count(*) FROM dalias_t a WHERE a.district_id NOT IN (SELECT district_id FROM districts_t)) AS BIGINT) AS orphan_district_aliases,
  CAST((SELECT count(*) FROM subs_t s WHERE s.parent_id NOT IN (SELECT district_id FROM districts_t)) AS BIGINT) AS orphan_subs,
  CAST((SELECT count(*) FROM salias_t a WHERE a.sub_id NOT IN (SELECT sub_id FROM subs_t)) AS BIGINT) AS orphan_sub_aliases,
  CAST((SELECT count(*) FROM legacy_t l WHERE l.sub_id NOT IN (SELECT sub_id FROM subs_t)) AS BIGINT) AS orphan_legacy_ids,
  CAST((SELECT count(*) FROM (SELECT district_id FROM districts_t GROUP BY 1 HAVING count(*) > 1)) AS BIGINT) AS duplicate_district_ids,
  CAST((SELECT count(*) FROM (SELECT sub_id FROM subs_t GROUP BY 1 HAVING count(*) > 1)) AS BIGINT) AS duplicate_sub_ids,
  CAST((SELECT count(*) FROM (SELECT alias FROM dalias_t GROUP BY 1 HAVING count(*) > 1)) AS BIGINT) AS duplicate_district_aliases,
  CAST((SELECT count(*) FROM (SELECT alias FROM salias_t GROUP BY 1 HAVING count(*) > 1)) AS BIGINT) AS duplicate_sub_aliases,
  CAST((SELECT count(*) FROM (SELECT old_id FROM legacy_t GROUP BY 1 HAVING count(*) > 1)) AS BIGINT) AS duplicate_legacy_ids
""")
def geo_integrity(spark, sf):
    """V9: referential integrity and uniqueness of the geography dimension (all counts 0)."""
    return star_geography(spark, sf).integrity()
