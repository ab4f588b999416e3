"""Geography resolution: messy source codes and names -> canonical keys.

Every lookup is a broadcast join with the geography's one key dictionary (``geo.dictionary``), so
resolution happens map-side in the scan stage: no shuffle, no Python.  A dimension too
large for that is left-joined table by table, as Spark and AQE choose.  Each resolver appends the four key columns
(district id/name, sub-district id/name) named by ``Keys``; a value that does not
resolve gives NULLs (filter them with ``operators.filters.drop_unresolved``).

Precedence: a sub-district match always wins over a district match.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoindicators.geo.dim import Geography, norm
from geoindicators.keys import Keys

_counter = itertools.count()


def _tag() -> str:
    return f"_g{next(_counter)}"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lookup(df: DataFrame, key: Column, kind: str, tag: str, geo: Geography) -> DataFrame:
    """Look ``key`` up among the keys of a kind; the struct of what it gives is column ``tag``, null for no hit."""
    known = geo.dictionary()
    if known is not None:
        return known.find(df, kind, key, tag)
    table = geo.table(kind)
    right = table.select(F.col("key").alias(f"{tag}_key"), F.struct(*[c for c in table.columns if c != "key"]).alias(tag))
    out = df.withColumn(f"{tag}_own", key)
    return out.join(right, F.col(f"{tag}_own") == F.col(f"{tag}_key"), "left").drop(f"{tag}_own", f"{tag}_key")


def zfill(c: Column, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole (``lpad`` would cut them)."""
    return F.when(F.length(c) >= width, c).otherwise(F.lpad(c, width, "0"))


def as_long(c) -> Column:
    """int(float(x)) of a number or its text, null for anything else.

    Text that cannot begin a number is sorted out before the cast, which would throw and catch an exception for each such row."""
    text = _c(c).cast("string")
    return F.when(text.rlike(r"^[\x00-\x20]*[+-]?[.0-9]"), text.try_cast("double").try_cast("long"))


def sub_id_key(c) -> Column:
    """Numeric sub-district id (101, 101.0, "0101") -> zero-padded 4-char key."""
    return zfill(as_long(c).cast("string"), 4)


# --- G1..G5: single lookups ------------------------------------------------------------

def by_district_id(df, col, geo, tag=None):
    tag = tag or _tag()
    return _lookup(df, _c(col).cast("string"), "district", tag, geo), tag


def by_district_name(df, col, geo, tag=None):
    """Name -> district via aliases; then ``prefix + name`` (e.g. "Frogner" -> "bydel frogner")."""
    tag = tag or _tag()
    return _lookup(df, norm(_c(col)), "district_name", tag, geo), tag


def by_sub_id(df, col, geo, tag=None):
    tag = tag or _tag()
    return _lookup(df, sub_id_key(col), "sub", tag, geo), tag


def by_sub_name(df, col, geo, tag=None):
    tag = tag or _tag()
    return _lookup(df, norm(_c(col)), "sub_alias", tag, geo), tag


def by_legacy_id(df, col, geo, tag=None):
    """Legacy 3-digit id: text is used as is, numbers are zero-padded to 3."""
    tag = tag or _tag()
    dtype = df.schema[col].dataType if isinstance(col, str) else T.StringType()
    key = (_c(col) if isinstance(dtype, T.StringType)
           else zfill(_c(col).try_cast("long").cast("string"), 3))
    return _lookup(df, key, "legacy", tag, geo), tag


def _finish(df, keys: Keys, did: Column, dname: Column, sid: Column, sname: Column,
            *tags: str) -> DataFrame:
    out = df.withColumns({keys.district_id: did, keys.district_name: dname, keys.sub_id: sid,
                          keys.sub_name: sname})
    return out.drop(*tags)


def _null() -> Column:
    return F.lit(None).cast("string")


def district_by_id(df: DataFrame, col, geo: Geography, keys: Keys = Keys()) -> DataFrame:
    """G1: exact 2-character id; 1 does not match "01"."""
    df, t = by_district_id(df, col, geo)
    return _finish(df, keys, F.col(t)["district_id"], F.col(t)["district_name"], _null(), _null(), t)


def district_by_name(df: DataFrame, col, geo: Geography, keys: Keys = Keys()) -> DataFrame:
    """District by name only."""
    df, t = by_district_name(df, col, geo)
    return _finish(df, keys, F.col(t)["district_id"], F.col(t)["district_name"], _null(), _null(), t)


def sub_by_legacy_id(df: DataFrame, col, geo: Geography, keys: Keys = Keys()) -> DataFrame:
    """Legacy id -> current sub-district (and its district)."""
    df, t = by_legacy_id(df, col, geo)
    return _finish(df, keys, F.col(t)["parent_id"], F.col(t)["district_name"],
                   F.col(t)["sub_id"], F.col(t)["sub_name"], t)


# --- R1..R11: the compositions the sources need ---------------------------------------

def _sub_then_parent_else_name(df, geo, keys, t_sub, name_col, default_city=False):
    d_name, tn = by_district_name(df, name_col, geo) if name_col is not None else (df, None)
    hit = F.col(t_sub)["sub_id"].isNotNull()
    did = F.when(hit, F.col(t_sub)["district_id"])
    dname = F.when(hit, F.col(t_sub)["district_name"])
    if tn is not None:
        did = did.otherwise(F.col(tn)["district_id"])
        dname = dname.otherwise(F.col(tn)["district_name"])
    if default_city:
        did = F.coalesce(did, F.lit(geo.city_id))
        dname = F.coalesce(dname, F.lit(geo.city_name))
    return _finish(d_name, keys, did, dname, F.col(t_sub)["sub_id"], F.col(t_sub)["sub_name"],
                   t_sub, *([tn] if tn else []))


def resolve_sub_id_with_fallback(df, sub_col, district_name_col, geo, keys=Keys(), default_city=False):
    """Numeric sub-district id; district = its parent, else by the district-name column."""
    df, t = by_sub_id(df, sub_col, geo)
    return _sub_then_parent_else_name(df, geo, keys, t, district_name_col, default_city)


def resolve_sub_name_with_fallback(df, sub_col, district_name_col, geo, keys=Keys()):
    """R2: sub-district name; district = its parent, else by the district-name column."""
    df, t = by_sub_name(df, sub_col, geo)
    return _sub_then_parent_else_name(df, geo, keys, t, district_name_col)


def resolve_sub_name_district_column(df, sub_col, district_name_col, geo, keys=Keys()):
    """Sub-district by name; the district only from the district-name column."""
    df, t = by_sub_name(df, sub_col, geo)
    df, tn = by_district_name(df, district_name_col, geo)
    return _finish(df, keys, F.col(tn)["district_id"], F.col(tn)["district_name"],
                   F.col(t)["sub_id"], F.col(t)["sub_name"], t, tn)


def resolve_one_column(df, col, geo, keys=Keys()):
    """One geography column: a sub-district name first, else a district name."""
    df, t = by_sub_name(df, col, geo)
    return _sub_then_parent_else_name(df, geo, keys, t, col)


def resolve_labelled(df, col, geo, keys=Keys(), sub_keeps_district=True):
    """One column with a textual level marker.

    City label -> city; unknown label -> the unknown district (R5 only);
    "<sub prefix><name>" -> that sub-district (R5: with its district; R5b: district
    NULL); anything else -> district by name.
    """
    text = _c(col).cast("string")
    prefix = geo.sub_label_prefix
    sub_name = F.when(text.startswith(prefix), F.substring(text, len(prefix) + 1, 1 << 20))
    df, ts = by_sub_name(df, sub_name, geo)
    df, tn = by_district_name(df, col, geo)
    hit = F.col(ts)["sub_id"].isNotNull()
    if sub_keeps_district:
        is_city = text == F.lit(geo.city_name)
        is_unknown = text == F.lit(geo.unknown_label)
        did = (F.when(is_city, F.lit(geo.city_id)).when(is_unknown, F.lit(geo.unknown_id))
               .when(hit, F.col(ts)["district_id"]).otherwise(F.col(tn)["district_id"]))
        dname = (F.when(is_city, F.lit(geo.city_name)).when(is_unknown, F.lit(geo.unknown_name))
                 .when(hit, F.col(ts)["district_name"]).otherwise(F.col(tn)["district_name"]))
        special = is_city | is_unknown
        sid = F.when(~special & hit, F.col(ts)["sub_id"])
        sname = F.when(~special & hit, F.col(ts)["sub_name"])
    else:
        did = F.when(hit, _null()).otherwise(F.col(tn)["district_id"])
        dname = F.when(hit, _null()).otherwise(F.col(tn)["district_name"])
        sid, sname = F.col(ts)["sub_id"], F.col(ts)["sub_name"]
    return _finish(df, keys, did, dname, sid, sname, ts, tn)


def district_code_id(code, geo: Geography) -> Column:
    """``301XX`` -> ``XX``; other numbers zero-padded to 2."""
    s = as_long(code).cast("string")
    p = geo.district_code_prefix
    return F.when(s.startswith(p), zfill(F.substring(s, len(p) + 1, 1 << 20), 2)).otherwise(zfill(s, 2))


def resolve_code_and_sub_id(df, code_col, sub_col, geo, keys=Keys(), id_from_code=False):
    """District code ``301XX`` plus numeric sub-district id.

    R6: a resolved sub-district gives the district id (its parent), the name comes
    from the code.  R7 (``id_from_code``): id and name both come from the code.
    """
    code_id = district_code_id(code_col, geo)
    df, tc = by_district_id(df, code_id, geo)
    df, ts = by_sub_id(df, sub_col, geo)
    hit = F.col(ts)["sub_id"].isNotNull()
    if id_from_code:
        did = F.col(tc)["district_id"]
    else:
        did = F.when(hit, F.col(ts)["parent_id"]).otherwise(code_id)
    return _finish(df, keys, did, F.col(tc)["district_name"], F.col(ts)["sub_id"], F.col(ts)["sub_name"],
                   tc, ts)


def resolve_single_code(df, col, geo, keys=Keys(), city_code: int = 100000, district_codes: bool = True):
    """One numeric code: the city code, ``301XX`` districts (R8), else a sub-district id."""
    n = as_long(col)
    s = n.cast("string")
    p = geo.district_code_prefix
    is_city = n == F.lit(city_code)
    is_district = s.startswith(p) & (F.length(s) == 5) if district_codes else F.lit(False)
    code_id = zfill(F.substring(s, len(p) + 1, 1 << 20), 2)
    df, tc = by_district_id(df, F.when(is_district, code_id), geo)
    df, ts = by_sub_id(df, F.when(~is_city & ~is_district, n), geo)
    hit = F.col(ts)["sub_id"].isNotNull()
    did = (F.when(is_city, F.lit(geo.city_id)).when(is_district, code_id)
           .when(hit, F.col(ts)["parent_id"]))
    dname = (F.when(is_city, F.lit(geo.city_name))
             .when(is_district & (code_id == F.lit(geo.unknown_id)), F.lit(geo.unknown_name))
             .when(is_district, F.col(tc)["district_name"])
             .when(hit, F.col(ts)["district_name"]))
    return _finish(df, keys, did, dname, F.col(ts)["sub_id"], F.col(ts)["sub_name"], tc, ts)


def resolve_mixed(df, col, geo, keys=Keys(), city_code: int = 10000):
    """A column holding names or numbers.

    Sub-district by name, else by numeric id; district = the sub-district's
    parent, else by name, else the city code or a ``301XX`` district code.
    """
    text = _c(col).cast("string")
    number = _tag()
    df = df.withColumn(number, as_long(text).cast("string"))  # read once for three uses
    n = F.col(number)
    df, tsn = by_sub_name(df, text, geo)
    tsi = _tag()
    df = _lookup(df, F.when(F.col(tsn).isNull(), zfill(n, 4)), "sub", tsi, geo)
    sid = F.coalesce(F.col(tsn)["sub_id"], F.col(tsi)["sub_id"])
    sname = F.coalesce(F.col(tsn)["sub_name"], F.col(tsi)["sub_name"])
    own = [F.when(F.col(tsn)["sub_id"].isNotNull(), F.col(tsn)[c]).otherwise(F.col(tsi)[c]) for c in ("district_id", "district_name")]
    df, tn = by_district_name(df, text, geo)
    p = geo.district_code_prefix
    is_code = n.startswith(p) & (F.length(n) == 5)
    df, tc = by_district_id(df, F.when(is_code, zfill(F.substring(n, len(p) + 1, 1 << 20), 2)), geo)
    hit = sid.isNotNull()
    by_name = F.col(tn)["district_id"].isNotNull()
    is_city = n == F.lit(str(city_code))
    did = (F.when(hit, own[0]).when(by_name, F.col(tn)["district_id"])
           .when(is_city, F.lit(geo.city_id)).when(is_code, F.col(tc)["district_id"]))
    dname = (F.when(hit, own[1]).when(by_name, F.col(tn)["district_name"])
             .when(is_city, F.lit(geo.city_name)).when(is_code, F.col(tc)["district_name"]))
    return _finish(df, keys, did, dname, sid, sname, number, tsn, tsi, tn, tc)


def resolve_names_parent_id(df, district_col, sub_col, geo, keys=Keys()):
    """Names in two columns; id = the sub-district's parent, name from the district column."""
    df, tn = by_district_name(df, district_col, geo)
    df, ts = by_sub_name(df, sub_col, geo)
    hit = F.col(ts)["sub_id"].isNotNull()
    did = F.when(hit, F.col(ts)["parent_id"]).otherwise(F.col(tn)["district_id"])
    return _finish(df, keys, did, F.col(tn)["district_name"], F.col(ts)["sub_id"], F.col(ts)["sub_name"],
                   tn, ts)


# --- G6 / G7 ---------------------------------------------------------------------------------

def district_id_for_name(df: DataFrame, col, geo: Geography, out: str = "district_id") -> DataFrame:
    """G6: "Bydel "-prefix the name unless it has one or is special; a miss is an error."""
    text = _c(col).cast("string")
    named = (F.when(text.startswith(geo.district_title_prefix) | text.isin(list(geo.special_district_names)), text)
             .otherwise(F.concat(F.lit(geo.district_title_prefix), text)))
    tag = _tag()
    df = _lookup(df, norm(named), "district_alias", tag, geo)
    return (df.withColumn(out, F.when(F.col(tag)["district_id"].isNull() & text.isNotNull(),
                                      F.raise_error(F.concat(F.lit("Unknown district: "), text)))
                          .otherwise(F.col(tag)["district_id"]))
            .drop(tag))


def add_district_id(df: DataFrame, id_col: str, geo: Geography, district_column: str | None = None,
                    out: str = "district") -> DataFrame:
    """district = characters 5-6 of an id; else by name (G6); without a name
    column, rows with an empty district are dropped."""
    part = F.substring(F.col(id_col).cast("string"), 5, 2)
    df = df.withColumn(out, part)
    if district_column:
        resolved = district_id_for_name(df, F.when(F.col(out).isNull(), F.col(district_column)), geo, "_g7")
        return resolved.withColumn(out, F.coalesce(F.col(out), F.col("_g7"))).drop("_g7")
    return df.filter(F.length(F.col(out)) > 0)
