"""Registered queries: the other variants of the datasets (``dataset_<name>__<variant>``).

``catalog_datasets`` has one variant of each; these run the rest, on the same landing tables and with the same common tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators.plans import catalog_datasets as base
from geoindicators.plans.catalog_datasets import _FLOWS, _K, _MOVES, _TS, _U, ENTRY, POP, _documents, _entries, _flat, docs_sql, population_sql, ratio, rolled, values_sql, wide_sql
from geoindicators.plans.common import conform
from geoindicators.plans.star_sources import BASE_SQL, pick_sql

Q: dict = {}
SQL: dict = {}
NEWEST = "WHERE date = (SELECT max(date) FROM rows)"


def variant(name: str, variant: str, series: list[str], status: bool, ratios: bool = True, nested: bool = False, ctes: str | None = None, where: str = "") -> None:
    """A variant with template A, B, J or C (``nested``) on the dataset's rows: the newest year (``status``) or all years."""
    cols = ", ".join(["date", *series, *([f"{s}_ratio" for s in series] if ratios else [])])
    kept = " AND ".join([*([NEWEST] if status else []), *([where] if where else [])])
    kept = kept if kept.startswith("WHERE") or not kept else f"WHERE {kept}"
    key = f"dataset_{name}__{variant}"
    SQL[key] = f"WITH {BASE_SQL},{ctes or base.ROWS[name]}, r AS (SELECT * FROM rows {kept}),{values_sql(series, ratios, nested, cols)}"

    def query(spark, sf):
        return _flat(_documents(spark, sf, name, variant), nested)
    query.__doc__ = f"{name}, variant {variant}, documents flattened."
    Q[key] = query


# --- both years of datasets with one series -----------------------------------------------------------

variant("boligpriser", "historisk", ["value"], False, ratios=False, where="value IS NOT NULL")
variant("median_totalpris", "historisk", ["value"], False, ratios=False, where="value IS NOT NULL")
variant("botid_ikke_vestlige", "historisk", ["ikke_vestlig_kort"], False)
variant("eieform", "status", ["leier", "andel", "selveier"], True)
variant("fattige_barnehusholdninger", "status", ["fattige"], True)
variant("levekaar_dodsrate", "historisk", ["rate"], False)
variant("levekar_ikke_sysselsatte", "historisk", ["ikke"], False)
variant("levekar_lav_utdanning", "historisk", ["lav"], False)
variant("levekar_redusert_funksjonsevne", "status", ["antall"], True)
variant("levekar_trangbodde", "historisk", ["antall"], False)
variant("neets", "historisk", ["antall"], False)
variant("husholdningstyper", "status", _TS[:-1], True)

# --- several series ---------------------------------------------------------------------------------

variant("bygningstyper", "alle_status", ["blokk", "rekkehus", "enebolig"], True)
for _label, _column in (("blokk", "blokk"), ("enebolig", "enebolig"), ("rekkehus", "rekkehus"), ("totalt", "total")):
    variant("bygningstyper", f"{_label}_status", [_column], True)
    variant("bygningstyper", f"{_label}_historisk", [_column], False)

_CHILDREN = ["one_child", "two_child", "three_or_more"]
variant("husholdning_med_barn", "alle_historisk", [*_CHILDREN, "total"], False, nested=True,
        ctes=base.ROWS["husholdning_med_barn"].replace("SELECT *, one_child", "SELECT *, total / nullif(total, 0) AS total_ratio, one_child"))
for _label, _column in zip(("1barn", "2barn", "3barn"), _CHILDREN, strict=True):
    variant("husholdning_med_barn", f"{_label}_status", [_column], True)
    variant("husholdning_med_barn", f"{_label}_historisk", [_column], False)

variant("trangboddhet", "alle_status", ["a", "b", "c", "d"], True)
for _label, _column in (("under-0-5", "a"), ("0-5-0-9", "b"), ("1-0-1-9", "c"), ("over-2", "d")):
    variant("trangboddhet", f"{_label}_status", [_column], True)
    variant("trangboddhet", f"{_label}_historisk", [_column], False)

variant("utdanning", "historisk", [*_U, "total"], False, nested=True,
        ctes=base.ROWS["utdanning"].replace("SELECT *, u0 /", "SELECT *, total / nullif(total, 0) AS total_ratio, u0 /"))

_U16 = ["to_foreldre", "en_forelder", "innvandrer"]
_U16_ROWS = f""" w AS ({wide_sql(pick_sql(base.KATEGORIER, 2), _K, "young").replace("AS cat,", "AS cat, CAST(floor(ok / 12) AS BIGINT) % 2 = 0 AS young,")}),
rolled AS ({rolled("SELECT date, district_id, district_name, sub_id, sub_name, k2 AS to_foreldre, k3 + k4 AS en_forelder, k1 AS innvandrer, k0 + k1 + k2 + k3 + k4 + k5 AS total FROM w", [*_U16, "total"])}),
rows AS (SELECT *, {ratio(_U16, "total")} FROM rolled)"""
for _label, _column in (("en-innvandrer", "en_forelder"), ("to-innvandrer", "to_foreldre"), ("innvandrer", "innvandrer")):
    for _years, _status in (("status", True), ("historisk", False)):
        if (_label, _years) != ("en-innvandrer", "historisk"):  # in ``catalog_datasets``
            variant("innvandring_under16", f"{_label}_{_years}", [_column], _status, ctes=_U16_ROWS)

# --- aligned inside: the newest common year, or all common years ------------------------------------------


def all_years(ctes: str) -> str:
    return ctes.replace("y AS (SELECT max(date) AS y FROM", "y AS (SELECT date AS y FROM").replace("date = (SELECT y FROM y)", "date IN (SELECT y FROM y)")


_INN_ALL = all_years(base.ROWS["innvandrer_befolkning"]).replace(
    "rows AS (SELECT *,", "rows AS (SELECT *, short + long + two_parents AS total_cat, (short + long + two_parents) / nullif(total, 0) AS total_cat_ratio,")
variant("innvandrer_befolkning", "alle_historisk", ["short", "long", "two_parents", "total_cat"], False, nested=True, ctes=_INN_ALL)
for _label, _column in (("kort", "short"), ("lang", "long"), ("to_foreldre", "two_parents")):
    variant("innvandrer_befolkning", f"{_label}_status", [_column], False)
    variant("innvandrer_befolkning", f"{_label}_historisk", [_column], False, ctes=_INN_ALL)
variant("kommunale_boliger", "historisk", ["antall_boliger"], False, ctes=all_years(base.ROWS["kommunale_boliger"]))
variant("folkemengde", "historisk", ["population"], False, ratios=False, ctes=f"{POP}, p AS ({population_sql()}), rows AS ({rolled('SELECT * FROM p', ['population'])})")

# --- moves of all years -----------------------------------------------------------------------------------

_SIDES = {"immigration": ("innflytting_mellom_bydeler", "innflytting_innenfor_bydelen", "innflytting_til_oslo"),
          "emigration": ("utflytting_mellom_bydeler", "utflytting_innenfor_bydelen", "utflytting_fra_oslo")}
_SIDE_SQL = " UNION ALL ".join(f"SELECT doc_id, kind, geo_id, date, age, '{d}' AS direction, {a} AS between_districts, {b} AS within_district, {c} AS city FROM m"
                               for d, (a, b, c) in _SIDES.items())
SQL["dataset_flyttehyppighet_totalt__historisk"] = f"""WITH {BASE_SQL}, {_FLOWS},
j AS (SELECT *, CAST(NULL AS VARCHAR) AS sub_id, CAST(NULL AS VARCHAR) AS sub_name FROM fra JOIN til USING (date, district_id, district_name, age)),
r AS ({rolled("SELECT * FROM j", _MOVES, ["age"])}), {docs_sql("date, age, " + ", ".join(_MOVES))}, n AS ({_SIDE_SQL})
SELECT e.doc_id, e.geo_id, e.geography, {base._FLAGS}, CAST(dense_rank() OVER (PARTITION BY doc_id, kind, geo_id ORDER BY date) - 1 AS BIGINT) AS ordinal, CAST(date AS BIGINT) AS year,
       direction, CAST(row_number() OVER (PARTITION BY doc_id, kind, geo_id, date, direction ORDER BY age) - 1 AS BIGINT) AS pos, age AS alder,
       CAST(between_districts AS DOUBLE) AS between_districts, CAST(within_district AS DOUBLE) AS within_district, CAST(city AS DOUBLE) AS city
FROM e JOIN n USING (doc_id, kind, geo_id)"""


def dataset_flyttehyppighet_totalt__historisk(spark, sf):
    """Moves of every year by age group (districts and city)."""
    e = _entries(_documents(spark, sf, "flyttehyppighet_totalt", "historisk")).select(*ENTRY, F.posexplode("vals").alias("ordinal", "v"))
    sides = F.array(*[F.struct(F.lit(d).alias("direction"), F.col(f"v.{d}").alias("rows")) for d in _SIDES])
    e = e.select(*ENTRY, "ordinal", F.col("v.year").alias("year"), F.explode(sides).alias("d")).select(*ENTRY, "ordinal", "year", "d.direction", F.posexplode("d.rows").alias("pos", "a"))
    return conform(e.select(*ENTRY, "ordinal", "year", "direction", "pos", F.col("a.alder").alias("alder"), F.col("a.mellomBydeler").cast("double").alias("between_districts"),
                            F.col("a.innenforBydelen").cast("double").alias("within_district"), F.col("a.tilFraOslo").cast("double").alias("city")))


Q["dataset_flyttehyppighet_totalt__historisk"] = dataset_flyttehyppighet_totalt__historisk
