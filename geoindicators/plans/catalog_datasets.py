"""Registered queries: the published datasets D01-D25 on landing tables shaped from the star tables.

Each query runs a dataset as published (normalise, resolve, pivot, derive, roll up, align, template, documents)
and flattens its documents to one row per value.  The SQL twins work on the rows that the resolvers should
find (``star_sources``), so they check the normalisers N1-N25 and resolvers too.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators import datasets
from geoindicators.datasets.composite import IKKE_VESTLIG, KORT, LANG, OVRIGE, TOTALT_VALUES
from geoindicators.datasets.households import BARN, KATEGORIER, LAV_UTDANNING, TYPER
from geoindicators.datasets.simple import BOLIGTYPER, UTDANNING_LEVELS
from geoindicators.plans import star_sources as src
from geoindicators.plans.common import conform, r4, rollup_sql
from geoindicators.plans.star_geo import star_geography
from geoindicators.plans.star_sources import BASE_SQL, KEYS_SQL, pick_sql
from geoindicators.sources.normalise import FLYTT_INN, FLYTT_UT

Q: dict = {}
SQL: dict = {}
ROWS: dict[str, str] = {}   # the common tables up to ``rows`` of each dataset, for its other variants
ENTRY = ["doc_id", "geo_id", "geography", "avg_row", "total_row"]


def _documents(spark, sf, name, variant):
    spec = datasets.get(name)
    raw = {s: src.raw(spark, sf, s) for s in spec.sources}
    return datasets.run(spec, variant, raw, star_geography(spark, sf), published_date="2026-01-01")


def _entries(docs):
    e = docs.select(F.col("id").alias("doc_id"), F.explode("data").alias("e"))
    return e.select("doc_id", F.col("e.id").alias("geo_id"), F.col("e.geography").alias("geography"), F.col("e.avgRow").alias("avg_row"),
                    F.col("e.totalRow").alias("total_row"), F.col("e.values").alias("vals"))


def _flat(docs, nested: bool):
    """Templates A, B, J (one list of values) and C (one per series, told by ``series``)."""
    e = _entries(docs)
    if nested:
        e = e.select(*ENTRY, F.posexplode("vals").alias("series", "vals"))
    keys = [*ENTRY, *(["series"] if nested else [])]
    e = e.select(*keys, F.posexplode_outer("vals").alias("ordinal", "v"))
    return conform(e.select(*keys, "ordinal", F.col("v.value").cast("double").alias("value"), F.col("v.ratio").alias("ratio"), F.col("v.date").alias("date")))


# --- the documents in SQL -----------------------------------------------------------------------------

_OUT = "'16', '17', '99'"


def docs_sql(cols: str) -> str:
    """Members (row, document, entry) and entries of the documents of the rows ``r``."""
    own = f"district_id NOT IN ({_OUT}, '00')"
    return f"""
m AS (SELECT district_id AS doc_id, 0 AS kind, sub_id AS geo_id, sub_name AS geography, {cols} FROM r WHERE {own} AND sub_id IS NOT NULL
      UNION ALL SELECT district_id, 1, district_id, district_name, {cols} FROM r WHERE {own} AND sub_id IS NULL
      UNION ALL SELECT d.district_id, 2, '00', 'Oslo i alt', {", ".join("r." + c.strip() for c in cols.split(","))}
                FROM (SELECT DISTINCT district_id FROM r WHERE {own}) d, r WHERE r.district_id = '00'
      UNION ALL SELECT '00', CASE WHEN district_id = '00' THEN 2 ELSE 1 END, district_id,
                       CASE WHEN district_id = '00' THEN 'Oslo i alt' ELSE district_name END, {cols}
                FROM r WHERE sub_name IS NULL AND district_id NOT IN ({_OUT})),
e AS (SELECT DISTINCT doc_id, kind, geo_id, geography FROM m
      UNION SELECT district_id, 1, district_id, max(district_name) FROM r WHERE {own} GROUP BY district_id
      UNION SELECT DISTINCT district_id, 2, '00', 'Oslo i alt' FROM r WHERE {own})"""


_FLAGS = "(e.kind = 1 AND e.doc_id <> '00') AS avg_row, (e.kind = 2) AS total_row"


def values_sql(series: list[str], ratios: bool, nested: bool, cols: str) -> str:
    """Flattened values; a series' ratio column is ``<series>_ratio``."""
    parts = " UNION ALL ".join(
        f"SELECT doc_id, kind, geo_id, {i} AS s, CAST({r4(c)} AS DOUBLE) AS value, {r4(c + '_ratio') if ratios else 'CAST(NULL AS DOUBLE)'} AS ratio, date FROM m"
        for i, c in enumerate(series))
    order = "v.s, v.date, v.value, v.ratio"
    one = ", v.s" if nested else ""
    lists = f"(SELECT e.*, s FROM e, (SELECT unnest(range({len(series)})) AS s)) e" if nested else "e"
    return f"""{docs_sql(cols)},
v AS ({parts})
SELECT e.doc_id, e.geo_id, e.geography, {_FLAGS}, {"CAST(e.s AS BIGINT) AS series," if nested else ""}
       CASE WHEN v.s IS NOT NULL THEN CAST(row_number() OVER (PARTITION BY e.doc_id, e.kind, e.geo_id{one} ORDER BY {order}) - 1 AS BIGINT) END AS ordinal,
       v.value, v.ratio, CAST(v.date AS BIGINT) AS date
FROM {lists} LEFT JOIN v ON v.doc_id = e.doc_id AND v.kind = e.kind AND v.geo_id = e.geo_id {"AND v.s = e.s" if nested else ""}"""


def plain(name: str, variant: str, ctes: str, series: list[str], ratios: bool = True, nested: bool = False, status: bool = False) -> None:
    """Register a dataset whose rows are the CTE ``rows`` and whose template is A, B, J or C."""
    cols = ", ".join(["date", *series, *([f"{s}_ratio" for s in series] if ratios else [])])
    newest = "WHERE date = (SELECT max(date) FROM rows)" if status else ""
    ROWS[name] = ctes
    SQL[f"dataset_{name}"] = f"WITH {BASE_SQL},{ctes}, r AS (SELECT * FROM rows {newest}),{values_sql(series, ratios, nested, cols)}"

    def query(spark, sf):
        return _flat(_documents(spark, sf, name, variant), nested)
    query.__doc__ = f"{name}, variant {variant}, documents flattened."
    Q[f"dataset_{name}"] = query


def s(*names: str) -> dict[str, str]:
    return {n: f"coalesce(sum({n}), 0)" for n in names}


def ratio(points, total: str) -> str:
    return ", ".join(f"{p} / nullif({total}, 0) AS {p}_ratio" for p in points)


def rolled(src_sql: str, names, extra=None) -> str:
    return rollup_sql(src_sql, s(*names), extra)


def long_sql(category: str, extra: str = "") -> str:
    return f"SELECT {KEYS_SQL}, {category} AS cat{extra}, antall FROM f"


def wide_sql(category: str, columns: dict[str, str], where: str = "true", absent: str = "0") -> str:
    """The category pivot on the full key: label -> column; rows with a null key or category vanish."""
    cells = ", ".join(f"coalesce(sum(antall) FILTER (WHERE cat = '{label}'), {absent}) AS {c}" for label, c in columns.items())
    return (f"SELECT date, district_id, district_name, sub_id, sub_name, {cells} FROM ({long_sql(category)}) "
            f"WHERE date IS NOT NULL AND district_id IS NOT NULL AND sub_id IS NOT NULL AND cat IS NOT NULL AND {where} GROUP BY ALL")


# population rows: sub-districts only (the others don't resolve to one); both genders of every order
POP = """
pop_long AS (SELECT date, did AS district_id, dname AS district_name, sid AS sub_id, sname AS sub_name,
                    CASE WHEN ok % 19 <> 5 THEN k END AS kjonn, CASE WHEN ok % 17 <> 3 THEN CAST(floor(ok / 7) AS BIGINT) % 123 END AS alder, antall + k AS antall
             FROM f, (SELECT unnest([1, 2]) AS k) WHERE kind = 'sub')"""


def population_sql(low: int = 0, high: int = 120) -> str:
    return (f"SELECT date, district_id, district_name, sub_id, sub_name, sum(antall) AS population FROM pop_long "
            f"WHERE alder BETWEEN {low} AND {high} GROUP BY ALL")


POP_ROLLED = f"pop AS ({rolled(population_sql(), ['population'])})"
ON_POP = "x.date = pop.date AND x.district_id = pop.district_id AND x.sub_id IS NOT DISTINCT FROM pop.sub_id"

# --- single-source datasets without a roll-up --------------------------------------------------------

plain("boligpriser", "status", f" rows AS (SELECT {KEYS_SQL}, CASE WHEN v % 7 <> 0 THEN v + 10000 END AS value FROM g), "
      "kept AS (SELECT * FROM rows)", ["value"], ratios=False, status=True)
SQL["dataset_boligpriser"] = SQL["dataset_boligpriser"].replace("FROM rows)", "FROM rows) AND value IS NOT NULL", 2).replace("kept AS (SELECT * FROM rows) AND value IS NOT NULL", "kept AS (SELECT * FROM rows)")
plain("eieform", "historisk", f" rows AS (SELECT DISTINCT {KEYS_SQL}, v AS selveier, v + 1 AS andel, v + 2 AS leier, v / 100 AS selveier_ratio, (v + 1) / 100 AS andel_ratio, "
      "(v + 2) / 100 AS leier_ratio FROM g)", ["leier", "andel", "selveier"], nested=True)
plain("fattige_barnehusholdninger", "historisk", f" rows AS (SELECT {KEYS_SQL}, v AS fattige, v / 2 / 100 AS fattige_ratio FROM g WHERE v % 5 <> 0)", ["fattige"])
plain("levekaar_dodsrate", "status", f" rows AS (SELECT {KEYS_SQL}, v / 10 AS rate, v / 10 / 100 AS rate_ratio FROM g WHERE kind <> 'none')", ["rate"], status=True)
plain("levekar_redusert_funksjonsevne", "historisk", " rows AS (SELECT date, CASE WHEN kind = 'city' THEN '00' WHEN kind = 'district' THEN did END AS district_id, "
      "CASE WHEN kind = 'city' THEN 'Oslo i alt' WHEN kind = 'district' THEN dname END AS district_name, sid AS sub_id, sname AS sub_name, v AS antall, v / 4 / 100 AS antall_ratio "
      "FROM g WHERE kind <> 'none')", ["antall"])
plain("levekar_trangbodde", "status", f" rows AS (SELECT {KEYS_SQL}, v AS antall, v / 4 / 100 AS antall_ratio FROM g WHERE kind <> 'none')", ["antall"], status=True)
plain("median_totalpris", "status", " rows AS (SELECT date, coalesce(did, '00') AS district_id, coalesce(dname, 'Oslo i alt') AS district_name, sid AS sub_id, sname AS sub_name, "
      "CASE WHEN v % 6 <> 0 THEN v + 100000 END AS value FROM g)", ["value"], ratios=False, status=True)
SQL["dataset_median_totalpris"] = SQL["dataset_median_totalpris"].replace("r AS (SELECT * FROM rows WHERE date = (SELECT max(date) FROM rows))",
                                                                          "r AS (SELECT * FROM rows WHERE date = (SELECT max(date) FROM rows) AND value IS NOT NULL)")
plain("neets", "status", f" rows AS (SELECT {KEYS_SQL}, v AS antall, v / 8 AS antall_ratio FROM g WHERE kind <> 'none')", ["antall"], status=True)

# --- single-source datasets with a roll-up --------------------------------------------------------------

_ROM = ["a", "b", "c", "d"]
plain("trangboddhet", "alle_historisk", f""" rolled AS ({rolled("SELECT date, did AS district_id, dname AS district_name, sid AS sub_id, sname AS sub_name, v AS a, v + 1 AS b, v + 2 AS c, v + 3 AS d FROM g WHERE kind = 'sub'", _ROM)}),
rows AS (SELECT *, {ratio(_ROM, "a + b + c + d")} FROM rolled)""", _ROM, nested=True)

_BOLIG = list(BOLIGTYPER)
_DWELL = {_BOLIG[0]: "t0", _BOLIG[1]: "t1", _BOLIG[2]: "t2", _BOLIG[3]: "t3", _BOLIG[4]: "t4"}
plain("bygningstyper", "alle_historisk", f""" w AS ({wide_sql(pick_sql(BOLIGTYPER, 3), _DWELL)}),
rolled AS ({rolled("SELECT date, district_id, district_name, sub_id, sub_name, t2 AS enebolig, t3 + t4 AS rekkehus, t0 + t1 AS blokk, t0 + t1 + t2 + t3 + t4 AS total FROM w", ["enebolig", "rekkehus", "blokk", "total"])}),
rows AS (SELECT *, {ratio(["enebolig", "rekkehus", "blokk", "total"], "total")} FROM rolled)""", ["blokk", "rekkehus", "enebolig", "total"], nested=True)

_B = dict(zip(BARN, ["b1", "b2", "b3", "b4", "b0"], strict=True))
plain("husholdning_med_barn", "alle_status", f""" w AS ({wide_sql(pick_sql(BARN, 3), _B)}),
rolled AS ({rolled("SELECT date, district_id, district_name, sub_id, sub_name, b1 AS one_child, b2 AS two_child, b3 + b4 AS three_or_more, b0 + b1 + b2 + b3 + b4 AS total FROM w", ["one_child", "two_child", "three_or_more", "total"])}),
rows AS (SELECT *, {ratio(["one_child", "two_child", "three_or_more"], "total")} FROM rolled)""", ["one_child", "two_child", "three_or_more"], status=True)

_T = {label: f"t{i}" for i, label in enumerate(TYPER)}
_TS = ["aleneboende", "par_uten_barn", "par_med_barn", "mor_far_med_barn", "flerfamiliehusholdninger", "total"]
plain("husholdningstyper", "historisk", f""" w AS ({wide_sql(pick_sql(TYPER, 3), _T)}),
rolled AS ({rolled("SELECT date, district_id, district_name, sub_id, sub_name, t0 AS aleneboende, t1 AS par_uten_barn, t2 + t3 AS par_med_barn, t4 + t5 AS mor_far_med_barn, t6 + t7 + t8 + t9 AS flerfamiliehusholdninger, t0 + t1 + t2 + t3 + t4 + t5 + t6 + t7 + t8 + t9 AS total FROM w", _TS)}),
rows AS (SELECT *, {ratio(_TS, "total")} FROM rolled)""", _TS, nested=True)

_K = {label: f"k{i}" for i, label in enumerate(KATEGORIER)}
plain("innvandring_under16", "en-innvandrer_historisk", f""" w AS ({wide_sql(pick_sql(KATEGORIER, 2), _K, "young").replace("AS cat,", "AS cat, CAST(floor(ok / 12) AS BIGINT) % 2 = 0 AS young,")}),
rolled AS ({rolled("SELECT date, district_id, district_name, sub_id, sub_name, k3 + k4 AS en_forelder, k0 + k1 + k2 + k3 + k4 + k5 AS total FROM w", ["en_forelder", "total"])}),
rows AS (SELECT *, {ratio(["en_forelder"], "total")} FROM rolled)""", ["en_forelder"])

_L = dict(zip(LAV_UTDANNING, ["l0", "l1", "l2", "l3", "l4"], strict=True))
_EDU_W = f"edu_w AS ({wide_sql(pick_sql(LAV_UTDANNING, 3), _L, absent='NULL')})"
_EDU_TOTAL = " + ".join(f"coalesce(l{i}, 0)" for i in range(5))
plain("levekar_lav_utdanning", "status", f""" {_EDU_W},
rolled AS ({rolled(f"SELECT date, district_id, district_name, sub_id, sub_name, l0 + l1 AS lav, {_EDU_TOTAL} AS total FROM edu_w", ["lav", "total"])}),
rows AS (SELECT *, {ratio(["lav"], "total")} FROM rolled)""", ["lav"], status=True)

_U = ["u0", "u1", "u2", "u3", "u4"]
_U_CELLS = ", ".join(f"sum(antall + i) FILTER (WHERE i = {i} AND (ok % 17 <> 3 OR i > 0)) AS u{i}" for i in range(len(UTDANNING_LEVELS)))
plain("utdanning", "status", f""" w AS (SELECT date, did AS district_id, dname AS district_name, sid AS sub_id, sname AS sub_name, {_U_CELLS}
      FROM f, (SELECT unnest(range(5)) AS i) WHERE kind = 'sub' GROUP BY ALL),
rolled AS ({rolled("SELECT *, u0 + u1 + u2 + u3 + u4 AS total FROM w", [*_U, "total"])}),
rows AS (SELECT *, {ratio(_U, "total")} FROM rolled)""", _U, status=True)

# --- datasets of several sources ------------------------------------------------------------------------

_IV = {f"{KORT}|{IKKE_VESTLIG}": "ikke_vestlig_kort"}
_IV_CAT = f"{pick_sql(src.BOTID, 2)} || '|' || {pick_sql(src.LAND, 6)}"
plain("botid_ikke_vestlige", "status", f"""{POP}, {POP_ROLLED}, w AS ({wide_sql(_IV_CAT, _IV)}), x AS ({rolled("SELECT * FROM w", ["ikke_vestlig_kort"])}),
rows AS (SELECT x.*, x.ikke_vestlig_kort / nullif(pop.population, 0) AS ikke_vestlig_kort_ratio FROM x JOIN pop ON {ON_POP})""", ["ikke_vestlig_kort"], status=True)

_INN = ["short", "long", "two_parents"]
plain("innvandrer_befolkning", "alle_status", f"""{POP},
liv AS (SELECT {KEYS_SQL}, {pick_sql(src.BOTID, 2)} AS botid, {pick_sql(src.INNVANDRING, 6)} AS kat, antall FROM f WHERE kind = 'sub'),
y AS (SELECT max(date) AS y FROM (SELECT date FROM liv INTERSECT SELECT date FROM pop_long)),
per AS (SELECT date, district_id, district_name, sub_id, sub_name, botid, coalesce(sum(antall) FILTER (WHERE kat IN ('{src.INNVANDRING[0]}', '{src.INNVANDRING[1]}')), 0) AS n
        FROM liv WHERE kat IS NOT NULL AND botid IS NOT NULL AND date = (SELECT y FROM y) GROUP BY ALL),
w AS (SELECT date, district_id, district_name, sub_id, sub_name, sum(n) FILTER (WHERE botid = '{KORT}') AS short, sum(n) FILTER (WHERE botid = '{LANG}') AS long,
             sum(n) FILTER (WHERE botid = '{OVRIGE}') AS two_parents FROM per GROUP BY ALL),
j AS (SELECT w.*, t.total FROM w JOIN (SELECT date, district_id, sub_id, sum(antall) AS total FROM pop_long GROUP BY ALL) t USING (date, district_id, sub_id)),
rolled AS ({rolled("SELECT * FROM j", [*_INN, "total"])}), rows AS (SELECT *, {ratio(_INN, "total")} FROM rolled)""", _INN)

_HOUSING = f"""housing AS (SELECT date, district_id, district_name, sum(antall) AS total FROM ({long_sql(pick_sql(BOLIGTYPER, 3))})
      WHERE cat IS NOT NULL AND district_id IS NOT NULL GROUP BY ALL)"""
plain("kommunale_boliger", "status", f""" municipal AS (SELECT {KEYS_SQL}, v AS antall_boliger FROM g), {_HOUSING},
y AS (SELECT max(date) AS y FROM (SELECT date FROM municipal INTERSECT SELECT date FROM housing)),
j AS (SELECT m.*, h.total FROM municipal m JOIN housing h USING (date, district_id, district_name) WHERE m.date = (SELECT y FROM y)),
rolled AS ({rolled("SELECT * FROM j", ["antall_boliger", "total"])}), rows AS (SELECT *, {ratio(["antall_boliger"], "total")} FROM rolled)""", ["antall_boliger"])


def _employed(shift_employed: int, shift_population: int) -> str:
    return f"""emp_pop AS ({population_sql(30, 59)}),
emp_j AS (SELECT g.date + {shift_employed} AS date, g.did AS district_id, g.dname AS district_name, g.sid AS sub_id, g.sname AS sub_name, p.population, p.population - g.v AS ikke
      FROM g JOIN emp_pop p ON p.date + {shift_population} = g.date + {shift_employed} AND p.sub_id = g.sid WHERE g.kind = 'sub'),
emp_r AS ({rolled("SELECT * FROM emp_j", ["ikke", "population"])}), emp AS (SELECT *, {ratio(["ikke"], "population")} FROM emp_r)"""


plain("levekar_ikke_sysselsatte", "status", f"{POP}, {_employed(0, -1)}, rows AS (SELECT * FROM emp)", ["ikke"], status=True)

# population with yearly change
plain("folkemengde", "historisk-prosent", f"""{POP}, p AS ({population_sql()}),
c AS (SELECT *, population - lag(population) OVER (PARTITION BY sub_id ORDER BY date) AS change FROM p),
rolled AS ({rollup_sql("SELECT * FROM c", {"population": "coalesce(sum(population), 0)", "change": "CASE WHEN count(change) > 0 THEN sum(change) END"})}),
q AS (SELECT *, change / nullif(lag(population) OVER (PARTITION BY district_id, sub_id ORDER BY date), 0) AS change_ratio FROM rolled),
rows AS (SELECT * FROM q WHERE change IS NOT NULL AND change_ratio IS NOT NULL)""", ["change"])


def register(name: str, sql: str):
    def deco(fn):
        Q[name], SQL[name] = fn, sql
        return fn
    return deco


# age distribution: template E
@register("dataset_alder_distribusjon_status", f"""WITH {BASE_SQL},{POP},
l AS (SELECT date, district_id, district_name, sub_id, sub_name, coalesce(CAST(alder AS VARCHAR), 'uoppgitt') AS alder,
             coalesce(sum(antall) FILTER (WHERE kjonn = 1), 0) AS mann, coalesce(sum(antall) FILTER (WHERE kjonn = 2), 0) AS kvinne
      FROM pop_long WHERE kjonn IS NOT NULL GROUP BY ALL),
rolled AS ({rolled("SELECT * FROM l", ["mann", "kvinne"], ["alder"])}), r AS (SELECT * FROM rolled WHERE date = (SELECT max(date) FROM rolled)),
{docs_sql("date, alder, mann, kvinne")},
t AS (SELECT doc_id, kind, geo_id, sum(mann + kvinne) AS total, max(date) AS date FROM m GROUP BY ALL)
SELECT e.doc_id, e.geo_id, e.geography, {_FLAGS}, a.a AS ordinal, CAST(a.a AS VARCHAR) AS age, CAST(coalesce(m.mann, 0) AS DOUBLE) AS mann,
       CAST(coalesce(m.kvinne, 0) AS DOUBLE) AS kvinne, CAST(coalesce(m.mann, 0) + coalesce(m.kvinne, 0) AS DOUBLE) AS value,
       {r4("(coalesce(m.mann, 0) + coalesce(m.kvinne, 0)) / t.total")} AS ratio, CAST(t.date AS BIGINT) AS date
FROM e JOIN t USING (doc_id, kind, geo_id) CROSS JOIN (SELECT unnest(range(121)) AS a) a
LEFT JOIN m ON m.doc_id = e.doc_id AND m.kind = e.kind AND m.geo_id = e.geo_id AND m.alder = CAST(a.a AS VARCHAR)""")
def dataset_alder_distribusjon_status(spark, sf):
    """Age pyramid of the newest year: 121 ages, the total over all rows."""
    e = _entries(_documents(spark, sf, "alder_distribusjon_status", "status")).select(*ENTRY, F.posexplode("vals").alias("ordinal", "v"))
    return conform(e.select(*ENTRY, "ordinal", F.col("v.age").alias("age"), *[F.col(f"v.{c}").cast("double").alias(c) for c in ("mann", "kvinne", "value", "ratio")],
                            F.col("v.date").alias("date")))


def _flow(table: str, divisor: int, labels: dict[str, str]) -> str:
    ages = ", ".join(f"'{a}'" for a in src.AGE_GROUPS)
    cells = ", ".join(f"coalesce(sum(antall) FILTER (WHERE cat = '{label}'), 0) AS {c}" for label, c in labels.items())
    return (f"{table} AS (SELECT date, district_id, district_name, age, {cells} FROM (SELECT date, did AS district_id, dname AS district_name, "
            f"list_extract([{ages}], CAST(floor(ok / {divisor}) AS BIGINT) % 4 + 1) AS age, {pick_sql(labels, 2)} AS cat, antall FROM f WHERE kind IN ('sub', 'district')) "
            f"WHERE cat IS NOT NULL GROUP BY ALL)")


_FLOWS = f"{_flow('fra', 3, FLYTT_UT)}, {_flow('til', 5, FLYTT_INN)}"
_MOVES = [*FLYTT_INN.values(), *FLYTT_UT.values()]


@register("dataset_flyttehyppighet_totalt", f"""WITH {BASE_SQL}, {_FLOWS},
j AS (SELECT *, CAST(NULL AS VARCHAR) AS sub_id, CAST(NULL AS VARCHAR) AS sub_name FROM fra JOIN til USING (date, district_id, district_name, age)),
rolled AS ({rolled("SELECT * FROM j", _MOVES, ["age"])}), r AS (SELECT * FROM rolled WHERE date = (SELECT max(date) FROM rolled)), {docs_sql("date, age, " + ", ".join(_MOVES))},
n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, kind, geo_id ORDER BY age) - 1 AS pos FROM m)
SELECT e.doc_id, e.geo_id, e.geography, {_FLAGS}, CAST(n.date AS BIGINT) AS year, d.direction, CAST(n.pos AS BIGINT) AS pos, n.age AS alder,
       CAST(CASE WHEN d.direction = 'immigration' THEN innflytting_mellom_bydeler ELSE utflytting_mellom_bydeler END AS DOUBLE) AS between_districts,
       CAST(CASE WHEN d.direction = 'immigration' THEN innflytting_innenfor_bydelen ELSE utflytting_innenfor_bydelen END AS DOUBLE) AS within_district,
       CAST(CASE WHEN d.direction = 'immigration' THEN innflytting_til_oslo ELSE utflytting_fra_oslo END AS DOUBLE) AS city
FROM e JOIN n USING (doc_id, kind, geo_id) CROSS JOIN (SELECT unnest(['immigration', 'emigration']) AS direction) d""")
def dataset_flyttehyppighet_totalt(spark, sf):
    """Moves of the newest year by age group (districts and city)."""
    e = _entries(_documents(spark, sf, "flyttehyppighet_totalt", "status"))
    sides = F.array(*[F.struct(F.lit(d).alias("direction"), F.col(f"vals.{d}").alias("rows")) for d in ("immigration", "emigration")])
    e = e.select(*ENTRY, F.col("vals.year").alias("year"), F.explode(sides).alias("d")).select(*ENTRY, "year", "d.direction", F.posexplode("d.rows").alias("pos", "a"))
    return conform(e.select(*ENTRY, "year", "direction", "pos", F.col("a.alder").alias("alder"), F.col("a.mellomBydeler").cast("double").alias("between_districts"),
                            F.col("a.innenforBydelen").cast("double").alias("within_district"), F.col("a.tilFraOslo").cast("double").alias("city")))


def _migration(table: str, flows: str, city: str, between: str, out: str) -> str:
    return (f"{table}_d AS (SELECT date, district_id, district_name, sum({city}) + sum({between}) AS n FROM {flows} GROUP BY ALL), "
            f"{table} AS (SELECT date, district_id, district_name, CAST(NULL AS VARCHAR) AS sub_id, CAST(NULL AS VARCHAR) AS sub_name, n AS {out} FROM {table}_d "
            f"UNION ALL SELECT date, '00', 'Oslo i alt', NULL, NULL, sum(n) FROM {table}_d GROUP BY date)")


_JOIN_KEYS = "date, district_id, district_name, sub_id, sub_name"
_H = ["deaths", "births", "emigration", "immigration", "population", "change"]
_ALL = [("pop", "population"), ("pop", "change"), ("dead", "deaths"), ("born", "births"), ("imm", "immigration"), ("emi", "emigration")]


@register("dataset_befolkningsutvkl_forv_utvkl", f"""WITH {BASE_SQL},{POP}, {_FLOWS},
cy AS (SELECT date FROM pop_long INTERSECT SELECT date FROM g WHERE kind <> 'none' INTERSECT SELECT date FROM fra INTERSECT SELECT date FROM til),
pop_c AS (SELECT date, district_id, district_name, sub_id, sub_name, sum(antall) AS population FROM pop_long
          WHERE alder BETWEEN 0 AND 120 AND kjonn IS NOT NULL AND date IN (SELECT date FROM cy) GROUP BY ALL),
pop_r AS ({rolled("SELECT * FROM pop_c", ["population"])}),
pop AS (SELECT *, population / nullif(lag(population) OVER (PARTITION BY district_id, sub_id ORDER BY date), 0) - 1 AS change FROM pop_r),
vital AS (SELECT date, did AS district_id, dname AS district_name, sid AS sub_id, sname AS sub_name, v + 1 AS deaths, v AS births FROM g WHERE kind = 'sub' AND date IN (SELECT date FROM cy)),
dead AS ({rolled("SELECT * FROM vital", ["deaths"])}), born AS ({rolled("SELECT * FROM vital", ["births"])}),
{_migration("imm", "(SELECT * FROM til WHERE date IN (SELECT date FROM cy))", "innflytting_til_oslo", "innflytting_mellom_bydeler", "immigration")},
{_migration("emi", "(SELECT * FROM fra WHERE date IN (SELECT date FROM cy))", "utflytting_fra_oslo", "utflytting_mellom_bydeler", "emigration")},
long AS ({" UNION ALL ".join(f"SELECT {_JOIN_KEYS}, '{c}' AS what, CAST({c} AS DOUBLE) AS n FROM {t}" for t, c in _ALL)}),
r AS (SELECT {_JOIN_KEYS}, {", ".join(f"max(n) FILTER (WHERE what = '{c}') AS {c}" for c in _H)} FROM long GROUP BY {_JOIN_KEYS}), {docs_sql("date, " + ", ".join(_H))}
SELECT e.doc_id, e.geo_id, e.geography, {_FLAGS}, CAST(row_number() OVER (PARTITION BY e.doc_id, e.kind, e.geo_id ORDER BY m.date) - 1 AS BIGINT) AS ordinal, CAST(m.date AS BIGINT) AS date,
       {", ".join(f"CAST({r4('m.' + c)} AS DOUBLE) AS {c}" for c in _H)}
FROM e JOIN m USING (doc_id, kind, geo_id)""")
def dataset_befolkningsutvkl_forv_utvkl(spark, sf):
    """Population change: deaths, births, migration, population and its yearly change, per year."""
    e = _entries(_documents(spark, sf, "befolkningsutvkl_forv_utvkl", "befolkningsutvikling"))
    e = e.select(*ENTRY, F.posexplode(F.col("vals")[0]).alias("ordinal", "v"))
    return conform(e.select(*ENTRY, "ordinal", F.col("v.date").alias("date"), *[F.col(f"v.{c}").cast("double").alias(c) for c in _H]))


_TOP_POINTS = ["innvandrer", "norskfodt"]


@register("dataset_landbakgrunn_innvandringsgrupper", f"""WITH {BASE_SQL},{POP},
l AS (SELECT date, did AS district_id, dname AS district_name, {pick_sql(src.INNVANDRING, 2)} AS kat, {pick_sql(src.COUNTRIES, 6)} AS land, antall FROM f WHERE kind IN ('sub', 'district')),
c AS (SELECT date, district_id, district_name, land, coalesce(sum(antall) FILTER (WHERE kat = '{src.INNVANDRING[0]}'), 0) AS innvandrer,
             coalesce(sum(antall) FILTER (WHERE kat = '{src.INNVANDRING[1]}'), 0) AS norskfodt FROM l WHERE kat IS NOT NULL AND land IS NOT NULL GROUP BY ALL),
cc AS (SELECT * FROM c UNION ALL SELECT date, '00', 'Oslo i alt', land, sum(innvandrer), sum(norskfodt) FROM c GROUP BY date, land),
{POP_ROLLED},
j AS (SELECT cc.*, innvandrer + norskfodt AS total, pop.population FROM cc JOIN pop ON cc.date = pop.date AND cc.district_id = pop.district_id AND cc.district_name = pop.district_name AND pop.sub_id IS NULL),
s AS (SELECT * FROM j WHERE date = (SELECT max(date) FROM j)),
k AS (SELECT *, row_number() OVER (PARTITION BY district_id ORDER BY total DESC, land) AS pos FROM s)
SELECT district_id AS doc_id, district_name AS district, CAST(pos - 1 AS BIGINT) AS pos, land AS geography, CAST(p.i AS BIGINT) AS series, CAST(date AS BIGINT) AS date,
       CAST(CASE p.i WHEN 0 THEN innvandrer ELSE norskfodt END AS DOUBLE) AS value, {r4("CASE p.i WHEN 0 THEN innvandrer ELSE norskfodt END / population")} AS ratio
FROM k CROSS JOIN (SELECT unnest([0, 1]) AS i) p WHERE pos <= 10""")
def dataset_landbakgrunn_innvandringsgrupper(spark, sf):
    """The ten largest countries of origin per district and for the city."""
    docs = _documents(spark, sf, "landbakgrunn_innvandringsgrupper", "status")
    e = docs.select(F.col("id").alias("doc_id"), "district", F.posexplode("data").alias("pos", "e"))
    e = e.select("doc_id", "district", "pos", F.col("e.geography").alias("geography"), F.posexplode("e.values").alias("series", "v"))
    return conform(e.select("doc_id", "district", "pos", "geography", "series", F.col("v.date").alias("date"), F.col("v.value").alias("value"), F.col("v.ratio").alias("ratio")))


def _relative(table: str, source: str, column: str) -> str:
    """Newest rows of a source with its ratio relative to the own district and to the city."""
    return f"""{table}_f AS (SELECT {_JOIN_KEYS}, {column} AS x FROM {source} WHERE district_id IS NOT NULL AND district_id NOT IN ({_OUT})),
{table}_k AS (SELECT a.*, a.x / nullif(d.x, 0) AS {table}_district, a.x / nullif(c.x, 0) AS {table}_oslo FROM {table}_f a
      JOIN (SELECT DISTINCT date, district_id, x FROM {table}_f WHERE sub_id IS NULL) d ON a.date = d.date AND a.district_id = d.district_id
      JOIN (SELECT DISTINCT date, x FROM {table}_f WHERE district_id = '00') c ON a.date = c.date),
{table} AS (SELECT * FROM {table}_k WHERE date = (SELECT max(date) FROM {table}_k))"""


_KEYS4 = ["district_id", "district_name", "sub_id", "sub_name"]
_PARTS = ["k1", "k2", "k3", "k4", "k5", "k6"]
_SAME = {p: " AND ".join(f"k1.{c} IS NOT DISTINCT FROM {p}.{c}" for c in _KEYS4) for p in _PARTS[1:]}


@register("dataset_levekar_totalt", f"""WITH {BASE_SQL},{POP}, {POP_ROLLED},
iv_w AS ({wide_sql(_IV_CAT, _IV, f"cat LIKE '%|{IKKE_VESTLIG}'")}), iv_x AS ({rolled("SELECT * FROM iv_w", ["ikke_vestlig_kort"])}),
iv AS (SELECT x.*, x.ikke_vestlig_kort / nullif(pop.population, 0) AS q FROM iv_x x JOIN pop ON {ON_POP}),
{_EDU_W}, edu_r AS ({rolled(f"SELECT date, district_id, district_name, sub_id, sub_name, coalesce(l0, 0) + coalesce(l1, 0) AS lav, {_EDU_TOTAL} AS total FROM edu_w", ["lav", "total"])}),
edu AS (SELECT *, lav / nullif(total, 0) AS q FROM edu_r), poor AS (SELECT {KEYS_SQL}, v / 2 / 100 AS q FROM g),
{_employed(1, 0)}, neets AS (SELECT {KEYS_SQL}, v / 8 AS q FROM g WHERE kind <> 'none'), crowd_g AS (SELECT {KEYS_SQL}, v / 4 / 100 AS q FROM g),
crowd AS (SELECT x.* FROM crowd_g x JOIN pop ON {ON_POP}),
{_relative("k1", "iv", "q")}, {_relative("k2", "edu", "q")}, {_relative("k3", "poor", "q")}, {_relative("k4", "emp", "ikke_ratio")}, {_relative("k5", "neets", "q")}, {_relative("k6", "crowd", "q")},
r AS (SELECT CAST(NULL AS INTEGER) AS date, {", ".join("k1." + c for c in _KEYS4)}, {", ".join(f"{p}_district, {p}_oslo" for p in _PARTS)}
      FROM k1 {" ".join(f"JOIN {p} ON {on}" for p, on in _SAME.items())}), {docs_sql(", ".join(f"{p}_district, {p}_oslo" for p in _PARTS))},
v AS ({" UNION ALL ".join(f"SELECT doc_id, kind, geo_id, {i} AS s, {p}_district AS d, {p}_oslo AS o FROM m" for i, p in enumerate(_PARTS))})
SELECT e.doc_id, e.geo_id, e.geography, {_FLAGS}, CASE WHEN v.s IS NOT NULL THEN CAST(v.s AS BIGINT) END AS ordinal, {r4("v.d")} AS district_ratio, {r4("v.o")} AS city_ratio
FROM e LEFT JOIN v USING (doc_id, kind, geo_id)""")
def dataset_levekar_totalt(spark, sf):
    """Living conditions: six indicators relative to the own district and to the city, each at its own newest year."""
    assert len(TOTALT_VALUES) == len(_PARTS)
    e = _entries(_documents(spark, sf, "levekar_totalt", "status")).select(*ENTRY, F.posexplode_outer("vals").alias("ordinal", "v"))
    return conform(e.select(*ENTRY, "ordinal", F.col("v.districtRatio").alias("district_ratio"), F.col("v.osloRatio").alias("city_ratio")))
