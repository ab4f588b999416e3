"""Datasets that combine sources or derive time series: population, age
distribution, population change, moves, length of residence, municipal housing,
countries of origin, non-employed and the living-conditions composite.

Alignment rules differ per dataset (some align the sources before joining
them), so these ``prepare`` functions align themselves and their variants use
``align=None``.  Labels, headings and series are published texts (fixed values).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoindicators.datasets.households import EDUCATION, education_levels
from geoindicators.datasets.simple import BOLIGTYPER, KEYS, S
from geoindicators.datasets.spec import HISTORIC, STATUS, DatasetSpec, Variant
from geoindicators.functions.nulls import row_sum_skip
from geoindicators.keys import OSLO_KEYS as K
from geoindicators.operators import align, change, filters, joins, pivot, relative, rollup
from geoindicators.operators.population import band_population
from geoindicators.publish.templates import (TemplateA, TemplateB, TemplateC, TemplateE, TemplateFlow, TemplateG,
                                             TemplateH, TemplateK)
from geoindicators.session import materialize
from geoindicators.sources import normalise as N

BEF = "befolkning-etter-kjonn-og-alder"
NON_RESIDENTIAL = ["16", "17", "99"]
KORT = "Innvandrer, kort botid (<=5 år)"
LANG = "Innvandrer, lang botid (>5 år)"
OVRIGE = "Øvrige befolkning"
IKKE_VESTLIG = "Asia, Afrika, Latin-Amerika og Øst-Europa utenfor EU"


def _is_status(variant: str) -> bool:
    return variant.endswith("status")


def _aligned(variant: str, *dfs: DataFrame) -> list[DataFrame]:
    return (align.status if variant.endswith("status") else align.historic)(*dfs, date=K.date)


def _population(long: DataFrame, min_age: int = 0, max_age: int = 200) -> DataFrame:
    """A7 on long population rows: population per (year, sub-district)."""
    return band_population(long, "alder", "antall", min_age, max_age, K)


def _befolkning_r7(raw, geo):
    return N.befolkning(raw, geo, district_from_code=True)


def _sub_keys_join(left: DataFrame, right: DataFrame, keys=(K.district_id, K.date, K.sub_id)) -> DataFrame:
    """Inner join on district, year and sub-district; a NULL sub-district matches a NULL one."""
    return joins.join_on(left, right, list(keys), "inner", null_safe=[K.sub_id])


# --- D01 age distribution ------------------------------------------------------------------------

AGES = [str(i) for i in range(0, 121)]
GENDERS = ["mann", "kvinne"]


def _alder(inputs, variant):
    # rows without an age count in the total, under an age that the published list doesn't hold
    long = inputs[BEF].withColumn("alder", F.coalesce(F.col("alder").cast("string"), F.lit("uoppgitt")))
    wide = pivot.pivot_sum(long, [*KEYS, "alder"], "kjonn", "antall", {1: "mann", 2: "kvinne"}, fill=None)
    wide = wide.withColumns({f"n_{c}": F.col(c).isNotNull().cast("int") for c in GENDERS}).fillna(0, GENDERS)
    [rows] = align.status(materialize(rollup.aggregate(wide, "sum", K, extra=["alder"])), date=K.date)
    return rows


_HA = "Aldersdistribusjon fordelt på kjønn"
ALDER_DISTRIBUSJON = DatasetSpec(
    "alder_distribusjon_status", [BEF], {BEF: N.befolkning}, _alder,
    {"status": Variant(TemplateE(age="alder", ages=AGES, present=[f"n_{c}" for c in GENDERS]), [], _HA, [S(_HA)], None)})


# --- D09 population ----------------------------------------------------------------------------------

def population_with_changes(long: DataFrame, horizon: int = 10) -> DataFrame:
    """Population per geography with 1-year and ``horizon``-year change and change ratios."""
    pop = materialize(_population(long))   # small; read by three change operators
    on = [K.date, K.district_id, K.sub_id]
    ch = change.yoy_change(pop, "population", "change", K).select(*on, "change")
    ch_h = change.horizon_change(pop, "population", horizon, "change_10y", K)
    df = pop.join(ch, on, "left").join(ch_h, on, "left")
    r = rollup.aggregate(df, {"population": "sum", "change": "strict", "change_10y": "strict"}, K)
    return change.change_ratios(r, "population", "change", "change_10y", horizon, K)


def _folkemengde(inputs, variant):
    df = inputs["base"]
    if variant == "historisk-prosent":
        return df.filter(F.col("change").isNotNull() & F.col("change_ratio").isNotNull())
    if variant == "nokkeltall":
        hist = change.growth_history(df, "population", 10, K)
        [latest] = align.status(df, date=K.date)
        # a geography with a history but no newest row is an error of the template, not dropped here
        return joins.join_on(latest, hist, [K.district_id, K.sub_id], "full_outer", null_safe=[K.sub_id])
    return df


FOLKEMENGDE = DatasetSpec(
    "folkemengde", [BEF], {BEF: N.befolkning}, _folkemengde, rows_key=lambda variant: variant,
    base=lambda inputs: population_with_changes(inputs[BEF].filter(F.col(K.date).isNotNull())), variants=
    {"historisk": Variant(TemplateB(), ["population"], "Folkemengde utvikling historisk", [], None),
     "historisk-prosent": Variant(TemplateB(), ["change"], "Folkemengde utvikling historisk prosent", [], None),
     "nokkeltall": Variant(TemplateG("history"), ["population", "change", "change_10y"],
                           "Nøkkeltall om befolkningen",
                           [{"heading": "Folkemengde", "subheading": "(totalt)"},
                            {"heading": "Utvikling siste år", "subheading": False},
                            {"heading": "Utvikling siste 10 år", "subheading": False}], None)})


# --- D02 population change and projection ----------------------------------------------------------

def _migration(df: DataFrame, city_col: str, between_col: str, label: str) -> DataFrame:
    """District totals over age groups (label = to/from city + between districts), then the city."""
    d = (df.groupBy(K.date, K.district_id, K.district_name)
         .agg((F.sum(city_col) + F.sum(between_col)).alias(label)))
    d = d.withColumns({K.sub_id: F.lit(None).cast("string"), K.sub_name: F.lit(None).cast("string")})
    t = rollup.district_city_totals(d.select(K.date, K.district_id, K.district_name, label), K)
    return t.withColumns({K.sub_id: F.lit(None).cast("string"), K.sub_name: F.lit(None).cast("string")}) \
        .select(*KEYS, label)


def _befolkningsutvkl(inputs, variant):
    pop_long, dead, born, imm, emi = align.historic(
        inputs[BEF], inputs["dode"], inputs["fodte"], inputs["flytting-til-etter-alder"],
        inputs["flytting-fra-etter-alder"], date=K.date)
    pop = rollup.aggregate(_population(pop_long.dropna()), "sum", K)
    pop = change.pct_change_levels(pop, "population", "change", K)
    dead = rollup.aggregate(dead.dropna(), "sum", K)
    born = rollup.aggregate(born.dropna(), "sum", K)
    imm = _migration(imm, "innflytting_til_oslo", "innflytting_mellom_bydeler", "immigration")
    emi = _migration(emi, "utflytting_fra_oslo", "utflytting_mellom_bydeler", "emigration")
    merged = joins.natural_join(pop, dead, born, imm, emi, how="full_outer")
    casts = {c: F.col(c).cast("long") for c in ["antall_dode", "antall_fodte", "immigration", "emigration",
                                                "population"]}
    return merged.withColumns(casts).withColumnsRenamed({"antall_dode": "deaths", "antall_fodte": "births"})


BEFOLKNINGSUTVKL = DatasetSpec(
    "befolkningsutvkl_forv_utvkl", [BEF, "dode", "fodte", "flytting-fra-etter-alder", "flytting-til-etter-alder"],
    {BEF: N.befolkning, "dode": N.dode, "fodte": N.fodte, "flytting-fra-etter-alder": N.flytting_fra,
     "flytting-til-etter-alder": N.flytting_til}, _befolkningsutvkl,
    {"befolkningsutvikling": Variant(
        TemplateH(), [["deaths", "births", "emigration", "immigration", "population", "change"], []],
        "Befolkningsutvikling og fremskrivning",
        [S("Befolkningsutvikling"), S("Befolkningsfremskrivning")], None)})


# --- D08 moves -------------------------------------------------------------------------------------------

_FLOW = {"in": ["innflytting_mellom_bydeler", "innflytting_innenfor_bydelen", "innflytting_til_oslo"],
         "out": ["utflytting_mellom_bydeler", "utflytting_innenfor_bydelen", "utflytting_fra_oslo"]}


def _flytting(inputs):
    on = [K.date, K.district_name, K.district_id, N.AGE_GROUP]
    df = inputs["flytting-fra-etter-alder"].join(inputs["flytting-til-etter-alder"], on)
    df = df.withColumns({K.sub_id: F.lit(None).cast("string"), K.sub_name: F.lit(None).cast("string")})
    return rollup.aggregate(df, "sum", K, extra=[N.AGE_GROUP])


def _flytting_aligned(inputs, variant):
    return _aligned(variant, inputs["base"])[0]


FLYTTEHYPPIGHET = DatasetSpec(
    "flyttehyppighet_totalt", ["flytting-fra-etter-alder", "flytting-til-etter-alder"],
    {"flytting-fra-etter-alder": N.flytting_fra, "flytting-til-etter-alder": N.flytting_til}, _flytting_aligned,
    rows_key=_is_status, base=_flytting, variants={"status": Variant(TemplateFlow(N.AGE_GROUP, status=True), _FLOW, "Flytting etter alder", [S("Flytting")], None),
     "historisk": Variant(TemplateFlow(N.AGE_GROUP), _FLOW, "Flytting etter alder", [S("Flytting")], None)})


# --- D04 non-western immigrants with short residence ----------------------------------------------------

def ikke_vestlig_kort(long: DataFrame) -> DataFrame:
    """Short-residence non-western immigrants per (year, sub-district), rolled up."""
    cat = F.concat(F.col("botid"), F.lit("|"), F.col("landbakgrunn"))
    w = pivot.pivot_sum(long.withColumn("_cat", cat), KEYS, "_cat", "antall",
                        {f"{KORT}|{IKKE_VESTLIG}": "ikke_vestlig_kort"}, fill=0)
    return rollup.aggregate(w, {"ikke_vestlig_kort": "sum"}, K)


def _with_population(df: DataFrame, pop_long: DataFrame, point: str) -> DataFrame:
    pop = rollup.aggregate(_population(pop_long), {"population": "sum"}, K).select(
        K.date, K.district_id, K.sub_id, "population")
    j = _sub_keys_join(df, pop, (K.district_id, K.date, K.sub_id))
    return rollup.add_ratios(j, [point], ["population"])


def _botid_ikke_vestlige(inputs, variant):
    df = _with_population(ikke_vestlig_kort(inputs["botid-ikke-vestlige"]), inputs[BEF], "ikke_vestlig_kort")
    return df


_H04 = "Ikke-vestlige innvandrere korttid"
_S04 = [S("Innvandrere fra Asia, Afrika, Latin-Amerika og Øst-Europa utenfor EU med botid kortere enn fem år")]
BOTID_IKKE_VESTLIGE = DatasetSpec(
    "botid_ikke_vestlige", ["botid-ikke-vestlige", BEF],
    {"botid-ikke-vestlige": N.botid_ikke_vestlige, BEF: _befolkning_r7}, _botid_ikke_vestlige,
    {"status": Variant(TemplateA(), ["ikke_vestlig_kort"], _H04, _S04, STATUS, scale="ikke_vestlig_kort"),
     "historisk": Variant(TemplateB(), ["ikke_vestlig_kort"], _H04, _S04, HISTORIC)})


# --- D12 immigrant population by length of residence ----------------------------------------------------

def _innvandrer(inputs, variant):
    livage, pop_long = _aligned(variant, inputs["botid"], inputs[BEF])
    # immigrants + children of immigrants per length of residence (absent -> NULL, like a mean pivot)
    cats = {"Innvandrer": "innvandrer", "Norskfødt med innvandrerforeldre": "norskfodt_med_innvandrerforeldre"}
    per_botid = pivot.pivot_sum(livage, [*KEYS, "botid"], "innvandringskategori", "antall", cats, fill=0)
    per_botid = per_botid.withColumn("_total", row_sum_skip(list(cats.values())))
    wide = pivot.pivot_sum(per_botid, KEYS, "botid", "_total", {KORT: "short", LANG: "long", OVRIGE: "two_parents"},
                           fill=None)
    total = pop_long.groupBy(K.date, K.district_id, K.sub_id).agg(F.sum("antall").alias("total"))
    j = wide.join(total, [K.date, K.sub_id, K.district_id])
    r = rollup.aggregate(j, {"two_parents": "sum", "short": "sum", "long": "sum", "total": "sum"}, K)
    r = r.withColumn("total_cat", F.col("two_parents") + F.col("short") + F.col("long"))
    return rollup.add_ratios(r, ["two_parents", "short", "long", "total_cat"], ["total"])


_H12 = "Innvandring befolkning"
_S12 = [S("Innvandrer", "kort botid (<=5 år)"), S("Innvandrer", "lang botid (>5 år)"),
        S("Norskfødt", "med innvandrerforeldre")]
_IB = {"alle_status": Variant(TemplateA(), ["short", "long", "two_parents"], _H12, _S12, None),
       "alle_historisk": Variant(TemplateC(), ["short", "long", "two_parents", "total_cat"], _H12,
                                 _S12 + [S("Totalt")], None)}
for _n, _c, _h in [("kort", "short", "Innvandrer med kort botid (<=5 år)"),
                   ("lang", "long", "Innvandrer med lang botid (>5 år)"),
                   ("to_foreldre", "two_parents", "Norskfødt med innvandrerforeldre")]:
    _IB[f"{_n}_status"] = Variant(TemplateA(), [_c], _h, [], None, scale=_c)
    _IB[f"{_n}_historisk"] = Variant(TemplateB(), [_c], _h, [], None)

INNVANDRER_BEFOLKNING = DatasetSpec(
    "innvandrer_befolkning", ["botid", BEF], {"botid": N.botid, BEF: _befolkning_r7}, _innvandrer, _IB, rows_key=_is_status)


# --- D14 municipal housing ---------------------------------------------------------------------------------

def housing_total(long: DataFrame) -> DataFrame:
    """All dwellings per (year, district): the five dwelling types summed."""
    w = pivot.pivot_sum(long, [K.date, K.district_id, K.district_name], "boligtype", "antall", BOLIGTYPER, fill=0)
    return w.select(K.date, K.district_id, K.district_name,
                    sum((F.col(c) for c in BOLIGTYPER.values()), F.lit(0)).alias("total"))


def _kommunale(inputs, variant):
    municipal, housing = _aligned(variant, inputs["kommunale-boliger"],
                                  housing_total(inputs["boligmengde-etter-boligtype"]))
    df = joins.natural_join(municipal, housing, how="inner")
    r = rollup.aggregate(df, {"antall_boliger": "sum", "total": "sum"}, K)
    return rollup.add_ratios(r, ["antall_boliger"], ["total"])


_H14 = "Kommunale boliger av boligmassen i alt"
KOMMUNALE_BOLIGER = DatasetSpec(
    "kommunale_boliger", ["kommunale-boliger", "boligmengde-etter-boligtype"],
    {"kommunale-boliger": N.kommunale_boliger, "boligmengde-etter-boligtype": N.boligmengde}, _kommunale, rows_key=_is_status,
    variants={"status": Variant(TemplateA(), ["antall_boliger"], _H14, [], None, scale="antall_boliger"),
     "historisk": Variant(TemplateB(), ["antall_boliger"], _H14, [], None, scale="antall_boliger")})


# --- D15 largest immigrant groups ------------------------------------------------------------------------------

def _landbakgrunn(inputs, variant):
    cats = {"Innvandrer": "innvandrer", "Norskfødt med innvandrerforeldre": "norskfodt_med_innvandrerforeldre"}
    country = pivot.pivot_sum(inputs["landbakgrunn-storste-innvandringsgrupper"],
                              [K.date, K.district_id, K.district_name, "landbakgrunn"], "kategori", "antall", cats,
                              fill=0)
    country = country.withColumn("total", row_sum_skip(list(cats.values())))
    country = rollup.add_city_total(country, "landbakgrunn", K)
    pop = rollup.district_only(_population(inputs[BEF]), {"population": "sum"}, K, ignore_districts=["16", "17"])
    df = country.join(pop.select(K.district_id, K.date, K.district_name, "population"),
                      [K.district_id, K.date, K.district_name])
    df = rollup.add_ratios(df, ["total", "innvandrer", "norskfodt_med_innvandrerforeldre"], ["population"])
    return df.withColumns({K.sub_id: F.lit(None).cast("string"), K.sub_name: F.lit(None).cast("string")})


_H15 = "10 største innvandringsgrupper"
_TOP = {"category": "landbakgrunn", "n": 10, "rank_by": "total"}
LANDBAKGRUNN = DatasetSpec(
    "landbakgrunn_innvandringsgrupper", ["landbakgrunn-storste-innvandringsgrupper", BEF],
    {"landbakgrunn-storste-innvandringsgrupper": N.landbakgrunn, BEF: N.befolkning}, _landbakgrunn,
    {"status": Variant(TemplateA(), ["innvandrer", "norskfodt_med_innvandrerforeldre"], _H15,
                       [S("Innvandrer"), S("Norskfødt med innvandrerforeldre")], STATUS, top_n=_TOP),
     "historisk": Variant(TemplateA(), ["total", "innvandrer", "norskfodt_med_innvandrerforeldre"], _H15,
                          [S("Totalt"), S("Innvandrer"), S("Norskfødt med innvandrerforeldre")], HISTORIC,
                          top_n=_TOP)})


# --- D17 non-employed aged 30-59 ---------------------------------------------------------------------------------

def ikke_sysselsatte(employed: DataFrame, pop_long: DataFrame, employed_shift: int, population_shift: int):
    """Population 30-59 minus employed, per geography, rolled up, with its ratio."""
    pop = _population(pop_long, 30, 59).withColumn(K.date, F.col(K.date) + population_shift)
    emp = employed.withColumn(K.date, F.col(K.date) + employed_shift)
    emp = joins.semi_join_present(emp, pop, K.sub_id)
    j = emp.join(pop.select(K.date, K.sub_id, "population"), [K.date, K.sub_id])
    j = filters.drop_districts(j, NON_RESIDENTIAL, K)
    j = j.withColumn("antall_ikke_sysselsatte", F.col("population") - F.col("antall_sysselsatte"))
    r = rollup.aggregate(j, {"population": "sum", "antall_ikke_sysselsatte": "sum"}, K)
    return rollup.add_ratios(r, ["antall_ikke_sysselsatte"], ["population"])


def _ikke_sysselsatte(inputs, variant):
    return ikke_sysselsatte(inputs["sysselsatte"], inputs[BEF], 0, -1)


_H17 = "Antall ikke-sysselsatte personer mellom 30-59 år"
IKKE_SYSSELSATTE = DatasetSpec(
    "levekar_ikke_sysselsatte", ["sysselsatte", BEF], {"sysselsatte": N.sysselsatte, BEF: _befolkning_r7},
    _ikke_sysselsatte,
    {"status": Variant(TemplateA(), ["antall_ikke_sysselsatte"], _H17, [S("Ikke sysselsatte")], STATUS,
                       scale="antall_ikke_sysselsatte"),
     "historisk": Variant(TemplateB(), ["antall_ikke_sysselsatte"], _H17, [S("Ikke sysselsatte")], HISTORIC)})


# --- D20 living conditions composite -------------------------------------------------------------------------------

TOTALT_VALUES = ["ikke_vestlig_kort", "lav_utdanning", "antall_fattige_barnehusholdninger", "antall_ikke_sysselsatte",
                 "neets", "antall_trangbodde"]


def _totalt(inputs, variant):
    pop_long = inputs[BEF]
    # short-stay non-western immigrants
    botid = inputs["botid-ikke-vestlige"]
    botid = botid.filter(F.col("landbakgrunn") == IKKE_VESTLIG)  # before the pivot: no rows, no zeros
    iv = _with_population(ikke_vestlig_kort(botid), pop_long, "ikke_vestlig_kort")
    # low education: both sums skip missing levels here
    edu = education_levels(inputs["lav-utdanning"])
    edu = edu.select(*KEYS, row_sum_skip(EDUCATION).alias("total"),
                     row_sum_skip(["ingen_utdanning_uoppgitt", "grunnskole"]).alias("lav_utdanning"))
    edu = rollup.add_ratios(rollup.aggregate(edu, {"lav_utdanning": "sum", "total": "sum"}, K),
                            ["lav_utdanning"], ["total"])
    # low-income households: the source has every level
    poor = inputs["fattige-husholdninger"].withColumn(
        "antall_fattige_barnehusholdninger_ratio", F.col(f"{N.FATTIGE_VALUE}_andel") / 100)
    # non-employed: employment counted one year later
    emp = ikke_sysselsatte(inputs["sysselsatte"], pop_long, 1, 0)
    neets = inputs["neets"].withColumnRenamed("andel", "neets_ratio")
    # overcrowding: share of the rolled-up population
    pop = rollup.aggregate(_population(pop_long), {"population": "sum"}, K).select(
        K.date, K.district_id, K.sub_id, "population")
    crowd = _sub_keys_join(inputs["trangbodde"], pop)
    crowd = crowd.withColumn("antall_trangbodde_ratio", F.col("andel_som_bor_trangt") / 100)
    parts = [(iv, "ikke_vestlig_kort_ratio"), (edu, "lav_utdanning_ratio"),
             (poor, "antall_fattige_barnehusholdninger_ratio"), (emp, "antall_ikke_sysselsatte_ratio"),
             (neets, "neets_ratio"), (crowd, "antall_trangbodde_ratio")]
    # each indicator is small once computed; the relative ratio reads it three times
    newest = [align.keep_newest(relative.add_relative_ratio(materialize(df), col, K)) for df, col in parts]
    merged = joins.natural_join(*newest, how="inner")
    return merged.withColumn(K.date, F.lit(None).cast("int"))


_S20 = [S("Innvandrere fra Afrika, Asia mv. med kort botid"), S("Lav utdanning"),
        S("Lavinntektshusholdninger med barn"), S("Ikke sysselsatte"), S("NEETs"), S("Trangbodde")]
LEVEKAR_TOTALT = DatasetSpec(
    "levekar_totalt", ["botid-ikke-vestlige", "lav-utdanning", "fattige-husholdninger", "sysselsatte", BEF, "neets",
                       "trangbodde"],
    {"botid-ikke-vestlige": N.botid_ikke_vestlige, "lav-utdanning": N.lav_utdanning,
     "fattige-husholdninger": N.fattige_husholdninger, "sysselsatte": N.sysselsatte, BEF: N.befolkning,
     "neets": N.neets, "trangbodde": lambda raw, geo: N.trangbodde(raw, geo, require_district=False)},
    _totalt, {"status": Variant(TemplateK(), TOTALT_VALUES, "", _S20, None)}, intermediate=False)

SPECS = [ALDER_DISTRIBUSJON, FOLKEMENGDE, BEFOLKNINGSUTVKL, FLYTTEHYPPIGHET, BOTID_IKKE_VESTLIGE,
         INNVANDRER_BEFOLKNING, KOMMUNALE_BOLIGER, LANDBAKGRUNN, IKKE_SYSSELSATTE, LEVEKAR_TOTALT]
