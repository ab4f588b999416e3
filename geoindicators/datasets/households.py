"""Single-source datasets that pivot categories, roll up and divide by a total:
households with children, household types, immigrant children, rooms per
person, low education.  Labels, headings and series are published texts
(fixed values)."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators.datasets.simple import KEYS, S, _only
from geoindicators.datasets.spec import HISTORIC, STATUS, DatasetSpec, Variant
from geoindicators.functions.nulls import row_sum_propagate, row_sum_skip
from geoindicators.keys import OSLO_KEYS as K
from geoindicators.operators import pivot, rollup
from geoindicators.publish.templates import TemplateA, TemplateB, TemplateC, TemplateJ
from geoindicators.sources import normalise as N

# --- D10 households with children -----------------------------------------------------------

# fixed values: category labels -> columns
BARN = {"1 barn i HH": "ett_barn_i_hh", "2 barn i HH": "to_barn_i_hh", "3 barn i HH": "tre_barn_i_hh",
        "4 barn eller mer": "fire_barn_eller_mer", "Ingen barn i HH": "ingen_barn_i_hh"}
BARN_POINTS = ["one_child", "two_child", "three_or_more", "no_children", "total"]


def _husholdning_med_barn(inputs, variant):
    w = pivot.pivot_sum(_only(inputs), KEYS, "barn", "antall", BARN, fill=0)
    w = w.select(*KEYS, F.col("ett_barn_i_hh").alias("one_child"), F.col("to_barn_i_hh").alias("two_child"),
                 (F.col("tre_barn_i_hh") + F.col("fire_barn_eller_mer")).alias("three_or_more"),
                 F.col("ingen_barn_i_hh").alias("no_children"))
    w = w.withColumn("total", row_sum_propagate(["one_child", "two_child", "three_or_more", "no_children"]))
    return rollup.add_ratios(rollup.aggregate(w, "sum", K), BARN_POINTS, ["total"])


_HB = [S("Husholdninger", "med 1 barn"), S("Husholdninger", "med 2 barn"), S("Husholdninger", "med 3 barn eller flere")]
_HMB = {
    "alle_status": Variant(TemplateA(), ["one_child", "two_child", "three_or_more"], "Husholdninger med barn", _HB),
    "alle_historisk": Variant(TemplateC(), ["one_child", "two_child", "three_or_more", "total"],
                              "Husholdninger med barn", _HB + [S("Totalt")], HISTORIC),
}
for _n, _c in [("1", "one_child"), ("2", "two_child"), ("3", "three_or_more")]:
    _HMB[f"{_n}barn_status"] = Variant(TemplateA(), [_c], f"Husholdninger med {_n} barn", [], STATUS, scale=_c)
    _HMB[f"{_n}barn_historisk"] = Variant(TemplateB(), [_c], f"Husholdninger med {_n} barn", [], HISTORIC)

HUSHOLDNING_MED_BARN = DatasetSpec("husholdning_med_barn", ["husholdninger-med-barn"],
                                   {"husholdninger-med-barn": N.husholdninger_med_barn}, _husholdning_med_barn, _HMB)


# --- D11 household types --------------------------------------------------------------------------

TYPER = {
    "Aleneboende": "aleneboende",
    "Par uten hjemmeboende barn": "par_uten_hjemmeboende_barn",
    "Par med små barn": "par_med_smaa_barn",
    "Par med store barn": "par_med_store_barn",
    "Mor/far med små barn": "mor_eller_far_med_smaa_barn",
    "Mor/far med store barn": "mor_eller_far_med_store_barn",
    "Enfamiliehusholdninger med voksne barn": "enfamiliehusholdninger_med_voksne_barn",
    "Flerfamiliehusholdninger med små barn": "flerfamiliehusholdninger_med_smaa_barn",
    "Flerfamiliehusholdninger med store barn": "flerfamiliehusholdninger_med_store_barn",
    "Flerfamiliehusholdninger uten barn 0-17 år": "flerfamiliehusholdninger_uten_barn_0_til_17_aar",
}
TYPER_STATUS = ["aleneboende", "par_uten_barn", "par_med_barn", "mor_far_med_barn", "flerfamiliehusholdninger"]


def _husholdningstyper(inputs, variant):
    w = pivot.pivot_sum(_only(inputs), KEYS, "husholdningstype", "antall", TYPER, fill=0)
    w = w.select(
        *KEYS, "aleneboende", F.col("par_uten_hjemmeboende_barn").alias("par_uten_barn"),
        (F.col("par_med_smaa_barn") + F.col("par_med_store_barn")).alias("par_med_barn"),
        (F.col("mor_eller_far_med_smaa_barn") + F.col("mor_eller_far_med_store_barn")).alias("mor_far_med_barn"),
        row_sum_propagate(["enfamiliehusholdninger_med_voksne_barn", "flerfamiliehusholdninger_med_smaa_barn",
                           "flerfamiliehusholdninger_med_store_barn",
                           "flerfamiliehusholdninger_uten_barn_0_til_17_aar"]).alias("flerfamiliehusholdninger"))
    w = w.withColumn("total", row_sum_propagate(["par_uten_barn", "par_med_barn", "mor_far_med_barn",
                                                 "flerfamiliehusholdninger", "aleneboende"]))
    w = rollup.presum(w, K)
    return rollup.add_ratios(rollup.aggregate(w, "sum", K), [*TYPER_STATUS, "total"], ["total"])


_TS = [S("Énpersonshusholdninger"), S("Par uten barn"), S("Par med barn"), S("Mor eller far", "med barn"),
       S("Flerfamiliehusholdninger")]
HUSHOLDNINGSTYPER = DatasetSpec(
    "husholdningstyper", ["husholdningstyper"], {"husholdningstyper": N.husholdningstyper}, _husholdningstyper,
    {"status": Variant(TemplateA(), TYPER_STATUS, "Husholdninger etter husholdningstype", _TS, STATUS,
                       scale="aleneboende"),
     "historisk": Variant(TemplateC(), [*TYPER_STATUS, "total"], "Husholdninger etter husholdningstype",
                          _TS + [S("Totalt")], HISTORIC, scale="aleneboende")})


# --- D13 immigrant children (0-15) ------------------------------------------------------------------

KATEGORIER = {
    "Uten innvandringsbakgrunn": "uten_innvandringsbakgrunn",
    "Innvandrer": "innvandrer",
    "Norskfødt med innvandrerforeldre": "norskfodt_med_innvandrerforeldre",
    "Utenlandsfødt m/en norsk forelder": "utenlandsfodt_med_en_norsk_forelder",
    "Norskfødt med en utenlandskfødt forelder": "norskfodt_med_en_utenlandskfodt_forelder",
    "Født i utlandet av norskfødte foreldre": "fodt_i_utlandet_av_norskfodte_foreldre",
}
U16_POINTS = ["to_foreldre", "en_forelder", "innvandrer"]


def _innvandring_under16(inputs, variant):
    w = pivot.pivot_sum(_only(inputs), [*KEYS, "alder"], "innvandringskategori", "antall", KATEGORIER, fill=0)
    w = w.filter(F.col("alder") == "0-15 år")
    w = w.withColumns({
        "en_forelder": F.col("norskfodt_med_en_utenlandskfodt_forelder") + F.col("utenlandsfodt_med_en_norsk_forelder"),
        "to_foreldre": F.col("norskfodt_med_innvandrerforeldre")})
    w = w.withColumn("total", row_sum_propagate(["fodt_i_utlandet_av_norskfodte_foreldre", "innvandrer",
                                                 "uten_innvandringsbakgrunn", "to_foreldre", "en_forelder"]))
    w = w.select(*KEYS, "to_foreldre", "en_forelder", "innvandrer", "total")
    return rollup.add_ratios(rollup.aggregate(w, "sum", K), U16_POINTS, ["total"])


_U16 = {}
for _n, _c, _hs, _hh in [("en-innvandrer", "en_forelder", "Personer (under 16) med én innvandrerforelder",
                          "Personer (under 16) med én innvandrerforelder"),
                         ("to-innvandrer", "to_foreldre", "Personer (under 16) med to innvandrerforeldre",
                          "Personer (under 16) med to innvandrerforeldre"),
                         ("innvandrer", "innvandrer", "Innvandrere (under 16)", "Andel innvandrere (under 16)")]:
    _U16[f"{_n}_status"] = Variant(TemplateA(), [_c], _hs, [], STATUS, scale=_c)
    _U16[f"{_n}_historisk"] = Variant(TemplateB(), [_c], _hh, [], HISTORIC)

INNVANDRING_UNDER16 = DatasetSpec("innvandring_under16", ["innvandrer-befolkningen-0-15-ar"],
                                  {"innvandrer-befolkningen-0-15-ar": N.innvandrer_0_15}, _innvandring_under16, _U16)


# --- D24 rooms per person ------------------------------------------------------------------------------

ROM_POINTS = ["rom_per_person_under_0_5", "rom_per_person_0_5_til_0_9", "rom_per_person_1_0_til_1_9",
              "rom_per_person_2_0_og_over"]


def _trangboddhet(inputs, variant):
    df = _only(inputs).select(*KEYS, *ROM_POINTS, "rom_per_person_i_alt")
    r = rollup.aggregate(df, "sum", K, exclude_city=True)
    return rollup.add_ratios(r, ROM_POINTS, ROM_POINTS)


_ROM_SERIES = [S("Under 0,5 rom per person"), S("0,5–0,9 rom per person"), S("1,0–1,9 rom per person"),
               S("2 rom eller flere per person")]
_TB = {
    "alle_status": Variant(TemplateJ(), ROM_POINTS, "Husstander fordelt på personer per rom", _ROM_SERIES),
    "alle_historisk": Variant(TemplateC(), ROM_POINTS, "", _ROM_SERIES, HISTORIC),
}
for _n, _c, _hs, _hh, _ht in [
        ("0-5-0-9", "rom_per_person_0_5_til_0_9", "0,5–0,9 rom per person", "0,5–0,9 rom per person", TemplateB),
        ("1-0-1-9", "rom_per_person_1_0_til_1_9", "1,0–1,9 rom per person", "Personer per rom - 1,5 - 1,9",
         TemplateB),
        ("over-2", "rom_per_person_2_0_og_over", "2 rom eller flere per person", "2 rom eller flere per person",
         TemplateB),
        ("under-0-5", "rom_per_person_under_0_5", "Under 0,5 rom per preson", "Personer per rom - under 0.5",
         TemplateA)]:
    _TB[f"{_n}_status"] = Variant(TemplateA(), [_c], _hs, [], STATUS, scale=_c)
    _TB[f"{_n}_historisk"] = Variant(_ht(), [_c], _hh, [], HISTORIC)

TRANGBODDHET = DatasetSpec("trangboddhet", ["husholdninger-etter-rom-per-person"],
                           {"husholdninger-etter-rom-per-person": N.rom_per_person}, _trangboddhet, _TB)


# --- D18 low education ----------------------------------------------------------------------------------

LAV_UTDANNING = {"Ingen utdanning/Uoppgitt utdanning": "ingen_utdanning_uoppgitt", "Grunnskole": "grunnskole",
                 "Videregående skolenivå": "videregaende",
                 "Universitets- og høgskolenivå, kort": "universitet_hogskole_kort",
                 "Universitets- og høgskolenivå, lang": "universitet_hogskole_lang"}
EDUCATION = list(LAV_UTDANNING.values())


def education_levels(df):
    """Pivot education levels (absent cells NULL; a level absent everywhere is 0)."""
    return pivot.pivot_sum(df, KEYS, "utdanning", "antall", LAV_UTDANNING, fill=None, zero_absent_columns=True)


def _lav_utdanning(inputs, variant):
    w = education_levels(_only(inputs))
    w = w.select(*KEYS, row_sum_skip(EDUCATION).alias("total"),
                 (F.col("ingen_utdanning_uoppgitt") + F.col("grunnskole")).alias("lav_utdanning"))
    r = rollup.aggregate(w, {"lav_utdanning": "sum", "total": "sum"}, K)
    return rollup.add_ratios(r, ["lav_utdanning"], ["total"])


_LU = "Personer mellom 30-59 år med lav utdanning"
LEVEKAR_LAV_UTDANNING = DatasetSpec(
    "levekar_lav_utdanning", ["lav-utdanning"], {"lav-utdanning": N.lav_utdanning}, _lav_utdanning,
    {"status": Variant(TemplateA(), ["lav_utdanning"], _LU, [S("Kun grunnskole eller ingen utdanning oppgitt")],
                       STATUS, scale="lav_utdanning"),
     "historisk": Variant(TemplateB(), ["lav_utdanning"], _LU, [S("Kun grunnskole eller ingen utdanning oppgitt")],
                          HISTORIC)})

SPECS = [HUSHOLDNING_MED_BARN, HUSHOLDNINGSTYPER, INNVANDRING_UNDER16, TRANGBODDHET, LEVEKAR_LAV_UTDANNING]
