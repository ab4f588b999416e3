"""Source normalisers: raw landing snapshot -> canonical indicator rows.

One function per landing table.  Each renames the year column to ``date``,
resolves the geography with the rule the source needs (``geo.resolve``; all
lookups are broadcast joins), applies the source's row filter and projects to
``date, delbydel_id, delbydel_navn, bydel_id, bydel_navn`` plus measures.
Headers are the sources' own (fixed values).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoindicators.functions.nulls import clean_number
from geoindicators.geo import resolve as R
from geoindicators.geo.dim import Geography
from geoindicators.keys import OSLO_KEYS as K

KEYS = [K.date, K.sub_id, K.sub_name, K.district_id, K.district_name]


def _year(df: DataFrame, col: str = "År") -> DataFrame:
    return df.withColumn(K.date, F.col(f"`{col}`").cast("int"))


# fixed values: output columns that hold labels; all other columns are measures
LABELS = frozenset(["boligtype", "botid", "innvandringskategori", "landbakgrunn", "barn", "husholdningstype", "alder",
                    "utdanning", "enhetstype", "nivaa", "kjonn", "kategori"])


def _measure(df: DataFrame, src: str, dst: str) -> Column:
    """A column under its output name; a measure read as text becomes a number (counts whole, blanks NULL)."""
    c = F.col(f"`{src}`")
    if dst in LABELS or df.schema[src].dataType.simpleString() != "string":
        return c.alias(dst)
    number = F.regexp_replace(c, r"[\s\u00a0]", "").try_cast("double")
    return (number.cast("long") if dst.startswith("antall") else number).alias(dst)


def _out(df: DataFrame, measures: dict[str, str]) -> DataFrame:
    return df.select(*KEYS, *[_measure(df, src, dst) for src, dst in measures.items()])


def _resolved_district(df: DataFrame) -> DataFrame:
    return df.filter(F.col(K.district_id).isNotNull())


# --- N1 population by gender and age (long) --------------------------------------------------

def befolkning(raw: DataFrame, geo: Geography, district_from_code: bool = False) -> DataFrame:
    """``År, Bydel (301XX), Delbydel, Kjønn, Alder, Antall personer`` -> long rows
    (kjonn, alder, antall).  R6 by default, R7 with ``district_from_code``.
    Rows whose sub-district does not resolve are dropped (the age pivot does so)."""
    df = R.resolve_code_and_sub_id(_year(raw), "Bydel", "Delbydel", geo, K, id_from_code=district_from_code)
    df = df.filter(F.col(K.sub_id).isNotNull())
    return df.select(*KEYS, F.col("`Kjønn`").cast("int").alias("kjonn"), F.col("Alder").cast("int").alias("alder"),
                     F.col("`Antall personer`").cast("long").alias("antall"))


# --- N2 dwellings by type ---------------------------------------------------------------------

def boligmengde(raw: DataFrame, geo: Geography) -> DataFrame:
    """``År, Geografi, Boligtype, Antall boliger`` (R4), long."""
    df = R.resolve_one_column(_year(raw), "Geografi", geo, K)
    return _out(df, {"Boligtype": "boligtype", "Antall boliger": "antall"})


# --- N3 flat prices ------------------------------------------------------------------------------

def boligpriser(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_sub_id_with_fallback(_year(raw), "Delbydelnummer", "Oslo-Bydelsnavn", geo, K)
    return _out(df, {"antall omsatte blokkleieligheter": "antall_omsatte_blokkleiligheter", "kvmpris": "kvmpris"})


# --- N4 / N5 length of residence -----------------------------------------------------------------

def botid(raw: DataFrame, geo: Geography) -> DataFrame:
    """``År, Bydel, Delbydel, Botid, Innvandringskategori, antall`` (R2), long; sub not null."""
    df = R.resolve_sub_name_with_fallback(_year(raw), "Delbydel", "Bydel", geo, K)
    df = df.filter(F.col(K.sub_id).isNotNull())
    return _out(df, {"Botid": "botid", "Innvandringskategori": "innvandringskategori", "antall": "antall"})


def botid_ikke_vestlige(raw: DataFrame, geo: Geography) -> DataFrame:
    """``År, Bydel, Delbydel, Botid, Landbakgrunn, antall`` (R2), long."""
    df = R.resolve_sub_name_with_fallback(_year(raw), "Delbydel", "Bydel", geo, K)
    return _out(df, {"Botid": "botid", "Landbakgrunn": "landbakgrunn", "antall": "antall"})


# --- N6 / N7 deaths and births ----------------------------------------------------------------------

def _names_parent(raw: DataFrame, geo: Geography, measure: str, out: str) -> DataFrame:
    df = R.resolve_names_parent_id(_year(raw), "Bydel", "Delbydel", geo, K)
    return _resolved_district(_out(df, {measure: out}))


def dode(raw: DataFrame, geo: Geography) -> DataFrame:
    """``År, Bydel, Delbydel, Antall døde``."""
    return _names_parent(raw, geo, "Antall døde", "antall_dode")


def fodte(raw: DataFrame, geo: Geography) -> DataFrame:
    """``År, Bydel, Delbydel, Antall fødte``."""
    return _names_parent(raw, geo, "Antall fødte", "antall_fodte")


# --- N8 death rates ---------------------------------------------------------------------------

def dodsrater(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_sub_name_district_column(_year(raw), "Delbydel", "Bydel", geo, K)
    return _resolved_district(_out(df, {"Dødelighet": "dodsrate"}))


# --- N9 tenure ------------------------------------------------------------------------------------

EIEFORM_COLUMNS = {"Selveier alle": "selveier_alle", "Borettslag-andel alle": "borettslag_andel_alle",
                   "Leier alle": "leier_alle", "Selveier uten studenter": "selveier_uten_studenter",
                   "Borettslag-andel uten studenter": "borettslag_andel_uten_studenter",
                   "Leier uten studenter": "leier_uten_studenter"}


def eieform(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_mixed(_year(raw), "Delbydel", geo, K, city_code=10000)
    return _out(df, EIEFORM_COLUMNS)


# --- N10 low-income households ---------------------------------------------------------------------

FATTIGE_VALUE = "husholdninger_med_barn_under_18_aar_eu_skala"
FATTIGE_COLUMNS = {
    "Husholdninger i alt": "husholdninger_i_alt",
    "Husholdninger med barn <18 år i alt": "husholdninger_med_barn_under_18_aar_i_alt",
    "Husholdninger EU-skala - andel": "husholdninger_i_alt_eu_skala_andel",
    "Husholdninger med barn <18 år EU-skala -andel": f"{FATTIGE_VALUE}_andel",
    "Husholdninger etter EU-skala - antall": "husholdninger_i_alt_eu_skala_antall",
    "Husholdninger med barn <18 år etter EU-skala - antall": f"{FATTIGE_VALUE}_antall",
}


def fattige_husholdninger(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_labelled(_year(raw), "Geografi", geo, K)
    return _out(df, FATTIGE_COLUMNS)


# --- N11 / N12 moves by age ---------------------------------------------------------------------------

def _flytting(raw: DataFrame, geo: Geography, district_col: str, labels: dict) -> DataFrame:
    from geoindicators.operators.pivot import pivot_sum
    df = R.district_by_name(_year(raw, "aargang"), district_col, geo, K)
    df = df.withColumns({AGE_GROUP: F.col("aldgr5"), "antall": _measure(df, "antall", "antall")})
    return pivot_sum(_resolved_district(df), [K.date, K.district_id, K.district_name, AGE_GROUP],
                     "til_fra_bydel", "antall", labels, fill=0)


AGE_GROUP = "aldersgruppe_5_aar"
# fixed values: move kinds -> measures (emigration / immigration)
FLYTT_UT = {"Flytting inn/ut av Oslo": "utflytting_fra_oslo", "Flytting innenfor bydelen": "utflytting_innenfor_bydelen",
            "Flytting mellom bydeler": "utflytting_mellom_bydeler"}
FLYTT_INN = {"Flytting inn/ut av Oslo": "innflytting_til_oslo",
             "Flytting innenfor bydelen": "innflytting_innenfor_bydelen",
             "Flytting mellom bydeler": "innflytting_mellom_bydeler"}


def flytting_fra(raw: DataFrame, geo: Geography) -> DataFrame:
    """``aargang, til_fra_bydel, fra_bydel, aldgr5, antall`` (R10) -> emigration by kind (pivoted)."""
    return _flytting(raw, geo, "fra_bydel", FLYTT_UT)


def flytting_til(raw: DataFrame, geo: Geography) -> DataFrame:
    """``aargang, til_fra_bydel, til_bydel, aldgr5, antall`` (R10) -> immigration by kind (pivoted)."""
    return _flytting(raw, geo, "til_bydel", FLYTT_INN)


# --- N13 rooms per person ------------------------------------------------------------------------------

ROM_COLUMNS = {
    "Rom per person - Under 0,5": "rom_per_person_under_0_5",
    "Rom per person - 0,5 - 0,9": "rom_per_person_0_5_til_0_9",
    "Rom per person - 1,0 - 1,9": "rom_per_person_1_0_til_1_9",
    "Rom per person - 2,0 og over": "rom_per_person_2_0_og_over",
    "Rom per person - I alt": "rom_per_person_i_alt",
}


def rom_per_person(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_single_code(_year(raw), "Geografi", geo, K, city_code=10000, district_codes=False)
    return _resolved_district(_out(df, ROM_COLUMNS))


# --- N14 / N15 / N16 households and children ---------------------------------------------------------

def _named_long(raw: DataFrame, geo: Geography, columns: dict) -> DataFrame:
    df = R.resolve_sub_name_with_fallback(_year(raw), "Delbydel", "Bydel", geo, K)
    return _out(df, columns)


def husholdninger_med_barn(raw: DataFrame, geo: Geography) -> DataFrame:
    return _named_long(raw, geo, {"Barn i husholdningen": "barn", "Antall": "antall"})


def husholdningstyper(raw: DataFrame, geo: Geography) -> DataFrame:
    return _named_long(raw, geo, {"Husholdningstype": "husholdningstype", "Antall": "antall"})


def innvandrer_0_15(raw: DataFrame, geo: Geography) -> DataFrame:
    return _named_long(raw, geo, {"Alder": "alder", "Innvandringskategori": "innvandringskategori",
                                  "Antall personer": "antall"})


# --- N17 municipal housing ---------------------------------------------------------------------------

def kommunale_boliger(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_sub_id_with_fallback(_year(raw, "år"), "Delbydelsnr", "Bydel", geo, K)
    return _out(df, {"Antall boliger": "antall_boliger"})


# --- N18 countries of origin -------------------------------------------------------------------------

def landbakgrunn(raw: DataFrame, geo: Geography) -> DataFrame:
    """``År, Bydel, Innvandringskategori, Landbakgrunn, Antall personer`` (R10), long."""
    df = _resolved_district(R.district_by_name(_year(raw), "Bydel", geo, K))
    return df.select(K.date, K.district_id, K.district_name, F.col("Innvandringskategori").alias("kategori"),
                     F.col("Landbakgrunn").alias("landbakgrunn"), _measure(df, "Antall personer", "antall"))


# --- N19 education (low) -------------------------------------------------------------------------------

def lav_utdanning(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_sub_name_district_column(_year(raw), "Delbydel", "Bydel", geo, K)
    return _out(df, {"Høyeste fullførte utdanning": "utdanning", "Antall personer": "antall"})


# --- N20 median price ------------------------------------------------------------------------------------

def median_totalpris(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_sub_id_with_fallback(_year(raw), "Delbydel ID", "Bydel", geo, K, default_city=True)
    return _out(df, {"Enhetstype": "enhetstype", "Median total pris": "totalpris"})


# --- N21 NEETs ---------------------------------------------------------------------------------------------

def neets(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_single_code(_year(raw, "aar"), "Geografi_num", geo, K, city_code=100000)
    return _resolved_district(_out(df, {"Andel NEETs (15-29 år)": "andel", "Antall NEETs": "antall"}))


# --- N22 reduced functional ability ----------------------------------------------------------------------

def redusert_funksjonsevne(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_labelled(_year(raw), "Geografi", geo, K, sub_keeps_district=False)
    df = df.filter(F.col(K.district_id).isNotNull() | F.col(K.sub_id).isNotNull())
    return _out(df, {"Antall personer med redusert funksjonsevne": "antall_personer_med_redusert_funksjonsevne",
                     "Andel personer med redusert funksjonsevne": "andel_personer_med_redusert_funksjonsevne"})


# --- N23 employed ------------------------------------------------------------------------------------------

def sysselsatte(raw: DataFrame, geo: Geography) -> DataFrame:
    """``År, Bydel, Delbydel, Antall sysselsatte`` (R2); text counts with blanks -> numbers."""
    df = R.resolve_sub_name_with_fallback(_year(raw), "Delbydel", "Bydel", geo, K)
    return df.select(*KEYS, clean_number(F.col("`Antall sysselsatte`")).alias("antall_sysselsatte"))


# --- N24 overcrowding ----------------------------------------------------------------------------------------

def trangbodde(raw: DataFrame, geo: Geography, require_district: bool = True) -> DataFrame:
    df = R.resolve_sub_name_with_fallback(_year(raw), "Delbydel", "Bydel", geo, K)
    df = _out(df, {"Andel som bor trangt": "andel_som_bor_trangt", "Antall som bor trangt": "antall_som_bor_trangt",
                   "Antall husholdninger": "antall_husholdninger"})
    return _resolved_district(df) if require_district else df


# --- N25 education ---------------------------------------------------------------------------------------------

def utdanning(raw: DataFrame, geo: Geography) -> DataFrame:
    df = R.resolve_sub_id_with_fallback(_year(raw, "aargang"), "delbydel2017_01", "bydel2_fmt", geo, K)
    return _out(df, {"bu1_gr5_imp_fmt": "nivaa", "kjoenn_fmt": "kjonn", "aldgr06a__fmt": "alder",
                     "antall": "antall"})


NORMALISERS = {
    "befolkning-etter-kjonn-og-alder": befolkning,
    "boligmengde-etter-boligtype": boligmengde,
    "boligpriser-blokkleiligheter": boligpriser,
    "botid": botid,
    "botid-ikke-vestlige": botid_ikke_vestlige,
    "dode": dode,
    "fodte": fodte,
    "dodsrater": dodsrater,
    "eieform": eieform,
    "fattige-husholdninger": fattige_husholdninger,
    "flytting-fra-etter-alder": flytting_fra,
    "flytting-til-etter-alder": flytting_til,
    "husholdninger-etter-rom-per-person": rom_per_person,
    "husholdninger-med-barn": husholdninger_med_barn,
    "husholdningstyper": husholdningstyper,
    "innvandrer-befolkningen-0-15-ar": innvandrer_0_15,
    "kommunale-boliger": kommunale_boliger,
    "landbakgrunn-storste-innvandringsgrupper": landbakgrunn,
    "lav-utdanning": lav_utdanning,
    "median-totalpris": median_totalpris,
    "neets": neets,
    "redusert-funksjonsevne": redusert_funksjonsevne,
    "sysselsatte": sysselsatte,
    "trangbodde": trangbodde,
    "utdanning": utdanning,
}
