"""Datasets without a roll-up (the source already has every level) and the
single-source roll-up datasets.  Headings and series are the published chart
texts (fixed values)."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoindicators.datasets.spec import HISTORIC, STATUS, DatasetSpec, Variant
from geoindicators.functions.nulls import row_sum_propagate
from geoindicators.keys import OSLO_KEYS as K
from geoindicators.operators import filters, pivot, rollup
from geoindicators.publish.templates import TemplateA, TemplateB, TemplateC
from geoindicators.sources import normalise as N

KEYS = K.all()


def S(heading: str, sub: str = "") -> dict:
    return {"heading": heading, "subheading": sub}


def _status_hist(values, heading, series=(), hist_template=None, scale=None, scale_after=True, drop_null=None,
                 hist_values=None, hist_series=None, hist_scale=False):
    return {
        "status": Variant(TemplateA(), values, heading, list(series), STATUS, scale, scale_after, drop_null),
        "historisk": Variant(hist_template or TemplateB(), hist_values or values, heading,
                             list(hist_series if hist_series is not None else series), HISTORIC,
                             scale if hist_scale else None, scale_after, drop_null),
    }


def _only(inputs):
    [df] = inputs.values()
    return df


# --- D03 flat prices ------------------------------------------------------------------------

def _boligpriser(inputs, variant):
    return _only(inputs).withColumnRenamed("kvmpris", "value")


_H03 = "Gjennomsnittpris (kr) pr kvm for blokkleilighet"
BOLIGPRISER = DatasetSpec(
    "boligpriser", ["boligpriser-blokkleiligheter"], {"boligpriser-blokkleiligheter": N.boligpriser}, _boligpriser,
    _status_hist(["value"], _H03, [S(_H03)], hist_template=TemplateA(), scale="value", scale_after=False,
                 drop_null="value", hist_scale=True))


# --- D06 tenure ----------------------------------------------------------------------------------

def _eieform(inputs, variant):
    df = _only(inputs).withColumnsRenamed({"selveier_alle": "selveier", "borettslag_andel_alle": "andel",
                                           "leier_alle": "leier"})
    df = filters.drop_districts(df, ["16", "17"], K).dropDuplicates()
    return df.withColumns({f"{c}_ratio": F.col(c) / 100 for c in ("leier", "andel", "selveier")})


EIEFORM = DatasetSpec(
    "eieform", ["eieform"], {"eieform": N.eieform}, _eieform,
    _status_hist(["leier", "andel", "selveier"], "Husholdninger fordelt etter eie-/leieforhold",
                 [S("Leier"), S("Andels-/aksjeeier"), S("Selveier")], hist_template=TemplateC(), scale="leier",
                 scale_after=False))


# --- D07 low-income households with children -------------------------------------------------------

_F = N.FATTIGE_VALUE


def _fattige(inputs, variant):
    df = _only(inputs).filter(F.col(f"{_F}_antall").isNotNull() & F.col(f"{_F}_andel").isNotNull())
    return df.withColumns({_F: F.col(f"{_F}_antall"), f"{_F}_ratio": F.col(f"{_F}_andel") / 100})


FATTIGE = DatasetSpec(
    "fattige_barnehusholdninger", ["fattige-husholdninger"], {"fattige-husholdninger": N.fattige_husholdninger},
    _fattige, _status_hist([_F], "Lavinntekts husholdninger med barn", [], scale=_F))


# --- D16 death rates --------------------------------------------------------------------------------

def _dodsrate(inputs, variant):
    return _only(inputs).withColumn("dodsrate_ratio", F.col("dodsrate") / 100)


DODSRATE = DatasetSpec(
    "levekaar_dodsrate", ["dodsrater"], {"dodsrater": N.dodsrater}, _dodsrate,
    _status_hist(["dodsrate"], "Dødelighet (gj.snitt siste 7 år) for personer 55–79 år", [], scale="dodsrate"))


# --- D19 reduced functional ability -----------------------------------------------------------------------

_R19 = "antall_personer_med_redusert_funksjonsevne"


def _redusert(inputs, variant):
    return _only(inputs).withColumn(f"{_R19}_ratio", F.col("andel_personer_med_redusert_funksjonsevne") / 100)


REDUSERT = DatasetSpec(
    "levekar_redusert_funksjonsevne", ["redusert-funksjonsevne"], {"redusert-funksjonsevne": N.redusert_funksjonsevne},
    _redusert, _status_hist([_R19], "Personer fra 16 til 66 år med redusert funksjonsevne",
                            [S("Redusert funksjonsevne")], scale=_R19))


# --- D21 overcrowding --------------------------------------------------------------------------------------

def _trangbodde(inputs, variant):
    return _only(inputs).withColumn("antall_som_bor_trangt_ratio", F.col("andel_som_bor_trangt") / 100)


TRANGBODDE = DatasetSpec(
    "levekar_trangbodde", ["trangbodde"], {"trangbodde": N.trangbodde}, _trangbodde,
    _status_hist(["antall_som_bor_trangt"], "Levekår Trangbodde", [S("Trangbodde")], scale="antall_som_bor_trangt"))


# --- D22 median price ----------------------------------------------------------------------------------------

def _median(inputs, variant):
    df = _only(inputs).withColumnRenamed("totalpris", "value")
    return df.filter(F.col("enhetstype") == "both").drop("enhetstype")


MEDIAN = DatasetSpec(
    "median_totalpris", ["median-totalpris"], {"median-totalpris": N.median_totalpris}, _median,
    _status_hist(["value"], "Median totalpris", [S("Median totalpris for leiligheter")], hist_template=TemplateA(),
                 scale="value", scale_after=False, drop_null="value", hist_scale=True))


# --- D23 NEETs ------------------------------------------------------------------------------------------------

def _neets(inputs, variant):
    return _only(inputs).withColumnRenamed("andel", "antall_ratio")


NEETS = DatasetSpec(
    "neets", ["neets"], {"neets": N.neets}, _neets,
    _status_hist(["antall"], "NEETs", [S("NEETs")], scale="antall"))


# --- D05 dwellings by building type ---------------------------------------------------------------------------

# fixed values: dwelling-type labels -> columns
BOLIGTYPER = {
    "Blokk, leiegård e.l.": "blokk_leiegaard_el",
    "Forretningsgård, bygg for felleshusholdning e.l.": "forretningsgaard_bygg_for_felleshusholdning_el",
    "Frittliggende enebolig eller våningshus": "frittliggende_enebolig_eller_vaaningshus",
    "Horisontaldelt tomannsbolig eller annet boligbygg med mindre enn 3 etasjer":
        "horisontaldelt_tomannsbolig_eller_annet_boligbygg_med_mindre_enn_3_etasjer",
    "Hus i kjede, rekke-/terasse-hus, vertikaldelt tomannsbolig":
        "hus_i_kjede_rekkehus_terrasse_hus_vertikaldelt_tomannsbolig",
}


def dwelling_types(df):
    """Pivot dwelling types (resolved sub-districts only) and derive the three groups + total."""
    w = pivot.pivot_sum(df, KEYS, "boligtype", "antall", BOLIGTYPER, fill=0)
    c = BOLIGTYPER
    w = w.withColumns({
        "enebolig": F.col(c["Frittliggende enebolig eller våningshus"]),
        "rekkehus": F.col(c["Horisontaldelt tomannsbolig eller annet boligbygg med mindre enn 3 etasjer"])
        + F.col(c["Hus i kjede, rekke-/terasse-hus, vertikaldelt tomannsbolig"]),
        "blokk": F.col(c["Blokk, leiegård e.l."]) + F.col(c["Forretningsgård, bygg for felleshusholdning e.l."]),
    }).drop(*c.values())
    return w.withColumn("total", F.col("rekkehus") + F.col("blokk") + F.col("enebolig"))


def _bygningstyper(inputs, variant):
    r = rollup.aggregate(dwelling_types(_only(inputs)), "sum", K)
    return rollup.add_ratios(r, ["rekkehus", "blokk", "enebolig", "total"], ["total"])


_ALLE = [S("Blokk, leiegård o.l"), S("Rekkehus, tomannsboliger o.l"), S("Enebolig")]
_BV = {
    "alle_status": Variant(TemplateA(), ["blokk", "rekkehus", "enebolig"], "Boliger etter bygningstype", _ALLE),
    "alle_historisk": Variant(TemplateC(), ["blokk", "rekkehus", "enebolig", "total"], "Boliger etter bygningstype",
                              _ALLE + [S("Totalt")], HISTORIC),
}
for _name, _col, _heading in [("blokk", "blokk", "Blokker og leiegårder"), ("enebolig", "enebolig", "Eneboliger"),
                              ("rekkehus", "rekkehus", "Rekkehus/tomannsboliger"),
                              ("totalt", "total", "Antall boliger")]:
    # the published "totalt" scale asks for a column named "totalt" (absent -> zeros); kept as published
    _BV[f"{_name}_status"] = Variant(TemplateA(), [_col], _heading, [], STATUS,
                                     scale="totalt" if _name == "totalt" else _col)
    _BV[f"{_name}_historisk"] = Variant(TemplateB(), [_col], _heading, [], HISTORIC)

BYGNINGSTYPER = DatasetSpec("bygningstyper", ["boligmengde-etter-boligtype"],
                            {"boligmengde-etter-boligtype": N.boligmengde}, _bygningstyper, _BV)


# --- D25 education -------------------------------------------------------------------------------------------------

# fixed values: education levels -> columns
UTDANNING_LEVELS = {"Grunnskole": "grunnskole", "Videregående skolenivå": "vgs",
                    "Universitets- og høgskolenivå, kort": "uni_kort", "Universitets- og høgskolenivå, lang": "uni_lang",
                    "Ingen utdanning/Uoppgitt utdanning": "ingen"}
UTD_STATUS = ["grunnskole", "vgs", "uni_kort", "uni_lang", "ingen"]


def _utdanning(inputs, variant):
    df = _only(inputs)
    per_level = pivot.group_sum(df, [*KEYS, "nivaa"], ["antall"])          # drops gender and age
    w = pivot.pivot_sum(per_level, KEYS, "nivaa", "antall", UTDANNING_LEVELS, fill=None)
    w = w.withColumn("total", row_sum_propagate(UTD_STATUS))
    r = rollup.aggregate(w, "sum", K)
    return rollup.add_ratios(r, [*UTD_STATUS, "total"], ["total"])


_US = [S("Grunnskole"), S("Videregående skolenivå"), S("Universitets- og høgskolenivå", "kort"),
       S("Universitets- og høgskolenivå", "lang"), S("Ingen/uoppgitt utdanning")]
UTDANNING = DatasetSpec(
    "utdanning", ["utdanning"], {"utdanning": N.utdanning}, _utdanning,
    {"status": Variant(TemplateA(), UTD_STATUS, "Utdanning", _US, STATUS, scale="total"),
     "historisk": Variant(TemplateC(), [*UTD_STATUS, "total"], "Utdanning", _US + [S("Totalt")], HISTORIC,
                          scale="total")})

SPECS = [BOLIGPRISER, EIEFORM, FATTIGE, DODSRATE, REDUSERT, TRANGBODDE, MEDIAN, NEETS, BYGNINGSTYPER, UTDANNING]
