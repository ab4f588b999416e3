"""The Oslo geography dimension (districts, sub-districts, aliases, legacy ids).

The lists below are fixed values: the published ids and names the documents
must carry.  The other aliases are the lower-cased names.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from geoindicators.geo.dim import Geography, from_tables

# --- fixed values: districts (id;name) ---------------------------------------------------
DISTRICTS = """
00;Oslo i alt
01;Bydel Gamle Oslo
02;Bydel Grünerløkka
03;Bydel Sagene
04;Bydel St. Hanshaugen
05;Bydel Frogner
06;Bydel Ullern
07;Bydel Vestre Aker
08;Bydel Nordre Aker
09;Bydel Bjerke
10;Bydel Grorud
11;Bydel Stovner
12;Bydel Alna
13;Bydel Østensjø
14;Bydel Nordstrand
15;Bydel Søndre Nordstrand
16;Sentrum
17;Marka
99;Uten registrert adresse
"""

# --- fixed values: extra district name spellings (alias;id), besides each lower-cased name --
DISTRICT_ALIASES = """
bydel st.hanshaugen;04
bydel st hanshaugen;04
uoppgitt;99
sentrum, marka, ura;99
"""

# --- fixed values: sub-districts (id;name); the district is the first two digits -----------
SUB_DISTRICTS = """
0101;Lodalen
0102;Grønland
0103;Enerhaugen
0104;Nedre Tøyen
0105;Kampen
0106;Vålerenga
0107;Helsfyr
0108;Kværnerbyen
0109;Bispevika
0110;Ensjø
0111;Etterstad
0201;Grünerløkka vest
0202;Grünerløkka øst
0203;Dælenenga
0204;Rodeløkka
0205;Sinsen
0206;Sofienberg
0207;Hasle-Løren
0208;Løren
0209;Hasle
0301;Iladalen
0302;Sagene
0303;Bjølsen
0304;Sandaker
0305;Torshov
0401;Hammersborg
0402;Bislett
0403;Ila
0404;Fagerborg
0405;Lindern
0501;Bygdøy
0502;Frogner
0503;Frognerparken
0504;Majorstuen nord
0505;Majorstuen syd
0506;Homansbyen
0507;Uranienborg
0508;Skillebekk
0601;Ullernåsen
0602;Lilleaker
0603;Ullern
0604;Montebello-Hoff
0605;Skøyen
0701;Røa
0702;Holmenkollen
0703;Hovseter
0704;Holmen
0705;Slemdal
0706;Grimelund
0707;Vinderen
0801;Disen
0802;Myrer
0803;Grefsen
0804;Kjelsås
0805;Korsvoll
0806;Tåsen
0807;Nordberg
0808;Ullevål hageby
0901;Veitvet
0902;Linderud
0903;Økern
0904;Årvoll
0905;Refstad
0906;Ulven
1001;Ammerud
1002;Rødtvet
1003;Nordtvet
1004;Grorud
1005;Romsås
1101;Vestli
1102;Fossum
1103;Rommen
1104;Haugenstua
1105;Stovner
1106;Høybråten
1201;Furuset
1202;Ellingsrud
1203;Lindeberg
1204;Trosterud
1205;Hellerudtoppen
1206;Tveita
1207;Teisen
1301;Manglerud
1302;Godlia
1303;Oppsal
1304;Bøler
1305;Skullerud
1306;Abildsø
1401;Ljan
1402;Nordstrand
1403;Bekkelaget
1404;Simensbråten
1405;Lambertseter
1406;Munkerud
1501;Holmlia Syd
1502;Holmlia Nord
1503;Prinsdal
1504;Bjørnerud
1505;Mortensrud
1506;Bjørndal
1601;Sentrum
1701;Marka
9901;Uten registrert adresse
9999;Uten registrert adresse
"""

# --- fixed values: sub-district aliases beyond the lower-cased names (alias;id) -------------
SUB_ALIASES = """
uoppgitt;9999
sentrum, marka og uten registrert adresse;9999
"""

# the unknown address has two ids; its name resolves to this one (fixed value)
UNKNOWN_SUB_BY_NAME = "9999"

# --- fixed values: legacy 3-digit ids (old id;sub-district id) ------------------------------
LEGACY = """
011;0101
012;0102
013;0103
014;0104
015;0105
016;0106
017;0107
021;0201
022;0202
023;0203
024;0204
025;0205
026;0206
027;0207
031;0301
032;0302
033;0303
034;0304
035;0305
041;0401
042;0402
043;0403
044;0404
045;0405
051;0501
052;0502
053;0503
054;0504
055;0505
056;0506
057;0507
058;0508
061;0601
062;0602
063;0603
064;0604
065;0605
071;0701
072;0702
073;0703
074;0704
075;0705
076;0706
077;0707
081;0801
082;0802
083;0803
084;0804
085;0805
086;0806
087;0807
088;0808
091;0901
092;0902
093;0903
094;0904
101;1001
102;1002
103;1003
104;1004
105;1005
111;1101
112;1102
113;1103
114;1104
115;1105
116;1106
121;1201
122;1202
123;1203
124;1204
125;1205
126;1206
127;1207
131;1301
132;1302
133;1303
134;1304
135;1305
136;1306
141;1401
142;1402
143;1403
144;1404
145;1405
146;1406
151;1501
152;1502
153;1503
154;1504
155;1505
156;1506
161;1601
171;1701
999;9901
"""


def _pairs(text: str) -> list[tuple[str, str]]:
    return [tuple(line.split(";", 1)) for line in text.strip().splitlines()]


def tables() -> dict[str, list[tuple]]:
    districts = _pairs(DISTRICTS)
    subs = [(sid, name, sid[:2]) for sid, name in _pairs(SUB_DISTRICTS)]
    district_aliases = [(name.lower(), did) for did, name in districts] + _pairs(DISTRICT_ALIASES)
    by_alias: dict[str, str] = {}
    for sid, name, _ in subs:
        key = name.lower()
        if key == "uten registrert adresse":
            by_alias[key] = UNKNOWN_SUB_BY_NAME
        else:
            by_alias.setdefault(key, sid)
    sub_aliases = list(by_alias.items()) + _pairs(SUB_ALIASES)
    return {"districts": districts, "subs": subs, "district_aliases": district_aliases,
            "sub_aliases": sub_aliases, "legacy": _pairs(LEGACY)}


def oslo_geography(spark: SparkSession) -> Geography:
    t = tables()
    return from_tables(spark, t["districts"], t["subs"], t["district_aliases"], t["sub_aliases"], t["legacy"],
                       city_id="00", city_name="Oslo i alt", unknown_id="99", unknown_name="Uten registrert adresse")
