"""Small synthetic landing snapshots with the sources' own headers (FIXTURES.md §2).

Two districts with two sub-districts each plus the city centre, three years.
Values follow simple formulas so expected numbers can be computed by hand.
"""

from __future__ import annotations

YEARS = [2020, 2021, 2022]
DISTRICTS = {"01": "Gamle Oslo", "03": "Sagene"}
SUBS = [("0101", "Lodalen", "01"), ("0102", "Grønland", "01"), ("0301", "Iladalen", "03"),
        ("0302", "Sagene", "03")]


def _v(*parts) -> int:
    return sum(ord(ch) * (i + 1) for i, ch in enumerate("|".join(map(str, parts)))) % 50 + 5


def rows(source: str):
    """(schema, rows) of one landing source."""
    out = []
    if source == "befolkning-etter-kjonn-og-alder":
        for y in range(2010, 2023):   # long enough for ten-year changes
            for sid, _, did in SUBS:
                for g in (1, 2):
                    for age in (0, 10, 20, 30, 45, 59, 70):
                        out.append((y, 30100 + int(did), int(sid), g, age, (y - 2000) + age % 7 + g + int(sid) % 5))
        return ("`År` int, Bydel int, Delbydel int, `Kjønn` int, Alder int, `Antall personer` int", out)
    if source == "boligmengde-etter-boligtype":
        types = ["Blokk, leiegård e.l.", "Forretningsgård, bygg for felleshusholdning e.l.",
                 "Frittliggende enebolig eller våningshus",
                 "Horisontaldelt tomannsbolig eller annet boligbygg med mindre enn 3 etasjer",
                 "Hus i kjede, rekke-/terasse-hus, vertikaldelt tomannsbolig"]
        for y in YEARS:
            for sid, name, _ in SUBS:
                for i, t in enumerate(types):
                    out.append((y, name, t, 10 * (i + 1) + int(sid) % 7 + y % 3))
            out.append((y, "Bydel Gamle Oslo", types[0], 999))  # district rows: dropped by the pivot
        return ("`År` int, Geografi string, Boligtype string, `Antall boliger` int", out)
    if source == "boligpriser-blokkleiligheter":
        for y in YEARS:
            for sid, name, did in SUBS:
                out.append((y, int(sid), name, DISTRICTS[did], 10 + y % 5, 50000.0 + int(sid) + y))
            for did, dname in DISTRICTS.items():
                out.append((y, None, None, dname, 30, 60000.0 + int(did)))
            out.append((y, None, None, "Oslo i alt", 100, 70000.0 if y < 2022 else None))
        return ("`År` int, Delbydelnummer int, Delbydelsnavn string, `Oslo-Bydelsnavn` string, "
                "`antall omsatte blokkleieligheter` int, kvmpris double", out)
    if source in ("botid", "botid-ikke-vestlige"):
        cats = (["Innvandrer", "Norskfødt med innvandrerforeldre"] if source == "botid"
                else ["Asia, Afrika, Latin-Amerika og Øst-Europa utenfor EU", "Norge"])
        for y in YEARS:
            for sid, name, did in SUBS:
                for b in ("Innvandrer, kort botid (<=5 år)", "Innvandrer, lang botid (>5 år)", "Øvrige befolkning"):
                    for c in cats:
                        out.append((y, DISTRICTS[did], name, b, c, _v(y, sid, b, c)))
        col = "Innvandringskategori" if source == "botid" else "Landbakgrunn"
        return (f"`År` int, Bydel string, Delbydel string, Botid string, {col} string, antall int", out)
    if source in ("dode", "fodte"):
        col = "Antall døde" if source == "dode" else "Antall fødte"
        for y in YEARS:
            for sid, name, did in SUBS:
                out.append((y, DISTRICTS[did], name, _v(y, sid, source)))
        return (f"`År` int, Bydel string, Delbydel string, `{col}` int", out)
    if source == "dodsrater":
        for y in YEARS:
            for sid, name, did in SUBS:
                out.append((y, DISTRICTS[did], name, 1.0 + int(sid) % 5 / 10))
            for did, dname in DISTRICTS.items():
                out.append((y, dname, None, 1.5))
            out.append((y, "Oslo i alt", None, 1.4))
        return ("`År` int, Bydel string, Delbydel string, `Dødelighet` double", out)
    if source == "eieform":
        for y in YEARS:
            for i, (sid, name, did) in enumerate(SUBS):
                geo = name if i % 2 == 0 else str(int(sid))
                out.append((y, geo, 40.0 + i, 30.0, 30.0 - i, 45.0, 30.0, 25.0))
            for did in DISTRICTS:
                out.append((y, str(30100 + int(did)), 41.0, 30.0, 29.0, 44.0, 31.0, 25.0))
            out.append((y, "10000", 42.0, 30.0, 28.0, 43.0, 32.0, 25.0))
        return ("`År` int, Delbydel string, `Selveier alle` double, `Borettslag-andel alle` double, "
                "`Leier alle` double, `Selveier uten studenter` double, `Borettslag-andel uten studenter` double, "
                "`Leier uten studenter` double", out)
    if source == "fattige-husholdninger":
        for y in YEARS:
            geos = [f"Delbydel {n}" for _, n, _ in SUBS] + [f"Bydel {d}" for d in DISTRICTS.values()] + ["Oslo i alt"]
            for i, g in enumerate(geos):
                out.append((y, g, 1000 + i, 300 + i, 10.0, 12.5 + i, 100 + i, 30 + i))
        return ("`År` int, Geografi string, `Husholdninger i alt` int, `Husholdninger med barn <18 år i alt` int, "
                "`Husholdninger EU-skala - andel` double, `Husholdninger med barn <18 år EU-skala -andel` double, "
                "`Husholdninger etter EU-skala - antall` int, "
                "`Husholdninger med barn <18 år etter EU-skala - antall` int", out)
    if source in ("flytting-fra-etter-alder", "flytting-til-etter-alder"):
        for y in YEARS:
            for did, dname in DISTRICTS.items():
                for a in ("0-4", "5-9", "10-14"):
                    for k in ("Flytting inn/ut av Oslo", "Flytting innenfor bydelen", "Flytting mellom bydeler"):
                        out.append((y, k, dname, a, _v(y, did, a, k, source)))
        col = "fra_bydel" if source.startswith("flytting-fra") else "til_bydel"
        return (f"aargang int, til_fra_bydel string, {col} string, aldgr5 string, antall int", out)
    if source == "husholdninger-etter-rom-per-person":
        for y in YEARS:
            for sid, _, _ in SUBS:
                a, b, c, d = (_v(y, sid, k) for k in range(4))
                out.append((y, int(sid), a, b, c, d, 1, a + b + c + d + 1))
            out.append((y, 10000, 1, 1, 1, 1, 1, 5))  # city row in the input: excluded from the roll-up
        return ("`År` int, Geografi int, `Rom per person - Under 0,5` int, `Rom per person - 0,5 - 0,9` int, "
                "`Rom per person - 1,0 - 1,9` int, `Rom per person - 2,0 og over` int, `Ukjent antall rom` int, "
                "`Rom per person - I alt` int", out)
    if source == "husholdninger-med-barn":
        cats = ["1 barn i HH", "2 barn i HH", "3 barn i HH", "4 barn eller mer", "Ingen barn i HH"]
        return ("`År` int, Bydel string, Delbydel string, `Barn i husholdningen` string, Antall int",
                [(y, DISTRICTS[d], n, c, _v(y, s, c)) for y in YEARS for s, n, d in SUBS for c in cats])
    if source == "husholdningstyper":
        cats = ["Aleneboende", "Par uten hjemmeboende barn", "Par med små barn", "Par med store barn",
                "Mor/far med små barn", "Mor/far med store barn", "Enfamiliehusholdninger med voksne barn",
                "Flerfamiliehusholdninger med små barn", "Flerfamiliehusholdninger med store barn",
                "Flerfamiliehusholdninger uten barn 0-17 år"]
        return ("`År` int, Bydel string, Delbydel string, Husholdningstype string, Antall int",
                [(y, DISTRICTS[d], n, c, _v(y, s, c)) for y in YEARS for s, n, d in SUBS for c in cats])
    if source == "innvandrer-befolkningen-0-15-ar":
        cats = ["Uten innvandringsbakgrunn", "Innvandrer", "Norskfødt med innvandrerforeldre",
                "Utenlandsfødt m/en norsk forelder", "Norskfødt med en utenlandskfødt forelder",
                "Født i utlandet av norskfødte foreldre"]
        return ("`År` int, Bydel string, Delbydel string, Alder string, Innvandringskategori string, "
                "`Antall personer` int",
                [(y, DISTRICTS[d], n, a, c, _v(y, s, a, c)) for y in YEARS for s, n, d in SUBS
                 for a in ("0-15 år", "16 år og over") for c in cats])
    if source == "kommunale-boliger":
        for y in YEARS:
            for sid, name, did in SUBS:
                out.append((y, int(did), DISTRICTS[did], int(sid), name, _v(y, sid)))
        return ("`år` int, Bydelsnr int, Bydel string, Delbydelsnr int, Delbydel string, `Antall boliger` int", out)
    if source == "landbakgrunn-storste-innvandringsgrupper":
        countries = ["Polen", "Pakistan", "Somalia", "Sverige", "Irak"]
        for y in YEARS:
            for did, dname in DISTRICTS.items():
                for c in countries:
                    for k in ("Innvandrer", "Norskfødt med innvandrerforeldre"):
                        out.append((y, dname, k, c, _v(y, did, c, k)))
        return ("`År` int, Bydel string, Innvandringskategori string, Landbakgrunn string, `Antall personer` int",
                out)
    if source == "lav-utdanning":
        cats = ["Ingen utdanning/Uoppgitt utdanning", "Grunnskole", "Videregående skolenivå",
                "Universitets- og høgskolenivå, kort"]   # "lang" absent everywhere -> 0
        for y in YEARS:
            for i, (sid, name, did) in enumerate(SUBS):
                for c in cats:
                    if not (i == 0 and c == "Grunnskole" and y == 2021):  # one absent cell
                        out.append((y, DISTRICTS[did], name, c, _v(y, sid, c)))
        return ("`År` int, Bydel string, Delbydel string, `Høyeste fullførte utdanning` string, "
                "`Antall personer` int", out)
    if source == "median-totalpris":
        for y in YEARS:
            for sid, name, did in SUBS:
                for e in ("both", "small"):
                    out.append((y, int(sid), name, int(did), DISTRICTS[did], e, 10, 4000000.0 + int(sid)))
            out.append((y, None, None, None, None, "both", 100, 4500000.0))
        return ("`År` int, `Delbydel ID` int, Delbydel string, `Bydel ID` int, Bydel string, Enhetstype string, "
                "`Antall salg` int, `Median total pris` double", out)
    if source == "neets":
        for y in YEARS:
            for sid, name, _ in SUBS:
                out.append((int(sid), name, y, 0.05 + int(sid) % 3 / 100, 20 + int(sid) % 9))
            for did, dname in DISTRICTS.items():
                out.append((30100 + int(did), dname, y, 0.06, 50))
            out.append((100000, "Oslo i alt", y, 0.07, 500))
        return ("Geografi_num int, Geografi string, aar int, `Andel NEETs (15-29 år)` double, `Antall NEETs` int", out)
    if source == "redusert-funksjonsevne":
        for y in YEARS:
            for sid, name, _ in SUBS:
                out.append((y, f"Delbydel {name}", 1000, 100 + int(sid) % 7, 10.0 + int(sid) % 7 / 10))
            for dname in DISTRICTS.values():
                out.append((y, f"Bydel {dname}", 2000, 210, 10.5))
            out.append((y, "Oslo i alt", 9000, 950, 10.6))
        return ("`År` int, Geografi string, `Antall personer 16-66 år` int, "
                "`Antall personer med redusert funksjonsevne` int, `Andel personer med redusert funksjonsevne` double",
                out)
    if source == "sysselsatte":
        for y in YEARS:
            for sid, name, did in SUBS:
                out.append((y, DISTRICTS[did], name, f"1 {100 + int(sid) % 50:03d}"))
        return ("`År` int, Bydel string, Delbydel string, `Antall sysselsatte` string", out)
    if source == "trangbodde":
        for y in YEARS:
            for sid, name, did in SUBS:
                out.append((y, DISTRICTS[did], name, name, 8.0 + int(sid) % 4, 40 + int(sid) % 9, 500))
            for dname in DISTRICTS.values():
                out.append((y, dname, None, dname, 9.0, 90, 1000))
            out.append((y, "Oslo i alt", None, "Oslo i alt", 9.5, 900, 10000))
        return ("`År` int, Bydel string, Delbydel string, Geografi string, `Andel som bor trangt` double, "
                "`Antall som bor trangt` int, `Antall husholdninger` int", out)
    if source == "utdanning":
        levels = ["Grunnskole", "Videregående skolenivå", "Universitets- og høgskolenivå, kort",
                  "Universitets- og høgskolenivå, lang", "Ingen utdanning/Uoppgitt utdanning"]
        for y in YEARS:
            for sid, _, did in SUBS:
                for lv in levels:
                    for g in ("Mann", "Kvinne"):
                        out.append((y, int(sid), DISTRICTS[did], lv, g, "30-39 år", _v(y, sid, lv, g)))
        return ("aargang int, delbydel2017_01 int, bydel2_fmt string, bu1_gr5_imp_fmt string, kjoenn_fmt string, "
                "aldgr06a__fmt string, antall int", out)
    raise KeyError(source)


def raw_inputs(spark, sources):
    out = {}
    for s in sources:
        schema, data = rows(s)
        out[s] = spark.createDataFrame(data, schema)
    return out
