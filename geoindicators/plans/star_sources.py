"""The landing tables of the datasets, shaped from the driver's star tables.

One base row per order: a year (two seven-year halves, so ten-year changes exist), its customer's
geography and how the source writes it.  ``kind`` is the level of the row: most are sub-district rows, some
carry only a district, some the city, and some a geography that no table knows; a few have no
category.  ``raw(spark, sf, source)`` gives a landing table with the source's own headers; ``BASE_SQL`` and
``keyed_sql`` are the same rows for DuckDB with their geography resolved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoindicators.datasets.composite import BEF, IKKE_VESTLIG, KORT, LANG, OVRIGE
from geoindicators.datasets.households import BARN, KATEGORIER, LAV_UTDANNING, TYPER
from geoindicators.datasets.simple import BOLIGTYPER, UTDANNING_LEVELS
from geoindicators.plans.star import geo_dim, table
from geoindicators.sources.normalise import FATTIGE_COLUMNS, FLYTT_UT, ROM_COLUMNS

BOTID = [KORT, LANG, OVRIGE]
LAND = [IKKE_VESTLIG, "Norge", "Vest-Europa"]
INNVANDRING = ["Innvandrer", "Norskfødt med innvandrerforeldre", "Øvrige"]
COUNTRIES = [f"Land {i:02d}" for i in range(12)]
AGE_GROUPS = ["0-9", "10-19", "20-29", "30-39"]

#: one row per order: ok, date, kind, did, dname, sid, sname (geography only as far as the kind has it), antall
BASE_SQL = """
f AS (SELECT ok, date, kind, CASE WHEN kind IN ('sub', 'district') THEN did END AS did,
             CASE WHEN kind IN ('sub', 'district') THEN dname END AS dname, CASE WHEN kind = 'sub' THEN sid END AS sid,
             CASE WHEN kind = 'sub' THEN sname END AS sname, 1 + ok % 5 AS antall
      FROM (SELECT o.o_orderkey AS ok, CAST(year(o.o_orderdate) - 7 * (o.o_custkey % 2) AS INTEGER) AS date,
                   CASE WHEN o.o_orderkey % 20 = 0 THEN 'none' WHEN o.o_orderkey % 20 IN (1, 2) THEN 'district'
                        WHEN o.o_orderkey % 20 = 3 THEN 'city' ELSE 'sub' END AS kind,
                   lpad(CAST(r.r_regionkey + 1 AS VARCHAR), 2, '0') AS did, r.r_name AS dname,
                   lpad(CAST(r.r_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n.n_nationkey AS VARCHAR), 2, '0') AS sid,
                   n.n_name AS sname
            FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
            JOIN region r ON n.n_regionkey = r.r_regionkey)),
g AS (SELECT date, kind, did, dname, sid, sname, sum(antall) AS v FROM f GROUP BY date, kind, did, dname, sid, sname)"""

#: the resolved keys of a row, for rules that find every level
KEYS_SQL = ("date, CASE WHEN kind = 'city' THEN '00' ELSE did END AS district_id, "
            "CASE WHEN kind = 'city' THEN 'Oslo i alt' ELSE dname END AS district_name, sid AS sub_id, sname AS sub_name")


def base(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("ok"), "o_custkey",
        (F.year("o_orderdate") - 7 * (F.col("o_custkey") % 2)).cast("int").alias("date"))
    customer = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    geo = customer.join(geo_dim(spark, sf), F.col("c_nationkey") == F.col("n_nationkey"))
    f = orders.join(geo, F.col("o_custkey") == F.col("c_custkey"))
    k = F.col("ok") % 20
    kind = F.when(k == 0, "none").when(k.isin(1, 2), "district").when(k == 3, "city").otherwise("sub")
    f = f.withColumn("kind", kind)
    has_district, is_sub = F.col("kind").isin("sub", "district"), F.col("kind") == "sub"
    return f.select("ok", "date", "kind", F.when(has_district, F.col("district_id")).alias("did"),
                    F.when(has_district, F.col("district_name")).alias("dname"), F.when(is_sub, F.col("sub_id")).alias("sid"),
                    F.when(is_sub, F.col("sub_name")).alias("sname"), (1 + F.col("ok") % 5).cast("int").alias("antall"))


def _per_geography(f: DataFrame) -> DataFrame:
    return f.groupBy("date", "kind", "did", "dname", "sid", "sname").agg(F.sum("antall").alias("v"))


def pick(labels, divisor: int) -> Column:
    """A label by the order key; none for some orders."""
    labels = list(labels)
    at = (F.floor(F.col("ok") / divisor) % len(labels) + 1).cast("int")
    return F.when(F.col("ok") % 17 != 3, F.element_at(F.array(*[F.lit(x) for x in labels]), at))


def pick_sql(labels, divisor: int) -> str:
    labels = list(labels)
    names = ", ".join("'" + x.replace("'", "''") + "'" for x in labels)
    return f"CASE WHEN ok % 17 <> 3 THEN list_extract([{names}], CAST(floor(ok / {divisor}) AS BIGINT) % {len(labels)} + 1) END"


# --- how the sources write a geography ------------------------------------------------------------

def _kind(**cases) -> Column:
    out = None
    for kind, value in cases.items():
        value = value if isinstance(value, Column) else F.lit(value)
        out = F.when(F.col("kind") == kind, value) if out is None else out.when(F.col("kind") == kind, value)
    return out


def district_name(city: str = "Oslo i alt") -> Column:
    return _kind(sub=F.initcap("dname"), district=F.col("dname"), city=city, none="Ukjent")


def sub_name() -> Column:
    return _kind(sub=F.concat(F.lit(" "), F.col("sname")), none="Ukjent")


def sub_number() -> Column:
    return _kind(sub=F.col("sid").cast("int"), none=98765)


def district_code() -> Column:
    return _kind(sub=F.col("did").cast("int") + 30100, district=F.col("did").cast("int") + 30100, city=30100, none=30177)


def one_column() -> Column:
    return _kind(sub=F.col("sname"), district=F.concat(F.lit("Bydel "), F.col("dname")), city="Oslo i alt", none="Ukjent")


def labelled() -> Column:
    return _kind(sub=F.concat(F.lit("Delbydel "), F.col("sname")), district=F.concat(F.lit("Bydel "), F.col("dname")),
                 city="Oslo i alt", none="Ukjent")


def single_code(city: int) -> Column:
    return _kind(sub=F.col("sid").cast("int"), district=F.col("did").cast("int") + 30100, city=city, none=98765)


def mixed() -> Column:
    number = F.col("sid").cast("int")
    return _kind(sub=F.when(number % 2 == 0, F.col("sname")).otherwise(number.cast("string")),
                 district=(F.col("did").cast("int") + 30100).cast("string"), city="10000", none="Ukjent")


# --- the landing tables -----------------------------------------------------------------------------

def raw(spark: SparkSession, sf: str, source: str) -> DataFrame:
    """The landing table ``source`` with its own headers."""
    f = base(spark, sf)
    g = _per_geography(f)
    year, names = F.col("date").alias("År"), [district_name().alias("Bydel"), sub_name().alias("Delbydel")]
    v = F.col("v")
    if source == BEF:
        both = f.withColumn("kjonn", F.explode(F.array(F.lit(1), F.lit(2))))
        return both.select(year, district_code().alias("Bydel"), sub_number().alias("Delbydel"),
                           F.when(F.col("ok") % 19 != 5, F.col("kjonn")).alias("Kjønn"),
                           F.when(F.col("ok") % 17 != 3, F.floor(F.col("ok") / 7) % 123).cast("int").alias("Alder"),
                           (F.col("antall") + F.col("kjonn")).alias("Antall personer"))
    if source == "boligmengde-etter-boligtype":
        return f.select(year, one_column().alias("Geografi"), pick(BOLIGTYPER, 3).alias("Boligtype"), F.col("antall").alias("Antall boliger"))
    if source == "boligpriser-blokkleiligheter":
        return g.select(year, sub_number().alias("Delbydelnummer"), district_name().alias("Oslo-Bydelsnavn"),
                        v.alias("antall omsatte blokkleieligheter"), F.when(v % 7 != 0, v + 10000.0).alias("kvmpris"))
    if source == "botid":
        return f.select(year, *names, pick(BOTID, 2).alias("Botid"), pick(INNVANDRING, 6).alias("Innvandringskategori"), "antall")
    if source == "botid-ikke-vestlige":
        return f.select(year, *names, pick(BOTID, 2).alias("Botid"), pick(LAND, 6).alias("Landbakgrunn"), "antall")
    if source in ("dode", "fodte"):
        return g.select(year, *names, (v + int(source == "dode")).alias("Antall døde" if source == "dode" else "Antall fødte"))
    if source == "dodsrater":
        return g.select(year, *names, (v / 10).alias("Dødelighet"))
    if source == "eieform":
        columns = ["Selveier alle", "Borettslag-andel alle", "Leier alle", "Selveier uten studenter", "Borettslag-andel uten studenter", "Leier uten studenter"]
        return g.select(year, mixed().alias("Delbydel"), *[(v + i).alias(c) for i, c in enumerate(columns)])
    if source == "fattige-husholdninger":
        share, count = "Husholdninger med barn <18 år EU-skala -andel", "Husholdninger med barn <18 år etter EU-skala - antall"
        own = {share: v / 2, count: F.when(v % 5 != 0, v)}
        return g.select(year, labelled().alias("Geografi"), *[own.get(c, v).alias(c) for c in FATTIGE_COLUMNS])
    if source.startswith("flytting-"):
        fra = source.startswith("flytting-fra")
        return f.select(F.col("date").alias("aargang"), pick(FLYTT_UT, 2).alias("til_fra_bydel"), district_name("Ukjent").alias("fra_bydel" if fra else "til_bydel"),
                        F.element_at(F.array(*map(F.lit, AGE_GROUPS)), (F.floor(F.col("ok") / (3 if fra else 5)) % 4 + 1).cast("int")).alias("aldgr5"), "antall")
    if source == "husholdninger-etter-rom-per-person":
        return g.select(year, single_code(10000).alias("Geografi"), *[(v + i).alias(c) for i, c in enumerate(ROM_COLUMNS)])
    if source == "husholdninger-med-barn":
        return f.select(year, *names, pick(BARN, 3).alias("Barn i husholdningen"), F.col("antall").alias("Antall"))
    if source == "husholdningstyper":
        return f.select(year, *names, pick(TYPER, 3).alias("Husholdningstype"), F.col("antall").alias("Antall"))
    if source == "innvandrer-befolkningen-0-15-ar":
        return f.select(year, *names, F.when(F.floor(F.col("ok") / 12) % 2 == 0, "0-15 år").otherwise("16 år og over").alias("Alder"),
                        pick(KATEGORIER, 2).alias("Innvandringskategori"), F.col("antall").alias("Antall personer"))
    if source == "kommunale-boliger":
        return g.select(F.col("date").alias("år"), sub_number().alias("Delbydelsnr"), names[0], v.alias("Antall boliger"))
    if source == "landbakgrunn-storste-innvandringsgrupper":
        return f.select(year, district_name("Ukjent").alias("Bydel"), pick(INNVANDRING, 2).alias("Innvandringskategori"),
                        pick(COUNTRIES, 6).alias("Landbakgrunn"), F.col("antall").alias("Antall personer"))
    if source == "lav-utdanning":
        return f.select(year, *names, pick(LAV_UTDANNING, 3).alias("Høyeste fullførte utdanning"), F.col("antall").alias("Antall personer"))
    if source == "median-totalpris":
        kinds = g.withColumn("Enhetstype", F.explode(F.array(F.lit("both"), F.lit("one"))))
        return kinds.select(year, sub_number().alias("Delbydel ID"), names[0], "Enhetstype", F.when(v % 6 != 0, v + 100000).alias("Median total pris"))
    if source == "neets":
        return g.select(F.col("date").alias("aar"), single_code(100000).alias("Geografi_num"), (v / 8).alias("Andel NEETs (15-29 år)"), v.alias("Antall NEETs"))
    if source == "redusert-funksjonsevne":
        return g.select(year, labelled().alias("Geografi"), v.alias("Antall personer med redusert funksjonsevne"),
                        (v / 4).alias("Andel personer med redusert funksjonsevne"))
    if source == "sysselsatte":
        return g.select(year, *names, F.concat(F.lit(" "), v.cast("string"), F.lit(" ")).alias("Antall sysselsatte"))
    if source == "trangbodde":
        return g.select(year, *names, (v / 4).alias("Andel som bor trangt"), v.alias("Antall som bor trangt"), (v * 3).alias("Antall husholdninger"))
    if source == "utdanning":
        levels = F.array(*map(F.lit, UTDANNING_LEVELS))
        each = f.select("*", F.posexplode(levels).alias("i", "level"))
        return each.select(F.col("date").alias("aargang"), sub_number().alias("delbydel2017_01"), district_name().alias("bydel2_fmt"),
                           F.when((F.col("ok") % 17 != 3) | (F.col("i") > 0), F.col("level")).alias("bu1_gr5_imp_fmt"),
                           (F.col("ok") % 2).alias("kjoenn_fmt"), F.lit("alle").alias("aldgr06a__fmt"), (F.col("antall") + F.col("i")).alias("antall"))
    raise ValueError(f"Unknown landing table: {source!r}")
