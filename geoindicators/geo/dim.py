"""The geography dimension: districts, sub-districts, name aliases, legacy ids.

The dimension is an *input* (a handful of small tables), not code: any
region -> sub-region hierarchy works.  Each table has one row per geography or
alias, hundreds of rows at most, so after a size check the whole dimension becomes
one key dictionary (``geo.dictionary``), which is broadcast once and serves every lookup.
A larger dimension stays a plan and is joined table by table.

Tables (all ids are strings):

* ``districts``        (district_id, district_name) - includes the city row
* ``subs``             (sub_id, sub_name, district_id)
* ``district_aliases`` (alias, district_id)  alias is lower-case, trimmed
* ``sub_aliases``      (alias, sub_id)
* ``legacy``           (old_id, sub_id)
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoindicators.geo.dictionary import KeyDictionary

# what the five tables together may hold to become one dictionary
MAX_ROWS = 100_000
MAX_BYTES = 8 << 20
DISTRICT_COLUMNS = ("district_id", "district_name")
SUB_COLUMNS = (*DISTRICT_COLUMNS, "sub_id", "sub_name", "parent_id")


def norm(c: Column) -> Column:
    """Lookup key of a name: lower case, surrounding whitespace removed."""
    return F.lower(F.regexp_replace(c.cast("string"), r"^\s+|\s+$", ""))


@dataclass
class Geography:
    districts: DataFrame
    subs: DataFrame
    district_aliases: DataFrame
    sub_aliases: DataFrame
    legacy: DataFrame
    city_id: str = "00"
    city_name: str = "Oslo i alt"
    # labels and codes used by the source tables
    district_name_prefix: str = "bydel "       # tried in front of a lower-cased name
    district_title_prefix: str = "Bydel "      # prefix of canonical district names
    special_district_names: tuple = ("Marka", "Sentrum", "Oslo i alt", "Uten registrert adresse")
    sub_label_prefix: str = "Delbydel "        # "Delbydel <name>" marks a sub-district row
    unknown_label: str = "Uoppgitt"
    unknown_id: str = "99"
    unknown_name: str = "Uten registrert adresse"
    district_code_prefix: str = "301"          # 301XX = district XX
    # the five tables' rows where they were given as lists: the dictionary then needs no job
    local_rows: dict[str, list[tuple]] | None = None

    def __post_init__(self):
        self._dictionary: KeyDictionary | None = None
        self._too_large = False

    # -- lookups: built once per geography ----------------------------------------------
    def table(self, kind: str) -> DataFrame:
        """(key, *columns) of one kind of lookup key.

        A sub-district comes with its own district (null if that is unknown).  A district name is an alias, or one
        without its prefix ("Frogner" for "bydel frogner") where that isn't an alias itself."""
        d = self.districts.select("district_id", "district_name")
        if kind == "district":
            return d.select(F.col("district_id").alias("key"), "district_id", "district_name")
        if kind in ("district_alias", "district_name"):
            aliases = self.district_aliases.join(d, "district_id").select(F.col("alias").alias("key"), "district_id", "district_name")
            if kind == "district_alias":
                return aliases
            short = aliases.where(F.col("key").startswith(self.district_name_prefix)).withColumn("key", F.substring("key", len(self.district_name_prefix) + 1, 1 << 20))
            return aliases.unionByName(short.join(aliases.select("key"), "key", "left_anti"))
        subs = self.subs.select("sub_id", "sub_name", F.col("district_id").alias("parent_id")).join(
            d, F.col("parent_id") == F.col("district_id"), "left")
        if kind == "sub":
            return subs.select(F.col("sub_id").alias("key"), *SUB_COLUMNS)
        if kind == "sub_alias":
            return self.sub_aliases.join(subs, "sub_id").select(F.col("alias").alias("key"), *SUB_COLUMNS)
        return self.legacy.join(subs, "sub_id").select(F.col("old_id").alias("key"), *SUB_COLUMNS)

    def dictionary(self) -> KeyDictionary | None:
        """The dictionary of all keys, or None for a dimension over ``MAX_ROWS`` rows or ``MAX_BYTES``.

        One job, which reads at most ``MAX_ROWS + 1`` rows of the five tables; both rows and bytes are checked."""
        if self._dictionary is None and not self._too_large:
            if self.local_rows is None:
                plain = self._plain_rows().limit(MAX_ROWS + 1).toArrow()
            else:
                rows = [(kind, *r, *[None] * (3 - len(r))) for kind, found in self.local_rows.items() for r in found]
                plain = pa.table({n: pa.array([r[i] for r in rows], pa.string()) for i, n in enumerate(("kind", "a", "b", "c"))})
            if plain.num_rows > MAX_ROWS or plain.nbytes > MAX_BYTES:
                self._too_large = True
            else:
                self._dictionary = KeyDictionary(self.districts.sparkSession, self._entries(plain.to_pylist()))
        return self._dictionary

    def _plain_rows(self) -> DataFrame:
        def rows(kind: str, df: DataFrame, *cols: str) -> DataFrame:
            cols = [F.col(c).cast("string") for c in cols] + [F.lit(None).cast("string")] * (3 - len(cols))
            return df.select(F.lit(kind).alias("kind"), *[c.alias(n) for c, n in zip(cols, "abc", strict=True)])

        return reduce(DataFrame.unionByName, [
            rows("district", self.districts, "district_id", "district_name"), rows("district_alias", self.district_aliases, "alias", "district_id"),
            rows("sub", self.subs, "sub_id", "sub_name", "district_id"), rows("sub_alias", self.sub_aliases, "alias", "sub_id"),
            rows("legacy", self.legacy, "old_id", "sub_id")])

    def _entries(self, plain: list[dict]) -> list[tuple]:
        """(kind, key, district_id, district_name, sub_id, sub_name, parent_id) out of the five small tables, joined as in ``table``."""
        districts = [(r["a"], r["b"]) for r in plain if r["kind"] == "district"]
        aliases = {r["a"] for r in plain if r["kind"] == "district_alias"}
        named: dict = {}
        for i, name in districts:
            named.setdefault(i, []).append((i, name))
        subs: dict = {}
        for r in plain:
            if r["kind"] == "sub":
                for d in named.get(r["c"], [(None, None)]):
                    subs.setdefault(r["a"], []).append((*d, r["a"], r["b"], r["c"]))
        out = [("district", i, i, name, None, None, None) for i, name in districts]
        out += [("sub", i, *e) for i, found in subs.items() for e in found]
        for r in plain:
            if r["kind"] == "district_alias":
                short = (r["a"] or "").removeprefix(self.district_name_prefix)
                keys = [("district_alias", r["a"]), ("district_name", r["a"])] + [("district_name", short)] * (short not in aliases)
                out += [(*k, *d, None, None, None) for k in keys for d in named.get(r["b"], [])]
            elif r["kind"] in ("sub_alias", "legacy"):
                out += [(r["kind"], r["a"], *e) for e in subs.get(r["b"], [])]
        return [e for e in out if e[1] is not None]

    # -- integrity (V9) -------------------------------------------------------------
    def check(self) -> "Geography":
        """Raise if ``integrity`` finds anything (one small job); returns the geography."""
        found = {k: n for k, n in self.integrity().first().asDict().items() if n}
        if found:
            raise ValueError(f"Geography dimension is not consistent: {found}")
        return self

    def integrity(self) -> DataFrame:
        """One row of violation counts; all must be 0.

        Orphans: aliases, sub-districts and legacy ids pointing nowhere.
        Duplicates: an alias or id that maps to more than one row (joins would fan out).
        """
        d_ids = self.districts.select("district_id")
        s_ids = self.subs.select("sub_id")
        orphan_d_alias = self.district_aliases.join(d_ids, "district_id", "left_anti").agg(F.count("*").alias("n"))
        orphan_sub = self.subs.join(d_ids, "district_id", "left_anti").agg(F.count("*").alias("n"))
        orphan_s_alias = self.sub_aliases.join(s_ids, "sub_id", "left_anti").agg(F.count("*").alias("n"))
        orphan_legacy = self.legacy.join(s_ids, "sub_id", "left_anti").agg(F.count("*").alias("n"))

        def dups(df: DataFrame, key: str) -> DataFrame:
            return (df.groupBy(key).agg(F.count("*").alias("c")).filter(F.col("c") > 1)
                    .agg(F.count("*").alias("n")))

        parts = {
            "orphan_district_aliases": orphan_d_alias, "orphan_subs": orphan_sub,
            "orphan_sub_aliases": orphan_s_alias, "orphan_legacy_ids": orphan_legacy,
            "duplicate_district_ids": dups(self.districts, "district_id"),
            "duplicate_sub_ids": dups(self.subs, "sub_id"),
            "duplicate_district_aliases": dups(self.district_aliases, "alias"),
            "duplicate_sub_aliases": dups(self.sub_aliases, "alias"),
            "duplicate_legacy_ids": dups(self.legacy, "old_id"),
        }
        return _one_row(parts)


def _one_row(parts: dict) -> DataFrame:
    items = list(parts.items())
    name0, df0 = items[0]
    out = df0.select(F.col("n").alias(name0))
    for name, df in items[1:]:
        out = out.select("*", df.select(F.col("n")).scalar().alias(name))
    return out


def local_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A small table of strings as a local relation, whose size Spark knows (so joins to it broadcast)."""
    names = [f.split()[0] for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c, pa.string()) for n, c in zip(names, columns, strict=True)}), schema)


def from_tables(spark: SparkSession, districts, subs, district_aliases, sub_aliases, legacy, **kw) -> Geography:
    """Build from DataFrames or lists of tuples (same column order as documented)."""
    def df(x, schema):
        return x if isinstance(x, DataFrame) else local_table(spark, x, schema)
    given = {"district": districts, "sub": subs, "district_alias": district_aliases, "sub_alias": sub_aliases, "legacy": legacy}
    lists = {k: [tuple(r) for r in x] for k, x in given.items() if not isinstance(x, DataFrame)}
    return Geography(
        local_rows=lists if len(lists) == len(given) else None,
        districts=df(districts, "district_id string, district_name string"),
        subs=df(subs, "sub_id string, sub_name string, district_id string"),
        district_aliases=df(district_aliases, "alias string, district_id string"),
        sub_aliases=df(sub_aliases, "alias string, sub_id string"),
        legacy=df(legacy, "old_id string, sub_id string"),
        **kw,
    )
