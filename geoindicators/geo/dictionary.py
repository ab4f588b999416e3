"""One key dictionary for all lookups of a geography.

All kinds of keys (ids, aliases, names without their prefix, legacy ids) are entries of one table, keyed by "kind:key".  An entry
holds the whole place: district, sub-district and the sub-district's own district; so a lookup never needs a second one for its
parent or for another spelling.  The table is a local relation whose bytes Spark knows: a lookup is a broadcast hash
join in the scan stage, and all lookups of a plan share the one broadcast.

(Lookups as expressions on an array of slots need no join at all, but every filter on a resolved column is then pushed below the
lookup and repeats it for each reference: 1,400 CASE branches for two chained lookups.  Joins keep each lookup a column.)

Its size is the dictionary's alone: the caller checks rows and bytes before it builds one.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ("district_id", "district_name", "sub_id", "sub_name", "parent_id")


class KeyDictionary:
    """entries: (kind, key, *FIELDS) tuples of text; a kind and key that occurs with two different contents is an error."""

    def __init__(self, spark: SparkSession, entries: list[tuple]):
        found: dict[str, tuple] = {}
        for kind, key, *fields in entries:
            name = f"{kind}:{key}"
            if found.setdefault(name, tuple(fields)) != tuple(fields):
                raise ValueError(f"the geography's {kind} {key!r} leads to more than one place")
        self.keys = len(found)
        names = sorted(found)
        columns = {"key": pa.array(names, pa.string()), **{f: pa.array([found[n][i] for n in names], pa.string()) for i, f in enumerate(FIELDS)}}
        self.table: DataFrame = spark.createDataFrame(pa.table(columns))

    def find(self, df: DataFrame, kind: str, key: Column, out: str) -> DataFrame:
        """Add column ``out``: the entry (a struct of FIELDS) of a row's key, null for an unknown or a null key."""
        right = self.table.select(F.col("key").alias(f"{out}_key"), F.struct(*FIELDS).alias(out))
        left = df.withColumn(f"{out}_own", F.concat(F.lit(f"{kind}:"), key))
        return left.join(right, F.col(f"{out}_own") == F.col(f"{out}_key"), "left").drop(f"{out}_own", f"{out}_key")
