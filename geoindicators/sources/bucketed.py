"""Bucketed intermediate tables: stored sources that are joined and rolled up without an exchange.

A source that is joined again and again is written once, dealt into buckets by its geography keys and sorted by them within each.
Two tables with the same bucket keys and number of buckets are then merged bucket by bucket, and a grouping by the
keys is local too.  A null key (a district row has no sub-district) would make the join null-safe, which hides the buckets from
Spark; so each key is also kept as text without nulls, and those columns are the bucket keys.
"""

from __future__ import annotations

import uuid
from typing import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoindicators.session import ensure_checkpoint_dir

PREFIX = "_b_"


def _key(name: str):
    """Null as an empty text; a present key starts with "=", so none is mistaken for it."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{name}`").cast("string")), F.lit(""))


def write_bucketed(df: DataFrame, keys: Iterable[str], buckets: int, name: str | None = None, path: str | None = None) -> str:
    """Write ``df`` as a table bucketed and sorted by ``keys``; returns the table's name.

    One shuffle by the bucket keys, so that each bucket is one file.  ``path`` defaults to a fresh folder in the
    cluster's checkpoint folder.
    """
    spark = df.sparkSession
    keys = list(keys)
    name = name or f"bucketed_{uuid.uuid4().hex}"
    path = path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}"
    cols = [PREFIX + k for k in keys]
    dealt = df.withColumns({PREFIX + k: _key(k) for k in keys}).repartition(buckets, *cols)
    dealt.write.format("parquet").mode("overwrite").bucketBy(buckets, *cols).sortBy(*cols).option("path", path).saveAsTable(name)
    return name


def _both(a: DataFrame, b: DataFrame) -> list[str]:
    keys = [c.removeprefix(PREFIX) for c in a.columns if c.startswith(PREFIX)]
    if not keys or keys != [c.removeprefix(PREFIX) for c in b.columns if c.startswith(PREFIX)]:
        raise ValueError("the tables are not bucketed by the same keys")
    return keys


def join_bucketed(spark: SparkSession, left: str, right: str, how: str = "inner") -> DataFrame:
    """Join two bucketed tables on their bucket keys, null keys matching null keys; key columns come once.

    A merge of sorted buckets: no exchange under the join (as long as neither side is so small that Spark broadcasts it).
    """
    a, b = spark.table(left), spark.table(right)
    keys = _both(a, b)
    a, b = a.alias("_l"), b.alias("_r").hint("merge")
    cond = [F.col(f"_l.`{PREFIX}{k}`") == F.col(f"_r.`{PREFIX}{k}`") for k in keys]
    joined = a.join(b, cond, how)
    side = {"inner": "_l", "left": "_l", "right": "_r"}.get(how)
    key_cols = [F.col(f"{side}.`{k}`").alias(k) if side else F.coalesce(F.col(f"_l.`{k}`"), F.col(f"_r.`{k}`")).alias(k) for k in keys]

    def rest(t: str, df: DataFrame) -> list:
        return [F.col(f"{t}.`{c}`").alias(c) for c in df.columns if c not in keys and not c.startswith(PREFIX)]

    return joined.select(*key_cols, *rest("_l", a), *rest("_r", b))


def sum_bucketed(spark: SparkSession, table: str, measures: Iterable[str]) -> DataFrame:
    """Sums per bucket key, without an exchange: a group lies in one bucket."""
    df = spark.table(table)
    keys = [c.removeprefix(PREFIX) for c in df.columns if c.startswith(PREFIX)]
    out = df.groupBy(*[PREFIX + k for k in keys]).agg(*[F.first(k).alias(k) for k in keys], *[F.sum(m).alias(m) for m in measures])
    return out.select(*keys, *measures)
