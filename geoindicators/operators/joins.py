"""Joins: null-safe natural joins, semi-joins, salted joins.

Nothing here forces a broadcast: dimension tables are small Parquet scans or local
relations, whose bytes Spark knows, and AQE broadcasts other sides when their
shuffled size turns out to be under the threshold.

Null keys match null keys in the indicator contract (a district row has a null
sub-district on both sides of a join), so every key comparison here is
``<=>`` (``eqNullSafe``).  ``USING`` joins would silently drop those rows.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

def null_safe_on(left: DataFrame, right: DataFrame, keys: Iterable[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def natural_join(*dfs: DataFrame, how: str = "inner") -> DataFrame:
    """Left fold of joins on ALL common columns, null keys matching null keys.

    For outer joins the key columns are coalesced from both sides, so a key
    that exists on one side only is kept.
    """
    def join2(a: DataFrame, b: DataFrame) -> DataFrame:
        common = [c for c in a.columns if c in b.columns]
        if not common:
            raise ValueError("natural_join: no common columns")
        la, rb = a.alias("_l"), b.alias("_r")
        cond = reduce(lambda x, y: x & y,
                      [F.col(f"_l.`{c}`").eqNullSafe(F.col(f"_r.`{c}`")) for c in common])
        joined = la.join(rb, cond, how)
        if how in ("inner", "left", "left_outer"):
            key_cols = [F.col(f"_l.`{c}`").alias(c) for c in common]
        elif how in ("right", "right_outer"):
            key_cols = [F.col(f"_r.`{c}`").alias(c) for c in common]
        else:
            key_cols = [F.coalesce(F.col(f"_l.`{c}`"), F.col(f"_r.`{c}`")).alias(c) for c in common]
        rest_a = [F.col(f"_l.`{c}`").alias(c) for c in a.columns if c not in common]
        rest_b = [F.col(f"_r.`{c}`").alias(c) for c in b.columns if c not in common]
        return joined.select(*key_cols, *rest_a, *rest_b)

    return reduce(join2, dfs)


def join_on(left: DataFrame, right: DataFrame, keys: Iterable[str], how: str = "inner",
            null_safe: Iterable[str] = ()) -> DataFrame:
    """Join on ``keys``; the ones listed in ``null_safe`` compare with ``<=>``."""
    keys = list(keys)
    ns = set(null_safe)
    la, rb = left.alias("_l"), right.alias("_r")
    cond = reduce(lambda x, y: x & y, [
        (F.col(f"_l.`{k}`").eqNullSafe(F.col(f"_r.`{k}`")) if k in ns
         else F.col(f"_l.`{k}`") == F.col(f"_r.`{k}`")) for k in keys])
    joined = la.join(rb, cond, how)
    if how in ("full", "outer", "full_outer"):
        key_cols = [F.coalesce(F.col(f"_l.`{k}`"), F.col(f"_r.`{k}`")).alias(k) for k in keys]
    elif how in ("right", "right_outer"):
        key_cols = [F.col(f"_r.`{k}`").alias(k) for k in keys]
    else:
        key_cols = [F.col(f"_l.`{k}`").alias(k) for k in keys]
    if how in ("left_semi", "semi", "left_anti", "anti"):
        return joined
    rest_l = [F.col(f"_l.`{c}`").alias(c) for c in left.columns if c not in keys]
    rest_r = [F.col(f"_r.`{c}`").alias(c) for c in right.columns if c not in keys]
    return joined.select(*key_cols, *rest_l, *rest_r)


def semi_join_present(df: DataFrame, other: DataFrame, column: str, null_matches: bool = True) -> DataFrame:
    """Keep rows of ``df`` whose ``column`` value occurs in ``other``.

    Membership follows the dataframe-library rule the contract was written in:
    a null value is "present" when ``other`` has a null too (``null_matches``).
    The distinct key set is pre-aggregated map-side before it is shuffled.
    """
    present = other.select(F.col(column).alias("_k")).distinct()
    cond = df[column].eqNullSafe(present["_k"]) if null_matches else df[column] == present["_k"]
    return df.join(present, cond, "left_semi")


def salted_join(left: DataFrame, right: DataFrame, keys: Iterable[str], salts: int = 16,
                how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` when one key of ``left`` may hold a large share of its rows.

    Each left row gets a salt in ``[0, salts)`` from a hash of the whole row
    (deterministic, so a retried task reproduces it) and each right row is
    repeated once per salt (``explode``, not a cross join), so a hot key is
    spread over ``salts`` tasks.  Use it where AQE skew-join splitting is not
    available; results equal the plain join.  ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left", "left_outer"):
        raise ValueError("salted_join supports inner and left joins")
    keys = list(keys)
    salted_left = left.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in left.columns]), F.lit(salts)))
    salted_right = right.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted_left.join(salted_right, [*keys, "_salt"], how).drop("_salt")
