"""Joins with heavy hitters: frequent keys of the fact side are found by a sketch and only they are split.

A sketch of the key hashes (bounded: ``TRACKED`` counters a task, merged) gives every key that holds more than ``share`` of the
fact rows.  A found key gets as many salts as it holds shares: its fact rows are dealt over the salts by a hash of the row, and
its rows on the other side are repeated once per salt.  All other rows keep salt 0, so unlike ``joins.salted_join``
nothing else is repeated or moved apart.  Both sides decide by the hash of the key, so a hash collision only salts a
key that needn't be.  Results equal the plain join's.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoindicators.operators.joins import join_on

TRACKED = 10_000
MOST_KEYS = 100


def _hash(keys: Iterable[str]) -> Column:
    return F.xxhash64(*[F.col(f"`{k}`") for k in keys])


def frequent_keys(df: DataFrame, keys: Iterable[str], share: float = 0.02) -> dict[int, float]:
    """{key hash: share of the rows} of the keys with more than ``share`` of ``df``'s rows (0.01 at least: ``MOST_KEYS`` keys).

    One pass with a map-side sketch; one row reaches the driver.  The sketch may overstate a key by 1/7,500 of the rows, never
    lose one.  Rows with equal keys count together, null keys too; an empty table has none.
    """
    if share < 1 / MOST_KEYS:
        raise ValueError(f"share must be {1 / MOST_KEYS} or more")
    hashed = df.select(_hash(keys).alias("h"))
    row = hashed.agg(F.count(F.lit(1)).alias("n"), F.expr(f"approx_top_k(h, {MOST_KEYS}, {TRACKED})").alias("top")).first()
    return {t["item"]: t["count"] / row["n"] for t in row["top"] or [] if t["count"] > share * row["n"]} if row["n"] else {}


def salts_of(frequent: dict[int, float], share: float) -> dict[int, int]:
    """Salts of each frequent key: as many as give each salt ``share`` of all rows at most."""
    return {h: max(2, int(-(-part // share))) for h, part in frequent.items()}


def _salts(keys: list[str], salts: dict[int, int]) -> Column:
    pairs = [x for h, n in sorted(salts.items()) for x in (F.lit(h).cast("bigint"), F.lit(n))]
    return F.coalesce(F.element_at(F.create_map(*pairs), _hash(keys)), F.lit(1))


def with_salt(facts: DataFrame, keys: Iterable[str], salts: dict[int, int], salt_by: Iterable[str] | None = None) -> DataFrame:
    """Fact rows with column ``_salt``, dealt by a hash of ``salt_by`` (default: all columns), so that a retried task repeats it."""
    by = [F.col(f"`{c}`") for c in (salt_by or facts.columns)]
    return facts.withColumn("_salt", F.pmod(F.xxhash64(*by), _salts(list(keys), salts)).cast("int"))


def hot_join(facts: DataFrame, other: DataFrame, keys: Iterable[str], how: str = "inner", share: float = 0.02,
             null_safe: Iterable[str] = (), salt_by: Iterable[str] | None = None) -> DataFrame:
    """Join ``facts`` with ``other`` on ``keys`` where few keys may hold a large part of the facts.

    ``how`` is inner or left.  Keys in ``null_safe`` match null with null.  Fact rows that are equal in all of ``salt_by`` (default: all
    columns) share a salt, so name an id there if many rows are equal.  Without frequent keys this is the plain join.
    """
    if how not in ("inner", "left"):
        raise ValueError("hot_join supports inner and left joins")
    keys = list(keys)
    salts = salts_of(frequent_keys(facts, keys, share), share)
    if not salts:
        return join_on(facts, other, keys, how, null_safe)
    repeated = other.withColumn("_salt", F.explode(F.sequence(F.lit(0), _salts(keys, salts) - 1)))
    return join_on(with_salt(facts, keys, salts, salt_by), repeated, [*keys, "_salt"], how, null_safe).drop("_salt")
