"""Row filters with the contract's null rules."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoindicators.keys import Keys


def not_in_keep_null(column: str, values: Iterable) -> Column:
    """``column NOT IN values`` that keeps NULL (SQL's NOT IN would drop it)."""
    return F.col(column).isNull() | ~F.col(column).isin(list(values))


def drop_districts(df: DataFrame, ids: Iterable[str], keys: Keys = Keys()) -> DataFrame:
    return df.filter(not_in_keep_null(keys.district_id, ids))


def drop_non_residential(df: DataFrame, keys: Keys = Keys()) -> DataFrame:
    return drop_districts(df, keys.non_residential, keys)


def drop_city(df: DataFrame, keys: Keys = Keys()) -> DataFrame:
    return df.filter(F.col(keys.district_id).isNull() | (F.col(keys.district_id) != F.lit(keys.city_id)))


def not_equal_keep_null(column: str, value) -> Column:
    """``column != value`` keeping NULL rows (dataframe-library semantics)."""
    return F.col(column).isNull() | (F.col(column) != F.lit(value))


def drop_unresolved(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows whose geography resolved (all ``columns`` non-null)."""
    cond = F.lit(True)
    for c in columns:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def count_unresolved(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """One-row table with the number of rows that ``drop_unresolved`` rejects."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNull()
    return df.agg(F.count(F.when(cond, F.lit(1))).alias("rejected"))


def drop_nulls(df: DataFrame, how: str = "any", subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows with nulls (NaN counts as null): ``how`` is ``any`` or ``all``."""
    return df.dropna(how=how, subset=list(subset) if subset else None)


def dedup(df: DataFrame) -> DataFrame:
    """Full-row distinct (nulls equal); duplicates are combined map-side first."""
    return df.dropDuplicates()


def distinct_keys(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.select(*columns).distinct()
