"""Data-quality rules enforced inside the plan (errors are part of the contract)."""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _non_finite(c: Column) -> Column:
    return F.isnan(c) | (c == F.lit(float("inf"))) | (c == F.lit(float("-inf")))


def assert_finite(df: DataFrame, columns: Iterable[str] | None = None, on_invalid: str = "error") -> DataFrame:
    """V6: no NaN or infinity in published numbers.

    ``on_invalid="error"`` fails the query; ``"null"`` publishes the value as missing.
    """
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not cols:
        return df
    if on_invalid == "null":
        return df.withColumns({c: F.when(_non_finite(F.col(c)), F.lit(None)).otherwise(F.col(c)) for c in cols})
    return df.withColumns({
        c: F.when(_non_finite(F.col(c)), F.raise_error(F.lit(f"Out of range float value in {c}")))
        .otherwise(F.col(c)) for c in cols})


def series_columns(series) -> list[str]:
    """The column names in a template's series argument (a list, nested lists or a mapping of lists)."""
    if isinstance(series, str):
        return [series]
    items = series.values() if isinstance(series, Mapping) else series
    return [c for x in items for c in series_columns(x)]


def assert_ratios(df: DataFrame, columns: Iterable[str], on_invalid: str = "error") -> DataFrame:
    """V6 for ratios: a value with a ratio column has a ratio.

    Division by zero gives NULL in the plan; where the value itself is there, that would be a non-finite
    number in the published document.  ``on_invalid="null"`` publishes the value without the ratio.
    """
    pairs = [(c, f"{c}_ratio") for c in columns if c in df.columns and f"{c}_ratio" in df.columns]
    if on_invalid == "null" or not pairs:
        return df
    return df.withColumns({r: F.when(F.col(c).isNotNull() & F.col(r).isNull(), F.raise_error(F.lit(f"Out of range float value in {r}")))
                           .otherwise(F.col(r)) for c, r in pairs})


def assert_single_name(df: DataFrame, id_col: str, name_col: str) -> DataFrame:
    """V5: one name per geography id (one row per id; fails otherwise)."""
    g = df.groupBy(id_col).agg(F.collect_set(name_col).alias("_names"))
    return g.select(id_col, F.when(F.size("_names") > 1, F.raise_error(F.lit("Multiple names for one geography id")))
                    .otherwise(F.get("_names", 0)).alias(name_col))
