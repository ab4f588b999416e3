"""Long -> wide pivots with an explicit category list.

The category list is part of the dataset specification, so the output schema
is static and no extra job runs to discover the distinct values.  Each output
cell is a conditional aggregate evaluated in the same hash aggregation (the
same thing Spark's own ``pivot`` compiles to), partially aggregated map-side.
"""

from __future__ import annotations

from typing import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _not_null(cols: Iterable[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def _names(values: "Iterable[str] | Mapping[str, str]") -> list[tuple[str, str]]:
    if isinstance(values, Mapping):
        return list(values.items())
    return [(v, v) for v in values]


def pivot_sum(df: DataFrame, index: Iterable[str], column: str, value: str,
              values: "Iterable[str] | Mapping[str, str]", fill: "int | float | None" = 0,
              zero_absent_columns: bool = False) -> DataFrame:
    """Sum ``value`` per (index x category).

    ``values`` lists the categories, or maps category -> output column; several
    categories may map to one column (they are summed).  Absent cells are
    ``fill`` (``None`` keeps them NULL); present cells sum with nulls skipped.
    With ``zero_absent_columns`` a category that occurs nowhere in the input
    gives 0 in every row (one global flag per category, a scalar subquery).
    Rows with a null index key or category do not take part.
    """
    index = list(index)
    outputs: dict[str, list[str]] = {}
    for cat, out in _names(values):
        outputs.setdefault(out, []).append(cat)
    base = df.filter(_not_null([*index, column]))
    anywhere = None
    if zero_absent_columns and fill is None:
        anywhere = base.agg(F.struct(*[F.max(F.col(column).isin(cats)).alias(out)
                                     for out, cats in outputs.items()]).alias("_p")).scalar()
    aggs = []
    for out, cats in outputs.items():
        hit = F.col(column).isin(cats)
        present = F.count(F.when(hit, F.lit(1))) > 0
        cell = F.coalesce(F.sum(F.when(hit, F.col(value))), F.lit(0))
        if fill is None:
            expr = F.when(present, cell)
            if anywhere is not None:
                expr = expr.when(F.coalesce(anywhere[out], F.lit(False)) == F.lit(False), F.lit(0))
            aggs.append(expr.alias(out))
        else:
            aggs.append(F.when(present, cell).otherwise(F.lit(fill)).alias(out))
    return base.groupBy(*index).agg(*aggs)


def pivot_mean(df: DataFrame, index: Iterable[str], column: str, value: str,
               values: "Iterable[str] | Mapping[str, str]") -> DataFrame:
    """Mean of ``value`` per (index x category); absent cells NULL; result is double."""
    index = list(index)
    aggs = [F.avg(F.when(F.col(column) == F.lit(cat), F.col(value).cast("double"))).alias(out)
            for cat, out in _names(values)]
    return df.filter(_not_null([*index, column])).groupBy(*index).agg(*aggs)


def pivot_regroup(df: DataFrame, column: str, value_columns: Iterable[str],
                  values: "Iterable[str] | Mapping[str, str]") -> DataFrame:
    """Pivot ``column`` and group by ALL other columns, summing (absent -> 0).

    With one value column the new columns are named by category; with several,
    ``<value>_<category>``.
    """
    value_columns = list(value_columns)
    keys = [c for c in df.columns if c != column and c not in value_columns]
    aggs = []
    for cat, out in _names(values):
        for v in value_columns:
            name = out if len(value_columns) == 1 else f"{v}_{out}"
            aggs.append(F.coalesce(F.sum(F.when(F.col(column) == F.lit(cat), F.col(v))), F.lit(0)).alias(name))
    return df.filter(_not_null([*keys, column])).groupBy(*keys).agg(*aggs)


def group_sum(df: DataFrame, index: Iterable[str], value_columns: Iterable[str]) -> DataFrame:
    """Pre-aggregating pivot without a column axis: a plain group-sum."""
    index = list(index)
    return (df.filter(_not_null(index)).groupBy(*index)
            .agg(*[F.coalesce(F.sum(v), F.lit(0)).alias(v) for v in value_columns]))


def unpivot(df: DataFrame, ids: Iterable[str], columns: Iterable[str], name: str = "category",
            value: str = "value") -> DataFrame:
    """Wide -> long (used to keep age tables long instead of 121 columns)."""
    return df.unpivot(list(ids), list(columns), name, value)
