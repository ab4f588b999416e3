"""Year alignment across sources.

The years of an input are pre-aggregated map-side to one row per distinct year, so
their number is bounded by the calendar, not by the data.  A set of years is a scalar
subquery (one array) and a single year one value; both filter the rows in place, so
nothing is shuffled by year.  Callers pass rows that are small already (rolled up and
materialized), because finding the years reads the input once more.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def years(df: DataFrame, date: str = "date") -> DataFrame:
    return df.select(date).filter(F.col(date).isNotNull()).distinct()


def common_years(*dfs: DataFrame, date: str = "date") -> DataFrame:
    return reduce(lambda a, b: a.intersect(b), [years(d, date) for d in dfs])


def historic(*dfs: DataFrame, date: str = "date") -> list[DataFrame]:
    """Restrict every input to the years present in ALL inputs (may be empty)."""
    common = common_years(*dfs, date=date).agg(F.collect_list(date)).scalar()
    return [d.filter(F.array_contains(common, F.col(date))) for d in dfs]


def latest_common_year(*dfs: DataFrame, date: str = "date") -> DataFrame:
    """One-row table with the newest year shared by all inputs; fails if none."""
    latest = common_years(*dfs, date=date).agg(F.max(date).alias("_y"))
    return latest.select(
        F.when(F.col("_y").isNull(), F.raise_error(F.lit("No overlapping years in dataframes")))
        .otherwise(F.col("_y")).alias(date)
    )


def status(*dfs: DataFrame, date: str = "date") -> list[DataFrame]:
    """Restrict every input to the newest year they all share; error if none."""
    latest = latest_common_year(*dfs, date=date).scalar()
    return [d.filter(F.col(date) == latest) for d in dfs]


def keep_newest(df: DataFrame, date: str = "date", drop_date: bool = True) -> DataFrame:
    """Rows at the input's own newest year; the year column is dropped."""
    newest = df.agg(F.max(date)).scalar()
    out = df.filter(F.col(date) == newest)
    return out.drop(date) if drop_date else out


def shift_years(df: DataFrame, by: int, date: str = "date") -> DataFrame:
    """Move a measure to another reference year (e.g. a Q4 count to 1 January)."""
    return df.withColumn(date, F.col(date) + F.lit(by))


def newest_of(df: DataFrame, *aggregates: Column, date: str = "date") -> DataFrame:
    """One row with the aggregates over the rows of the newest year, in one pass over the input.

    Every task carries one partial result a year (map-side); of the merged ones the newest year's is kept.  Rows without
    a year don't count; without any year all aggregates are null.
    """
    by_year = df.filter(F.col(date).isNotNull()).groupBy(date).agg(*aggregates)
    names = [c for c in by_year.columns if c != date]
    newest = by_year.agg(F.max_by(F.struct(*names), F.col(date)).alias("_newest"))
    return newest.select(*[F.col("_newest")[n].alias(n) for n in names])
