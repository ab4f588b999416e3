"""Changes over time: year-over-year, horizon changes, ratios, growth history.

All of these run on indicator rows, i.e. after the facts were aggregated to
one row per (year, geography): window partitions hold one geography's years,
so they are bounded by the calendar whatever the size of the raw data.

The lag is *positional* (previous available year), not calendar based: a gap
year compares with the last year present.  That is the documented contract.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from geoindicators.functions.nulls import safe_div
from geoindicators.keys import Keys


def yoy_change(df: DataFrame, value: str, out: str = "change", keys: Keys = Keys()) -> DataFrame:
    """``value - previous value`` of the same sub-district in year order.

    Rows without a sub-district get NULL (they form no group).
    """
    # rows without a sub-district have no series; the year keeps them from meeting in one partition
    w = Window.partitionBy(keys.sub_id, F.when(F.col(keys.sub_id).isNull(), F.col(keys.date))).orderBy(keys.date)
    diff = F.col(value) - F.lag(value).over(w)
    return df.withColumn(out, F.when(F.col(keys.sub_id).isNotNull(), diff))


def horizon_years(df: DataFrame, horizon: int = 10, date: str = "date") -> DataFrame:
    """Two-row table {max year, max year - horizon}; fails if the older year is absent."""
    ys = df.select(date).filter(F.col(date).isNotNull()).distinct()
    bounds = ys.agg(F.max(date).alias("_mx"), F.collect_set(date).alias("_ys"))
    checked = bounds.select(
        F.when(~F.array_contains("_ys", F.col("_mx") - F.lit(horizon)),
               F.raise_error(F.concat(F.lit("Dataset does not contain "), F.lit(str(horizon)),
                                      F.lit(" years before "), F.col("_mx").cast("string"))))
        .otherwise(F.array(F.col("_mx"), F.col("_mx") - F.lit(horizon))).alias("_pair")
    )
    return checked.select(F.explode("_pair").alias(date))


def horizon_set(df: DataFrame, horizon: int = 10, date: str = "date") -> DataFrame:
    """Keep only the newest year and the year ``horizon`` years earlier."""
    pair = horizon_years(df, horizon, date).agg(F.collect_list(date)).scalar()
    return df.filter(F.array_contains(pair, F.col(date)))


def horizon_change(df: DataFrame, value: str, horizon: int = 10, out: str = "change_10y",
                   keys: Keys = Keys()) -> DataFrame:
    """Change between the newest year and ``horizon`` years before, per sub-district.

    Returns (date, district_id, sub_id, out) for the two years; non-null only at
    the newest year.
    """
    pair = horizon_set(df.select(keys.date, keys.district_id, keys.sub_id, value), horizon, keys.date)
    return yoy_change(pair, value, out, keys).drop(value)


def change_ratios(df: DataFrame, population: str = "population", change: str = "change",
                  change_h: str | None = "change_10y", horizon: int = 10, keys: Keys = Keys()) -> DataFrame:
    """``change / population one row back`` and ``change_h / population horizon rows back``.

    Rows are ordered by year within (district, sub-district); the district and
    city rows (NULL sub-district) form their own series.
    """
    w = Window.partitionBy(keys.district_id, keys.sub_id).orderBy(keys.date)
    cols = {f"{change}_ratio": safe_div(F.col(change), F.lag(population, 1).over(w))}
    if change_h:
        cols[f"{change_h}_ratio"] = safe_div(F.col(change_h), F.lag(population, horizon).over(w))
    return df.withColumns(cols)


def pct_change_levels(df: DataFrame, value: str, out: str = "change", keys: Keys = Keys()) -> DataFrame:
    """``value / previous value - 1`` per geography series (city, district, sub-district)."""
    w = Window.partitionBy(keys.district_id, keys.sub_id).orderBy(keys.date)
    return df.withColumn(out, safe_div(F.col(value), F.lag(value).over(w)) - F.lit(1))


def growth_history(df: DataFrame, value: str, years: int = 10, keys: Keys = Keys(),
                   out: str = "history") -> DataFrame:
    """Per geography, the values of the last ``years`` years as an array ordered by year.

    Returns (district_id, sub_id, out: array<struct<date, value>>).  The newest
    year is taken over the whole input.
    """
    newest = df.agg(F.max(keys.date)).scalar()
    recent = df.filter(F.col(keys.date) > newest - F.lit(years))
    return (
        recent.groupBy(keys.district_id, keys.sub_id)
        .agg(F.array_sort(F.collect_list(F.struct(F.col(keys.date).alias("date"),
                                                  F.col(value).alias("value")))).alias(out))
    )
