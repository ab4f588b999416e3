"""Three-level roll-up (sub-district -> district -> city) and its relatives.

``aggregate`` is the core operator.  For distributive aggregates (sum) it works in
two stages: the facts are aggregated once at the finest key (null sub-districts
kept), map-side first, so the shuffle carries at most (years x geographies x extra
categories) rows per task whatever the input size, and a hot geography holding a
third of the rows costs no more than any other.  The three levels then come out
of those small rows with ``GROUPING SETS``; no fact row is ever expanded.  For
non-distributive or strict aggregates sub-district and district come from the base
rows and the city from the (small) district result.
"""

from __future__ import annotations

from typing import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoindicators.functions.nulls import coalesced_sum, numeric_columns, row_sum_skip, safe_div, strict_sum
from geoindicators.keys import Keys
from geoindicators.session import materialize

AggSpec = "str | Callable[[Column], Column]"


def _agg_expr(name: str, how) -> Column:
    if callable(how):
        return how(F.col(name)).alias(name)
    if how == "sum":
        return coalesced_sum(name).alias(name)
    if how == "strict":
        return strict_sum(name, name).alias(name)
    if how in ("min", "max", "mean", "avg", "count"):
        fn = {"mean": "avg"}.get(how, how)
        return getattr(F, fn)(F.col(name)).alias(name)
    raise ValueError(f"Unknown aggregate {how!r} for column {name!r}")


def _resolve_config(df: DataFrame, keys: Keys, extra: list[str], config) -> dict:
    group_cols = set(keys.all()) | set(extra)
    measures = numeric_columns(df, exclude=group_cols)
    if isinstance(config, str) or callable(config):
        return {m: config for m in measures}
    wrong = [m for m in config if m not in measures]
    if wrong:
        raise ValueError(f"Not numeric measures of the input: {wrong} (measures: {measures})")
    return dict(config)


def _non_null(cols: Iterable[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


def not_city(keys: Keys) -> Column:
    """Rows that are not city rows (rows with a null district are kept)."""
    return F.col(keys.district_id).isNull() | (F.col(keys.district_id) != F.lit(keys.city_id))


def aggregate(df: DataFrame, config: "str | Mapping[str, AggSpec]" = "sum", keys: Keys = Keys(),
              extra: Iterable[str] = (), exclude_city: bool = False) -> DataFrame:
    """Roll measures up to sub-district, district and city level.

    * ``config``: ``"sum"`` for every numeric non-key column, or a mapping
      column -> ``"sum" | "strict" | "min" | "max" | "mean" | callable``.
      ``"sum"`` for all leaves out non-numeric columns; a mapping that names a column
      that is absent or not numeric is an error.
    * ``extra``: further dimensions kept at every level.
    * Null rule: rows with a null date, district id/name or extra dimension
      are ignored; rows with a null sub-district count at district and city
      level but form no sub-district group.
    * ``exclude_city``: drop city rows already present in the input.
    """
    extra = list(extra)
    cfg = _resolve_config(df, keys, extra, config)
    k = keys
    base = df.filter(_non_null([k.date, k.district_id, k.district_name, *extra]))
    if exclude_city:
        base = base.filter(not_city(k))
    base = base.select(*k.all(), *extra, *cfg.keys())
    distributive = all(how == "sum" for how in cfg.values())

    sub_set = [k.date, k.district_id, k.district_name, k.sub_id, k.sub_name, *extra]
    district_set = [k.date, k.district_id, k.district_name, *extra]
    city_set = [k.date, *extra]
    aggs = [_agg_expr(m, how) for m, how in cfg.items()]

    sets = [sub_set, district_set, city_set] if distributive else [sub_set, district_set]
    if distributive:
        base = base.groupBy(*sub_set).agg(*aggs)
    grouped = (
        base.groupingSets(sets, *sub_set)
        .agg(*aggs, F.grouping(k.sub_id).alias("_g_sub"), F.grouping(k.district_id).alias("_g_district"))
    )
    # a sub-district group needs both sub id and name; null ones are dropped
    grouped = grouped.filter(
        (F.col("_g_sub") == 1) | (F.col(k.sub_id).isNotNull() & F.col(k.sub_name).isNotNull())
    )
    if not distributive:
        district_rows = grouped.filter(F.col("_g_sub") == 1)
        city = (
            district_rows.groupBy(*city_set)
            .agg(*[_agg_expr(m, how) for m, how in cfg.items()])
            .withColumns({"_g_sub": F.lit(1), "_g_district": F.lit(1),
                          k.district_id: F.lit(None).cast("string"), k.district_name: F.lit(None).cast("string"),
                          k.sub_id: F.lit(None).cast("string"), k.sub_name: F.lit(None).cast("string")})
        )
        grouped = grouped.unionByName(city.select(*grouped.columns))
    is_city = F.col("_g_district") == 1
    out = grouped.withColumns({
        k.district_id: F.when(is_city, F.lit(k.city_id)).otherwise(F.col(k.district_id)),
        k.district_name: F.when(is_city, F.lit(k.city_name)).otherwise(F.col(k.district_name)),
    })
    return out.select(*k.all(), *extra, *cfg.keys())


def add_ratios(df: DataFrame, data_points: Iterable[str], ratio_of: Iterable[str]) -> DataFrame:
    """``<m>_ratio = m / (sum of ratio_of, nulls as 0)``; NULL on a zero denominator."""
    denominator = row_sum_skip(list(ratio_of))
    return df.withColumns({f"{dp}_ratio": safe_div(F.col(dp), denominator) for dp in data_points})


def presum(df: DataFrame, keys: Keys = Keys(), extra: Iterable[str] = ()) -> DataFrame:
    """Collapse duplicate rows: group-sum every measure on the full key (null keys dropped)."""
    group = [*keys.all(), *extra]
    measures = numeric_columns(df, exclude=group)
    return (df.filter(_non_null(group)).groupBy(*group)
            .agg(*[coalesced_sum(m).alias(m) for m in measures]))


def add_city_total(df: DataFrame, category: str, keys: Keys = Keys()) -> DataFrame:
    """Append a city row per (date, category) summing the district rows.

    The district rows (years x districts x categories) are written once, so that what made them runs
    once for the two readers.
    """
    df = materialize(df)
    group = [keys.date, category]
    measures = numeric_columns(df, exclude=[*keys.all(), category])
    city = (df.filter(_non_null(group)).groupBy(*group)
            .agg(*[coalesced_sum(m).alias(m) for m in measures])
            .withColumns({keys.district_id: F.lit(keys.city_id), keys.district_name: F.lit(keys.city_name)}))
    return df.unionByName(city, allowMissingColumns=True)


def district_city_totals(df: DataFrame, keys: Keys = Keys(), extra: Iterable[str] = ()) -> DataFrame:
    """District and city totals for sources that have no sub-district level."""
    extra = list(extra)
    k = keys
    district_set = [k.date, k.district_id, k.district_name, *extra]
    measures = numeric_columns(df, exclude=[*k.all(), *extra])
    base = (df.filter(_non_null(district_set)).groupBy(*district_set)
            .agg(*[coalesced_sum(m).alias(m) for m in measures]))
    grouped = (base.groupingSets([district_set, [k.date, *extra]], *district_set)
               .agg(*[coalesced_sum(m).alias(m) for m in measures],
                    F.grouping(k.district_id).alias("_g_district")))
    is_city = F.col("_g_district") == 1
    return grouped.withColumns({
        k.district_id: F.when(is_city, F.lit(k.city_id)).otherwise(F.col(k.district_id)),
        k.district_name: F.when(is_city, F.lit(k.city_name)).otherwise(F.col(k.district_name)),
    }).select(*district_set, *measures)


def district_only(df: DataFrame, config="sum", keys: Keys = Keys(), ignore_districts: Iterable[str] = (),
                  extra: Iterable[str] = ()) -> DataFrame:
    """Roll up, then keep the district and city rows (sub-district null)."""
    ignore = list(ignore_districts)
    if ignore:
        df = df.filter(F.col(keys.district_id).isNull() | ~F.col(keys.district_id).isin(ignore))
    return aggregate(df, config, keys, extra).filter(F.col(keys.sub_id).isNull())


def level(keys: Keys = Keys()) -> Column:
    """'sub' | 'district' | 'city' from the key columns."""
    return (F.when(F.col(keys.sub_id).isNotNull(), F.lit("sub"))
            .when(F.col(keys.district_id) == F.lit(keys.city_id), F.lit("city"))
            .otherwise(F.lit("district")))
