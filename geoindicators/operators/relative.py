"""Values relative to the own district and to the city, for the same year."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoindicators.functions.nulls import safe_div
from geoindicators.keys import Keys
from geoindicators.operators.filters import not_in_keep_null


def _only(name: str) -> Column:
    """The value that all rows of a group share; an error if they differ."""
    c = F.col(name)
    differ = (F.min(c) != F.max(c)) | ((F.count(c) > 0) & (F.count(c) < F.count(F.lit(1))))
    return F.when(differ, F.raise_error(F.lit(f"Several reference rows for {name}"))).otherwise(F.max(c))


def add_relative_ratio(df: DataFrame, ratio_col: str, keys: Keys = Keys(),
                       keep: list[str] | None = None) -> DataFrame:
    """``<c>_district = c / own district's c`` and ``<c>_oslo = c / city's c``, same year.

    Non-residential districts are dropped first.  The reference values are the
    district row (NULL sub-district) and the city row of the year; a missing
    reference row is a data error, and so are several that differ.  Rows without a
    district take no part.  The reference tables hold one row per
    (year, district) and per year: they are joined by key (AQE broadcasts them
    at runtime), so the indicator rows are never shuffled by year alone.
    Returns the key columns, ``keep`` columns and the two ratios.
    """
    k = keys
    rows = df.filter(F.col(k.district_id).isNotNull() & not_in_keep_null(k.district_id, list(k.non_residential)))
    district_ref = (rows.filter(F.col(k.sub_id).isNull())
                    .groupBy(k.date, k.district_id).agg(_only(ratio_col).alias("_dref")))
    city_ref = (rows.filter(F.col(k.district_id) == F.lit(k.city_id))
                .groupBy(k.date).agg(_only(ratio_col).alias("_cref")))
    joined = (rows.join(district_ref.withColumn("_dhit", F.lit(True)), [k.date, k.district_id], "left")
              .join(city_ref.withColumn("_chit", F.lit(True)), [k.date], "left"))
    missing = F.col("_dhit").isNull() | F.col("_chit").isNull()
    d_col, o_col = f"{ratio_col}_district", f"{ratio_col}_oslo"
    out = joined.withColumns({
        d_col: F.when(missing, F.raise_error(F.lit(f"Reference row missing for {ratio_col}")))
        .otherwise(safe_div(F.col(ratio_col), F.col("_dref"))),
        o_col: safe_div(F.col(ratio_col), F.col("_cref")),
    })
    return out.select(*k.all(), *(keep or []), d_col, o_col)
