"""Population by age band, on long (one row per age) data.

The source tables are long: (year, geography, gender, age, count).  Rather than
pivot them to 121 age columns, a band is a range filter followed by a group-sum,
which prunes columns at the scan and aggregates map-side.
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoindicators.functions.nulls import coalesced_sum
from geoindicators.keys import Keys

MAX_AGE = 120


def band_population(df: DataFrame, age: str = "age", value: str = "count", min_age: int = 0,
                    max_age: int = 200, keys: Keys = Keys(), out: str = "population", oldest: int = MAX_AGE) -> DataFrame:
    """Population per (year, geography) for ages ``min_age..min(max_age, oldest)``, all genders.

    ``oldest`` is the last age of the published tables (120); ages beyond it belong to no band.  Ages absent from the data simply contribute nothing.  Rows with a null key
    are ignored.
    """
    hi = min(max_age, oldest)
    group = keys.all()
    cond = F.col(age).between(min_age, hi)
    for c in group:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond).groupBy(*group).agg(coalesced_sum(value).alias(out))


def total_population(df: DataFrame, value: str = "count", keys: Keys = Keys(),
                     out: str = "population") -> DataFrame:
    """Population per (year, district, sub-district) over all ages and genders; rows with a null key form no group."""
    group = [keys.date, keys.district_id, keys.sub_id]
    return df.dropna(subset=group).groupBy(*group).agg(coalesced_sum(value).alias(out))


def age_prefix(df: DataFrame, age: str = "age", value: str = "count", keys: Keys = Keys(), oldest: int = MAX_AGE) -> DataFrame:
    """Cumulative counts per key and age, (keys, ``age``, ``upto``): ``upto`` sums all ages up to and including ``age``.

    One aggregation of the population serves any number of bands (``bands``).  The sums run over the few ages of one
    key, on rows that are aggregated already.  Rows with a null key or age and ages over ``oldest`` take no part;
    a key without people in the published ages has no rows.
    """
    group = keys.all()
    cond = F.col(age).between(-(1 << 30), oldest)
    for c in group:
        cond = cond & F.col(c).isNotNull()
    counts = df.filter(cond).groupBy(*group, F.col(age).alias("age")).agg(coalesced_sum(value).alias("_n"))
    running = Window.partitionBy(*group).orderBy("age").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(*group, "age", F.sum("_n").over(running).alias("upto"))


def bands(prefix: DataFrame, wanted: Mapping[str, tuple[int, int]], keys: Keys = Keys()) -> DataFrame:
    """One row per key with a column per band (name -> first and last age): the difference of two prefix entries.

    The entry of an age that does not occur is that of the next lower one, 0 below the first.  A band without people is
    null, so a key that ``band_population`` would leave out can be told from one that counts 0.
    """
    def at(last: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("age") <= last, F.struct("age", "upto")))["upto"], F.lit(0))

    def there(lo: int, hi: int) -> Column:
        return F.count_if(F.col("age").between(lo, hi)) > 0

    return prefix.groupBy(*keys.all()).agg(*[F.when(there(lo, hi), at(hi) - at(lo - 1)).alias(name) for name, (lo, hi) in wanted.items()])
