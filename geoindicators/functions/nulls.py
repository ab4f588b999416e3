"""Null, NaN and rounding rules as Spark ``Column`` expressions.

The indicator contract was written against a dataframe library in which NaN and
null are the same thing, sums of nothing are zero and rounding is
round-half-to-even on the binary value.  These helpers pin those rules down so
that no operator has to think about them again.  All of them are built-in
expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ColumnOrName = "Column | str"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                 T.DoubleType, T.DecimalType)


def is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, NUMERIC_TYPES)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if is_numeric(f.dataType) and f.name not in skip]


def nan_to_null(c) -> Column:
    """NaN becomes NULL; everything else passes through."""
    c = _c(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def normalise_nans(df: DataFrame) -> DataFrame:
    """Apply ``nan_to_null`` to every floating point column (ingest rule)."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.FloatType, T.DoubleType))}
    if not floats:
        return df
    return df.withColumns({n: nan_to_null(n) for n in floats})


def coalesced_sum(c) -> Column:
    """Sum that skips nulls and gives 0 (not NULL) for an all-null group."""
    return F.coalesce(F.sum(_c(c)), F.lit(0))


def strict_sum(c, label: str = "value") -> Column:
    """Sum whose inputs must be all null (-> NULL) or all present (-> sum).

    A mix of null and non-null inputs is a data error and fails the query.
    """
    c = _c(c)
    present = F.count(c)
    rows = F.count(F.lit(1))
    return (
        F.when(present == 0, F.lit(None).cast("double"))
        .when(present < rows, F.raise_error(F.lit(f"Mix of null and values in strict sum of {label}")))
        .otherwise(F.sum(c).cast("double"))
    )


def safe_div(a, b) -> Column:
    """Division that yields NULL for a zero or null denominator."""
    return F.try_divide(_c(a), _c(b))


def row_sum_skip(cols: Iterable) -> Column:
    """Row-wise sum where nulls count as 0 (an all-null row sums to 0)."""
    cols = list(cols)
    return reduce(lambda a, b: a + b, [F.coalesce(_c(c), F.lit(0)) for c in cols])


def row_sum_propagate(cols: Iterable) -> Column:
    """Row-wise ``a + b + ...``: null as soon as one operand is null."""
    cols = list(cols)
    return reduce(lambda a, b: a + b, [_c(c) for c in cols])


def round4(c) -> Column:
    """Round to 4 decimals, half-to-even on the binary value (``rint``)."""
    return F.rint(_c(c).cast("double") * F.lit(10000.0)) / F.lit(10000.0)


def round_numeric(df: DataFrame, exclude: Iterable[str] = ()) -> DataFrame:
    """``round4`` on every floating point column (integers are left alone)."""
    skip = set(exclude)
    floats = [f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.FloatType, T.DoubleType, T.DecimalType)) and f.name not in skip]
    if not floats:
        return df
    return df.withColumns({n: round4(n) for n in floats})


def clean_number(c) -> Column:
    """Lenient number: drop blanks used as thousand separators, NULL if not numeric."""
    text = F.regexp_replace(_c(c).cast("string"), r"\s", "")
    return text.try_cast("double")


def to_int_lenient(c) -> Column:
    """``int(float(x))`` with a catch: text or number to integer, else NULL."""
    return _c(c).cast("string").try_cast("double").try_cast("long")
