from geoindicators.functions.nulls import (
    clean_number,
    coalesced_sum,
    nan_to_null,
    normalise_nans,
    numeric_columns,
    round4,
    round_numeric,
    row_sum_propagate,
    row_sum_skip,
    safe_div,
    strict_sum,
    to_int_lenient,
)

__all__ = [
    "clean_number", "coalesced_sum", "nan_to_null", "normalise_nans", "numeric_columns", "round4",
    "round_numeric", "row_sum_propagate", "row_sum_skip", "safe_div", "strict_sum", "to_int_lenient",
]
