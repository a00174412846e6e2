from sluiceworks.functions.columns import (
    NULL_MARKER,
    count_where,
    decimal_sum,
    exact_sum,
    full_name,
    money,
    seconds,
)

__all__ = ["NULL_MARKER", "count_where", "decimal_sum", "exact_sum", "full_name", "money", "seconds"]
