from lanewise.operators.dedup import drop_duplicates, first_per_key, keys_are_unique, lowest_per_key
from lanewise.operators.encoding import encoded_values, one_hot, value_domains
from lanewise.operators.joins import join_groups, lookup
from lanewise.operators.packages import count_over, roll_up
from lanewise.operators.rolling import calendar_index, trailing_name, trailing_stats
from lanewise.operators.selection import (
    by_date,
    keep_between,
    keep_in,
    keep_present,
    lowercase_columns,
    select_columns,
    select_features,
    tag_by_date,
)

__all__ = [
    "by_date",
    "calendar_index",
    "count_over",
    "drop_duplicates",
    "first_per_key",
    "join_groups",
    "keep_between",
    "keep_in",
    "keep_present",
    "keys_are_unique",
    "lookup",
    "lowercase_columns",
    "lowest_per_key",
    "one_hot",
    "roll_up",
    "select_columns",
    "select_features",
    "tag_by_date",
    "trailing_name",
    "trailing_stats",
    "encoded_values",
    "value_domains",
]
