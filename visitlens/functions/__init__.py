"""Column-expression helpers: buckets, rounding, packed records, date keys, SQL functions."""

from visitlens.functions.columns import (  # noqa: F401
    STEP_BUCKETS, VISIT_BUCKETS, bucket_label, concat_long_string, date_hour_key,
    group_concat_distinct, half_up_ratio, json_field, minute_key, nonempty,
    pack_record, packed_field, parse_action_time, split_ids,
)
from visitlens.functions.sql import register_sql_functions  # noqa: F401
