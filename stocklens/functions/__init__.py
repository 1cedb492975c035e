from .core import (  # noqa: F401
    count_where,
    epoch_millis,
    kept_if,
    landed_once,
    latest_per_key,
    money,
    normalise_keys,
    normal_key,
    not_below_zero,
    parse_time,
    ratio,
    sum_long,
    sum_money,
    timestamp_lit,
)
