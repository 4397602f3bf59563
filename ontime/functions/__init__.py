"""Column expressions used across the library."""

from ontime.functions.expressions import (  # noqa: F401
    BUCKET_DELAYED,
    BUCKET_EARLY,
    BUCKET_ON_TIME,
    BUCKET_SLIGHT,
    BUCKET_UNKNOWN,
    cyclical,
    delay_bucket,
    delayed_flag,
    hash_fraction_predicate,
    hash_unit,
    hhmm_hour,
    is_missing,
    is_valid_number,
    minutes_of_day,
    pct,
    to_double,
)
