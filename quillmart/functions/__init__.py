"""Column-level helpers: built-in Spark expressions only (no Python UDFs)."""

from quillmart.functions.scalars import (
    coerce_bool,
    full_name,
    json_encode,
    json_first_scalar,
    url_id,
    zero_pad,
)
from quillmart.functions.timeutil import (
    days_between,
    end_of_day,
    hours_between,
    local_to_utc,
    parse_local_timestamp,
    today_in,
)

__all__ = [
    "coerce_bool", "full_name", "json_encode", "json_first_scalar", "url_id", "zero_pad",
    "days_between", "end_of_day", "hours_between", "local_to_utc",
    "parse_local_timestamp", "today_in",
]
