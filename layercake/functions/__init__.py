"""Column -> Column functions used by the silver and gold layers."""

from layercake.functions._util import trim_spaces
from layercake.functions.codes import fallback, map_codes
from layercake.functions.dates import lenient_date, null_if_future, parse_int_date, previous_day
from layercake.functions.flags import missing_flag
from layercake.functions.numbers import repair_amount, round_to_long
from layercake.functions.text import (
    split_composite_key,
    squeeze_spaces,
    strip_chars,
    strip_prefix,
    title_case,
)

__all__ = [
    "fallback",
    "lenient_date",
    "map_codes",
    "missing_flag",
    "null_if_future",
    "parse_int_date",
    "previous_day",
    "repair_amount",
    "round_to_long",
    "split_composite_key",
    "squeeze_spaces",
    "strip_chars",
    "strip_prefix",
    "title_case",
    "trim_spaces",
]
