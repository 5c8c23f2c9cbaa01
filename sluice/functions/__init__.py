"""Column builders (parsing, trimming, clamping, codes) and field rules."""

from sluice.functions import parse, rules
from sluice.functions.parse import (
    clamp,
    code3,
    code_field,
    digits_key,
    empty_to_null,
    parse_date,
    parse_double,
    parse_integral,
    text_field,
    trimmed,
)

__all__ = [
    "parse",
    "rules",
    "clamp",
    "code3",
    "code_field",
    "digits_key",
    "empty_to_null",
    "parse_date",
    "parse_double",
    "parse_integral",
    "text_field",
    "trimmed",
]
