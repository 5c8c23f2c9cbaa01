"""Field rules: a parse expression plus the target type and length it produces."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Optional

from pyspark.sql import Column

from sluice.functions import parse


@dataclass(frozen=True)
class Rule:
    build: Callable[[Column], Column]
    dtype: str  # Spark SQL type name of the result
    length: Optional[int] = None  # VARCHAR/CHAR limit the result must respect

    def __call__(self, text: Column) -> Column:
        return self.build(text).cast(self.dtype)


def date(layout: str) -> Rule:
    return Rule(lambda c: parse.parse_date(c, layout), "date")


def integer() -> Rule:
    return Rule(lambda c: parse.parse_integral(c, "int"), "int")


def bigint() -> Rule:
    return Rule(lambda c: parse.parse_integral(c, "bigint"), "bigint")


def double() -> Rule:
    return Rule(parse.parse_double, "double")


def text(length: int) -> Rule:
    """Trimmed, clamped; blank-only text becomes ``''``."""
    return Rule(lambda c: parse.text_field(c, length), "string", length)


def code(length: int) -> Rule:
    """Trimmed, clamped; empty or blank-only text becomes NULL."""
    return Rule(lambda c: parse.code_field(c, length), "string", length)


def digits_int() -> Rule:
    return Rule(lambda c: parse.digits_key(c, "int"), "int")


def code3() -> Rule:
    return Rule(lambda c: parse.clamp(parse.code3(c), 3), "string", 3)


def null_of(dtype: str, length: Optional[int] = None) -> Rule:
    """A column the feed does not carry: a typed NULL."""
    from pyspark.sql import functions as F

    return Rule(lambda c: F.lit(None), dtype, length)
