"""Non-raising text → typed Column builders.

Every builder takes a string Column and returns a typed Column that is NULL where the
text does not parse; none of them raises under ANSI mode and none needs a session
setting. The date and integer rules reproduce the lenient parsing a feed written for
Spark's legacy parser expects (prefix parsing of dates, truncating integer casts); all
of them stay native expressions, so they run inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three date layouts feeds use, mapped to (separator regex, field order).
DATE_LAYOUTS = {
    "d.M.yyyy": (r"\.", ("d", "M", "y")),
    "d-M-yyyy": ("-", ("d", "M", "y")),
    "yyyy-M-d": ("-", ("y", "M", "d")),
}


def _date_pattern(layout: str) -> tuple[str, str]:
    """Regex matching every text (lenient prefix or anything else) and its replacement.

    A text that starts like the layout becomes ``000y-M-d`` (year of 1–4 significant digits,
    with the zeros 4–7 as the cast to a date asks); any other text matches the catch-all
    branch, whose groups are empty, and becomes ``000--``, which is no date.
    """
    sep, order = DATE_LAYOUTS[layout]
    group = {"y": r"0*([1-9]\d{0,3})", "M": r"0*(\d+)", "d": r"0*(\d+)"}
    body = rf"\s*{group[order[0]]}{sep}\s*{group[order[1]]}{sep}\s*{group[order[2]]}"
    if order[-1] == "y":
        body += r"(?!\d)"  # a fifth year digit makes the text invalid
    at = {name: i + 1 for i, name in enumerate(order)}
    return rf"(?s)^(?:{body}.*|.*)$", f"000${at['y']}-${at['M']}-${at['d']}"


def parse_date(text: Column, layout: str) -> Column:
    """Date from text in ``layout``, accepting what a lenient prefix parser accepts.

    Three digit groups are taken from the start of the text (blanks allowed before each
    group, anything allowed after the last), the year loses its leading zeros and must
    have 1–4 digits, and the calendar check is left to the cast, so
    ``31.02.2018`` is NULL while ``2018-01-01abc`` is 2018-01-01. One regex pass and
    one cast per value; unlike a formatter, the cast of a bad date raises nothing inside.
    """
    pattern, replacement = _date_pattern(layout)
    return F.regexp_replace(text, pattern, replacement).try_cast("date")


# Characters Spark's numeric casts trim at both ends: U+0000–U+0020 and U+007F.
_CAST_BLANK = r"[\x00-\x20\x7f]"


def parse_integral(text: Column, type_name: str = "int") -> Column:
    """``int``/``bigint`` from text; decimal text truncates (``'12.7'`` → 12, ``'.5'`` → 0).

    Anything else that is not a plain (optionally signed, blank-padded) integer in range
    is NULL: ``'1e3'``, ``'abc'``, ``''``, ``'+.'``, overflow. A plain integer goes to the
    cast; everything else takes one anchored regex pass that rewrites decimal text to
    ``.<sign><integer part>:<fraction>`` and any other text to ``:``. Casting only text
    that looks like an integer also keeps away from the cast's slow failure path.
    """
    b = _CAST_BLANK
    plain = text.rlike(rf"^{b}*[+-]?\d+{b}*$")
    shape = F.regexp_replace(text, rf"(?s)^(?:{b}*([+-]?)(\d*)(\.)(\d*){b}*|.*)$", "$3$1$2:$4")
    head = F.substring_index(F.substring(shape, 2, 1 << 30), ":", 1)  # sign and integer part
    frac = F.substring_index(shape, ":", -1)
    decimal = F.when(
        head.isin("", "+", "-"),  # no integer digits: '.5' and '.' are 0, '+.' is not a number
        F.when((head == "") | (frac != ""), F.lit(0).cast(type_name)),
    ).otherwise(head.try_cast(type_name))
    return F.when(plain, text.try_cast(type_name)).when(F.startswith(shape, F.lit(".")), decimal)


def parse_double(text: Column) -> Column:
    """``double`` from text: blanks, exponents, ``NaN``/``inf``, ``d``/``f`` suffixes; else NULL."""
    return text.try_cast("double")


def trimmed(text: Column) -> Column:
    """Strip U+0020 blanks at both ends (tabs and NBSP stay)."""
    return F.trim(text)


def clamp(text: Column, length: int) -> Column:
    """First ``length`` characters (characters, not bytes)."""
    return F.substring(text, 1, length)


def text_field(text: Column, length: int) -> Column:
    """Trimmed text clamped to ``length``; ``''`` stays ``''``."""
    return clamp(trimmed(text), length)


def empty_to_null(text: Column) -> Column:
    """Trimmed text (any input type is taken as its text), NULL when nothing is left."""
    return F.nullif(trimmed(text.cast("string")), F.lit(""))


def code_field(text: Column, length: int) -> Column:
    """Empty or blank text → NULL, otherwise trimmed and clamped to ``length``."""
    return clamp(empty_to_null(text), length)


def digits_key(text: Column, type_name: str = "int") -> Column:
    """Key from the ASCII digits of the text (``'RK-12'`` → 12, ``'12.7'`` → 127).

    No digits → NULL; a digit string out of range for ``type_name`` → NULL (a wrapped
    key would silently point at another row).
    """
    digits = F.regexp_replace(trimmed(text.cast("string")), r"\D", "")
    return F.nullif(digits, F.lit("")).try_cast(type_name)


def code3(text: Column) -> Column:
    """Three-letter code: upper-cased, the first run of three Latin capitals, else NULL."""
    return F.nullif(F.regexp_extract(F.upper(trimmed(text.cast("string"))), "([A-Z]{3})", 1), F.lit(""))
