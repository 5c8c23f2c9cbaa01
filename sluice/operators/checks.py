"""Constraint checks (NOT NULL, primary key, length) as violation DataFrames.

Each check returns the violating rows; an empty result means the constraint holds.
All are single-pass filters or one partially aggregated ``groupBy``, so a hot key is
collapsed map-side before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.spec import TableSpec


def _any(flags: list[Column]) -> Column:
    """True if any flag is true (NULL flags, e.g. the length of a NULL, count as false)."""
    return F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(f, F.lit(False)) for f in flags], F.lit(False)), F.lit(False))


def violation_flags(spec: TableSpec) -> tuple[Column, Column]:
    """Per-row flags: a NOT NULL column is NULL; a text is longer than its column. The load
    counts them; the violation frames below list what they mark."""
    return (
        _any([F.col(c).isNull() for c in spec.not_null]),
        _any([F.length(c) > n for c, n in spec.lengths.items()]),
    )


def not_null_violations(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows with a NULL in any NOT NULL column."""
    return df.filter(violation_flags(spec)[0])


def pk_violations(df: DataFrame, spec: TableSpec, *, distinct_rows: bool = False) -> DataFrame:
    """Keys held by more than one row: ``(pk..., n_rows)``.

    With ``distinct_rows=True`` the frame is taken as not yet deduplicated and a key
    only violates when it holds two *different* rows (``n_rows`` then counts distinct
    rows). Both steps are partially aggregated hash aggregates, so exact copies and
    hot keys collapse map-side.
    """
    pk = list(spec.primary_key)
    rows = df.dropDuplicates() if distinct_rows else df
    return rows.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def length_violations(df: DataFrame, spec: TableSpec, key: list[str] | None = None) -> DataFrame:
    """One row per (row, column) whose text is longer than the column's limit.

    Output: key columns, ``column_name``, ``actual_length``, ``max_length``.
    """
    key = key or list(spec.primary_key)
    limits = {c: n for c, n in spec.lengths.items() if c in df.columns}
    if not limits:
        return df.select(*key).limit(0)
    candidates = F.array(
        *[
            F.when(
                F.length(c) > n,
                F.struct(F.lit(c).alias("column_name"), F.length(c).alias("actual_length"), F.lit(n).alias("max_length")),
            )
            for c, n in limits.items()
        ]
    )
    return (
        df.select(*key, F.explode(candidates).alias("v"))
        .filter(F.col("v").isNotNull())
        .select(*key, "v.column_name", "v.actual_length", "v.max_length")
    )
