"""Spec-driven cleaning: one projection, the required-columns filter, defaults, distinct.

Everything is a native expression in one ``select`` plus a ``filter``, compiled by
whole-stage codegen over the scan (the projection and the filter are two codegen spans,
split by the input counter that also keeps each parse expression from being evaluated a
second time inside the filter). Row counters (input, after the filter, output) are
collected with ``DataFrame.observe`` on whatever action runs the plan, so counting never
costs an extra pass over the text.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from typing import Optional

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluice.operators.checks import violation_flags
from sluice.spec import TableSpec


#: Columns of a pass that the result does not have: which required values were blank text,
#: and the whole line of a malformed record.
_BLANK, MALFORMED = "_blank", "_malformed"


def typed(raw: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()) -> DataFrame:
    """Raw strings → the spec's typed columns that come from the feed (no filtering), and the
    columns to ``keep`` as they are."""
    return raw.select(
        *[f.rule(F.col(f"`{f.source}`")).alias(f.name) for f in spec.fields if f.source is not None], *keep
    )


def _required_sources(spec: TableSpec) -> list[tuple[str, str]]:
    """(column, source column) of the required columns that the feed has."""
    source = {f.name: f.source for f in spec.fields}
    return [(c, source[c]) for c in spec.required if source[c] is not None]


def blank_mask(spec: TableSpec) -> Column:
    """Over raw rows: bit i is set where the text of the i-th required column is absent or blank."""
    bits = [
        F.when(F.coalesce(F.trim(F.col(f"`{s}`")), F.lit("")) == "", 1 << i).otherwise(0)
        for i, (_, s) in enumerate(_required_sources(spec))
    ]
    return reduce(lambda a, b: a.bitwiseOR(b), bits, F.lit(0)).cast("int")


def reasons(spec: TableSpec, blank: str = _BLANK) -> dict[tuple[str, str], Column]:
    """(required column, reason) → is it why a typed row is rejected? ``missing``: there was no
    text; ``invalid``: the text is no such value. A row may have several reasons."""
    out = {}
    for i, (c, _) in enumerate(_required_sources(spec)):
        was_blank = F.col(blank).bitwiseAND(F.lit(1 << i)) != 0
        out[c, "missing"] = F.col(c).isNull() & was_blank
        out[c, "invalid"] = F.col(c).isNull() & ~was_blank
    return out


def rejected_rows(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """The raw rows that the required-columns filter rejects, as they are in the feed, with
    ``reasons``: texts such as ``account_rk: invalid``, in the order of the required columns."""
    kept = [F.col(f"`{c}`").alias(f"_raw_{i}") for i, c in enumerate(spec.source_columns)]
    fields = [f.rule(F.col(f"`{f.source}`")).alias(f.name) for f in spec.fields if f.source is not None]
    rows = raw.select(*fields, *kept, blank_mask(spec).alias(_BLANK)).filter(~all_present(spec.required))
    found = [F.when(why, F.lit(f"{c}: {reason}")) for (c, reason), why in reasons(spec).items()]
    return rows.select(
        *[F.col(f"_raw_{i}").alias(c) for i, c in enumerate(spec.source_columns)],
        F.array_compact(F.array(*found)).alias("reasons"),
    )


def all_present(columns: list[str] | tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns], F.lit(True))


def required_filter(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Keep rows whose required columns are all non-NULL (NaN passes, unlike ``dropna``)."""
    return df.filter(all_present(spec.required)) if spec.required else df


def apply_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Replace NULLs in a column by another column's value, after the filter."""
    if not spec.defaults:
        return df
    fallback = dict(spec.defaults)
    return df.select(
        *[F.coalesce(F.col(c), F.col(fallback[c])).alias(c) if c in fallback else F.col(c) for c in df.columns]
    )


def align(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns in the spec's order; columns the frame lacks become typed NULLs."""
    have = set(df.columns)
    return df.select(
        *[F.col(f.name) if f.name in have else F.lit(None).cast(f.dtype).alias(f.name) for f in spec.fields]
    )


def accepted(
    raw: DataFrame, spec: TableSpec, counted: Optional[Observation] = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Typed, filtered and defaulted rows, before duplicate removal.

    The typed rows are counted (``counted``) before the filter, with the reasons for which the
    filter rejects rows, and the malformed records where ``raw`` marks them. The count also keeps
    Catalyst from pushing the filter below the projection, which would inline — and so
    evaluate twice — every parse expression the filter tests.
    """
    counted = counted or Observation()
    more = [MALFORMED] if MALFORMED in raw.columns else []
    with_blank = raw.withColumn(_BLANK, blank_mask(spec))
    rows = typed(with_blank, spec, (*keep, _BLANK, *more)).observe(
        counted,
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(why.cast("long")).alias(f"{c}: {reason}") for (c, reason), why in reasons(spec).items()],
        *[F.count(c).alias(c) for c in more],
    )
    return apply_defaults(required_filter(rows, spec).drop(_BLANK, *more), spec)


def transform(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """The cleaned table: accepted rows, full-row distinct if the spec asks, aligned."""
    df = accepted(raw, spec)
    if spec.distinct:
        # Partial aggregation map-side, so exact copies (even a hot one) collapse
        # before the shuffle; the shuffle key is the whole row.
        df = df.dropDuplicates()
    return align(df, spec)


@dataclass
class Counters:
    """Row counters of one pass, filled when an action runs the observed plan."""

    table: str
    observed_input: Observation
    observed_accepted: Observation

    def get(self) -> dict:
        rows_input = int(self.observed_input.get["rows"])
        rows_after = int(self.observed_accepted.get["rows"])
        return {
            "rows_input": rows_input,
            "rows_after_filter": rows_after,
            "rows_output": rows_after,
            "rows_rejected": rows_input - rows_after,
        }

    def rejects(self) -> dict[str, dict[str, int]]:
        """Required column → {"missing": rows without text, "invalid": rows with unusable text}.
        A row with two reasons counts under both."""
        found: dict[str, dict[str, int]] = {}
        for name, n in self.observed_input.get.items():
            column, colon, reason = name.rpartition(": ")
            if colon:
                found.setdefault(column, {})[reason] = int(n or 0)
        return found

    def malformed(self) -> Optional[int]:
        """Records with too few or too many fields; ``None`` where the scan does not mark them."""
        return self.observed_input.get.get(MALFORMED)

    def violations(self) -> tuple[int, int]:
        """Accepted rows that break NOT NULL, and that break a length."""
        seen = self.observed_accepted.get
        return int(seen["not_null"] or 0), int(seen["too_long"] or 0)


def accepted_observed(
    raw: DataFrame, spec: TableSpec, keep: tuple[str, ...] = ()
) -> tuple[DataFrame, Counters]:
    """``accepted`` with its input, accepted and violation counters attached (one pass, no
    shuffle).

    With no shuffle between scan and the action's write, every counter update comes from
    a result task, which Spark applies exactly once even when tasks are retried.
    """
    obs_in, obs_ok = Observation(), Observation()
    rows = accepted(raw, spec, obs_in, keep)
    # Columns that the feed lacks are typed NULLs after alignment.
    nn, ln = violation_flags(spec)
    missing = {f.name: F.lit(None).cast(f.dtype) for f in spec.fields if f.name not in rows.columns}
    flagged = rows.withColumns(missing).observe(
        obs_ok,
        F.count(F.lit(1)).alias("rows"),
        F.sum(nn.cast("long")).alias("not_null"),
        F.sum(ln.cast("long")).alias("too_long"),
    )
    return flagged.select(*rows.columns), Counters(spec.name, obs_in, obs_ok)
