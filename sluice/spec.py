"""Declarative description of one target table and how its feed is cleaned and loaded."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Optional

from pyspark.sql import types as T

from sluice.functions.rules import Rule

_TYPES = {
    "date": T.DateType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


@dataclass(frozen=True)
class Field:
    """One target column: its raw source column (``None`` → typed NULL) and parse rule."""

    name: str
    source: Optional[str]
    rule: Rule
    nullable: bool = True  # False → NOT NULL constraint (checked by N1)

    @property
    def dtype(self) -> str:
        return self.rule.dtype

    @property
    def length(self) -> Optional[int]:
        return self.rule.length


@dataclass(frozen=True)
class TableSpec:
    """A target table: columns in order, rules, filter, key, constraints and load mode.

    ``required``: rows with a NULL in any of these columns are rejected.
    ``defaults``: (column, fallback column) pairs applied after the filter.
    ``distinct``: remove full-row duplicates after the filter.
    ``mode``: ``"upsert"`` (keyed merge) or ``"overwrite"`` (full replacement).
    ``partition_date``: the key's date column; the target is partitioned by its
    ``partition_grain`` (``"month"`` or ``"day"``), a function of the key, so a keyed
    row never moves between partitions.
    ``key_buckets``: above 1, each date partition is divided by a hash of the key, so a
    small batch rewrites a few buckets of a date that holds most of the table.
    ``store_buckets``: above 0, the files of each partition are divided by a hash of the key
    (``operators.bucketed``), so merges of many partitions need not shuffle the table.
    """

    name: str
    fields: tuple[Field, ...]
    required: tuple[str, ...]
    primary_key: tuple[str, ...] = ()
    distinct: bool = True
    mode: str = "upsert"
    defaults: tuple[tuple[str, str], ...] = ()
    partition_date: Optional[str] = None
    partition_grain: str = "month"
    source_name: Optional[str] = None  # feed file base name; defaults to ``name``
    key_buckets: int = 1
    store_buckets: int = 0

    def __post_init__(self) -> None:
        names = [f.name for f in self.fields]
        if len(set(names)) != len(names):
            raise ValueError(f"{self.name}: duplicate column names")
        for col in (*self.required, *self.primary_key, *(c for pair in self.defaults for c in pair)):
            if col not in names:
                raise ValueError(f"{self.name}: unknown column {col!r}")
        if self.mode not in ("upsert", "overwrite"):
            raise ValueError(f"{self.name}: mode must be 'upsert' or 'overwrite'")
        if self.mode == "upsert":
            if not self.primary_key:
                raise ValueError(f"{self.name}: an upsert needs a primary key")
            if not self.update_columns:
                # Checked here, before any job runs.
                raise ValueError(f"{self.name}: every column is in the primary key, nothing to update")
            if not set(self.primary_key) <= set(self.required):
                # A NULL key never matches in the merge: key columns must be required.
                raise ValueError(f"{self.name}: primary key columns must be required (NOT NULL)")
            if self.partition_date and self.partition_date not in self.primary_key:
                raise ValueError(f"{self.name}: partition date must be part of the primary key")
        types = {f.name: f.dtype for f in self.fields}
        for col, fallback in self.defaults:
            if types[col] != types[fallback]:
                raise ValueError(f"{self.name}: default of {col!r} must have its type ({types[col]})")
        if self.partition_date and types.get(self.partition_date) != "date":
            raise ValueError(f"{self.name}: partition_date must be a date column")
        if self.key_buckets < 1 or (self.key_buckets > 1 and not (self.partition_date and self.primary_key)):
            raise ValueError(f"{self.name}: key_buckets is 1, or more for a table with partition_date and a key")
        if self.store_buckets and (self.mode != "upsert" or not self.partition_date or self.key_buckets > 1):
            raise ValueError(f"{self.name}: store_buckets are for upserts by partition_date without key_buckets")
        if self.partition_grain not in ("month", "day"):
            raise ValueError(f"{self.name}: partition_grain must be 'month' or 'day'")

    # -- derived views -------------------------------------------------------------
    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def source_columns(self) -> list[str]:
        return [f.source for f in self.fields if f.source is not None]

    @property
    def update_columns(self) -> list[str]:
        return [c for c in self.columns if c not in self.primary_key]

    @property
    def not_null(self) -> list[str]:
        return [f.name for f in self.fields if not f.nullable]

    @property
    def lengths(self) -> dict[str, int]:
        return {f.name: f.length for f in self.fields if f.length is not None}

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, _TYPES[f.dtype], True) for f in self.fields])

    @property
    def raw_schema(self) -> T.StructType:
        """All-string schema of the feed, in the spec's source order."""
        return T.StructType([T.StructField(c, T.StringType(), True) for c in self.source_columns])

    @property
    def feed_name(self) -> str:
        return self.source_name or self.name
