"""Delimited text feeds: raw all-string scans (S1), spec-bound scans (S2), CSV writer."""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluice.spec import TableSpec

SEPARATOR = ";"  # fixed value: the feed format's field separator


def read_raw(spark: SparkSession, path: str, sep: str = SEPARATOR) -> DataFrame:
    """Every column of a header feed as a nullable string; no type inference.

    ``path`` may be a file, a folder or a glob, so one scan covers a whole day's drop.
    Unquoted empty and ``""`` values read as NULL; blank-only values stay blanks. The
    column names come from the first file's header, and every other file's header is
    checked against them (``enforceSchema=false``): a file with reordered columns fails
    the read instead of being bound by position.
    """
    return (
        spark.read.option("header", True)
        .option("inferSchema", False)
        .option("enforceSchema", False)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


def read_feed(
    spark: SparkSession, spec: TableSpec, path: str, *, by_header: bool = True, malformed: Optional[str] = None
) -> DataFrame:
    """The spec's source columns of a feed, bound by header name (case-insensitive).

    ``by_header=True`` reads the header, then selects the spec's columns by name, so
    reordered or extra feed columns are fine and a missing column fails before any data
    job. ``by_header=False`` binds the spec's all-string schema without the header read
    and makes Spark verify each file's header against it (``enforceSchema=false``).

    ``malformed`` names a further column for the whole line of a record that has too few or too
    many fields (NULL for the others). The values of such records are the same with it and
    without: missing fields are NULL, further ones are ignored. The marking is part of the
    one scan, which then splits all columns of the feed.
    """
    if by_header and malformed is None:
        raw = read_raw(spark, path)
        return raw.select(*[F.col(f"`{c}`").alias(c) for c in spec.source_columns])
    schema = read_raw(spark, path).schema if by_header else spec.raw_schema
    reader = spark.read.option("header", True).option("enforceSchema", False).option("sep", SEPARATOR)
    if malformed is not None:
        schema = T.StructType([*schema.fields, T.StructField(malformed, T.StringType(), True)])
        # Without pruning in the parser: it counts the fields of whole records only.
        reader = reader.option("columnPruning", False).option("columnNameOfCorruptRecord", malformed)
    raw = reader.schema(schema).csv(path)
    more = [malformed] if malformed is not None else []
    return raw.select(*[F.col(f"`{c}`").alias(c) for c in spec.source_columns], *more)


def write_delimited(df: DataFrame, path: str, sep: str = SEPARATOR) -> None:
    """Write text columns as a header feed, blanks kept as they are."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("sep", sep)
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
