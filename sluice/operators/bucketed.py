"""Targets stored in buckets of their key, so that wide merges move the batch but not the table.

With ``TableSpec.store_buckets`` the files of every partition are divided by a hash of the
primary key (the hash that Spark's joins use). A scan that knows this brings no row of the table
to another task: the join of a backfill with the target needs a shuffle of neither side, and each
of its tasks writes the files of one bucket. Spark plans such scans for tables of its catalog
only, so for the time of a statement the folder gets a table name there (an external table;
dropping it leaves the files). Readers that do not know of the buckets see plain Parquet files.

All files of a target must be in buckets: choose ``store_buckets`` before the first load.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sluice.spec import TableSpec


@contextmanager
def table(
    spark: SparkSession, spec: TableSpec, path: str, schema: T.StructType, parts: list[str], *, read: bool = True
) -> Iterator[str]:
    """A catalog name for the bucketed files at ``path`` (``schema`` with the partition columns
    ``parts`` last), while the block runs; to ``read`` what is there, or only to add to it."""
    name = f"spark_catalog.default.sluice_{uuid.uuid4().hex}"
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
    keys = ", ".join(f"`{k}`" for k in spec.primary_key)
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet {by} CLUSTERED BY ({keys}) INTO {spec.store_buckets} BUCKETS "
        "LOCATION {path}",
        path=path,
    )
    try:
        if parts and read:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        yield name
    finally:
        spark.sql(f"DROP TABLE {name}")


def write(df: DataFrame, spec: TableSpec, path: str, parts: list[str], *, dealt: bool = False) -> None:
    """Adds ``df`` (partition columns last) to the bucketed files at ``path``. A task writes one
    bucket: rows are brought together by key, unless they are ``dealt`` like that already."""
    with table(df.sparkSession, spec, path, df.schema, parts, read=False) as name:
        rows = df if dealt else df.repartition(spec.store_buckets, *spec.primary_key)
        rows.write.insertInto(name)


def kept_rows(target: DataFrame, batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Rows of ``target`` whose key ``batch`` lacks; both are scans of bucketed tables. A sort-merge
    join, as its tasks keep the buckets apart whatever the batch's size."""
    return target.join(batch.select(*spec.primary_key).hint("merge"), list(spec.primary_key), "left_anti")
