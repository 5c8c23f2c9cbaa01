"""Optional JDBC sink: connection options and a thin writer (append / truncating overwrite).

The Parquet targets are the primary sink; this mirrors loading into a relational
database for users who need one. Writes run one connection per partition, so the
frame's partition count bounds the parallelism (``num_partitions`` coalesces).
"""

from __future__ import annotations

from typing import Optional

from pyspark.sql import DataFrame

POSTGRES_DRIVER = "org.postgresql.Driver"  # fixed value: PostgreSQL JDBC driver class


def jdbc_url(host: str, port: int, database: str, vendor: str = "postgresql") -> str:
    return f"jdbc:{vendor}://{host}:{port}/{database}"


def quoted(name: str) -> str:
    """A quoted identifier: letter case and reserved words are kept, inner quotes doubled."""
    return '"' + name.replace('"', '""') + '"'


def qualified_table(schema: str, table: str) -> str:
    """``"SCHEMA"."table"``, both quoted."""
    return f"{quoted(schema)}.{quoted(table)}"


def jdbc_options(url: str, user: str, password: str, driver: str = POSTGRES_DRIVER, **extra: str) -> dict:
    return {"url": url, "user": user, "password": password, "driver": driver, **extra}


def write_jdbc(
    df: DataFrame,
    table: str,
    options: dict,
    *,
    mode: str = "append",
    batch_size: int = 10_000,
    num_partitions: Optional[int] = None,
) -> None:
    """Append, or overwrite with ``truncate`` so the table keeps its constraints."""
    writer = df.write.format("jdbc").options(**options).option("dbtable", table).option("batchsize", batch_size)
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    if mode == "overwrite":
        writer = writer.option("truncate", True)
    writer.mode(mode).save()
