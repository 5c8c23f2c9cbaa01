"""sluice — declarative cleaning and keyed loading of delimited text feeds on Spark.

A table is described once by a :class:`~sluice.spec.TableSpec`; the library reads the
raw feed as strings, parses it with non-raising native expressions, rejects rows that
lack required values, removes duplicates, checks constraints and loads the result as a
full replacement or as a keyed upsert that rewrites only the partitions it touches.
"""

from sluice.spec import Field, TableSpec

__all__ = ["Field", "TableSpec"]
