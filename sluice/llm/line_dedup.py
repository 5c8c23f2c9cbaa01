"""Lines that several documents share are kept in one of them only (DataFrame functions only).

Lines are exploded, normalised and hashed; the documents of each hash are counted; lines of
hashes in ``min_docs`` documents or more go, except in the smallest doc_id; what is left of a
text is put together again by line position.

- A text is split at line feeds; a null or empty text is one empty line.
- A line's key is the line without ASCII white space at both ends, A-Z in lower case. Keys of
  fewer than ``min_chars`` code points are never dropped. Two hashes of 64 bits with different
  seeds stand for a key.
- Documents are told apart by doc_id: rows sharing one count as one document, and each row is
  cleaned by itself. A row without doc_id counts as a document of its own kind that comes after
  all others: null is one more id.
- An empty table gives an empty table; a text all of whose lines go becomes empty. Only doc_id
  and text are read by ``dropped_lines``; ``deduplicate`` gives every column of its input back.

Only hashes, ids and positions are shuffled for the counts, after summing in the tasks; whole
texts travel once, to meet their dropped positions. A line that a third of all documents hold
is one row after the sums; the shared lines are written to the shared folder, and adaptive
execution splits their join where one line has many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.common import store

BLANKS = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ROW = ["_line_row1", "_line_row2"]


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """The line as it is compared: stripped, A-Z in lower case, other letters as they are."""
    key = F.btrim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(key) == F.length(key)
    return F.when(ascii_only, F.lower(key)).otherwise(F.translate(key, _UPPER, _LOWER))


def _row(doc_id: Column, text: Column) -> list[Column]:
    """128 bits that name a row by its id and text; equal rows share them and their result."""
    known = doc_id.isNotNull()
    return [F.xxhash64(F.lit(seed), known, doc_id, text).alias(n) for seed, n in enumerate(_ROW)]


def dropped_lines(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """Positions (sorted, from 0) of the lines to drop, by row; rows that keep all are absent."""
    keyed = docs.select(
        "doc_id", *_row(F.col("doc_id"), F.col("text")), F.posexplode(_split(F.col("text"))).alias("at", "line")
    ).select("doc_id", *_ROW, "at", line_key(F.col("line")).alias("key"))
    lines = keyed.filter(F.length("key") >= min_chars).select(
        "doc_id", *_ROW, "at", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2")
    )
    holders = lines.select("h1", "h2", "doc_id").distinct()
    shared = (
        holders.groupBy("h1", "h2")
        .agg(F.count("*").alias("n"), F.min("doc_id").alias("first"))
        .filter(F.col("n") >= max(2, min_docs))
    )
    # Written, so that the join shuffles both of its sides itself and can split a hot line's rows.
    shared = store(shared, "shared-lines")
    gone = lines.join(shared, ["h1", "h2"]).filter(~F.col("doc_id").eqNullSafe(F.col("first")))
    return gone.groupBy(*_ROW).agg(F.sort_array(F.collect_set("at")).alias("gone"))


def _rest(lines: Column, gone: Column) -> Column:
    """``lines`` without those at the positions ``gone``: the stretches between them."""
    after = F.concat(F.array(F.lit(-1)), gone)
    until = F.concat(gone, F.array(F.size(lines)))
    stretches = F.zip_with(after, until, lambda a, b: F.slice(lines, a + 2, b - a - 1))
    return F.array_join(F.flatten(stretches), "\n")


def _cleaned(docs: DataFrame, names: list[str], min_chars: int, min_docs: int) -> DataFrame:
    """``docs`` and the columns ``names``: lines before dropping, lines dropped, remaining text."""
    n_lines, n_dropped, kept = names
    gone = dropped_lines(docs.select("doc_id", "text"), min_chars, min_docs)
    row = _row(F.col("doc_id"), F.col("text"))
    found = docs.select("*", *row).join(gone.withColumnRenamed("gone", kept), _ROW, "left")
    lines, positions = _split(F.col("text")), F.col(kept)
    return found.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        F.size(lines).cast("long").alias(n_lines),
        F.when(positions.isNull(), 0).otherwise(F.size(positions)).cast("long").alias(n_dropped),
        F.when(positions.isNull(), F.coalesce("text", F.lit(""))).otherwise(_rest(lines, positions)).alias(kept),
    )


def lines_kept(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """doc_id, n_lines (before dropping), n_dropped, kept (the remaining text), one row a document."""
    return _cleaned(docs.select("doc_id", "text"), ["n_lines", "n_dropped", "kept"], min_chars, min_docs).drop("text")


def deduplicate(docs: DataFrame, min_chars: int = 10, min_docs: int = 2) -> DataFrame:
    """``docs``, all columns in their order, with the remaining text as text."""
    own = ["_line_n", "_line_dropped", "_line_kept"]
    found = _cleaned(docs, own, min_chars, min_docs)
    text = F.when(F.col(own[1]) > 0, F.col(own[2])).otherwise(F.col("text"))
    return found.select(*[text.alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])


def oracle(min_chars: int = 10, min_docs: int = 2) -> str:
    """DuckDB statement of ``op12_line_dedup``'s rows."""
    blanks = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH parts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS place FROM parts
), keyed AS (
  SELECT doc_id, place, line, translate(trim(line, {blanks}), '{_UPPER}', '{_LOWER}') AS key FROM lines
), shared AS (
  SELECT key, min(doc_id) AS first FROM keyed WHERE length(key) >= {min_chars}
  GROUP BY key HAVING count(DISTINCT doc_id) >= {min_docs}
), marked AS (
  SELECT k.doc_id, k.place, k.line, s.first IS NOT NULL AND s.first <> k.doc_id AS gone
  FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_lines,
  CAST(count(*) FILTER (WHERE gone) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
