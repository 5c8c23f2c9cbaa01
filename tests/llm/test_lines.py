"""Line dedup against brute force."""

import pytest
from pyspark.sql import functions as F

from sluice.llm import line_dedup

from .helpers import documents, empty, lower, odd_texts, sentence

BLANKS = " \t\n\x0b\x0c\r"


def brute(rows, min_chars=10, min_docs=2):
    """(n_lines, n_dropped, kept) of each (doc_id, text)."""
    key = lambda line: lower(line.strip(BLANKS))
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            holders.setdefault(key(line), set()).add(doc)
    out = []
    for doc, text in rows:
        lines, left = (text or "").split("\n"), []
        for line in lines:
            held = holders[key(line)]
            first = min(held, key=lambda d: (d is None, d or 0))
            if not (len(key(line)) >= min_chars and len(held) >= min_docs and doc != first):
                left.append(line)
        out.append((doc, len(lines), len(lines) - len(left), "\n".join(left)))
    return out


def texts():
    common = [sentence(90 + i, 6) for i in range(4)]
    return [
        *odd_texts(),
        "\n".join(common),
        "\n".join([common[1].upper(), "short", "\t" + common[0] + " \r", "", common[0], "short"]),
        "\n".join(["short", *common[::-1], "", ""]),
        "ÀÉÎÕÜ Zeile " + common[2] + "\n" + common[3] + " \n" + common[3] + "\x0c",
        "àéîõü Zeile " + common[2] + "\nÀÉÎÕÜ ZEILE " + common[2],
        "123456789\n1234567890\nßßßßßßßßßß\nßßßßßßßßß",
        "123456789\n1234567890\nßßßßßßßßßß\nßßßßßßßßß\n" + "only\n" * 5000 + common[0],
        "\n\n\n",
    ]


@pytest.mark.parametrize("min_chars,min_docs", [(10, 2), (1, 3), (0, 2)])
def test_odd_documents_against_brute_force(spark, min_chars, min_docs):
    docs = documents(spark, texts())
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = line_dedup.lines_kept(docs, min_chars, min_docs).collect()
    order = lambda x: (x[0] is None, x[0] or 0, x[1:])
    assert sorted(map(tuple, found), key=order) == sorted(brute(rows, min_chars, min_docs), key=order)


def test_every_column_is_kept(spark):
    docs = documents(spark, texts())
    left = line_dedup.deduplicate(docs)
    assert left.schema == docs.schema and left.count() == docs.count()
    want = {(d, k) for d, _, _, k in brute([(r.doc_id, r.text) for r in docs.collect()])}
    assert {(r.doc_id, r.text or "") for r in left.collect()} == want
    assert left.filter("text is null").count() == docs.filter("text is null").count()


def test_other_id_types_and_empty_tables(spark):
    docs = spark.createDataFrame([("b", "a line of its own\nx"), ("a", "A LINE OF ITS OWN\ny")], "doc_id string, text string")
    assert {tuple(r) for r in line_dedup.lines_kept(docs).collect()} == {("b", 2, 1, "x"), ("a", 2, 0, "A LINE OF ITS OWN\ny")}
    assert line_dedup.lines_kept(empty(spark)).count() == 0 and line_dedup.deduplicate(empty(spark)).count() == 0


def test_no_python_in_the_plan(spark):
    found = line_dedup.lines_kept(documents(spark)).select(F.sha2("kept", 256))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
