from __future__ import annotations

from collections import defaultdict

import pytest

from kontora.llm import line_dedup as L

LONG = "this line is long enough to be a key of its own"


def brute(rows, least=40, many=5):
    where = defaultdict(set)
    key = lambda x: x.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least:
                where[key(line)].add(i)
    out = {}
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if len(where.get(key(x), ())) < many or max(where[key(x)]) == i]
        out[i] = ("\n".join(kept), len(lines), len(lines) - len(kept))
    return out


def found(spark, rows, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in L.dedup_lines(df, **options).collect()}


ROWS = [
    (1, None), (2, ""), (3, "\n\n"), *[(10 + i, f"head {i}\n  {LONG.upper()} \r\n{LONG}\ntail") for i in range(6)], *[(30 + i, "é" * 40 + f"\nshort\n{LONG} {i % 2}") for i in range(4)],
    (50, "é" * 40), (60, "x" * 39), *[(70 + i, "y" * 39) for i in range(6)], (90, "\n".join([LONG] * 300) + "\n" + "z" * 100_000),
]


def test_filters_follow_the_text(spark):
    text = spark.createDataFrame([("x" * 100_000_000,)], "text string")
    assert L.filter_bits_for(text, "text") == 1 << 23 and L.filter_bits_for(text.limit(0), "text") == L.MIN_BITS


@pytest.mark.parametrize("bits", [None, 1 << 25, 1 << 15])
def test_equals_brute_force(spark, bits):
    """Also with filters so small that nearly every line is a suspect."""
    assert found(spark, ROWS, filter_bits=bits) == brute(ROWS)


def test_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    out = L.dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"]
    assert {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in out.collect()} == brute(rows)


def test_repeated_rows_null_ids_clashing_names_and_empty(spark):
    rows = [(i % 3, LONG, "x") for i in range(6)] + [(None, LONG, "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    got = sorted((-1 if r.doc_id is None else r.doc_id, r.text, r.n_dropped) for r in L.dedup_lines(df).collect())
    assert got == [(-1, "", 1), (0, "", 1), (0, "", 1), (1, "", 1), (1, "", 1), (2, LONG, 0), (2, LONG, 0)]
    assert L.dedup_lines(df.limit(0)).count() == 0
