from __future__ import annotations

import random
import re
from itertools import combinations

import pytest

from kontora.llm import near_dedup as N

FOLDER = "/root/testdata/sf0.001"


def brute(rows, width, percent):
    """Components by exact Jaccard of all pairs; (id, text) with distinct ids."""
    sets, parent = {}, {}
    for i, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
        parent[i] = i

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in combinations(sorted(sets), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            a, b = top(a), top(b)
            parent[max(a, b)] = min(a, b)
    return {i: (len(s), top(i)) for i, s in sets.items()}


def found(spark, rows, width, percent, ddl="doc_id long, text string"):
    out = N.near_duplicates(spark.createDataFrame(rows, ddl), width=width, percent=percent).collect()
    return {r.doc_id: (r.n_shingles, r.component_id) for r in out}


@pytest.mark.parametrize(("width", "percent"), [(3, 85), (5, 80)])
def test_equals_brute_force_on_documents(spark, width, percent):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(df, width=width, percent=percent).collect()}
    assert got == brute([(r.doc_id, r.text) for r in df.collect()], width, percent)


def test_large_group_of_near_copies(spark, monkeypatch):
    """Copies at all distances around the threshold, in several blocks."""
    monkeypatch.setattr(N, "BLOCK", 32)
    r = random.Random(1)
    base = [f"w{r.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(220):
        words = list(base)
        for _ in range(r.randrange(14)):
            words[r.randrange(150)] = f"x{r.randrange(10**6)}"
        rows.append((i * 3, " ".join(words)))
    got = found(spark, rows, 3, 85)
    assert got == brute(rows, 3, 85)
    assert len({c for _, c in got.values()}) > 20


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "a b c d"), (8, "A  b\nc d"), (9, "z " * 5000)]
    assert found(spark, rows, 3, 85) == brute(rows, 3, 85)
    assert found(spark, [], 3, 85) == {}


def test_repeated_rows_null_ids_and_clashing_names(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "y"), (None, "a b c d", "z"), (2, "a b c d", "w")]
    df = spark.createDataFrame(rows, "doc_id long, text string, component_id string")
    out = sorted(((r.doc_id or 0), r.component_id, r.kept) for r in N.near_duplicates(df, width=3, percent=85).collect())
    assert out == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]


def test_long_chain_is_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.id: r.comp for r in N.components(links).collect()}
    assert got == {i: 0 for i in range(1, 61)} | {0: 0, 100: 100, 101: 100} or got == {i: 0 for i in range(1, 61)} | {101: 100}


def test_sketch_allows_all_links():
    """Pairs at the threshold pass the sketch."""
    import numpy as np

    r = np.random.default_rng(5)
    for n in (20, 60, 300, 3000):
        for _ in range(40):
            both = int(round(n * 0.85))
            pool = r.integers(0, 2**64, both + 2 * (n - both), dtype=np.uint64)
            half = (n - both) // 2
            a, b = np.unique(pool[: both + half]), np.unique(np.append(pool[:both], pool[both + half : n]))
            real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            one, many = (np.frombuffer(N.sketch_of(x), np.uint8) for x in (a, b))
            if real >= 0.85:
                assert N.agree(one, many[None], np.array([len(a) + len(b)]), 0.85)[0]


def group(n=60, changes=14):
    """Near copies of one text, at all distances around the threshold."""
    r = random.Random(2)
    base = [f"w{r.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(n):
        words = list(base)
        for _ in range(r.randrange(changes)):
            words[r.randrange(150)] = f"x{r.randrange(10**6)}"
        rows.append((i * 3, " ".join(words)))
    return rows


def test_few_shuffles(spark):
    """Each takes files for all pairs of a task and a folder, whatever it moves."""
    rows, new = group(), spark.sparkContext._jsc.sc().newShuffleId
    before = new()
    got = found(spark, rows, 3, 85)
    assert new() - before - 1 <= 45
    assert got == brute(rows, 3, 85)


def test_same_classes_without_broadcasts(spark, monkeypatch):
    """Links in rounds over all, joins by shuffles: as with large tables."""
    for name in ("LINKS_AT_ONCE", "BROADCAST_ROWS", "BROADCAST_IDS"):
        monkeypatch.setattr(N, name, 0)
    monkeypatch.setattr(N, "BLOCK", 16)
    rows = group()
    assert found(spark, rows, 3, 85) == brute(rows, 3, 85)


def test_components_in_one_task_and_in_rounds(spark, monkeypatch):
    r = random.Random(3)
    links = [(r.randrange(300), r.randrange(300)) for _ in range(140)] + [(2000 - i, 1999 - i) for i in range(200)]
    links += [(5000, 4000 + i) for i in range(50)] + [(-7, 9000), (9000, -7), (1, 1)]
    top = {i: i for link in links for i in link}
    for _ in top:
        for a, b in links:
            top[a] = top[b] = min(top[a], top[b])
    expected = {i: c for i, c in top.items() if any(i in link and link[0] != link[1] for link in links)}
    df = spark.createDataFrame(links, "a long, b long").repartition(5)
    full = lambda out: {r.comp: r.comp for r in out} | {r.id: r.comp for r in out}
    assert full(N.components(df).collect()) == expected
    monkeypatch.setattr(N, "LINKS_AT_ONCE", 0)
    assert full(N.components(df).collect()) == expected
    assert N.components(df.filter("a = b")).collect() == []
