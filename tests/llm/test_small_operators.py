"""Decontamination, licences, languages, toxicity, URLs: edges and brute force."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from kontora.llm import decontamination as D
from kontora.llm import language_id as L
from kontora.llm import license_scan as I
from kontora.llm import toxicity as T
from kontora.llm import url_filter as U

# --- decontamination


def contained(docs, items, width=5, similarity=0.8):
    import math
    import re

    words = lambda t: [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    grams = lambda w, k: {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
    out = set()
    for i, t in items:
        w = words(t)
        if w:
            k = min(width, len(w))
            own = grams(w, k)
            for d, x in docs:
                n = len(own & grams(words(x), k))
                if n >= math.ceil(len(own) * similarity - 1e-9):
                    out.add((d, i, n, len(own)))
    return out


def test_decontamination_equals_brute_force(spark, monkeypatch):
    r = random.Random(2)
    text = lambda n: " ".join(f"w{r.randrange(400)}" for _ in range(n))
    items = [(i, text(n)) for i, n in enumerate([1, 2, 4, 5, 6, 12, 25, 40, 80])] + [(20, None), (21, ""), (22, "same same same same same same"), (5_000, "Ünïcode, wörds: hére!")]
    docs = [(100, None), (101, ""), (102, "w1"), (103, "ünïcode wörds hére"), (104, "same " * 50)]
    for i, t in items:
        w = (t or "").split()
        docs += [(200 + i, text(300) + " " + " ".join(w).upper() + ". " + text(30)), (300 + i, " ".join(w[:-1])), (400 + i, text(9) + " " + " ".join(w[1:]) + " " + text(9000)), (500 + i, " ".join("zz" if k % 9 == 4 else x for k, x in enumerate(w)))]
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, words string")
    it = spark.createDataFrame(items, "item_id long, text string")
    want = contained(docs, items)
    got = lambda: {(r.doc_id, r.item_id, r.found, r["size"]) for r in D.contained(df, it).collect()}
    assert got() == want
    monkeypatch.setattr(D, "LITERAL_ROWS", 1)
    assert got() == want
    monkeypatch.setattr(D, "BROADCAST_ROWS", 1)
    assert got() == want
    assert D.contained(df.limit(0), it).count() == 0 and D.contained(df, it.limit(0)).count() == 0
    left = {r.doc_id for r in D.decontaminate(df, it).collect()}
    assert left == {d for d, _ in docs} - {w[0] for w in want}


def test_decontamination_of_repeated_and_null_ids(spark, monkeypatch):
    r = random.Random(6)
    text = lambda n: " ".join(f"w{r.randrange(400)}" for _ in range(n))
    a, b, c, d = text(12), text(25), text(12), text(9)
    items = [(1, a), (1, b), (1, a), (None, c), (None, d), (2, text(30))]
    docs = [(10, f"{text(50)} {a}"), (10, f"{b} {text(50)}"), (11, f"{text(9)} {b} {text(9)}"), (12, c), (None, f"{c} {text(40)}"), (None, f"{d} x {a}"), (None, None), (13, d), (14, text(60))]
    docs += [(15, f"{a} {text(9)}"), (15, f"{' '.join(b.split()[:-2])} {text(9)}")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame(items, "item_id long, text string")
    best = {}
    for i, j, found, size in contained(docs, items):
        best[i, j] = max(best.get((i, j), (0, 0, 0)), (found / size, found, size))
    want = {(*k, *v[1:]) for k, v in best.items()}
    assert {(10, 1), (11, 1), (12, None), (None, None), (None, 1), (13, None), (15, 1)} == set(best)
    got = lambda: {(x.doc_id, x.item_id, x.found, x["size"]) for x in D.contained(df, it).collect()}
    assert got() == want
    monkeypatch.setattr(D, "LITERAL_ROWS", 1)
    assert got() == want
    monkeypatch.setattr(D, "BROADCAST_ROWS", 1)
    assert got() == want
    left = [x[:] for x in D.decontaminate(df, it).collect()]
    assert sorted(left, key=str) == sorted([(None, None), (14, docs[8][1])], key=str)


# --- licences


def test_licenses(spark):
    rows = [
        ("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "no words"), ("a/b/COPYING", "text\nThis work is licensed under the GNU General Public License, version 3.\nmore"),
        ("a/b/d/y.py", "Licensed under CC BY-NC 4.0."), ("z/q.py", None), ("r.py", ""), (None, "copyright me"), ("a/e.py", "x" * 100_000), ("a/e.py", "x"),
    ]
    df = spark.createDataFrame([(i, p, t, "s") for i, (p, t) in enumerate(rows)], "i int, p string, text string, license string")
    got = {r.i: (r.license, r.origin, r.license_dir) for r in I.scan_licenses(df, F.col("p")).collect()}
    none = (None, "none", None)
    assert got == {0: ("MIT", "own", None), 1: ("GPL-3.0", "inherited", "a/b"), 2: ("GPL-3.0", "own", None), 3: ("CC-BY-NC-4.0", "own", None), 4: none, 5: none, 6: none, 7: ("MIT", "inherited", "a"), 8: ("MIT", "inherited", "a")}
    assert I.scan_licenses(df.limit(0), F.col("p")).count() == 0


def test_every_template_and_licence_line_is_found(spark):
    gpl = "GNU GENERAL PUBLIC LICENSE\n  Version 3, 29 June 2007\n\nCopyright (C) 2007 Someone"
    cases = [(n, t) for n, t in I.TEMPLATES] + [(n, t.upper()) for n, t in I.TITLES] + [
        (I.RESERVED, "All rights reserved."), (I.RESERVED, "Some words.\nCopyright 2020 The Long Name of an Owner Inc. All rights reserved.\nMore words."), ("MIT", "Released under the MIT License.\nAll rights reserved."),
        ("MIT", "# SPDX-License-Identifier: MIT"), ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"), ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0-or-later */"), ("MIT OR Apache-2.0", "SPDX-License-Identifier: MIT OR Apache-2.0"), ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
        ("GPL", "GNU GENERAL PUBLIC LICENSE"), ("GPL-3.0", gpl), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
        (None, "in the public domain of ideas many people meet and talk"), (None, "he has a driving license"), (None, "all of the rights"),
    ]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "i int, t string").select("i", I.own_license(F.col("t")).alias("x"))
    got = {r.i: r.x and r.x.license for r in df.collect()}
    assert [(got[i], t) for i, (_, t) in enumerate(cases)] == cases


def test_near_neighbours_and_whole_files(spark):
    mit = "Copyright (c) 2020 Jane Doe\n\n" + I.MIT_GRANT + "\n\n" + I.MIT_WARRANTY
    cases = [
        ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."), ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("CC-BY-NC-ND-4.0", "licensed under cc by-nc-nd 4.0"),
        ("MIT", mit), ("BSD-2-Clause", "Copyright 2019 X\n\n" + I.BSD_GRANT + "\n\n" + I.BSD_WARRANTY), ("BSD-3-Clause", I.BSD_GRANT + I.BSD_NAMES + "\n\n" + I.BSD_WARRANTY), ("GPL-2.0", "This program is licensed under the GNU General Public License, version 2."),
    ]
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(cases)], "i int, t string").select("i", I.own_license(F.col("t")).alias("x"))
    got = {r.i: r.x and r.x.license for r in df.collect()}
    assert [(got[i], t[:30]) for i, (_, t) in enumerate(cases)] == [(n, t[:30]) for n, t in cases]


def test_inheritance_equals_brute_force(spark):
    """Random trees: the nearest directory upwards with a licence file."""
    import posixpath

    r = random.Random(7)
    lines = [("MIT", "Released under the MIT License."), ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"), ("ISC", "isc license")]
    rows = []
    for i in range(400):
        place = "/".join(r.choices("abcdef", k=r.randrange(1, 5)))
        kind, text = r.choice(lines) if r.random() < 0.15 else (None, "words")
        rows.append((i, posixpath.join(place, r.choice(["LICENSE", "COPYING.txt"]) if kind and r.random() < 0.5 else f"f{i}"), text, kind))
    files = {}
    for _, path, _, kind in rows:
        if kind and posixpath.basename(path).startswith(("LICENSE", "COPYING")):
            files.setdefault(posixpath.dirname(path), []).append(kind)
    want = {}
    for i, path, _, kind in rows:
        at, found = posixpath.dirname(path), None
        while found is None:
            found = (min(files[at]), "inherited", at) if at in files else (None, "none", None) if not at else None
            at = posixpath.dirname(at)
        want[i] = (kind, "own", None) if kind else found
    df = spark.createDataFrame(rows, "i int, p string, text string, k string")
    assert {x.i: (x.license, x.origin, x.license_dir) for x in I.scan_licenses(df, F.col("p")).collect()} == want
    assert {w[1] for w in want.values()} == {"own", "inherited", "none"}


def test_documents_equal_direct_computation(spark):
    """Every text's own licence, recomputed block by block."""
    import math
    import re
    from collections import Counter

    def cosine(block):
        tf = Counter(I._WORD.findall(block.lower()))
        v = {w: n * I.IDF.get(w, I.UNSEEN) for w, n in tf.items()}
        norm = math.sqrt(sum(x * x for x in v.values()))
        return [sum(x * m.get(w, 0) for w, x in v.items()) / norm if norm else 0 for m in I.VECTORS]

    rows = [r for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect() if re.search(I.CUE, r.text or "")]
    df = spark.createDataFrame([(r.doc_id, r.text) for r in rows], "doc_id long, t string")
    got = {r.doc_id: r.x for r in df.select("doc_id", I.own_license(F.col("t")).alias("x")).collect()}
    for r in rows:
        blocks = {x for x in [*r.text.split("\n"), *re.split(r"\n[\x20\t]*\n", r.text), r.text] if re.search(I.CUE, x)}
        best = max((max(cosine(b)) for b in blocks), default=0)
        x = got[r.doc_id]
        if x is None:
            assert best < I.LEAST and "rights reserved" not in r.text.lower()
        elif x.score < 1:
            assert abs(x.score - best) < 1e-9 and I.TEMPLATES[int(np.argmax(max((cosine(b) for b in blocks), key=max)))][0] == x.license


def test_long_blocks_take_steps_in_proportion(spark):
    import time

    def took(n):
        df = spark.createDataFrame([("license " + " ".join(f"w{i}" for i in range(n)),)], "t string").select(I.own_license(F.col("t")).alias("x"))
        began = time.perf_counter()
        df.collect()
        return time.perf_counter() - began

    took(10)
    assert took(64_000) < 16 * took(8_000) + 2


def test_cosine_equals_direct_computation(spark):
    import math
    from collections import Counter

    block = "Licensed under the Apache License; see the license"
    tf = Counter(I._WORD.findall(block.lower()))
    v = {w: n * I.IDF.get(w, I.UNSEEN) for w, n in tf.items()}
    norm = math.sqrt(sum(x * x for x in v.values()))
    want = [sum(x * m.get(w, 0) for w, x in v.items()) / norm for m in I.VECTORS]
    got = spark.createDataFrame([(block,)], "b string").select(I.block_scores(F.col("b"))).first()[0]
    assert np.allclose(got, want)


# --- languages

FOLDER = "/root/testdata/sf0.01"


def test_language_held_out_accuracy(spark):
    df = spark.read.parquet(f"{FOLDER}/documents.parquet")
    model = L.train(df, "doc_id", "text", "lang")
    out = L.identify(df, model).select("lang", "lang_pred", "score", L.held_out(F.col("doc_id")).alias("h")).collect()
    held = [r for r in out if r.h]
    assert len(held) > 100 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in out)


def test_language_edges(spark):
    df = spark.createDataFrame([(i, t, "aa" if i % 2 else "bb", "x") for i, t in enumerate(["oo uu oo uu", "ii ee ii ee"] * 30)], "doc_id long, text string, lang string, score string")
    model = L.train(df, "doc_id", "text", "lang")
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "123 !?"), (4, "oo uu"), (4, "oo uu"), (5, "é" * 10_000)], "doc_id long, text string")
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.identify(odd, model).orderBy("doc_id").collect()]
    assert [g[1] for g in got[:5]] == ["und", "und", "und", "bb", "bb"] and got[5][1] in ("aa", "bb") and got[0][2] == 0
    assert L.identify(odd.limit(0), model).count() == 0
    empty = L.train(df.limit(0), "doc_id", "text", "lang")
    assert {r.lang_pred for r in L.identify(odd, empty).collect()} == {"und"}
    single = L.train(df.filter("lang = 'aa'"), "doc_id", "text", "lang")
    assert {r.lang_pred for r in L.identify(odd.filter("doc_id = 4"), single).collect()} == {"aa"}


def test_letters_are_of_category_l(spark):
    import unicodedata

    for c in range(0x30000):
        if not 0xD800 <= c < 0xE000:
            assert L.has_letter(f"1 {chr(c)}_") == unicodedata.category(chr(c)).startswith("L"), hex(c)
    df = spark.createDataFrame([(i, t, "aa" if i % 2 else "bb") for i, t in enumerate(["oo uu oo uu", "ii ee ii ee"] * 30)], "doc_id long, text string, lang string")
    model = L.train(df, "doc_id", "text", "lang")
    odd = spark.createDataFrame([(1, "²"), (2, "½ ① Ⅳ")], "doc_id long, text string")
    assert {(r.lang_pred, r.score) for r in L.identify(odd, model).collect()} == {("und", 0.0)}


def test_the_sample_is_bounded_for_any_number_of_languages(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.concat(F.lit("words of "), "id").alias("text"), F.when(F.col("id") % 2 == 0, "many").otherwise(F.concat(F.lit("l"), "id")).alias("lang"))
    model = L.train(df, "doc_id", "text", "lang", sample=200)
    assert len(model.languages) <= 10 and "many" in model.languages
    hot = spark.range(3000).select(F.lit(1).alias("doc_id"), F.lit("one text").alias("text"), F.lit("aa").alias("lang"))
    assert L.train(hot, "doc_id", "text", "lang").languages in (["aa"], [])


def test_decoding_equals_direct_computation():
    r = np.random.default_rng(8)
    x = r.random((5, L.FEATURES)).astype(np.float32)
    m = L.Model(["a", "b", "c"], L.codewords(3), np.full((3, 3), 1 / 3), r.normal(size=(L.FEATURES + 1, 3)).astype(np.float32) / 50)
    best, score, doubt = L.decode(m, x)
    for k in range(5):
        f = [sum(float(v) * float(w) for v, w in zip(x[k], m.weights[:-1, j], strict=True)) + float(m.weights[-1, j]) for j in range(3)]
        away = [sum(np.log1p(np.exp(-f[j] * c[j])) / 3 for j in range(3)) for c in m.codes]
        p = [np.exp(-4 * a) for a in away]
        assert best[k] == int(np.argmin(away)) and abs(score[k] - max(p) / sum(p)) < 1e-3
        assert doubt[k] == ((sorted(p)[-1] - sorted(p)[-2]) / sum(p) < L.MARGIN)


def test_codewords_differ():
    for n in (2, 3, 4, 7, 9, 30):
        c = L.codewords(n)
        assert len({tuple(r) for r in c}) == n


# --- toxicity


def test_chain_learns_and_generalises(spark):
    r = random.Random(4)
    word = lambda: f"w{r.randrange(2000)}"
    bad = ["vile", "foul", "nasty", "awful"]
    docs = [(i, " ".join([word() for _ in range(80)] + (r.sample(bad, 2) if i % 5 == 0 else [])), int(i % 5 == 0)) for i in range(600)]
    df = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y, int(i % 3 == 0)) for i, _, y in docs if i < 450] + [(9999, None, 1)], "doc_id long, toxic int, quality int")
    chain = T.train(df, labels, T.CATEGORIES)
    out = {x.doc_id: x.toxic for x in T.classify(df, chain).collect()}
    assert sum(out[i] == bool(y) for i, _, y in docs[450:]) >= 145
    odd = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (3, "VILE, foul!", "x"), (3, "VILE, foul!", "x")], "doc_id long, text string, toxic string")
    got = [(x.doc_id, x.toxic) for x in T.classify(odd, chain).orderBy("doc_id").collect()]
    assert got == [(1, False), (2, False), (3, True), (3, True)]
    assert T.classify(odd.limit(0), chain).count() == 0
    blank = T.train(df, labels.limit(0), T.CATEGORIES)
    assert {x.toxic for x in T.classify(odd, blank).collect()} == {False}


def test_chain_equals_direct_computation():
    r = np.random.default_rng(6)
    c = T.Chain(["a", "b"], {5: 0, 7: 1, 9: 2}, [np.array([1.0, -2.0, 0.5, 0.1]), np.array([0.3, 0.2, -1.0, 4.0, -2.0])], [0.5, 0.5])
    x = r.integers(0, 2, (8, 3)).astype(float)
    p = T.predict(c, x)
    for row, (p0, p1) in zip(x, p, strict=True):
        first = 1 / (1 + np.exp(-(row @ [1.0, -2.0, 0.5] + 0.1)))
        assert abs(p0 - first) < 1e-9 and abs(p1 - 1 / (1 + np.exp(-(row @ [0.3, 0.2, -1.0] + 4.0 * first - 2.0)))) < 1e-9


def test_toxicity_of_held_out_documents(spark):
    """Trained without every fourth labelled document, judged on those."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 1
    chain = T.train(docs, labels.filter(~out), T.CATEGORIES)
    held = T.classify(docs.join(labels.filter(out).select("doc_id", F.col("toxic").alias("y")), "doc_id"), chain).select("y", "toxic").collect()
    hit, toxic, flagged = sum(r.y == 1 and r.toxic for r in held), sum(r.y == 1 for r in held), sum(r.toxic for r in held)
    print("held out:", len(held), "toxic", toxic, "found", hit, "flagged", flagged)
    assert toxic > 50 and hit >= 0.85 * toxic and hit >= 0.9 * flagged


# --- URLs

URLS = [None, "", "no scheme", "http://A.Example.NET/en/x", "http://example.net", "http://example.net/", "x://b.example.com/de/?q", "https://www.lists.org/page/?utm_source=1&a=2", "http://lists.org:80/page?a=2#f", "http://lists.org/fr/1", "http://lists.org/other", "a://b://c/d", "http://h.org/é", "http://h.org/p\nq?x"]


def test_urls(spark):
    df = spark.createDataFrame([(i, u, "x") for i, u in enumerate(URLS)] + [(7, URLS[7], "x")], "page_id long, url string, host string")
    listed = spark.createDataFrame([("lists.org/page?a=2",), (None,), ("lists.org/page?a=2",)], "url string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(df, listed).collect()}
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert got[4] == ("example.net", "", None, "allow") and got[5] == ("example.net", "/", "net/", "block")
    assert got[6] == ("b.example.com", "/de/", "example.com/de/", "block")
    assert got[7] == ("www.lists.org", "/page/", None, "block") and got[8] == ("lists.org:80", "/page", None, "block")
    assert got[9] == ("lists.org", "/fr/1", "org/fr/", "allow") and got[10][3] == "allow"
    assert got[11] == ("b:", "//c/d", None, "allow") and got[13][1] == "/p\nq"
    assert U.filter_urls(df, listed).count() == len(URLS) + 1
    assert U.filter_urls(df.limit(0), listed).count() == 0
    assert {r.verdict for r in U.filter_urls(df.filter("page_id = 7"), listed.limit(0)).collect()} == {"allow"}


def test_one_url_may_have_most_rows(spark):
    pages = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, "http://hot.example/x").when(F.col("id") % 3 == 1, F.concat(F.lit("http://u"), "id")).alias("url"))
    out = U.filter_urls(pages, U.mass_posted(pages))
    assert out.groupBy("verdict").count().orderBy("verdict").collect() == [("allow", 2666), ("block", 1334)]


def test_bloom_has_no_false_negatives_and_few_hits(spark):
    keys = spark.range(3000).select(F.concat(F.lit("u"), "id").alias("url"))
    pages = spark.range(6000).select("id", F.concat(F.lit("http://u"), "id").alias("url"))
    out = U.filter_urls(pages, keys, max_blocks=16)
    assert out.filter("verdict = 'block'").agg(F.count("*"), F.max("id")).first()[:] == (3000, 2999)
