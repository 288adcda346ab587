from __future__ import annotations

import zlib
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kontora.llm import packing as P

TEXTS = ["<|endoftext|>", "a <|endoftext|>  <|endoftext|>b<|endoftext|>", "x  <|endoftext|>\n", "", "a", "Hello world", "two  spaces", " lead", "trail ", "a \nb", "tab\t x", "x  y", "café naïve 12 345!", "<|endoftext|> in text", "a" * 300, "it's we'll  \n\n  end", "x" + " " * 40 + "y", "\n", "  "]


@pytest.fixture(scope="module")
def codec():
    return P.Encoder(P.default_tokenizer())


@lru_cache
def tokenizer():
    """The tokenizer as it is in the file."""
    return Tokenizer.from_file(P.default_tokenizer())


def whole(text):
    return tokenizer().encode(text, add_special_tokens=False).ids


def ids(codec, text):
    return np.frombuffer(codec.encode([text])[0], "<u4").tolist()


def test_ids_equal_the_untouched_tokenizer(codec):
    assert codec.fast is not None
    for t in TEXTS:
        assert ids(codec, t) == whole(t), t[:40]
    assert ids(codec, "<|endoftext|>") == [50256]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from([*" \n\t \x1cab'sZ9.,é中𝄞\u0301\u200d\u3000", "<|endoftext|>", "<|endof", "text|>", "'ll", "the", " and"]), max_size=30).map("".join))
def test_ids_of_random_texts(text):
    assert ids(P.encoder(P.default_tokenizer()), text) == whole(text)


def test_ids_of_documents(codec):
    import pyarrow.parquet as pq

    for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist():
        assert ids(codec, t or "") == whole(t or "")


def test_texts_beyond_the_pattern(codec):
    for t in (" " * 1_100_000, "\n" * 1_100_000 + "x", "a" * 200_000):
        assert ids(codec, t) == whole(t)


def test_other_kinds_of_files_use_their_tokenizer(tmp_path):
    import json

    with open(P.default_tokenizer(), encoding="utf-8") as f:
        other = json.load(f)
    other["model"]["merges"][5], other["model"]["merges"][6] = other["model"]["merges"][6], other["model"]["merges"][5]
    (tmp_path / "other.json").write_text(json.dumps(other))
    codec = P.Encoder(str(tmp_path / "other.json"))
    assert codec.fast is None
    assert ids(codec, "the other <|endoftext|>") == Tokenizer.from_file(str(tmp_path / "other.json")).encode("the other <|endoftext|>", add_special_tokens=False).ids


def least_bins(sizes, capacity):
    """Brute force: the least number of bins."""
    best = len(sizes)

    def place(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for b in sorted({r for r in bins if r >= sizes[i]}):
            k = bins.index(b)
            bins[k] -= sizes[i]
            place(i + 1, bins)
            bins[k] += sizes[i]
        bins.append(capacity - sizes[i])
        place(i + 1, bins)
        bins.pop()

    place(0, [])
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=9))
def test_reduction_keeps_an_optimum(sizes):
    """What the reduction fixes can be completed to an optimal packing."""
    histogram = {w: sizes.count(w) for w in set(sizes)}
    p = P.Packer(histogram, 12)
    p.reduce()
    rest = [w for w, n in p.left.items() for _ in range(n)]
    fixed = sum(p.patterns.values())
    assert fixed + (least_bins(sorted(rest, reverse=True), 12) if rest else 0) == least_bins(sorted(sizes, reverse=True), 12)


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 1024), st.integers(1, 50), max_size=40))
def test_patterns_hold_every_piece_once(histogram):
    patterns = P.Packer(histogram, 1024).pack()
    seen = defaultdict(int)
    for content, n in patterns.items():
        assert sum(content) <= 1024
        for w in content:
            seen[w] += n
    assert dict(seen) == histogram


def test_cut_points():
    assert P.cut_points(1024, 1024) == [0]
    assert P.cut_points(2500, 1024) == [0, 452, 1476]
    assert P.cut_points(2048, 1024) == [0, 1024]


def test_pieces_are_whole_and_gapless(spark, codec):
    texts = [*TEXTS, None, "word " * 3000, "b " * 700, "dup", "dup"]
    df = spark.createDataFrame([(i if t != "dup" else 99, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, sequence_id string")
    rows = P.pack_documents(df, P.default_tokenizer(), keep_ids=True).collect()
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
        assert r.ids_crc32 == zlib.crc32(bytes(r.ids)) and len(r.ids) == 4 * r.length
    for i, t in enumerate(texts):
        if t != "dup":
            parts = sorted(by_doc[i], key=lambda r: r.piece)
            ids = np.frombuffer(b"".join(bytes(r.ids) for r in parts), "<u4").tolist()
            assert ids == [*(whole(t) if t else []), 2]
            assert [r.start for r in parts] == P.cut_points(len(ids), 1024)
    assert len(by_doc[99]) == 2
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert P.pack_documents(df, P.default_tokenizer()).count() == 0
