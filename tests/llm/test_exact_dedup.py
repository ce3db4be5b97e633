"""Exact copies against a dictionary of normalised texts."""

import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tabwarden.llm import exact_dedup


def plainly(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in rows]
    groups = collections.defaultdict(list)
    for r, n in zip(rows, norm):
        groups[n].append(r[0])
    least = {n: min((k for k in keys if k is not None), default=None) for n, keys in groups.items()}
    return collections.Counter((r[0], least[n], len(groups[n]), hashlib.sha256(n.encode()).hexdigest()) for r, n in zip(rows, norm))


def check(df, rows, **how):
    got = exact_dedup.exact_duplicates(df, **how).collect()
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == plainly(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) and all(r.doc_id == r.keep_id for r in kept)


@pytest.fixture(scope="module")
def rows(request):
    words = [f"w{i * 7919 % 1000} bosc{chr(97 + i % 26)}" for i in range(3000)]
    long = " ".join(words)
    return [
        (5, long), (3, long.replace(" ", "\n")), (9, long + " "), (4, long[:-1]), (None, long), (None, None), (7, None), (6, ""), (8, " "),
        (1, "\t\r\n"), (2, "a  b"), (2, "a  b"), (12, "a b"), (13, "x" * 50_000), (14, "x" * 50_000), (15, "x" * 49_999), (16, "é。ü！" * 900),
    ]


def test_nulls_ties_repeats_long_texts_and_clashing_names(make_docs, rows):
    check(make_docs(rows, extra=["row", "recipe", "hash", "whole", "parts", "first", "size", "keep_id", "chunk"]), rows)


def test_shared_identifiers_are_found_and_replaced(make_docs, rows):
    narrow = lambda c: F.substring(F.md5(c), 1, 2)
    more = rows + [(100 + i, f"text {i}") for i in range(600)]
    check(make_docs(more), more, digests=(narrow, F.md5))
    with pytest.raises(exact_dedup.UnverifiedChunks):
        exact_dedup.exact_duplicates(make_docs(more), digests=(narrow,))


def test_without_broadcast(make_docs, rows, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BROADCAST_RECIPES", 0)
    check(make_docs(rows), rows)


def test_chunks_put_together_are_the_text(spark, rows):
    df = spark.createDataFrame([r for r in rows if r[1]], "id bigint, text string")
    for r in df.select("text", exact_dedup.chunks(F.col("text")).alias("c")).collect():
        assert "".join(r.c) == r.text and max(map(len, r.c)) <= exact_dedup.MOST + 2


def test_empty_table(make_docs):
    assert exact_dedup.exact_duplicates(make_docs([])).collect() == []
