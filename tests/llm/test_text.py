import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwarden.llm import text as tx

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(alphabet="aAb é\n\t\x0b\x1f ", max_size=40)), max_size=8)


@settings(deadline=None, max_examples=150)
@given(TEXTS)
def test_words_are_those_of_the_pattern(texts):
    data, offsets = tx.utf8(pa.array(texts, pa.string()))
    start, end, bounds = tx.word_spans(data, offsets)
    for i, t in enumerate(texts):
        got = [data[a:b].tobytes().decode() for a, b in zip(start[bounds[i] : bounds[i + 1]], end[bounds[i] : bounds[i + 1]])]
        assert got == WORD.findall(t or "")


@settings(deadline=None, max_examples=150)
@given(TEXTS)
def test_shingles_are_equal_where_words_are(texts):
    data, offsets = tx.utf8(pa.array(texts, pa.string()))
    hashes, bounds = tx.shingles(data, offsets, 3)
    names = {}
    for i, t in enumerate(texts):
        words = WORD.findall((t or "").replace("A", "a"))
        want = [tuple(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
        got = hashes[bounds[i] : bounds[i + 1]].tolist()
        assert len(got) == len(want)
        for g, w in zip(got, want):
            assert names.setdefault(w, g) == g
    assert len(set(names.values())) == len(names)


def test_slices_hold_every_row_once():
    offsets = np.array([0, 5, 5, 100, 101, 103])
    got = list(tx.slices(offsets, 10))
    assert [i for a, b in got for i in range(a, b)] == [0, 1, 2, 3, 4]


@pytest.mark.parametrize("column", [pa.array([], pa.string()), pa.array(["abc", None, "dé"]).slice(1)])
def test_offsets_of_sliced_columns(column):
    data, offsets = tx.utf8(column)
    assert [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])] == [x or "" for x in column.to_pylist()]
