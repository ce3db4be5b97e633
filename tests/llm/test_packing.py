import collections

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tabwarden.llm import packing

VOCABULARY = open(packing.TOKENIZER, "rb").read()


def encode(text):
    return packing.encoder(VOCABULARY, packing.PATTERN).encode_ordinary(text)


def documents(rows, row=packing.ROW):
    """Token ids of every document, put together from its segments; (doc_id, n) for the n-th such id."""
    parts = collections.defaultdict(lambda: collections.defaultdict(list))
    for r in rows:
        for doc, part, ids in packing.segments(r.asDict(), row):
            parts[doc][part].append(ids.tolist())
    return parts


def test_round_trip(make_docs, prose):
    texts = {0: "", 1: None, 2: "héllo  wörld\n\n x", 3: prose(1, 30_000), 4: "a" * 5000, 5: prose(2, 40), 6: "<|endoftext|> \x00"}
    rows = packing.pack_documents(make_docs(list(texts.items()), extra=["ids", "row"])).collect()
    parts = documents(rows)
    for doc, text in texts.items():
        ids = [i for p in sorted(parts[doc]) for i in parts[doc][p][0]]
        assert ids == encode(text or "") + [packing.END_ID]
        assert packing.encoder(VOCABULARY, packing.PATTERN).decode(ids[:-1]) == (text or "")


def test_rows_bounds_and_positions(make_docs, prose):
    rows = packing.pack_documents(make_docs([(i, prose(i, 1 + i * 3)) for i in range(150)]).coalesce(1)).collect()
    assert len({(r.shard, r.row) for r in rows}) == len(rows)
    for r in rows:
        assert r.bounds[0] == 0 and r.bounds[-1] == r.n_tokens <= packing.ROW
        assert len(r.doc_ids) == len(r.parts) == len(r.bounds) - 1
        positions = np.frombuffer(r.positions, "<u2")
        assert len(positions) == packing.ROW == len(r.ids) // 2
        for a, b in zip(r.bounds[:-1], r.bounds[1:]):
            assert positions[a:b].tolist() == list(range(b - a))
    assert sum(r.n_tokens for r in rows) > 0.97 * (len(rows) - 1) * packing.ROW


def test_small_rows_split_documents(make_docs, prose):
    text = prose(3, 100)
    rows = packing.pack_documents(make_docs([(1, text), (None, "x")]), row=16).collect()
    parts = documents(rows, 16)
    assert [i for p in sorted(parts[1]) for i in parts[1][p][0]] == encode(text) + [packing.END_ID]
    assert parts[None][0] == [encode("x") + [packing.END_ID]]


def test_repeated_rows_are_packed_each(make_docs):
    parts = documents(packing.pack_documents(make_docs([(1, "same text"), (1, "same text")])).collect())
    assert parts[1][0] == [encode("same text") + [packing.END_ID]] * 2


def test_empty_table(make_docs):
    assert packing.pack_documents(make_docs([])).count() == 0


def test_shards_are_bounded(make_docs, prose, monkeypatch):
    monkeypatch.setattr(packing, "SHARD_TOKENS", 500)
    docs = make_docs([(i, prose(i, 50)) for i in range(30)]).coalesce(1)
    shards = packing._pack(type("B", (), {"value": VOCABULARY}), packing.PATTERN, packing.END_ID, 64, "<u2")
    monkeypatch.setattr(packing.TaskContext, "get", lambda: type("C", (), {"partitionId": lambda self: 0})())
    out = [r for b in shards(iter(docs.select("doc_id", "text").toArrow().to_batches())) for r in b.to_pylist()]
    assert len({r["shard"] for r in out}) > 5
    assert sum(r["n_tokens"] for r in out) == sum(len(encode(prose(i, 50))) + 1 for i in range(30))


def test_written_rows_are_read_back(spark, make_docs, prose, tmp_path):
    packed = packing.pack_documents(make_docs([(i, prose(i, 30)) for i in range(20)]))
    packing.write_packed(packed, str(tmp_path / "rows"))
    key = lambda r: (r.shard, r.row)
    assert sorted(packing.read_packed(spark, str(tmp_path / "rows")).collect(), key=key) == sorted(packed.collect(), key=key)


@settings(deadline=None, max_examples=100)
@given(st.lists(st.integers(1, 20), max_size=60))
def test_best_fit_decreasing(lengths):
    rows = packing.best_fit(np.array(lengths, np.int64), 20)
    assert sorted(p for r in rows for p in r) == list(range(len(lengths)))
    # The same by looking at every open row.
    room, want = [], []
    for p in sorted(range(len(lengths)), key=lambda p: -lengths[p]):
        fits = [r for r in range(len(room)) if room[r] >= lengths[p]]
        if fits:
            least = min(room[r] for r in fits)
            best = next(r for r in fits if room[r] == least)
        else:
            room.append(20)
            want.append(0)
            best = len(room) - 1
        room[best] -= lengths[p]
        want[best] += lengths[p]
    assert sorted(sum(lengths[p] for p in r) for r in rows) == sorted(want)


@pytest.mark.parametrize("text", ["", "a b c", "word " * 50, "a  b\n c d " * 20, "nospace" * 30])
def test_parts_have_the_tokens_of_the_whole(text, monkeypatch):
    monkeypatch.setattr(packing, "TEXT_PART", 7)
    parts = list(packing.text_parts(text))
    assert "".join(parts) == text
    assert [t for p in parts for t in encode(p)] == encode(text)


def test_large_vocabularies_are_refused(make_docs, monkeypatch):
    monkeypatch.setattr(packing, "MAX_VOCABULARY", 10)
    with pytest.raises(ValueError):
        packing.pack_documents(make_docs([]))
