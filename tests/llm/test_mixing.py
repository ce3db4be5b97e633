import collections

import pytest

from tabwarden.llm import mixing


def shares(sizes):
    """Targets by plain water filling."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if 2 * sizes[s] <= level * weight[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def mixed(make_docs, rows):
    out = [r.asDict() for r in mixing.mix_sizes(make_docs(rows, extra=["size", "rank"])).collect()]
    source = {r[0]: r[3] for r in rows}
    for r in out:
        r["source"] = source[r["doc_id"]]
    return out


@pytest.mark.parametrize("n", [30, 700])
def test_targets_are_met(make_docs, prose, n):
    rows = [(i, prose(i, 3 + i * 7 % 90), "en", [None, "b", "a", "ö", "Z", "hot", "hot", "hot"][i % 8]) for i in range(n)]
    out = mixed(make_docs, rows)
    sizes, largest = collections.Counter(), collections.Counter()
    for r in out:
        assert r["size"] == len(rows[r["doc_id"]][1].split()) and r["taken"] <= 2 * r["size"] and r["taken"] % r["size"] == 0
        sizes[r["source"]] += r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    want = shares(sizes)
    taken = collections.Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        taken[r["source"]] += r["taken"]
    for s in want:
        # The document that fills the gap best leaves half of the largest one at most.
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1


def test_reruns_and_row_order_agree(make_docs, prose):
    rows = [(i, prose(i, 5 + i % 60), "en", f"s{i % 5}") for i in range(200)]
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, mixed(make_docs, rows))) == sorted(map(key, mixed(make_docs, rows[::-1])))


def test_empty_texts_repeated_rows_and_missing_keys(make_docs, prose):
    rows = [(1, None, "en", "a"), (2, "", "en", "empty"), (3, prose(3, 50), "en", "a"), (3, prose(3, 50), "en", "a"), (None, prose(4, 70), "en", "b")]
    out = mixing.mix_sizes(make_docs(rows)).collect()
    assert len(out) == 5
    assert all(r.taken == 0 for r in out if r.doc_id in (1, 2))
    assert len({r.taken for r in out if r.doc_id == 3}) == 1
    assert {r.doc_id: r.source_size for r in out} == {1: 100, 2: 0, 3: 100, None: 70}


def test_only_empty_texts_and_empty_table(make_docs):
    assert [r.taken for r in mixing.mix_sizes(make_docs([(1, None), (2, " ")])).collect()] == [0, 0]
    assert mixing.mix_sizes(make_docs([])).count() == 0
    assert mixing.mix_documents(make_docs([])).count() == 0


def test_the_stage_takes_what_the_sizes_say(make_docs, prose):
    rows = [(i, prose(i, 1 + i % 40), "en", f"s{i % 4}") for i in range(150)]
    docs = make_docs(rows, extra=["size", "src", "key", "p", "rank"])
    want = {r.doc_id: r.taken // r.size for r in mixing.mix_sizes(docs).collect() if r.taken}
    out = mixing.mix_documents(docs)
    assert out.columns == docs.columns
    assert collections.Counter(r.doc_id for r in out.collect()) == want


def test_longer_documents_expect_more_copies(make_docs, prose):
    docs = make_docs([(i, prose(i, 4 if i % 2 else 400), "en", "ab"[i % 3 > 0]) for i in range(300)])
    sizes = mixing.doc_sizes(docs, ["doc_id", "source"])
    plan = mixing.mix_plan(sizes, "source", "doc_id", 7).collect()
    for s in ("a", "b"):
        copies = {r["class"]: r.copies for r in plan if r.source == s}
        assert copies[3] <= copies[9] <= 2
