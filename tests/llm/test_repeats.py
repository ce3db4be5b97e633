import collections
import hashlib
import random

import numpy as np
import pytest

from tabwarden.llm import repeats

SPAN = repeats.SPAN


def brute(texts):
    data = [(t or "").encode() for t in texts]
    count = collections.Counter(b[k : k + SPAN] for b in data for k in range(len(b) - SPAN + 1))
    out = []
    for b in data:
        gone = bytearray(len(b))
        for k in range(len(b) - SPAN + 1):
            if count[b[k : k + SPAN]] > 1:
                gone[k : k + SPAN] = b"\1" * SPAN
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def noise(seed, n, alphabet="abcdefgh é\n"):
    return "".join(random.Random(seed).choices(alphabet, k=n))


def planted():
    passage, other = noise(1, 450), noise(2, 199)
    shared = noise(3, 205)
    rows = [noise(10 + i, 300) + passage + noise(50 + i, 100 * i) for i in range(6)]
    rows += [noise(70, 90) + passage[:180] + "X" + passage[181:], passage[100:320], other + "a", "b" + other]
    rows += [noise(80, 40) + shared + noise(81, 10) + shared, "ab" * 400, "z" * 199, "z" * 200, "z" * 201, None, "", "short"]
    rows += [noise(90, 900)] * 3 + [noise(90, 900)[:500] + noise(91, 400)]
    rows += [noise(200 + i, 60) + shared + noise(300 + i, 60) for i in range(30)]
    return rows


def results(df):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in df.collect()}


def test_against_brute_force(make_docs):
    texts = planted()
    got = results(repeats.remove_repeats(make_docs(list(enumerate(texts)), extra=["h", "body", "t"])))
    assert got == dict(enumerate(brute(texts)))


def test_busy_anchors_are_counted_instead(make_docs, monkeypatch):
    texts = planted()
    monkeypatch.setattr(repeats, "MOST_CONTEXTS", 5)
    assert results(repeats.remove_repeats(make_docs(list(enumerate(texts))))) == dict(enumerate(brute(texts)))


def test_small_indexes_give_the_same(make_docs, monkeypatch):
    texts = planted()
    monkeypatch.setattr(repeats, "INDEX_BYTES", 300)
    assert results(repeats.remove_repeats(make_docs(list(enumerate(texts))))) == dict(enumerate(brute(texts)))


def test_anchors_of_a_long_text_found_in_pieces(monkeypatch):
    import pyarrow as pa

    text = noise(5, 5000) + noise(6, 300) * 3
    windows = lambda: sorted(
        (w, int(a), int(h))
        for _, lo, hi, at, hs, _ in repeats.anchors_of(pa.array([text]))
        for x, y, a, h in zip(lo, hi, at, hs)
        for w in range(x, y + 1)
    )
    whole = windows()
    assert [w for w, *_ in whole] == list(range(len(text.encode()) - SPAN + 1))
    monkeypatch.setattr(repeats, "PIECE", 700)
    assert windows() == whole


def test_repeated_rows_and_rows_without_id(make_docs):
    text = noise(7, 700)
    rows = repeats.remove_repeats(make_docs([(1, text), (1, text), (None, noise(8, 500)), (None, noise(8, 500)), (2, noise(9, 400))])).collect()
    assert sorted((r.doc_id or 0, r.n_removed, r.n_bytes) for r in rows) == sorted(
        [(1, len(text.encode()), len(text.encode()))] * 2
        + [(0, len(noise(8, 500).encode()), len(noise(8, 500).encode()))] * 2
        + [(2, 0, len(noise(9, 400).encode()))]
    )


def test_empty_table(make_docs):
    assert repeats.remove_repeats(make_docs([])).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_matching_statistics_against_brute_force(seed):
    r = random.Random(seed)
    base = "".join(r.choices("ab", k=60))
    contexts = [(base[r.randint(0, 20) : r.randint(30, 60)] + "".join(r.choices("abc", k=r.randint(1, 30)))).encode() for _ in range(12)]
    index = repeats.RunIndex(np.frombuffer(b"".join(contexts), np.uint8), np.concatenate(([0], np.cumsum([len(c) for c in contexts]))))
    suffixes = [(i, j) for i, c in enumerate(contexts) for j in range(len(c))]

    def common(a, b):
        n = 0
        while n < min(len(a), len(b)) and a[n] == b[n]:
            n += 1
        return n

    want = [max(common(contexts[i][j:], contexts[k][m:]) for k, m in suffixes if (k, m) != (i, j)) for i, j in suffixes]
    assert index.matching_statistics().tolist() == want
    assert index.runs < len(want)
