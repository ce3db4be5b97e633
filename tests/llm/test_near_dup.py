import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from tabwarden.llm import near_dup
from tabwarden.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        shared = len(sets[a] & sets[b])
        if shared and 100 * shared >= percent * len(sets[a] | sets[b]):
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i), root(i) == i) for i in sets}


def ruled_out(threshold):
    """Chance that the sketches of a pair at the threshold differ in too many bits: samples that differ, then bits that end odd."""
    bits, limit = near_dup.SKETCH, near_dup.most_differing(threshold)
    k = np.arange(bits + 1)
    odd, chance = np.zeros(bits + 1), 0.0
    odd[0] = 1
    for differing in range(near_dup.SAMPLES + 1):
        weight = math.comb(near_dup.SAMPLES, differing) * (1 - threshold) ** differing * threshold ** (near_dup.SAMPLES - differing)
        chance += weight * odd[limit + 1 :].sum()
        for _ in range(2):
            step = np.zeros(bits + 1)
            step[1:] += odd[:-1] * (bits - k[:-1]) / bits
            step[:-1] += odd[1:] * k[1:] / bits
            odd = step
    return chance


@pytest.mark.parametrize("threshold,stated", [(0.8, 4.3e-7), (0.85, 1e-8)])
def test_sketches_rarely_rule_out_a_pair_at_the_threshold(threshold, stated):
    assert ruled_out(threshold) <= stated
    no_band = (1 - threshold**near_dup.BAND) ** near_dup.BANDS
    assert no_band + ruled_out(threshold) < {0.8: 3.7e-6, 0.85: 3.1e-8}[threshold]


def edited(text, seed, changes):
    r = random.Random(seed)
    words = text.split()
    for _ in range(changes):
        words[r.randrange(len(words))] = f"new{seed}x{r.randint(0, 999)}"
    return " ".join(words)


def corpus(prose):
    base, other = prose(1, 300), prose(2, 120)
    rows = [base, base.upper(), base, *[edited(base, k, 1 + k % 9) for k in range(60)]]
    rows += [*[edited(other, k, k % 4) for k in range(20)], None, "", "a b", "A  B", "a c", " \n", "w " * 500, "w " * 9]
    rows += [prose(10 + i, 80) for i in range(20)] + [prose(5, 5000), edited(prose(5, 5000), 3, 20)]
    # A chain: each is near the next, the ends are not near each other.
    words = prose(6, 420).split()
    rows += [" ".join(words[8 * k : 8 * k + 200]) for k in range(12)]
    return list(enumerate(rows))


def results(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


def test_groups_against_brute_force(make_docs, prose):
    rows = corpus(prose)
    for percent in (80, 85):
        got = results(near_dup.near_duplicates(make_docs(rows, extra=["digest", "bands", "rep", "u"]), percent))
        assert got == brute(rows, percent)


@pytest.mark.parametrize("size,shingles", [(256, 1_000_000), (7, 1_000_000), (256, 2_000)])
def test_open_buckets_lose_no_link(make_docs, prose, monkeypatch, size, shingles):
    """Without the star links everything comes from comparing blocks."""
    monkeypatch.setattr(near_dup, "BLOCK", size)
    monkeypatch.setattr(near_dup, "BLOCK_SHINGLES", shingles)
    real = near_dup.confirm_pairs
    monkeypatch.setattr(near_dup, "confirm_pairs", lambda *how: real(*how).limit(0))
    rows = [(i, edited(prose(1, 300), i, 1 + i % 3)) for i in range(40)] + [(100 + i, prose(50 + i, 60)) for i in range(5)]
    assert results(near_dup.near_duplicates(make_docs(rows), 80)) == brute(rows, 80)


def test_block_counts_and_joining_links():
    r = np.random.default_rng(2)
    sets = [np.unique(r.integers(0, 300, 100).astype(np.uint64)) for _ in range(20)]
    got = near_dup.shared_counts(sets[:8], sets[8:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[8:]] for a in sets[:8]]
    assert near_dup.shared_counts([np.array([1], np.uint64)], [np.array([2], np.uint64)]).tolist() == [[0]]
    links = near_dup.joining_links(np.ones((3, 3), bool), np.array([1, 2, 3]), np.array([1, 2, 3]))
    assert len(links) == 2


def test_ids_picked_by_shuffle(make_docs, prose, monkeypatch):
    monkeypatch.setattr(near_dup, "BROADCAST_IDS", 0)
    rows = corpus(prose)[:30]
    assert results(near_dup.near_duplicates(make_docs(rows), 80)) == brute(rows, 80)


def test_repeated_and_missing_ids(make_docs, prose):
    a, b = prose(1, 100), prose(2, 100)
    rows = [(5, a), (5, a), (7, a), (None, a), (None, None), (9, b), (7, b)]
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_dup.near_duplicates(make_docs(rows)).collect())
    # Document 7 has both texts and so joins them.
    assert got == [(0, None, True), (0, None, True), (5, 5, True), (5, 5, True), (7, 5, False), (7, 5, False), (9, 5, False)]
    kept = near_dup.drop_near_duplicates(make_docs(rows)).collect()
    assert sorted(r.doc_id or 0 for r in kept) == [0, 0, 5]


def test_empty_table_and_stage_columns(make_docs, prose):
    assert near_dup.near_duplicates(make_docs([])).count() == 0
    docs = make_docs([(2, prose(1, 50)), (1, prose(1, 50)), (3, None)], extra=["kept", "id"])
    out = near_dup.drop_near_duplicates(docs)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 3]


def test_sketches_estimate_similarity():
    r = np.random.default_rng(1)
    for shared in (0.8, 0.9, 0.97):
        found = []
        for _ in range(60):
            n = 400
            both = r.integers(0, 1 << 62, int(2 * n * shared / (1 + shared)), dtype=np.uint64)
            one = np.unique(np.concatenate((both, r.integers(0, 1 << 62, n - len(both), dtype=np.uint64))))
            two = np.unique(np.concatenate((both, r.integers(0, 1 << 62, n - len(both), dtype=np.uint64))))
            s = near_dup.odd_sketches(near_dup.samples(np.concatenate((one, two)), np.array([0, len(one), len(one) + len(two)])))
            found.append(near_dup.similarity(np.bitwise_count(s[0] ^ s[1]).sum()))
        assert abs(np.mean(found) - shared) < 0.03


def test_sets_of_slices():
    column = pa.array(["a b c d e f", None, "x"])
    (first, hashes, bounds), *rest = near_dup.shingle_sets(column)
    assert first == 0 and bounds.tolist() == [0, 2, 2, 3] and not rest


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(200)] + [(1000 + i, 1000) for i in range(50)] + [(5, 5), (7, 6), (6, 7)]
    got = {r.u: r.v for r in components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {i: 0 for i in range(1, 201)} | {1000 + i: 1000 for i in range(1, 50)}
