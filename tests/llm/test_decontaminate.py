import random

import numpy as np
import pytest

from tabwarden.llm import decontaminate as dc


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id bigint, text string")


def distance(item, text):
    """Least edits from the item to any part of the text, by the whole table."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def edited(text, seed, n):
    r = random.Random(seed)
    out = list(text)
    for _ in range(n):
        k = r.randrange(len(out))
        kind = r.randrange(3)
        if kind == 0:
            out[k] = "#"
        elif kind == 1:
            del out[k]
        else:
            out.insert(k, "%")
    return "".join(out)


def test_exact_and_edited_copies(spark, make_docs, prose):
    wanted = [(i, prose(i, 30)) for i in range(12)]
    rows = [(i, prose(100 + i, 80)) for i in range(30)]
    for i in range(12):
        most = int(len(dc.normalised(wanted[i][1])) * dc.MAX_EDITS)
        rows += [
            (1000 + i, prose(200 + i, 50) + " " + wanted[i][1].upper().replace(" ", "\n  ") + " " + prose(300 + i, 20)),
            (2000 + i, prose(400 + i, 50) + " " + edited(wanted[i][1], i, most) + " tail"),
            (3000 + i, prose(500 + i, 50) + " " + edited(wanted[i][1], i, 4 * most)),
            (4000 + i, wanted[i][1][: len(wanted[i][1]) // 2] + prose(600 + i, 50)),
        ]
    got = {r.doc_id: r for r in dc.contamination(make_docs(rows, extra=["item_id", "found"]), items(spark, wanted)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        clean = dc.normalised(text)
        want = []
        for k, item in wanted:
            pattern = dc.normalised(item)
            if i % 1000 == k or i < 1000:
                if distance(pattern, clean) <= int(len(pattern) * dc.MAX_EDITS):
                    want.append(k)
        assert got[i].item_ids == want, i
        for c in got[i].copies:
            part = text[c.start : c.end]
            assert distance(dc.normalised(wanted[c.item_id][1]), dc.normalised(part)) == c.edits
    assert all(got[1000 + i].item_ids == [i] and got[2000 + i].item_ids == [i] for i in range(12))
    assert not any(got[4000 + i].contaminated for i in range(12))


def test_items_in_blocks_give_the_same(spark, make_docs, prose, monkeypatch):
    wanted = items(spark, [(i, prose(i, 30)) for i in range(9)])
    docs = make_docs([(i, prose(50 + i, 20) + " " + prose(i % 12, 30) + " " + prose((i + 3) % 12, 30)) for i in range(24)])
    whole = sorted(dc.contamination(docs, wanted).collect(), key=lambda r: r.doc_id)
    monkeypatch.setattr(dc, "BLOCK_CHARS", 400)
    assert len(list(dc.item_blocks(wanted))) > 3
    assert sorted(dc.contamination(docs, wanted).collect(), key=lambda r: r.doc_id) == whole


def test_nulls_short_items_repeats_and_empty_tables(spark, make_docs, prose):
    item = prose(1, 30)
    wanted = items(spark, [(1, item), (1, item), (2, None), (None, item), (3, "short"), (4, "")])
    rows = [(1, None), (2, ""), (3, item), (3, item), (None, item), (5, "short " * 40), (6, item + " " + item), (7, "x" * 300_000 + " " + item)]
    got = sorted(dc.contamination(make_docs(rows), wanted).collect(), key=lambda r: r.doc_id or 0)
    assert [(r.doc_id, r.contaminated) for r in got] == [
        (None, True), (1, False), (2, False), (3, True), (3, True), (5, False), (6, True), (7, True),
    ]
    assert dc.contamination(make_docs([]), wanted).count() == 0
    none = dc.contamination(make_docs(rows), items(spark, [])).collect()
    assert len(none) == len(rows) and not any(r.contaminated for r in none)
    docs = make_docs(rows, extra=["start"])
    out = dc.drop_contaminated(docs, wanted)
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == [1, 2, 5]


def test_every_length_and_all_edits_in_the_budget(spark, make_docs, prose):
    """Recall 1 against the whole table for items of 25 to 60 characters; the bound is never 0."""
    assert all(n + 1 - dc.gram_size(n) * (dc.most_edits(n) + 1) >= 1 for n in range(1, 20_000))
    wanted, rows = [], []
    for n in range(dc.MIN_ITEM, 61):
        item = dc.normalised(prose(9_000 + n, 40))[:n].rstrip().ljust(n, "z")
        wanted.append((n, item))
        for k in range(dc.most_edits(n) + 2):
            # Edits at equal distances leave the shortest pieces.
            places = [(j + 1) * n // (k + 1) for j in range(k)]
            spread = "".join("#" if c in places else x for c, x in enumerate(item))
            rows += [(100 * n + 10 * k, prose(n, 6) + " " + spread + " " + prose(n + 1, 6)), (100 * n + 10 * k + 1, edited(item, n + k, k))]
    got = {r.doc_id: r for r in dc.contamination(make_docs(rows), items(spark, wanted)).collect()}
    for i, text in rows:
        clean = dc.normalised(text)
        assert set(got[i].item_ids) == {n for n, w in wanted if distance(w, clean) <= dc.most_edits(n)}, i


def test_short_items_are_reported_apart(spark, make_docs):
    wanted = items(spark, [(1, "What is  2+2?"), (2, "of"), (3, "who am I"), (4, "who AM i"), (5, "x" * 24)])
    rows = [(1, "He asked: 'what is\n2+2?' of me"), (2, "often, who am  I."), (3, "who am Io"), (4, None), (5, "y" + "x" * 24)]
    got = {r.doc_id: r for r in dc.contamination(make_docs(rows), wanted).collect()}
    assert {i: sorted(r.short_ids) for i, r in got.items()} == {1: [1, 2], 2: [3, 4], 3: [], 4: [], 5: []}
    assert not any(r.contaminated or r.n_items or r.copies for r in got.values())
    assert sorted(r.doc_id for r in dc.drop_contaminated(make_docs(rows), wanted, short=True).collect()) == [3, 4, 5]
    assert dc.drop_contaminated(make_docs(rows), wanted).count() == 5


def test_names_of_columns_do_not_clash(spark, make_docs, prose):
    item = prose(1, 30)
    docs = make_docs([(1, item), (2, "clean")], extra=["__found", "___FOUND", "a.b"])
    kept = dc.drop_contaminated(docs, items(spark, [(1, item)]))
    assert kept.columns == docs.columns
    assert kept.collect() == docs.where("doc_id = 2").collect()


@pytest.mark.parametrize("seed", range(8))
def test_alignment_against_the_whole_table(seed):
    r = random.Random(seed)
    item = "".join(r.choices("abc", k=30))
    text = "".join(r.choices("abc", k=r.randint(0, 15))) + edited(item, seed, seed % 4) + "".join(r.choices("abc", k=r.randint(0, 15)))
    most = 4
    codes = [dc.codes(x).astype(np.int64) for x in (item, text)]
    found = dc.align(*codes, -len(item), len(text), most)
    want = distance(item, text)
    assert (found[0] if found else None) == (want if want <= most else None)
    if found:
        assert distance(item, text[found[1] : found[2]]) == want


def test_places_of_normalised_characters():
    text = "  Ab\n\n c\0İd  e "
    clean, where = dc.normalised(text), dc.places(text)
    assert len(where) == len(clean) + 1
    for c, k in zip(clean, where):
        assert c == " " or dc.lowered(text)[k] == c
