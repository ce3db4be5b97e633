import random
import zlib

import numpy as np

from tabwarden.llm import language

WORDS = {
    "en": "the of and that with from house water which there would people thing".split(),
    "de": "der und nicht haus wasser welche über straße möchte leute schön zwischen".split(),
    "fr": "le et les maison eau été où qui être gens garçon voilà toujours".split(),
}


def sample(n, seed=0):
    r = random.Random(seed)
    langs = sorted(WORDS)
    return [(i, " ".join(r.choices(WORDS[langs[i % 3]], k=r.randint(3, 60))), langs[i % 3]) for i in range(n)]


def test_held_out_accuracy(make_docs):
    rows = sample(300)
    got = language.identify(make_docs(rows, extra=["lang_pred", "pick"])).collect()
    assert len(got) == 300
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 3 == 1}
    assert np.mean([r.lang_pred == rows[r.doc_id][2] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_labels_sources_and_ids_do_not_decide(make_docs):
    rows = sample(150)
    first = {r.doc_id: r for r in language.identify(make_docs(rows)).collect()}
    held = [i for i, r in first.items() if r.held_out]
    # Labels of held-out rows are not learned from.
    changed = [(i, t, "xx" if i in held else lang, "other") for i, t, lang in rows]
    second = {r.doc_id: r for r in language.identify(make_docs(changed)).collect()}
    assert all(first[i] == second[i] for i in held)


def test_texts_without_letters_and_nulls(make_docs):
    odd = [(900, None, "en"), (901, "", "en"), (902, "123 !? _", "en"), (903, "the house", None), (None, "der und nicht", "de"), (904, "the " * 100_000, "en")]
    got = {r.doc_id: r for r in language.identify(make_docs(sample(150) + odd)).collect()}
    for i in (900, 901, 902):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[903].lang_pred == "en" and got[None].lang_pred == "de" and not got[None].held_out and got[904].lang_pred == "en"


def test_distant_texts_are_rejected(make_docs):
    got = {r.doc_id: r for r in language.identify(make_docs(sample(300) + [(999, "これはぺんです" * 20, None)])).collect()}
    assert got[999].rejected and got[999].lang_pred in WORDS
    assert np.mean([r.rejected for i, r in got.items() if i != 999]) < 0.1


def test_no_label_and_empty_table(make_docs):
    assert [r.lang_pred for r in language.identify(make_docs([(1, "text", None), (2, None, None)])).collect()] == ["und", "und"]
    assert language.identify(make_docs([])).count() == 0


def test_repeated_rows_are_predicted_alike(make_docs):
    rows = sample(120) + [sample(120)[4]] * 50
    got = [r for r in language.identify(make_docs(rows)).collect() if r.doc_id == 4]
    assert len(got) == 51 and len(set(got)) == 1


def test_several_centroids_for_a_language():
    r = np.random.default_rng(0)
    points = np.abs(np.concatenate([r.normal(c, 0.05, (40, 6)) for c in np.eye(6)[:3]]))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    centroids = language.spherical_means(points, 3)
    assert (points @ centroids.T).max(axis=1).min() > 0.9
    assert len(language.spherical_means(np.ones((5, 4)) / 2, 4)) == 1


def test_letters_are_unicode_letters(spark):
    texts = ["²½", "Ⅷ", "12_ ٣", "a²", "ß", "漢", "ʰ", "", None, "²½ é"]
    want = [False, False, False, True, True, True, True, False, False, True]
    assert [language.has_letter(t) for t in texts] == want
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    assert [r[0] for r in rows.orderBy("i").selectExpr(r"coalesce(t rlike '\\p{L}', false)").collect()] == want
