import collections
import re

import pytest

from tabwarden.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    seen, same = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            same += line in seen
            seen.add(line)
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    count = collections.Counter(windows)
    covered = {k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), same, len(covered)


NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def test_counts_and_base_rules_against_brute_force(make_docs, prose):
    texts = [
        None, "", " \n\t", "one", "a b c d e f g h i j", "a b c d e a b c d e f", "x é ü # <b> | & %\n\nsame line\nsame line\n same line",
        "w " * 40, prose(1, 3000), "line\n" * 5000, prose(2, 40) + "\n" + prose(2, 40), "word" * 50_000,
    ]
    rows = quality.quality_rules(make_docs(list(enumerate(texts)), extra=["n_words", "kept"])).collect()
    assert len(rows) == len(texts)
    for r in rows:
        want = brute(texts[r.doc_id])
        assert tuple(r[n] for n in NAMES) == want, r.doc_id
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)


def test_repeated_rows_and_missing_keys_are_judged_alone(make_docs, prose):
    good = prose(3, 60)
    rows = quality.quality_rules(make_docs([(1, good), (1, good), (None, good), (2, "few", "en", None)])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.kept) for r in rows) == [
        (False, 1, True), (False, 1, True), (False, 2, False), (True, 0, True),
    ]


def test_a_condemned_host_loses_its_doubtful_documents_only(make_docs, prose):
    marked = " ".join(w + "#" for w in prose(4, 50).split())
    rows = [(i, prose(i, 50), "en", f"h{i % 20}") for i in range(400)]
    rows += [(1000 + i, marked + f" {i}", "en", "bad") for i in range(60)] + [(2000, prose(9, 50), "en", "bad"), (3000, marked, "en", "h1")]
    got = {r.doc_id: r for r in quality.quality_rules(make_docs(rows)).collect()}
    assert not got[1000].kept and got[1000].host_condemned
    assert got[2000].kept and got[2000].host_condemned
    assert got[3000].kept and not got[3000].host_condemned
    kept = {r.doc_id for r in quality.keep_good(make_docs(rows)).collect()}
    assert kept == {k for k, r in got.items() if r.kept}


def test_a_small_host_is_shrunk_to_the_corpus(make_docs, prose):
    rows = [(i, prose(i, 50), "en", f"h{i % 10}") for i in range(200)] + [(900, "few words", "en", "tiny")]
    got = {r.doc_id: r for r in quality.quality_rules(make_docs(rows)).collect()}
    assert not got[900].host_condemned and got[900].host_rate < 0.5


@pytest.mark.parametrize("hosts,docs,failed,square", [(0, 0, 0, 0.0), (1, 5, 5, 5.0), (3, 30, 0, 0.0), (10, 1000, 100, 40.0)])
def test_priors_are_proper(hosts, docs, failed, square):
    a, b = quality.beta_prior(hosts, docs, failed, square)
    assert a > 0 and b > 0


def test_empty_table_and_columns_of_the_stage(make_docs, prose):
    assert quality.quality_rules(make_docs([])).count() == 0
    docs = make_docs([(1, prose(1, 50)), (2, None)], extra=["condemned"])
    out = quality.keep_good(docs)
    assert out.columns == docs.columns and [r.doc_id for r in out.collect()] == [1]


def test_names_of_columns_do_not_clash(make_docs, prose):
    marked = " ".join(w + "#" for w in prose(4, 50).split())
    rows = [(i, prose(i, 50), "en", f"h{i % 20}") for i in range(400)] + [(1000 + i, marked + f" {i}", "en", "bad") for i in range(60)]
    docs = make_docs(rows, extra=["__host", "__counts", "__few_words", "___HOST", "condemned", "a.b"])
    kept = quality.keep_good(docs)
    assert kept.columns == docs.columns
    assert sorted(kept.collect()) == sorted(docs.where("doc_id < 400").collect())
