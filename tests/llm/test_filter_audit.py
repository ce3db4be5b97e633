"""The audit against running the filters one after another in plain Python."""

import itertools
import re

from tabwarden.llm import filter_audit


def plainly(docs, labels):
    facts = []
    for key, text, part in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {
            "A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            "D": bool(re.search("[#$%&*|]", t)), "E": key is not None and any(k is not None and k < key and (u or "") == t for k, u, _ in docs),
        }
        mark = lambda at: any(row[0] == key and row[0] is not None and row[at] == 1 for row in labels)
        facts.append((part or "", {f for f, bad in fails.items() if bad}, mark(1), mark(2)))
    out, share = {}, {}
    for order in itertools.permutations("ABCDE"):
        for part in {f[0] for f in facts}:
            left = [f for f in facts if f[0] == part]
            for step, name in enumerate(order, 1):
                failing = [f for f in facts if f[0] == part and name in f[1]]
                removed = [f for f in left if name in f[1]]
                left = [f for f in left if name not in f[1]]
                share[part, name] = share.get((part, name), 0) + len(removed)
                out[part, "".join(order), step] = (
                    name, len(left), len(removed), len(failing) - len(removed), sum(f[1] == {name} for f in failing),
                    sum(f[2] for f in removed), sum(f[3] for f in removed),
                )
    return {k: (*v[1:], share[k[0], v[0]]) for k, v in out.items()}


def audited(docs, labels):
    return {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.filter_audit(docs, labels).collect()}


def test_nulls_ties_repeats_long_texts_and_clashing_names(spark, make_docs, prose):
    texts = [None, "", prose(1, 150), prose(2, 150), prose(1, 150) + " #", "SHOUT " * 120, "same " * 20_000, "A|B", prose(3, 99)]
    langs = ["en", None, "", "de"]
    rows = [(i, texts[i * 5 % 9], langs[i % 4]) for i in range(40)] + [(3, texts[6], "en"), (3, texts[6], "en"), (None, texts[2], "fr"), (None, None, None)]
    marks = [(i, i % 2, None if i % 3 else 1) for i in range(0, 40, 2)] + [(4, 1, 0), (None, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int, toxic int").selectExpr("*", "1 AS key", "1 AS good")
    names = ["row", "key", "part", "words", "n", "digest", "size", "least", "filter", "before"]
    assert audited(make_docs(rows, extra=names), labels) == plainly(rows, marks)


def test_empty_tables(spark, make_docs):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert audited(make_docs([]), labels) == {}
    rows = [(1, "short", "en"), (2, "short", "en")]
    assert audited(make_docs(rows), labels) == plainly(rows, [])
