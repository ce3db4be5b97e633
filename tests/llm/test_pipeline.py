"""The whole pipeline on a small corpus, stage by stage against plain Python."""

import corpus_pipeline
import pytest

import __spark_entry__
from tabwarden.llm import decontaminate, packing, queries
from tests_llm_support import quality_keeps, similar_groups


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    return str(tmp_path_factory.mktemp("corpus"))


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and set(queries.QUERIES) <= set(names)
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
    assert 4 <= len(corpus_pipeline.STAGES) <= 5


def test_stages_against_plain_python(spark, make_docs, prose, folder):
    item = prose(77, 30)
    rows = [(i, prose(i, 20 + i % 50), "en", f"s{i % 3}") for i in range(60)]
    rows += [(100 + i, prose(i, 20 + i % 50) + " more", "en", "s1") for i in range(0, 60, 7)]
    rows += [(200, "too few", "en", "s0"), (201, None, "en", "s2"), (202, "again and again it is " * 30, "en", "s0")]
    rows += [(300, prose(90, 40) + " " + item, "en", "s2"), (301, prose(91, 40) + " " + item.upper(), None, None)]
    docs = make_docs(rows)
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    texts = {r[0]: r[1] for r in rows}

    out = spark.read.parquet(f"{folder}/documents.parquet")
    kept = dict(texts)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, out, folder)
        assert out.columns == docs.columns
        got = [r.doc_id for r in out.collect()]
        if name == "quality rules":
            kept = {i: t for i, t in kept.items() if quality_keeps(t)}
        elif name == "near duplicates":
            kept = {i: kept[i] for i in similar_groups(kept, 80)}
        elif name == "benchmark decontamination":
            kept = {i: t for i, t in kept.items() if decontaminate.normalised(item) not in decontaminate.normalised(t)}
        else:
            assert set(got) <= set(kept) and max(got.count(i) for i in got) <= 2
            taken = sum(len(texts[i].split()) for i in got)
            assert abs(taken - 1.5 * sum(len(t.split()) for t in kept.values())) < 150
            continue
        assert sorted(got) == sorted(kept), name

    tokens = lambda t: packing.encoder(open(packing.TOKENIZER, "rb").read(), packing.PATTERN).encode_ordinary(t)
    packed = corpus_pipeline.run(spark, folder).collect()
    assert sum(r.n_tokens for r in packed) == sum(len(tokens(texts[i])) + 1 for i in got)
    assert sorted(d for r in packed for d, p in zip(r.doc_ids, r.parts) if p == 0) == sorted(got)
