import random

import pytest

from pyspark.sql import types as T

DOC = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, lang[, source]]) rows, with columns whose names operators use themselves."""

    def make(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "a", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOC)
        for name in extra:
            df = df.selectExpr("*", f"'x' AS `{name}`")
        return df

    return make


@pytest.fixture
def prose():
    """Different words in a fixed order for each seed."""

    def make(seed, n, size=4000):
        r = random.Random(seed)
        return " ".join("".join(r.choices("abcdefghijklmnop", k=r.randint(2, 9))) for _ in range(n))[: size * 10]

    return make
