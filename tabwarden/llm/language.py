"""Language identification by nearest centroid.

A text is a TF-IDF vector of hashed character n-grams (one to four bytes of the lower-cased text,
anything but letters being a space), scaled to length one. Each language has several
centroids, found by k-means on the cosine in a bounded sample of its labelled texts. A text gets
the language of the centroid with the largest cosine; it is also marked as rejected where that
cosine is below what all but a few of the language's sample texts reach.

Document frequencies are counted over all training documents. The sample has about
``SAMPLE`` texts per language, those with the smallest hashes of their id and text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwarden.llm import text as tx
from tabwarden.session import materialise

BITS = 13
DIMENSIONS = 1 << BITS
LENGTHS = (1, 2, 3, 4)
CENTROIDS = 4
ROUNDS = 12
SAMPLE = 1_500
# Share of a language's sample that is farther away than its rejection limit.
REJECTED_SHARE = 0.002
# Most languages that are learned; labels beyond it are an error, as no text has so many.
MAX_LANGUAGES = 2_000
UNKNOWN = "und"
# Rows of vectors held at once.
ROWS = 256

# Word characters that are no decimal digits: the letters, but also characters like ² and Ⅷ.
LETTERLIKE = re.compile(r"[^\W\d_]")

# Bytes of letters, and of anything outside ASCII, are kept.
LETTERS = np.full(256, 0x20, np.uint8)
LETTERS[0x80:] = np.arange(0x80, 0x100)
LETTERS[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)


def has_letter(text: str | None) -> bool:
    """Whether a character of the Unicode categories L* occurs, as in ``fit``."""
    return bool(text) and any(m[0].isalpha() for m in LETTERLIKE.finditer(text))


def counts(texts: list[str | None]) -> np.ndarray:
    """n-gram counts of each text, hashed to ``DIMENSIONS`` places."""
    out = np.zeros((len(texts), DIMENSIONS), np.float32)
    for row, text in enumerate(texts):
        if not text:
            continue
        data = LETTERS[np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)]
        # Runs of spaces count as one.
        data = data[np.concatenate(([True], (data[1:] != 0x20) | (data[:-1] != 0x20)))]
        gram = np.zeros(len(data), np.uint64)
        for n in range(1, max(LENGTHS) + 1):
            if len(data) < n:
                break
            gram = (gram[: len(data) - n + 1] << np.uint64(8)) | data[n - 1 :]
            if n in LENGTHS:
                place = ((gram + np.uint64(n << 40)) * tx.BASE) >> np.uint64(64 - BITS)
                out[row] += np.bincount(place.astype(np.int64), minlength=DIMENSIONS)
    return out


def vectors(texts: list[str | None], idf: np.ndarray) -> np.ndarray:
    found = np.log1p(counts(texts)) * idf
    norm = np.linalg.norm(found, axis=1, keepdims=True)
    return found / np.maximum(norm, 1e-12)


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    limit: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, cosine, rejected) of each text."""
        cosine = vectors(texts, self.idf) @ self.centroids.T
        best = cosine.argmax(axis=1)
        score = np.clip(cosine[np.arange(len(texts)), best], 0, 1).astype(np.float64)
        lettered = np.array([has_letter(t) for t in texts], bool)
        owner = self.owner[best]
        names = [self.languages[o] if ok else UNKNOWN for o, ok in zip(owner, lettered, strict=True)]
        return names, np.where(lettered, score, 0.0), ~lettered | (score < self.limit[owner])


def held_out(key: Column) -> Column:
    return F.coalesce(F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % 3 == 1, F.lit(False))


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen = np.zeros(DIMENSIONS, np.int64)
    docs = 0
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            seen += (counts(batch.column("text").slice(i, ROWS).to_pylist()) > 0).sum(axis=0)
        docs += batch.num_rows
    if docs:
        place = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(place, -1)), pa.array(np.append(seen[place], docs))], names=["place", "docs"])


def inverse_frequencies(texts: DataFrame) -> np.ndarray:
    """IDF of every place over all rows; at most ``DIMENSIONS`` + 1 numbers reach the driver."""
    found = texts.select("text").mapInArrow(_frequencies, "place bigint, docs bigint")
    rows = found.groupBy("place").agg(F.sum("docs").alias("docs")).toPandas()
    seen = rows.set_index("place")["docs"] if len(rows) else pd.Series(dtype="int64")
    total = float(seen.get(-1, 0))
    idf = np.full(DIMENSIONS, np.log(1 + total) + 1, np.float32)
    seen = seen[seen.index >= 0]
    idf[seen.index.to_numpy(np.int64)] = np.log((1 + total) / (1 + seen.to_numpy())) + 1
    return idf


def _start(points: np.ndarray, k: int) -> np.ndarray:
    """k different points, each the farthest from those before it."""
    chosen = [int((points @ points.mean(axis=0)).argmax())]
    near = points @ points[chosen[0]]
    while len(chosen) < k:
        far = int(near.argmin())
        if near[far] > 1 - 1e-6:
            break
        chosen.append(far)
        near = np.maximum(near, points @ points[far])
    return points[chosen]


def spherical_means(points: np.ndarray, k: int) -> np.ndarray:
    centroids = _start(points, k)
    for _ in range(ROUNDS):
        nearest = (points @ centroids.T).argmax(axis=1)
        means = [points[nearest == c].mean(axis=0) if (nearest == c).any() else centroids[c] for c in range(len(centroids))]
        centroids = np.stack([m / max(np.linalg.norm(m), 1e-12) for m in means])
    return centroids.astype(np.float32)


def _cluster(idf: np.ndarray):
    def cluster(sample: pd.DataFrame) -> pd.DataFrame:
        # Order must not depend on how rows arrived.
        texts = sample.sort_values(["pick", "text"])["text"].tolist()
        points = np.concatenate([vectors(texts[i : i + ROWS], idf) for i in range(0, len(texts), ROWS)])
        centroids = spherical_means(points, CENTROIDS)
        nearest = (points @ centroids.T).max(axis=1)
        limit = float(np.quantile(nearest, REJECTED_SHARE))
        return pd.DataFrame({"lang": sample["lang"].iloc[0], "limit": limit, "centroid": [c.tobytes() for c in centroids]})

    return cluster


def fit(labelled: DataFrame) -> Model | None:
    """Model from rows of (doc_id, text, lang); None without a labelled text that has a letter.

    The sample of a language is bounded, so its clustering is one bounded task; what reaches
    the driver is ``CENTROIDS`` vectors for each of at most ``MAX_LANGUAGES`` languages.
    """
    usable = labelled.where("text IS NOT NULL AND lang IS NOT NULL").where(F.col("text").rlike(r"\p{L}"))
    pick = F.pmod(F.xxhash64("text", "lang", "doc_id"), F.lit(1 << 40))
    sizes = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    sizes = materialise(sizes, "languages")
    if sizes.count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if sizes.isEmpty():
        return None
    idf = inverse_frequencies(usable)
    limits = F.broadcast(sizes.select("lang", (F.least(F.lit(1.0), SAMPLE / F.col("n")) * (1 << 40)).alias("upto")))
    sample = usable.withColumn("pick", pick).join(limits, "lang").where("pick < upto").select("lang", "text", "pick")
    sample = sample.dropDuplicates(["lang", "text"])
    found = sample.groupBy("lang").applyInPandas(_cluster(idf), "lang string, limit double, centroid binary")
    rows = found.toPandas().sort_values(["lang", "centroid"])
    languages = sorted(set(rows["lang"]))
    owner = np.array([languages.index(x) for x in rows["lang"]])
    limit = np.array([rows.loc[rows["lang"] == x, "limit"].iloc[0] for x in languages])
    centroids = np.stack([np.frombuffer(c, np.float32) for c in rows["centroid"]])
    return Model(languages, idf, centroids, owner, limit)


def _predict(shared):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                rows = batch.slice(i, ROWS)
                texts = rows.column("text").to_pylist()
                if model is None:
                    names, score, rejected = [UNKNOWN] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
                else:
                    names, score, rejected = model.predict(texts)
                others = [n for n in rows.schema.names if n != "text"]
                added = [pa.array(names, pa.string()), pa.array(score), pa.array(rejected)]
                yield pa.RecordBatch.from_arrays([*[rows.column(n) for n in others], *added], names=[*others, "lang_pred", "score", "rejected"])

    return predict


def predict(docs: DataFrame, model: Model | None, keep: list[str]) -> DataFrame:
    """``keep`` columns with lang_pred, score and rejected for each text."""
    kept = docs.select(*keep, "text")
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema if f.name != "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return kept.mapInArrow(_predict(shared), f"{types}, lang_pred string, score double, rejected boolean")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, rejected) of every row of ``docs`` (doc_id, text, lang; other
    columns are ignored), with a model learned from the labelled rows that are not held out.

    Only the text decides a prediction. A null text, or one without a letter, is ``und`` with
    score 0. Rows without a label are predicted but not learned from; without any label all rows are
    ``und``. A row without an id counts as the empty id and is not held out. Repeated rows are
    predicted alike. An empty table gives an empty result.
    """
    rows = docs.select("doc_id", "text", "lang").withColumn("held_out", held_out(F.col("doc_id")))
    model = fit(rows.where(~F.col("held_out")))
    return predict(rows, model, ["doc_id", "held_out"])
