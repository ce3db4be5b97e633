"""Near-duplicate groups by MinHash bands and odd sketches.

A text is the set of its windows of five words. 96 MinHash samples are cut into 24 bands of
four; sets that share a band are candidates. The samples are also folded into an odd sketch:
256 parity bits, sample i flipping the bit its value picks. The bits in which two sketches
differ estimate how many samples differ, so candidates whose estimate is far below the
threshold go without being compared. The others are confirmed on the full sets.

A band bucket is not expanded into pairs. First every set is compared with one leader of its
bucket, the set that shares buckets with most others; it is the one that was changed least, and
links almost all that can be linked. Buckets that then still hold several components are compared
in blocks: a task gets the full sets of two blocks of a bucket, counts shared shingles across
components by matrix products, and returns only the links that join components. So no
link is lost, no pair that is not a link leaves a task, and nothing is made inside a group that is
already joined.

The chance that a pair at the threshold 0.8 shares no band is (1 - 0.8^4)^24, 3.2 in a million. With the sketches
it is missed with a chance of 3.7 in a million at most, at 0.85 of 3 in a hundred million.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden.llm import text as tx
from tabwarden.llm.components import components
from tabwarden.session import materialise

WIDTH = 5
SAMPLES, BAND = 96, 4
BANDS = SAMPLES // BAND
SKETCH = 256
# How far the sketch's estimate may fall below the threshold. Sampling and parity bits together pass it at the
# threshold 0.8 with a chance of 4.3 in ten million, at 0.85 of 1 in a hundred million.
MARGIN = 0.3
# Sets in one block of a bucket, and shingles of them all, on average.
BLOCK = 256
BLOCK_SHINGLES = 1_000_000
# Columns of one matrix product.
COLUMNS = 4_096
# Ids that are broadcast to pick rows; more are joined by shuffle.
BROADCAST_IDS = 1_000_000

_seeds = tx.mix(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64))
MULTIPLIERS = (_seeds[:SAMPLES] >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
MASKS = (_seeds[SAMPLES:] >> np.uint64(32)).astype(np.uint32)


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes, bounds) for slices of a column: the sorted distinct shingles of each text."""
    for i, _, data, offsets in tx.sliced(column):
        hashes, bounds = tx.shingles(data, offsets, WIDTH)
        sets = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int64)
        yield i, np.concatenate(sets) if sets else hashes, ends


def digests(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """128 bits for each set, equal for equal sets."""
    out = np.zeros((len(bounds) - 1, 2), np.uint64)
    for k, salt in enumerate((np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F))):
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(tx.mix(hashes ^ salt), dtype=np.uint64)))
        out[:, k] = sums[bounds[1:]] - sums[bounds[:-1]]
    return out


def samples(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """MinHash samples of each set, none of which may be empty."""
    short = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(bounds) - 1, SAMPLES), np.uint32)
    for k in range(SAMPLES):
        out[:, k] = np.minimum.reduceat((short ^ MASKS[k]) * MULTIPLIERS[k], bounds[:-1])
    return out


def odd_sketches(found: np.ndarray) -> np.ndarray:
    """Parity bits of the samples, as four 64-bit numbers each."""
    places = tx.mix(found.astype(np.uint64) + (np.arange(1, SAMPLES + 1, dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH)
    flat = np.arange(len(found))[:, None] * SKETCH + places.astype(np.int64)
    odd = (np.bincount(flat.ravel(), minlength=len(found) * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(len(found), SKETCH), axis=1).view(np.uint64)


def band_keys(found: np.ndarray) -> np.ndarray:
    keys = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(found), 1))
    for k in range(BAND):
        keys = tx.mix(keys * tx.BASE + found[:, k::BAND].astype(np.uint64))
    return keys


def similarity(differing: np.ndarray) -> np.ndarray:
    """Estimated Jaccard similarity from the number of differing bits of two odd sketches."""
    left = np.maximum(1 - 2 * np.asarray(differing) / SKETCH, 1e-9)
    return 1 + SKETCH / (4 * SAMPLES) * np.log(left)


def most_differing(threshold: float) -> int:
    """The most bits in which the sketches of a candidate pair may differ."""
    return int((similarity(np.arange(SKETCH + 1)) >= threshold - MARGIN).sum()) - 1


SIGNATURE = "doc_id bigint, n_shingles bigint, digest binary, bands array<bigint>, sketch array<bigint>"


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch.column("doc_id")
        for first, hashes, bounds in shingle_sets(batch.column("text")):
            n = np.diff(bounds)
            full = np.flatnonzero(n)
            keys, sketch = np.zeros((0, BANDS), np.int64), np.zeros((0, SKETCH // 64), np.int64)
            if len(full):
                found = samples(hashes, np.concatenate((bounds[full], bounds[-1:])))
                keys, sketch = band_keys(found).view(np.int64), odd_sketches(found).view(np.int64)
            have = n > 0
            digest = digests(hashes, bounds)
            ends = lambda width: pa.array(np.concatenate(([0], np.cumsum(have * width))), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(first, len(n)),
                    pa.array(n, pa.int64()),
                    pa.array([d.tobytes() if h else None for d, h in zip(digest, have, strict=True)], pa.binary()),
                    pa.ListArray.from_arrays(ends(BANDS), pa.array(keys.ravel(), pa.int64())),
                    pa.ListArray.from_arrays(ends(SKETCH // 64), pa.array(sketch.ravel(), pa.int64())),
                ],
                names=["doc_id", "n_shingles", "digest", "bands", "sketch"],
            )


def _full_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, hashes, bounds in shingle_sets(batch.column("text")):
            rows = len(bounds) - 1
            digest = digests(hashes, bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").slice(first, rows),
                    pa.array([d.tobytes() for d in digest], pa.binary()),
                    pa.array([hashes[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)], pa.binary()),
                ],
                names=["rep", "digest", "members"],
            )


def _confirmed(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
            mask = pa.array(linked, pa.bool_())
            kept = [batch.column(n).filter(mask) for n in ("u", "v")]
            yield pa.RecordBatch.from_arrays(kept, names=["u", "v"])

    return confirm


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common members of every set on the left and on the right."""
    flat = np.concatenate([*left, *right])
    members, place, times = np.unique(flat, return_inverse=True, return_counts=True)
    # Only members of two sets or more can be common.
    column = np.where(times > 1, np.cumsum(times > 1) - 1, -1)[place]
    row = np.repeat(np.arange(len(left) + len(right)), [len(x) for x in (*left, *right)])
    row, column = row[column >= 0], column[column >= 0]
    out = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, (begin, begin + COLUMNS))
        table = np.zeros((len(left) + len(right), COLUMNS), np.float32)
        table[row[a:b], column[a:b] - begin] = 1
        out += table[: len(left)] @ table[len(left) :].T
    return out.astype(np.int64)


def joining_links(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Of the linked pairs, enough to join the components named by ``left`` and ``right``."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    out = []
    for i, j in zip(*np.nonzero(linked), strict=True):
        x, y = root(int(left[i])), root(int(right[j]))
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def _cross_links(percent: int, limit: int):
    def compare(block: pd.DataFrame) -> pd.DataFrame:
        side = block["side"].to_numpy()
        a, b = (block[side == 0], block[side == 1]) if block["low"].iloc[0] < block["high"].iloc[0] else (block, block)
        if not len(a) or not len(b):
            return pd.DataFrame({"u": [], "v": []}, dtype="int64")
        groups = [x["component"].to_numpy() for x in (a, b)]
        sketch = [np.stack(x["sketch"].to_numpy()).astype(np.int64).view(np.uint64) for x in (a, b)]
        near = groups[0][:, None] != groups[1][None]
        for i in range(len(a)):
            near[i] &= np.bitwise_count(sketch[1] ^ sketch[0][i]).sum(axis=1) <= limit
        rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
        links = []
        if len(rows):
            sets = [[np.frombuffer(m, np.uint64) for m in x["members"].to_numpy()[k]] for x, k in ((a, rows), (b, columns))]
            shared = shared_counts(*sets)
            total = np.add.outer(*[np.array([len(m) for m in x]) for x in sets]) - shared
            linked = near[np.ix_(rows, columns)] & (100 * shared >= percent * total)
            links = joining_links(linked, groups[0][rows], groups[1][columns])
        u = a["rep"].to_numpy()[rows[[i for i, _ in links]]] if links else []
        v = b["rep"].to_numpy()[columns[[j for _, j in links]]] if links else []
        return pd.DataFrame({"u": u, "v": v}, dtype="int64")

    return compare


def _pick(docs: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    """Rows of ``docs`` whose doc_id is (left_semi) or is not (left_anti) among ``ids``."""
    side = ids.withColumnRenamed(ids.columns[0], "__id")
    if ids.count() <= BROADCAST_IDS:
        side = F.broadcast(side)
    return docs.join(side, docs["doc_id"] == side["__id"], how)


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, digest, members) of the documents with the given ids."""
    texts = _pick(docs.select("doc_id", "text"), ids, "left_semi")
    sets = materialise(texts.mapInArrow(_full_sets, "rep bigint, digest binary, members binary"), "candidate-sets")
    return sets.dropDuplicates(["rep", "digest"])


def confirm_pairs(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) among candidate pairs, from the full sets of both."""
    pairs = materialise(pairs.distinct(), "candidates")
    ids = materialise(pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct(), "candidate-ids")
    sets = full_sets(docs, ids)
    name = lambda side, out: sets.select(F.col("rep").alias(side), F.col("digest").alias(f"digest_{side}"), F.col("members").alias(out))
    both = pairs.join(name("a", "set_a"), ["a", "digest_a"]).join(name("b", "set_b"), ["b", "digest_b"])
    named = both.select(F.col("a").alias("u"), F.col("b").alias("v"), "set_a", "set_b")
    return named.mapInArrow(_confirmed(percent), "u bigint, v bigint")


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs`` (doc_id, text; other columns
    are ignored).

    Texts are linked if 100 * shared shingles >= ``percent`` * shingles of both; A-Z count as
    lower case. A null or empty text has no shingles and no links. Rows with one doc_id are
    one document. A row without a doc_id has no component and is kept. An empty table
    gives an empty result.
    """
    rows = materialise(docs.select("doc_id", "text").mapInArrow(_signatures, SIGNATURE), "signatures")
    known = rows.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = known.groupBy("digest").agg(
        F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"), F.first("n_shingles").alias("n")
    )
    classes = materialise(classes, "classes")
    limit = most_differing(percent / 100)

    buckets = classes.select("rep", "digest", "n", F.posexplode("bands").alias("band", "key"))
    buckets = buckets.select(F.xxhash64("band", "key").alias("bucket"), "rep", "digest", "n")
    sizes = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("shingles")).where("size > 1")
    shared = materialise(buckets.join(sizes, "bucket"), "buckets")

    scores = shared.groupBy("digest").agg(F.sum("size").alias("score"))
    ranked = F.struct("score", F.bitwise_not("rep").alias("first"), "digest")
    leads = shared.join(scores, "digest").groupBy("bucket").agg(F.max(ranked).alias("lead"))
    star = shared.join(leads, "bucket").where("digest <> lead.digest").select(
        F.bitwise_not("lead.first").alias("a"), F.col("lead.digest").alias("digest_a"), F.col("rep").alias("b"), F.col("digest").alias("digest_b")
    )
    star = _close(star.distinct(), classes, limit)
    links = materialise(confirm_pairs(star, docs, percent), "links-star")

    # Rows of one doc_id but different texts are one document.
    own = known.select("doc_id", "digest").distinct()
    several = own.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
    twins = own.join(several, "doc_id").join(classes.select("digest", "rep"), "digest")
    links = links.unionByName(twins.select(F.col("doc_id").alias("u"), F.col("rep").alias("v")))
    found = components(links)

    rest = _open_buckets(shared, found)
    if not rest.isEmpty():
        links = links.unionByName(_block_links(rest, classes, docs, percent, limit))
        found = components(links)

    reps = classes.select("digest", "rep").join(found.withColumnsRenamed({"u": "rep", "v": "least"}), "rep", "left")
    reps = reps.select("digest", F.coalesce("least", "rep").alias("component_id"))
    out = rows.select("doc_id", "n_shingles", "digest").join(reps, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).when(F.col("doc_id").isNotNull(), F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def _close(pairs: DataFrame, classes: DataFrame, limit: int) -> DataFrame:
    """The pairs whose odd sketches differ in at most ``limit`` bits."""
    side = lambda s: classes.select(F.col("digest").alias(f"digest_{s}"), F.col("sketch").alias(f"sketch_{s}"))
    both = pairs.join(side("a"), "digest_a").join(side("b"), "digest_b")
    differ = sum(F.bit_count(F.col("sketch_a")[i].bitwiseXOR(F.col("sketch_b")[i])) for i in range(SKETCH // 64))
    return both.where(differ <= limit).select("a", "digest_a", "b", "digest_b")


def _open_buckets(shared: DataFrame, found: DataFrame) -> DataFrame:
    """Members of buckets of three sets or more that lie in several components, with their component."""
    member = shared.where("size > 2").join(found.withColumnsRenamed({"u": "rep", "v": "least"}), "rep", "left")
    member = member.select("bucket", "size", "shingles", "rep", "digest", F.coalesce("least", "rep").alias("component"))
    spread = member.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    spread = spread.where("low <> high").select("bucket")
    return materialise(member.join(spread, "bucket"), "open-buckets")


def _block_links(rest: DataFrame, classes: DataFrame, docs: DataFrame, percent: int, limit: int) -> DataFrame:
    """Links that join components within open buckets, from the full sets of two blocks at a time."""
    sets = full_sets(docs, materialise(rest.select("rep").distinct(), "open-ids"))
    blocks = F.ceil(F.greatest(F.col("size") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    member = rest.join(classes.select("digest", "sketch"), "digest").join(sets, ["rep", "digest"])
    member = member.withColumn("blocks", blocks).withColumn("mine", F.pmod(F.xxhash64("digest"), "blocks").cast("int"))
    spread = member.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    spread = spread.select(
        "bucket", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"),
        (F.col("mine") > F.col("other")).cast("int").alias("side"), "rep", "component", "sketch", "members",
    )
    return spread.groupBy("bucket", "low", "high").applyInPandas(_cross_links(percent, limit), "u bigint, v bigint")


def drop_near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One document of each group, the one with the smallest doc_id, with the columns of ``docs``."""
    groups = materialise(near_duplicates(docs, percent), "groups")
    repeated = groups.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1")
    left = _pick(docs, groups.where("NOT kept").select("doc_id").distinct(), "left_anti")
    if repeated.isEmpty():
        return left
    # Rows of one doc_id: one stays. Rows without a doc_id all stay.
    return left.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"]).unionByName(left.where("doc_id IS NULL"))
