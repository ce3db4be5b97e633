"""Benchmark passages in documents, by q-gram counts in diagonal bands and banded alignment.

Texts are compared in lower case with white space taken as one space. A copy of an item of m
characters with at most k edits keeps at least m - q + 1 - k * q of the item's q-grams, all of
them on at most k + 1 neighbouring diagonals (place in the text minus place in the item). So
shared q-grams are counted in bands of 2 (k + 1) diagonals that overlap by half, and a band
that reaches the bound is a region to verify: a banded alignment of the item with free ends in
the text must need at most k edits, k being ``MAX_EDITS`` of the item's length.

The bound is at least 1 for every item: q is ``Q``, or less where an item is so short that its edits
could touch all of its q-grams. Items of fewer than ``MIN_ITEM`` characters occur in clean text by chance;
they are found where they stand unchanged at word boundaries, and reported apart.

The items are the stated query set. They are read in blocks of bounded size, which are
broadcast and held against all documents, several in one pass; documents are not shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwarden.llm import text as tx
from tabwarden.session import materialise

Q = 10
MAX_EDITS = 0.08
# Shorter items (normalised) must occur unchanged, at word boundaries.
MIN_ITEM = 25
# Characters of items in one broadcast block; a longer single item is a block of its own.
BLOCK_CHARS = 500_000
# Blocks a task holds at once. Beyond them the documents are written and read again.
BLOCKS_AT_ONCE = 4

FIELDS = ("item_id", "start", "end", "edits")
FOUND = T.ArrayType(
    T.StructType([*[T.StructField(n, T.LongType()) for n in FIELDS], T.StructField("short", T.BooleanType())])
)
ARROW_FOUND = pa.list_(pa.struct([*[(n, pa.int64()) for n in FIELDS], ("short", pa.bool_())]))


def lowered(text: str) -> str:
    """Lower case, character by character where that keeps the length."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def normalised(text: str) -> str:
    return " ".join(lowered(text).replace("\0", " ").split())


def places(text: str) -> list[int]:
    """For every character of the normalised text its place in the text, and the end."""
    out: list[int] = []
    for m in re.finditer(r"[^\s\0]+", lowered(text)):
        if out:
            out.append(m.start() - 1)
        out += range(m.start(), m.end())
    return [*out, out[-1] + 1 if out else 0]


def codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def most_edits(length: int) -> int:
    return int(length * MAX_EDITS)


def gram_size(length: int) -> int:
    """The q of an item: k edits leave at least one of its q-grams if q (k + 1) is at most its length."""
    return min(Q, length // (most_edits(length) + 1))


def q_grams(points: np.ndarray, q: int) -> np.ndarray:
    """Hash of the q-gram at every place."""
    if len(points) < q:
        return np.zeros(0, np.uint64)
    sums = tx.prefix_sums(points)
    _, down = tx.powers(len(points))
    return (sums[q:] - sums[:-q]) * down[: len(points) - q + 1]


@dataclass
class Block:
    """Items of one q with the sorted hashes of their q-grams and where each occurs."""

    q: int
    ids: list
    texts: list[str]
    edits: np.ndarray
    bound: np.ndarray
    grams: np.ndarray
    first: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bits: int

    @classmethod
    def of(cls, items: list[tuple[int, str]]) -> Block:
        q = gram_size(len(items[0][1]))
        length = np.array([len(t) for _, t in items], np.int64)
        edits = np.array([most_edits(n) for n in length], np.int64)
        grams = [q_grams(codes(t), q) for _, t in items]
        item = np.repeat(np.arange(len(items)), [len(g) for g in grams])
        place = np.concatenate([np.arange(len(g)) for g in grams])
        flat = np.concatenate(grams)
        order = np.argsort(flat, kind="stable")
        unique, first = np.unique(flat[order], return_index=True)
        bits = max(16, int(len(unique)).bit_length() + 6)
        return cls(
            q, [i for i, _ in items], [t for _, t in items], edits, length - q + 1 - edits * q,
            unique, np.append(first, len(flat)), item[order], place[order], bits,
        )

    def index(self) -> np.ndarray:
        """Which leading bits occur among the hashes."""
        out = np.zeros(1 << self.bits, bool)
        out[self.grams >> np.uint64(64 - self.bits)] = True
        return out

    def copies(self, clean: list[str], index: np.ndarray) -> Iterator[tuple]:
        """(document, item_id, start, end, edits, whether the item is short) in normalised texts, the best
        copy of each item."""
        lengths = np.array([len(t) + 1 for t in clean])
        starts = np.cumsum(lengths) - lengths
        points = codes("\0".join([*clean, ""]))
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for doc, item, low, high in regions(points, starts, self, index):
            if best.get((doc, item), (1,))[0] == 0:
                continue
            text, wanted = clean[doc], self.texts[item]
            begin, end = max(0, low), max(0, min(len(text), high + len(wanted)))
            at = text.find(wanted, begin, end)
            if at >= 0:
                copy = (0, at, at + len(wanted))
            else:
                copy = align(codes(wanted).astype(np.int64), codes(text).astype(np.int64), low, high, int(self.edits[item]))
            if copy and copy < best.get((doc, item), (len(wanted) + 1,)):
                best[doc, item] = copy
        for (doc, item), (edits, start, end) in best.items():
            yield doc, self.ids[item], start, end, edits, False


def regions(points: np.ndarray, starts: np.ndarray, block: Block, table: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(document, item, first diagonal, last diagonal) of bands that reach the bound. ``points`` holds
    the documents end to end with a zero after each, ``starts`` where they begin."""
    grams = q_grams(points, block.q)
    at = np.flatnonzero(table[grams >> np.uint64(64 - block.bits)])
    found = np.searchsorted(block.grams, grams[at])
    found[found == len(block.grams)] = 0
    same = block.grams[found] == grams[at]
    at, found = at[same], found[same]
    if not len(at):
        return
    count = block.first[found + 1] - block.first[found]
    hit = np.repeat(block.first[found], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    at = np.repeat(at, count)
    item, place = block.item[hit], block.place[hit]
    doc = np.searchsorted(starts, at, side="right") - 1
    diagonal = at - starts[doc] - place
    step = block.edits[item] + 1
    band = diagonal // step
    # A hit counts in the band that begins with its half and in the one before.
    low = int(band.min()) - 1
    width = int(band.max()) - low + 1
    pair = doc * len(block.ids) + item
    keys, counts = np.unique(np.concatenate((pair * width + band - low, pair * width + band - 1 - low)), return_counts=True)
    pair, band = keys // width, keys % width + low
    doc, item = pair // len(block.ids), pair % len(block.ids)
    for k in np.flatnonzero(counts >= block.bound[item]):
        step = int(block.edits[item[k]]) + 1
        yield int(doc[k]), int(item[k]), int(band[k]) * step, (int(band[k]) + 2) * step - 1


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best copy of ``item`` in ``text`` along diagonals low to high, widened
    by ``most`` on either side; None beyond ``most`` edits. Ends in the text are free."""
    low, high = low - most, high + most
    diagonals = np.arange(low, high + 1)
    far = len(item) + len(text) + 1
    steps = np.arange(len(diagonals))
    # Cost and the start of the copy are carried in one number: cost first.
    scale = far + len(text) + 1
    cost = np.where((diagonals >= 0) & (diagonals <= len(text)), np.clip(diagonals, 0, len(text)), far * scale)
    padded = np.full(len(text) + 2 * (len(item) + len(diagonals)) + 2, -1, np.int64)
    shift = len(item) + len(diagonals)
    padded[shift : shift + len(text)] = text
    for i, c in enumerate(item):
        other = padded[np.clip(shift + i + diagonals, 0, len(padded) - 1)]
        step = cost + np.where(other == c, 0, np.where(other < 0, far * scale, scale))
        skip = np.append(cost[1:] + scale, far * scale)
        step = np.minimum(step, skip)
        cost = np.minimum.accumulate(step - steps * scale) + steps * scale
        ends = i + 1 + diagonals
        cost[(ends < 0) | (ends > len(text))] = far * scale
        if cost.min() >= (most + 1) * scale:
            return None
    best = int(cost.argmin())
    edits, start = divmod(int(cost[best]), scale)
    return (edits, start, len(item) + int(diagonals[best])) if edits <= most else None


@dataclass
class Shorts:
    """Items that are searched unchanged: by their text, the ids that have it."""

    ids: dict[str, list[int]]

    @classmethod
    def of(cls, items: list[tuple[int, str]]) -> Shorts:
        ids: dict[str, list[int]] = {}
        for i, text in items:
            ids.setdefault(text, []).append(i)
        return cls(ids)

    def index(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for text in self.ids:
            out.add_word(text, text)
        out.make_automaton()
        return out

    def copies(self, clean: list[str], index: ahocorasick.Automaton) -> Iterator[tuple]:
        """As ``Block.copies``: the first place of each item that cuts no word."""
        for doc, text in enumerate(clean):
            seen = set()
            for last, item in index.iter(text):
                start, end = last + 1 - len(item), last + 1
                cut = (start and text[start - 1].isalnum() and item[0].isalnum()) or (
                    end < len(text) and text[end].isalnum() and item[-1].isalnum()
                )
                if not cut and item not in seen:
                    seen.add(item)
                    yield from ((doc, i, start, end, 0, True) for i in sorted(set(self.ids[item])))


def _search_texts(texts: list[str | None], blocks: list[tuple]) -> dict[int, list[dict]]:
    """{document: its copies of items}; ``blocks`` holds blocks with their indexes."""
    clean = [normalised(t) if t else "" for t in texts]
    found: dict[int, list[tuple]] = {}
    for block, index in blocks:
        for doc, *copy in block.copies(clean, index):
            found.setdefault(doc, []).append(copy)
    out = {}
    for doc, copies in found.items():
        at = places(texts[doc])
        out[doc] = [
            dict(zip((*FIELDS, "short"), (item_id, at[start], at[end - 1] + 1, edits, short), strict=True))
            for item_id, start, end, edits, short in copies
        ]
    return out


def _search(shared: list, name: str):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = [(s.value, s.value.index()) for s in shared]
        for batch in batches:
            texts = batch.column("text")
            _, offsets = tx.utf8(texts)
            for i, j in tx.slices(offsets):
                found = _search_texts(texts.slice(i, j - i).to_pylist(), blocks)
                rows = batch.slice(i, j - i)
                lists = rows.column(name).to_pylist() if name in rows.schema.names else [[]] * (j - i)
                lists = [old + found.get(k, []) for k, old in enumerate(lists)]
                others = [n for n in rows.schema.names if n != name]
                yield pa.RecordBatch.from_arrays(
                    [*[rows.column(n) for n in others], pa.array(lists, ARROW_FOUND)], names=[*others, name]
                )

    return search


def item_blocks(items: DataFrame, key: str = "item_id") -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of bounded size, each of short items only or of items of one q."""
    blocks: dict[int, list[tuple[int, str]]] = {}
    sizes: dict[int, int] = {}
    for row in items.select(key, "text").where(F.col("text").isNotNull() & F.col(key).isNotNull()).toLocalIterator():
        clean = normalised(row["text"])
        if not clean:
            continue
        q = gram_size(len(clean)) if len(clean) >= MIN_ITEM else 0
        if q in blocks and sizes[q] + len(clean) > BLOCK_CHARS:
            yield blocks.pop(q)
            sizes[q] = 0
        blocks.setdefault(q, []).append((row[key], clean))
        sizes[q] = sizes.get(q, 0) + len(clean)
    yield from blocks.values()


def find_items(docs: DataFrame, items: DataFrame, name: str = "__found") -> DataFrame:
    """``docs`` with ``name``, the copies of items in each text: item_id, start, end (places in the
    text), edits and whether the item is short, sorted by item. ``docs`` has no column ``name``.

    A null or empty text holds none. Items without an id or a text are left out, and so are those of
    white space only. With no item at all every list is empty. Repeated rows are searched one by
    one; an item that occurs several times in a text is given once, by its best copy.
    """
    spark = docs.sparkSession
    own = docs.columns
    # Names of our own inside the tasks, so that any name may stand outside.
    out, first = docs.toDF(*["text" if c == "text" else f"c{i}" for i, c in enumerate(own)]), True
    schema = T.StructType([*out.schema.fields, T.StructField("found", FOUND)])
    blocks = item_blocks(items)
    while some := list(islice(blocks, BLOCKS_AT_ONCE)):
        if not first:
            out = materialise(out, "found")
        kinds = [Shorts if len(b[0][1]) < MIN_ITEM else Block for b in some]
        shared = [spark.sparkContext.broadcast(kind.of(b)) for kind, b in zip(kinds, some)]
        out = out.mapInArrow(_search(shared, "found"), schema)
        first = False
    if first:
        out = out.withColumn("found", F.array().cast(FOUND))
    return out.withColumn("found", F.array_sort("found")).toDF(*own, name)


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_ids, copies, short_ids) of every row of ``docs``.

    ``short_ids`` are the items of fewer than ``MIN_ITEM`` characters that stand in the text; they do not
    make a document contaminated, as short phrases occur anywhere.
    """
    found = find_items(docs.select("doc_id", "text"), items)
    long = F.filter("__found", lambda f: ~f["short"])
    return found.select(
        "doc_id",
        (F.size(long) > 0).alias("contaminated"),
        F.size(long).cast("bigint").alias("n_items"),
        F.transform(long, lambda f: f["item_id"]).alias("item_ids"),
        F.transform(long, lambda f: F.struct(*[f[n].alias(n) for n in FIELDS])).alias("copies"),
        F.transform(F.filter("__found", lambda f: f["short"]), lambda f: f["item_id"]).alias("short_ids"),
    )


def drop_contaminated(docs: DataFrame, items: DataFrame, short: bool = False) -> DataFrame:
    """The documents without a copy of an item, with the columns of ``docs``, whatever they are called;
    ``short`` drops those with a short item too.

    A null or empty text is kept, repeated rows are judged one by one, an empty table stays empty.
    """
    name = tx.clear_prefix(docs.columns) + "found"
    found = find_items(docs, items, name)
    return found.where(~F.exists(name, lambda f: F.lit(short) | ~f["short"])).select(*[F.col(f"`{c}`") for c in docs.columns])
