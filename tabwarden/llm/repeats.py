"""Passages that repeat, found with run-length compressed Burrows-Wheeler indexes.

A byte goes if it lies in a string of ``SPAN`` bytes that also starts anywhere else. To index a
corpus in bounded pieces, every window of ``SPAN`` bytes is filed under its anchor, the
32-byte gram in it with the least hash. Equal windows have equal anchors in the same place,
so only windows under one anchor hash need to be compared. The windows filed under one
anchor occurrence are neighbours; the bytes they cover are its context.

* An anchor hash that occurs once is done: none of its windows repeats.
* Equal contexts repeat as a whole; they are counted, not compared, however many there are.
* Different contexts under one anchor hash go to an index: the suffixes of up to a megabyte of
  contexts are sorted, the Burrows-Wheeler transform is cut into runs, and the common prefix
  with the preceding (following) suffix is computed only at run heads (tails). Streaming
  over the text, every other position has one less than the position before it, which
  gives the matching statistics: the longest match of each position elsewhere. Windows
  with ``SPAN`` or more repeat.
* An anchor hash with more different contexts than an index takes has its windows counted by
  hash instead, which needs no group in one place.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden.llm import text as tx
from tabwarden.session import materialise

SPAN = 200
GRAM = 32
GRAMS = SPAN - GRAM + 1
# Bytes of text whose anchors are found at once; places in it need PLACE_BITS bits.
PIECE = 1_000_000
PLACE_BITS = 24
PLACE = np.uint64((1 << PLACE_BITS) - 1)
# Contexts an index takes for one anchor hash, and bytes after which an index is closed.
MOST_CONTEXTS = 3_000
INDEX_BYTES = 400_000
# Documents turned into Python objects at once.
ROWS = 500
# Symbols of a key: seven bytes of nine bits, so that the end of a context is below any byte.
KEY = 7
NO_ID = -(1 << 63)


# --- anchors --------------------------------------------------------------------------------


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    out, have = keys, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, first window, last window, anchor, anchor hash, context hash) of texts laid end to end; places
    are counted from the start of the data."""
    sums = tx.prefix_sums(data)
    _, down = tx.powers(len(sums))
    grams = (sums[GRAM:] - sums[:-GRAM]) * down[: len(sums) - GRAM]
    keys = (grams & ~PLACE) | np.arange(len(grams), dtype=np.uint64)
    at = (_least(keys, GRAMS) & PLACE).astype(np.int64)
    window = np.arange(len(at))
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(at)]
    inside = window + SPAN <= offsets[row + 1]
    window, at, row = window[inside], at[inside], row[inside]
    if not len(at):
        none = np.zeros(0, np.int64)
        return none, none, none, none, none, none
    head = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1]) | (row[1:] != row[:-1]))))
    tail = np.append(head[1:], len(at)) - 1
    first, last, anchor = window[head], window[tail], at[head]
    context = tx.span_hash(sums, first, last + SPAN) ^ tx.mix((anchor - first).astype(np.uint64) + np.uint64(1))
    return row[head], first, last, anchor, tx.mix(grams[anchor]).view(np.int64), context.view(np.int64)


def anchors_of(column: pa.Array) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, first window, last window, anchor, anchor hash, context hash), places counted in each text."""
    for i, _, data, offsets in tx.sliced(column, PIECE):
        if len(data) < SPAN:
            continue
        if len(offsets) == 2 and len(data) > 2 * PIECE:
            yield from _long(i, data)
        else:
            row, first, last, anchor, h, c = _anchors(data, offsets)
            start = offsets[row]
            yield row + i, first - start, last - start, anchor - start, h, c


def _long(row: int, data: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """The same for one long text, a piece of its windows at a time. An anchor whose windows lie in
    two pieces has a context in each."""
    for begin in range(0, len(data) - SPAN + 1, PIECE):
        piece = data[begin : begin + PIECE + SPAN - 1]
        _, first, last, anchor, h, c = _anchors(piece, np.array([0, len(piece)]))
        yield np.full(len(first), row), first + begin, last + begin, anchor + begin, h, c


ANCHOR = "d bigint, t bigint, lo bigint, hi bigint, h bigint, c bigint"


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        d, t = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("d", "t"))
        for row, first, last, _, h, c in anchors_of(batch.column("text")):
            columns = [d[row], t[row], first, last, h, c]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["d", "t", "lo", "hi", "h", "c"])


# --- the index ------------------------------------------------------------------------------


class RunIndex:
    """Burrows-Wheeler index of contexts, kept as runs with the common prefixes at their ends."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        n = len(data)
        self.end = np.repeat(offsets[1:], np.diff(offsets)).astype(np.int32)
        self.levels = self._ranks(data, offsets)
        order = np.argsort(self.levels[-1][1], kind="stable")
        before = data[order - 1].astype(np.int16)
        starts = np.zeros(n, bool)
        starts[offsets[:-1]] = True
        # No two context starts are preceded by the same symbol.
        opening = starts[order]
        same = (before[1:] == before[:-1]) & ~opening[1:] & ~opening[:-1]
        heads = np.flatnonzero(~same) + 1
        self.runs = len(heads) + 1
        self.data = data
        # Samples: text positions at run heads with their match to the suffix before, and at
        # run tails with their match to the suffix after.
        match = self._match(order[heads], order[heads - 1])
        self.head, self.head_match = np.append(order[heads], order[0]), np.append(match, 0)
        self.tail, self.tail_match = np.append(order[heads - 1], order[-1]), np.append(match, 0)

    def _ranks(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Ranks of all suffixes by their first 7, 14, 28 ... symbols."""
        n = len(data)
        place = np.arange(n, dtype=np.int32)
        key = np.zeros(n, np.int64)
        symbols = np.append(data.astype(np.int64) + 1, np.zeros(KEY, np.int64))
        for k in range(KEY):
            key = (key << 9) | np.where(place + k < self.end, symbols[k : n + k], 0)
        rank, width = self._dense(key), KEY
        levels = [(width, rank)]
        longest = int(np.diff(offsets).max())
        while width < longest and rank.max() < n - 1:
            nxt = np.minimum(place + width, n - 1)
            follow = np.where(place + width < self.end, rank[nxt] + 1, 0)
            rank, width = self._dense(rank.astype(np.int64) * (n + 1) + follow), 2 * width
            levels.append((width, rank))
        return levels

    @staticmethod
    def _dense(key: np.ndarray) -> np.ndarray:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(len(key), np.int32)
        rank[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        return rank

    def _match(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b."""
        a, b, out = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        ends = self.end[a], self.end[b]
        n = len(self.data)
        for width, rank in reversed(self.levels):
            left = np.minimum(ends[0] - a, ends[1] - b)
            equal = (left >= width) & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
            step = np.where(equal, width, 0)
            a, b, out = a + step, b + step, out + step
        going = np.ones(len(a), bool)
        for _ in range(KEY):
            going &= (a < ends[0]) & (b < ends[1])
            going &= self.data[np.minimum(a, n - 1)] == self.data[np.minimum(b, n - 1)]
            a, b, out = a + going, b + going, out + going
        return out

    def matching_statistics(self) -> np.ndarray:
        """For every position the length of its longest match that starts anywhere else."""
        return np.maximum(self._stream(self.head, self.head_match), self._stream(self.tail, self.tail_match))

    def _stream(self, sampled: np.ndarray, match: np.ndarray) -> np.ndarray:
        n = len(self.data)
        place = np.arange(n)
        known = np.full(n, -1, np.int64)
        known[sampled] = match
        last = np.maximum.accumulate(np.where(known >= 0, place, 0))
        return known[last] - (place - last)


def repeated_windows(contexts: list[bytes]) -> list[np.ndarray]:
    """For each context, which of its windows also start elsewhere in the contexts."""
    data = np.frombuffer(b"".join(contexts), np.uint8)
    offsets = np.concatenate(([0], np.cumsum([len(c) for c in contexts])))
    found = RunIndex(data, offsets).matching_statistics() >= SPAN
    return [found[a : b - SPAN + 1] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def spans_of(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of true flags."""
    edge = np.diff(np.concatenate(([0], flags.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1


SPANS = "d bigint, t bigint, lo bigint, hi bigint"


def _span_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = np.array(rows, np.int64).reshape(-1, 4).T
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["d", "t", "lo", "hi"])


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated windows of contexts that arrive ordered by anchor hash, one index after another."""
    held: list[tuple] = []
    size = 0
    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("h", "d", "t", "lo", "single", "bytes")]
        for row in zip(*columns, strict=True):
            if size >= INDEX_BYTES and row[0] != held[-1][0]:
                yield _span_batch(_search_index(held))
                held, size = [], 0
            held.append(row)
            size += len(row[5])
    if held:
        yield _span_batch(_search_index(held))


def _search_index(held: list[tuple]) -> list[tuple[int, int, int, int]]:
    out = []
    for (_, d, t, lo, single, _), flags in zip(held, repeated_windows([r[5] for r in held]), strict=True):
        if single:
            out += [(d, t, lo + int(a), lo + int(b)) for a, b in zip(*spans_of(flags), strict=True)]
    return out


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of every window of every context."""
    for batch in batches:
        h, d, t, lo = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("h", "d", "t", "lo"))
        for i, context in enumerate(batch.column("bytes").to_pylist()):
            sums = tx.prefix_sums(np.frombuffer(context, np.uint8))
            start = np.arange(len(context) - SPAN + 1)
            w = tx.span_hash(sums, start, start + SPAN).view(np.int64)
            columns = [np.full(len(w), x[i]) for x in (h, d, t)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in [*columns, w, start + lo[i]]], names=["h", "d", "t", "w", "at"])


# --- documents ------------------------------------------------------------------------------


def cut(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """(removed bytes, removed runs, remaining bytes) without the windows in the given ranges of first bytes."""
    edge = np.zeros(len(data) + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends + SPAN, -1)
    gone = np.cumsum(edge[:-1]) > 0
    return int(gone.sum()), len(spans_of(gone)[0]), np.frombuffer(data, np.uint8)[~gone].tobytes()


STAGE = (
    "doc_id bigint, d bigint, t bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
    "body binary, starts array<bigint>, ends array<bigint>, h bigint, lo bigint, single boolean, bytes binary"
)
ARROW_STAGE = pa.schema(
    [("doc_id", pa.int64()), ("d", pa.int64()), ("t", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
     ("n_spans", pa.int64()), ("kept_sha256", pa.string()), ("body", pa.binary()), ("starts", pa.list_(pa.int64())),
     ("ends", pa.list_(pa.int64())), ("h", pa.int64()), ("lo", pa.int64()), ("single", pa.bool_()), ("bytes", pa.binary())]
)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, as each row becomes Python objects."""
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def _finished(doc: dict, data: bytes, starts: np.ndarray, ends: np.ndarray) -> dict:
    removed, spans, rest = cut(data, starts, ends)
    return doc | {"n_bytes": len(data), "n_removed": removed, "n_spans": spans, "kept_sha256": hashlib.sha256(rest).hexdigest()}


def _staged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents beside the anchors they share: those whose marks are all known are finished, the
    others wait; contexts for the index become rows of their own."""
    for batch in _small(batches):
        rows = []
        for r in batch.to_pylist():
            data = (r["text"] or "").encode()
            doc = {n: r[n] for n in ("doc_id", "d", "t")}
            full, open_ = r["whole"] or [], r["parts"] or []
            starts = np.array([x["lo"] for x in full], np.int64)
            ends = np.array([x["hi"] for x in full], np.int64)
            rows += [
                {"d": r["d"], "t": r["t"], "h": x["h"], "lo": x["lo"], "single": x["single"], "bytes": data[x["lo"] : x["hi"] + SPAN]}
                for x in open_
            ]
            if any(x["single"] for x in open_):
                rows.append(doc | {"body": data, "starts": starts.tolist(), "ends": ends.tolist()})
            else:
                rows.append(_finished(doc, data, starts, ends))
        yield pa.RecordBatch.from_pylist(rows, schema=ARROW_STAGE)


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def _completed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    schema = pa.schema([ARROW_STAGE.field(n) for n in names])
    for batch in _small(batches):
        rows = []
        for r in batch.to_pylist():
            more = r["marks"] or []
            starts = np.array([*r["starts"], *[x["lo"] for x in more]], np.int64)
            ends = np.array([*r["ends"], *[x["hi"] for x in more]], np.int64)
            rows.append(_finished({"doc_id": r["doc_id"]}, r["body"], starts, ends))
        yield pa.RecordBatch.from_pylist(rows, schema=schema)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` (doc_id, text; other
    columns are ignored).

    Matches never cross rows. A null text counts as empty; texts under ``SPAN`` bytes lose
    nothing. Repeated rows repeat each other and go as a whole, with or without a doc_id. An
    empty table gives an empty result.
    """
    named = docs.select(
        "doc_id", "text", F.coalesce("doc_id", F.lit(NO_ID)).alias("d"), F.xxhash64("text").alias("t")
    )
    places = materialise(named.select("d", "t", "text").mapInArrow(_anchor_rows, ANCHOR), "anchors")
    often = places.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h")
    shared = materialise(places.join(often, "h"), "shared-anchors")

    place = F.struct("d", "t", "lo")
    classes = shared.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    classes = materialise(classes, "contexts")
    kinds = classes.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"))
    classes = classes.join(kinds, "h")
    known = shared.join(classes, ["h", "c"]).select(
        "d", "t", "lo", "hi", "h",
        (F.col("n") > 1).alias("whole"),
        ((F.col("kinds") > 1) & (place == F.col("first"))).alias("part"),
    )
    per_doc = known.groupBy("d", "t").agg(
        F.collect_set(F.when(F.col("whole"), F.struct("lo", "hi"))).alias("whole"),
        F.collect_set(F.when(F.col("part"), F.struct("lo", "hi", "h", (~F.col("whole")).alias("single")))).alias("parts"),
    )
    staged = named.join(per_doc, ["d", "t"], "left").select("doc_id", "d", "t", "text", "whole", "parts")
    staged = materialise(staged.mapInArrow(_staged, STAGE), "staged-documents")

    # Repeated rows give the same context twice; it stands for one place of the text.
    contexts = staged.where("bytes IS NOT NULL").select("h", "d", "t", "lo", "single", "bytes").dropDuplicates(["h", "d", "t", "lo"])
    many = materialise(kinds.where(F.col("kinds") > MOST_CONTEXTS).select("h"), "busy-anchors")
    few = contexts.join(many, "h", "left_anti")
    spans = few.repartition("h").sortWithinPartitions("h", "d", "t", "lo").mapInArrow(_indexed, SPANS)
    if not many.isEmpty():
        spans = spans.unionByName(_counted_windows(contexts.join(many, "h", "left_semi")))
    marks = spans.groupBy("d", "t").agg(F.collect_list(F.struct("lo", "hi")).alias("marks"))

    waiting = staged.where("body IS NOT NULL").select("doc_id", "d", "t", "body", "starts", "ends")
    completed = waiting.join(marks, ["d", "t"], "left").drop("d", "t").mapInArrow(_completed, RESULT)
    finished = staged.where("kept_sha256 IS NOT NULL").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    return finished.unionByName(completed)


def _counted_windows(contexts: DataFrame) -> DataFrame:
    windows = contexts.select("h", "d", "t", "lo", "bytes").mapInArrow(_window_rows, "h bigint, d bigint, t bigint, w bigint, at bigint")
    windows = materialise(windows, "windows")
    twice = windows.groupBy("h", "w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "w")
    return windows.join(twice, ["h", "w"]).select("d", "t", F.col("at").alias("lo"), F.col("at").alias("hi"))
