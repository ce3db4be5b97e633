"""Token ids of documents, packed into rows of fixed length.

Each document becomes its token ids and an end id. Documents longer than a row are split into
full rows and a rest, so nothing is lost. A task gathers pieces up to ``SHARD_TOKENS`` tokens and
packs them by best fit decreasing: the longest piece first, into the row with the least room
that still takes it, found in a segment tree over the room left. Rows are written as
little-endian id matrices with the bounds of their segments and with positions that start
again at each segment.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this tokenizer cuts a text before merging bytes.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END_ID = 50_256
ROW = 2_048
SHARD_TOKENS = 1_000_000
# Characters tokenized at once; longer texts are cut where tokens cannot reach across.
TEXT_PART = 200_000
# The vocabulary is broadcast; files beyond this size are refused.
MAX_VOCABULARY = 64_000_000

# Before one space between two other characters a new token always begins.
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")

OUT = "shard bigint, row int, n_tokens int, doc_ids array<bigint>, parts array<int>, bounds array<int>, ids binary, positions binary"
ARROW_OUT = pa.schema(
    [("shard", pa.int64()), ("row", pa.int32()), ("n_tokens", pa.int32()), ("doc_ids", pa.list_(pa.int64())),
     ("parts", pa.list_(pa.int32())), ("bounds", pa.list_(pa.int32())), ("ids", pa.binary()), ("positions", pa.binary())]
)


class RoomTree:
    """Open rows by the room left in them; finds the least room that is enough."""

    def __init__(self, most: int):
        self.size = 1 << most.bit_length()
        self.count = [0] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(most + 1)]

    def _add(self, room: int, n: int) -> None:
        i = room + self.size
        while i:
            self.count[i] += n
            i >>= 1

    def put(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        self._add(room, 1)

    def take(self, least: int) -> tuple[int, int] | None:
        """(room, row) with the least room of at least ``least``."""
        i = least + self.size
        if not self.count[i]:
            # Up to the first subtree on the right that holds a row, then down its left side.
            while i > 1 and (i & 1 or not self.count[i + 1]):
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.size:
                i = 2 * i if self.count[2 * i] else 2 * i + 1
        room = i - self.size
        self._add(room, -1)
        return room, self.rows[room].pop()


def best_fit(lengths: np.ndarray, most: int) -> list[list[int]]:
    """Pieces of each row, the longest pieces placed first."""
    tree, rows = RoomTree(most), []
    for piece in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[piece])
        found = tree.take(length)
        room, row = found if found else (most, len(rows))
        if not found:
            rows.append([])
        rows[row].append(piece)
        if room > length:
            tree.put(room - length, row)
    return rows


def text_parts(text: str) -> Iterator[str]:
    """The text in parts whose tokens are the tokens of the whole."""
    begin = 0
    while len(text) - begin > TEXT_PART:
        cut = SAFE_CUT.search(text, begin + TEXT_PART)
        if not cut:
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    yield text[begin:]


@dataclass
class Shard:
    """Pieces that wait to be packed together."""

    tokens: int = 0
    pieces: list[np.ndarray] = field(default_factory=list)
    owners: list[tuple[int | None, int]] = field(default_factory=list)

    def add(self, doc_id: int | None, ids: np.ndarray, row: int) -> None:
        for part, begin in enumerate(range(0, len(ids), row)):
            self.pieces.append(ids[begin : begin + row])
            self.owners.append((doc_id, part))
        self.tokens += len(ids)

    def packed(self, number: int, row: int, width: np.dtype) -> Iterator[pa.RecordBatch]:
        rows = best_fit(np.array([len(p) for p in self.pieces], np.int64), row)
        for begin in range(0, len(rows), 512):
            out = []
            for n, pieces in enumerate(rows[begin : begin + 512], begin):
                lengths = [len(self.pieces[p]) for p in pieces]
                ids = np.concatenate([self.pieces[p] for p in pieces]).astype(width)
                places = np.concatenate([np.arange(k, dtype=np.uint32) for k in lengths])
                out.append(
                    {
                        "shard": number, "row": n, "n_tokens": len(ids),
                        "doc_ids": [self.owners[p][0] for p in pieces], "parts": [self.owners[p][1] for p in pieces],
                        "bounds": np.concatenate(([0], np.cumsum(lengths))).tolist(),
                        "ids": _filled(ids, row), "positions": _filled(places.astype("<u4" if row > 1 << 16 else "<u2"), row),
                    }
                )
            yield pa.RecordBatch.from_pylist(out, schema=ARROW_OUT)


def _filled(values: np.ndarray, row: int) -> bytes:
    out = np.zeros(row, values.dtype)
    out[: len(values)] = values
    return out.tobytes()


_encoders: dict[int, object] = {}


def encoder(vocabulary: bytes, pattern: str):
    import tiktoken

    key = hash((vocabulary, pattern))
    if key not in _encoders:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        _encoders[key] = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encoders[key]


def _pack(shared, pattern: str, end_id: int, row: int, width: str):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value, pattern).encode_ordinary
        number = TaskContext.get().partitionId() << 32
        shard = Shard()
        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            for i in range(batch.num_rows):
                text = texts[i].as_py() or ""
                tokens = [np.array(encode(part), np.uint32) for part in text_parts(text)]
                shard.add(ids[i].as_py(), np.concatenate([*tokens, np.array([end_id], np.uint32)]), row)
                if shard.tokens >= SHARD_TOKENS:
                    yield from shard.packed(number, row, np.dtype(width))
                    number, shard = number + 1, Shard()
        if shard.pieces:
            yield from shard.packed(number, row, np.dtype(width))

    return pack


def pack_documents(
    docs: DataFrame, vocabulary: str = TOKENIZER, pattern: str = PATTERN, end_id: int = END_ID, row: int = ROW
) -> DataFrame:
    """Packed rows of the documents of ``docs`` (doc_id, text; other columns are ignored).

    shard, row
        number of the shard and of the row in it
    n_tokens
        ids in the row; the rest of ``ids`` and ``positions`` is zero
    doc_ids, parts
        document of each segment and which part of it the segment is
    bounds
        cumulative segment lengths, from 0 to n_tokens
    ids, positions
        ``row`` little-endian numbers each: 16 bits where that is enough, or 32

    A null or empty text gives the end id alone. Repeated rows are packed as often as they occur; a
    missing doc_id stays null in ``doc_ids``. An empty table gives no rows. Shards follow the
    partitions of ``docs``, so no row is shuffled and a lost task can be run again alone.
    """
    spark = docs.sparkSession
    with open(vocabulary, "rb") as file:
        held = file.read(MAX_VOCABULARY + 1)
    if len(held) > MAX_VOCABULARY:
        raise ValueError(f"{vocabulary} is larger than {MAX_VOCABULARY} bytes")
    width = "<u2" if max(end_id, held.count(b"\n")) < 1 << 16 else "<u4"
    shared = spark.sparkContext.broadcast(held)
    return docs.select("doc_id", "text").mapInArrow(_pack(shared, pattern, end_id, row, width), OUT)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows to a shared folder, a file for each partition."""
    packed.write.mode("overwrite").parquet(path)


def read_packed(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def segments(row: dict, row_length: int = ROW) -> Iterator[tuple[int | None, int, np.ndarray]]:
    """(doc_id, part, ids) of every segment of one packed row."""
    width = "<u2" if len(row["ids"]) == 2 * row_length else "<u4"
    ids = np.frombuffer(row["ids"], width)
    for doc, part, a, b in zip(row["doc_ids"], row["parts"], row["bounds"][:-1], row["bounds"][1:], strict=True):
        yield doc, part, ids[a:b]
