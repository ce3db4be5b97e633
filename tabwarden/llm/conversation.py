"""Repairing the turn structure of conversations by iterative-deepening A*.

Every row of a conversation is kept, reroled or deleted, and empty rows may be inserted before any row and at the end,
so that the role initials become ``(s?(ua)+)?``. The cheapest edits are searched depth first in
ASCII order of their initials under a rising cost bound; positions that failed with some rest of the bound
are remembered, and the first path that is accepted is the answer: no cheaper one exists and of equal ones it is the
least. What remains to be paid is estimated from below by the same problem with a system row
counting as a finished pair, worked out from the last row to the first.

Faults are found by aggregation, without texts. A search sees one letter a row, in one task for each conversation; its
time and memory grow with the rows of that conversation, not with its text. At last texts and edits come together, sorted by
conversation, and are read as a stream into one hash, which holds one batch of rows at a time.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwarden.llm.groups import join_groups
from tabwarden.session import materialise

DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1
SPACES = " \t\n\x0b\x0c\r"

# What has been put out so far: nothing, a system row, or a user's or an assistant's as the last row.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = frozenset({START, ASSISTANT})
AFTER = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
NEXT = (USER, USER, ASSISTANT, USER)
# States as the estimate sees them: a system row counts as a finished pair.
SEEN = (0, 1, 2, 1)
NEVER = 1 << 60


def estimates(codes: str) -> list[list[int]]:
    """Least costs from every position and seen state, a system row counting as a finished pair."""
    flip = (2, 2, 1)

    def with_inserts(row: list[int]) -> list[int]:
        for _ in range(2):
            row = [min(row[c], INSERT + row[flip[c]]) for c in range(3)]
        return row

    last = [NEVER] * 3
    for goal in ACCEPTED:
        last[SEEN[goal]] = 0
    out = [with_inserts(last)]
    for code in reversed(codes):
        then = out[-1]
        row = [DELETE + cost for cost in then]
        if code != "D":
            extra = TRUNCATED if code.isupper() else 0
            keeps = {"s": {0: 1}, "u": {0: 2, 1: 2}, "a": {2: 1}}.get(code.lower(), {})
            for c in range(3):
                row[c] = min(row[c], REROLE + extra + then[flip[c]])
                if c in keeps:
                    row[c] = min(row[c], extra + then[keeps[c]])
        out.append(with_inserts(row))
    return out[::-1]


def cheapest(codes: str) -> tuple[int, str]:
    """Cost and initials of the cheapest edits.

    ``codes`` has one letter a row: D where it must be deleted, else s, u, a or x for its role's
    initial, in upper case if it is truncated.
    """
    left, n = estimates(codes), len(codes)
    bound = left[0][SEEN[START]]
    while True:
        failed: dict[int, int] = {}
        over = NEVER
        path: list[str] = []
        # Open positions: (row, state, cost so far, moves not yet tried, last first).
        stack = [(0, START, 0, _moves(codes, 0, START))]
        while stack:
            i, state, cost, moves = stack[-1]
            if i == n and state in ACCEPTED:
                return cost, "".join(path)
            if not moves:
                stack.pop()
                failed[4 * i + state] = max(failed.get(4 * i + state, -1), bound - cost)
                if path:
                    path.pop()
                continue
            edit, j, after, price = moves.pop()
            least = cost + price + left[j][SEEN[after]]
            if least > bound:
                over = min(over, least)
            elif failed.get(4 * j + after, -1) < bound - cost - price:
                path.append(edit)
                stack.append((j, after, cost + price, _moves(codes, j, after)))
        bound = over


def _moves(codes: str, i: int, state: int) -> list[tuple[str, int, int, int]]:
    """(edit, row after, state after, price) in falling ASCII order, as they are taken from the end."""
    out, n = [], len(codes)
    if i < n and codes[i] != "D":
        extra = TRUNCATED if codes[i].isupper() else 0
        out.append(("R", i + 1, NEXT[state], REROLE + extra))
        kept = AFTER.get(codes[i].lower(), {}).get(state)
        if kept is not None:
            out.append(("K", i + 1, kept, extra))
    out.append(("I", i, NEXT[state], INSERT))
    if i < n:
        out.append(("D", i + 1, state, DELETE))
    return out


def illegal_pairs(initials: str) -> int:
    return sum(pair not in ("su", "ua", "au") for pair in map("".join, zip(initials, initials[1:])))


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies) after every row is hit by what the checksum of its place says."""
    shown = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.col("kind")
    return (
        rows.select(
            F.col(f"`{conv}`").alias("conv"), F.col(f"`{turn}`").alias("turn"), shown(role).alias("role"), shown(text).alias("text"),
            F.pmod(F.crc32(F.encode(F.concat(shown(conv), F.lit(":"), shown(turn)), "UTF-8")), F.lit(20)).alias("kind"),
        )
        .where("kind <> 0")
        .select(
            "conv",
            "turn",
            F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(kind == 1, "").when(kind == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
            F.when(kind == 3, 2).otherwise(1).cast("long").alias("copies"),
        )
    )


def _in_order(df: DataFrame, *first: str) -> DataFrame:
    """Whole conversations in one partition each, sorted by ``first``, turn (nulls first), role and digest."""
    sort = [F.col("conv").asc_nulls_first(), *first, F.col("turn").asc_nulls_first(), "role", "digest"]
    return df.repartition("conv").sortWithinPartitions(*sort)


def light_rows(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn folded into one with their number ``m``, with the fault of the first of them."""
    end = F.rtrim("text", F.lit(SPACES))
    folded = (
        rows.select(
            "conv", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "copies",
            (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        )
        .groupBy("conv", "turn", "role", "digest")
        .agg(F.sum("copies").alias("m"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    )
    folded = materialise(folded.withColumn("said", F.struct("conv", "role", "digest")), "turns")
    place = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    first = folded.groupBy("said").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("size")).where("size > 1")
    joined = join_groups(folded, materialise(first, "said"), "said", "size", folded.count())
    repeat = F.coalesce(place != F.col("first"), F.lit(False)) & ~F.col("blank")
    initial = F.substring("role", 1, 1)
    code = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    marked = F.when(F.col("blank") | repeat, "D").when(F.col("cut"), F.upper(code)).otherwise(code)
    return joined.select("conv", "turn", "role", "digest", "m", "blank", "cut", repeat.alias("repeat"), code.alias("initial"), marked.alias("code"))


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, codes, initials, out, begun = None, [], [], [], False

    def close() -> None:
        cost, audit = cheapest("".join(codes))
        out.append((conv, illegal_pairs("".join(initials)), cost, audit))

    schema = None
    for batch in batches:
        schema = pa.schema([("conv", batch.schema.field("conv").type), ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string())])
        columns = [batch.column(c).to_pylist() for c in ("conv", "initial", "code", "m")]
        for one, initial, code, m in zip(*columns, strict=True):
            if begun and one != conv:
                close()
                codes, initials = [], []
            conv, begun = one, True
            codes.append(code + "D" * (m - 1))
            initials.append(initial * m)
        if len(out) > 1_000:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
            out.clear()
    if begun:
        close()
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of every repaired conversation: its plan comes first, then its rows in order."""
    conv, edits, state, written, sha, begun = None, deque(), START, False, None, False

    def put(role: str, text: str) -> None:
        nonlocal state, written
        sha.update((("\n" if written else "") + f"{role}:{text}").encode())
        written = True

    def inserts() -> None:
        nonlocal state
        while edits and edits[0] == "I":
            edits.popleft()
            state = NEXT[state]
            put("user" if state == USER else "assistant", "")

    def close() -> tuple:
        inserts()
        return conv, sha.hexdigest()

    for batch in batches:
        out = []
        for one, row, role, text, copies, audit in zip(
            *[batch.column(c).to_pylist() for c in ("conv", "is_row", "role", "text", "copies", "audit")], strict=True
        ):
            if not row:
                if begun:
                    out.append(close())
                conv, edits, state, written, sha, begun = one, deque(audit), START, False, hashlib.sha256(), True
                continue
            for _ in range(copies):
                inserts()
                edit = edits.popleft()
                if edit == "K":
                    state = AFTER[role[0]][state]
                    put(role, text)
                elif edit == "R":
                    state = NEXT[state]
                    put("user" if state == USER else "assistant", text)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], batch.schema.field("conv").type), pa.array([r[1] for r in out])], ["conv", "sha"])
        kind = batch.schema.field("conv").type
    if begun:
        last = close()
        yield pa.RecordBatch.from_arrays([pa.array([last[0]], kind), pa.array([last[1]])], ["conv", "sha"])


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, the counts of faults, the cost, the edits' initials and the hash of each conversation.

    Rows are damaged first, as ``damaged`` says. Their order is that of the turns, nulls first; rows of one turn are
    taken by role and then by the digest of their text. A null role or text is one space, a null conversation is a
    conversation of its own. A conversation without rows after the damage has zeros, no edits and the hash of nothing; an empty
    table gives an empty result. Other columns are ignored.
    """
    kind = conversations.schema[conv].dataType.simpleString()
    rows = damaged(conversations, conv, turn, role, text)
    light = materialise(light_rows(rows), "light-turns")
    plans = materialise(
        _in_order(light).select("conv", "initial", "code", "m").mapInArrow(_plans, f"conv {kind}, illegal bigint, cost bigint, audit string"), "plans"
    )
    head = plans.select("conv", F.lit(False).alias("is_row"), "audit")
    body = rows.withColumns({"digest": F.unhex(F.sha2("text", 256)), "is_row": F.lit(True)})
    both = _in_order(head.unionByName(body, allowMissingColumns=True), "is_row")
    hashes = both.select("conv", "is_row", "role", "text", "copies", "audit").mapInArrow(_hashes, f"conv {kind}, sha string")

    count = lambda c: F.sum(F.when(c, F.col("m")).otherwise(0))
    again = F.when(F.col("blank"), 0).when(F.col("repeat"), F.col("m")).otherwise(F.col("m") - 1)
    by_turn = light.groupBy("conv", "turn").agg(
        count(F.col("blank")).alias("blank"),
        F.sum(again).alias("duplicate"),
        F.sum((F.col("cut") & ~F.col("blank") & ~F.col("repeat")).cast("long")).alias("truncated"),
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    faults = by_turn.groupBy("conv").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    )
    keyed = lambda df: df.withColumn("id", F.struct("conv")).drop("conv")
    every = conversations.select(F.col(f"`{conv}`").alias("conv")).distinct().withColumn("id", F.struct("conv"))
    found = every.join(keyed(faults), "id", "left").join(keyed(plans), "id", "left").join(keyed(hashes), "id", "left")
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        F.col("conv").alias(conv),
        *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in longs],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
