"""Exact copies by recipes of content-defined chunks.

White space runs of a text become one space; the text is cut where its own letters say so, so an
insertion moves no cut behind it but the next ones. A chunk has 512 to 8,192 code points, some 750
on average. Its identifier is a digest, and a text is the ordered list of its identifiers, its
recipe: 16 bytes instead of 750. Recipes are grouped, and a recipe that occurs once is a text that
occurs once. The identifiers in the other recipes are verified: the chunks that carry them are
shuffled once each, after the copies inside a task are folded, and every identifier must belong to
one chunk only. Where it does not, the next digest takes its place for all. So texts with equal
verified recipes are equal, no text is shuffled as a whole, and texts that occur once are not shuffled
at all while the repeated recipes are few enough to be broadcast.

Everything is DataFrame functions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwarden.llm.groups import fresh, join_groups
from tabwarden.session import materialise

LEAST, MOST = 512, 8_192
# A cut lies between a word's last letter out of one eighth of them and a first letter out of another, or behind
# the full stop of scripts without spaces.
CUT = r"(?:[bfjnrvz] (?=[cgkosw])|[。！？])"
CHUNK = f"(?s).{{{LEAST},{MOST}}}?{CUT}|.{{1,{MOST}}}"
# White space besides the space itself.
OTHER_SPACES = "\t\n\x0b\x0c\r"

# Digests of a chunk as lowercase hex. The next one is taken when two chunks are found to share an identifier.
DIGESTS: tuple[Callable[[Column], Column], ...] = (F.md5, lambda c: F.sha2(c, 256), lambda c: F.sha2(c, 512))
# Repeated recipes that are broadcast, 16 bytes each, to pick the texts whose chunks are verified.
BROADCAST_RECIPES = 1_000_000


class UnverifiedChunks(Exception):
    """Different chunks share an identifier under every digest."""


def normalised(text: Column) -> Column:
    """One space for every run of white space; the pattern only sees texts that hold two in a row."""
    spaced = F.coalesce(text.cast("string"), F.lit(""))
    for space in OTHER_SPACES:
        spaced = F.replace(spaced, F.lit(space), F.lit(" "))
    return F.when(F.contains(spaced, F.lit("  ")), F.regexp_replace(spaced, " {2,}", " ")).otherwise(spaced)


def chunks(text: Column) -> Column:
    """The chunks of a normalised text; put together they are the text."""
    return F.regexp_extract_all(text, F.lit(CHUNK), 0)


def recipe(parts: Column, digest: Callable[[Column], Column]) -> Column:
    return F.unhex(F.array_join(F.transform(parts, digest), ""))


def _recipes(docs: DataFrame, text: str, carried: Sequence[str], names: Sequence[str], digest) -> DataFrame:
    """(carried columns, row, recipe, hash of the text, chunks, digest of the text)."""
    row, made, hashed, count, sha, whole, parts = names
    kept = [F.col(f"`{c}`") for c in carried]
    return (
        docs.select(*kept, normalised(F.col(f"`{text}`")).alias(whole))
        .withColumn(parts, chunks(F.col(whole)))
        .select(
            *kept,
            F.monotonically_increasing_id().alias(row),
            recipe(F.col(parts), digest).alias(made),
            F.xxhash64(whole).alias(hashed),
            F.size(parts).cast("long").alias(count),
            F.sha2(F.col(whole), 256).alias(sha),
        )
    )


def verified(docs: DataFrame, text: str, repeated: DataFrame, digest) -> bool:
    """Whether every identifier in the repeated recipes belongs to one chunk.

    ``repeated`` has the hashes of the texts of each such recipe: the smallest and the largest, which are
    equal unless different texts share a recipe.
    """
    found = repeated.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("least") != F.col("most")).alias("mixed")).first()
    if not found["n"] or found["mixed"]:
        return not found["n"]
    whole = docs.select(normalised(F.col(f"`{text}`")).alias("whole"))
    if found["n"] <= BROADCAST_RECIPES:
        wanted = F.broadcast(repeated.select(F.col("least").alias("hash")))
        whole = whole.withColumn("hash", F.xxhash64("whole")).join(wanted, "hash", "left_semi")
    # An outer explode: the other one has the chunks made once more, to drop texts without any.
    found = whole.select(F.explode_outer(chunks(F.col("whole"))).alias("chunk")).groupBy("chunk").agg(F.lit(1).alias("one"))
    ids = found.where("chunk IS NOT NULL").groupBy(F.unhex(digest(F.col("chunk"))).alias("id")).agg(F.count("one").alias("n"))
    return ids.where("n > 1").isEmpty()


def exact_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Sequence[str] = (), digests=DIGESTS
) -> DataFrame:
    """``key``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256`` and ``n_chunks`` of every row.

    Texts are equal when they are after every run of ``[\\x20\\x09-\\x0D]`` is replaced by one space.
    Of equal texts the row with the smallest key stays; ``keep_id`` is its key. A null text is
    empty, and empty texts are copies of one another. A null key is larger than any other; among
    equal keys one row stays. Texts of any length are cut into chunks, and none is read in part. An
    empty table gives an empty result. Other columns are ignored, or carried along if named in
    ``carry``; they may have any names but those of the result.
    """
    carried = [key, *[c for c in carry if c != key]]
    row, made, hashed, count, sha, whole, parts, group, least, most = names = fresh(
        [*docs.columns, "keep_id", "group_size", "kept"],
        "row", "recipe", "hash", "n_chunks", "text_sha256", "whole", "parts", "first", "least", "most",
    )
    for digest in digests:
        rows = materialise(_recipes(docs, text, carried, names[:7], digest), "recipes")
        n_rows = rows.count()
        first = F.min(F.struct(F.col(f"`{key}`").isNull().alias("unnamed"), F.col(f"`{key}`").alias("key"), F.col(row).alias("row")))
        grouped = rows.groupBy(made).agg(
            first.alias(group), F.count(F.lit(1)).alias("group_size"), F.min(hashed).alias(least), F.max(hashed).alias(most)
        )
        repeated = materialise(grouped.where("group_size > 1"), "repeated-recipes")
        if verified(docs, text, repeated.select(F.col(least).alias("least"), F.col(most).alias("most")), digest):
            break
    else:
        raise UnverifiedChunks("different chunks share an identifier under every digest")
    known = F.col(group).isNotNull()
    return join_groups(rows, repeated, made, "group_size", n_rows).select(
        *[F.col(f"`{c}`") for c in carried],
        F.when(known, F.col(f"{group}.key")).otherwise(F.col(f"`{key}`")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col(f"{group}.row") == F.col(row), F.lit(True)).alias("kept"),
        F.col(sha).alias("text_sha256"),
        F.col(count).alias("n_chunks"),
    )
