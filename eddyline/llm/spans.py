"""Regular-expression matches with their positions, in SQL functions only.

Java's regular expressions and Python's find the same leftmost, non-overlapping matches for the patterns used here. Groups
that repeat are possessive, so that no match recurses however long it is; the patterns are written so that they stay equal
to the greedy ones.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eddyline.llm.common import let

BLOCK = 64
CONTEXT = 32

SPAN = "struct<start:int,end:int,value:string,before:string>"


def running_starts(lengths: Column) -> Column:
    """For each element the sum of all earlier ones. Two levels, so a long array costs BLOCK steps an element, not its length."""

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda a, x: a + x)

    def of(lens: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), (F.size(lens) - 1).cast("int"), F.lit(BLOCK)), lambda at: total(F.slice(lens, at + 1, F.lit(BLOCK))))
        starts = F.aggregate(blocks, F.array(F.lit(0)), lambda done, x: F.array_append(done, F.element_at(done, -1) + x))
        return let(
            starts,
            lambda s: F.transform(
                lens,
                lambda _, i: F.element_at(s, (F.floor(i / BLOCK) + 1).cast("int")) + total(F.slice(lens, (F.floor(i / BLOCK) * BLOCK + 1).cast("int"), (i % BLOCK).cast("int"))),
            ),
        )

    return F.when(F.size(lengths) > 0, let(lengths, of)).otherwise(F.array().cast("array<int>"))


def find_all(text: Column, pattern: str) -> Column:
    """array<SPAN> of all matches in order: code-point start, end (exclusive), the match and up to CONTEXT characters
    before it. No match (or a null text): an empty array. Most texts have no match and cost one search."""
    p = F.lit(pattern)

    def both(pieces: Column, matches: Column) -> Column:
        lengths = F.zip_with(F.slice(pieces, F.lit(1), F.size(matches)), matches, lambda a, b: F.char_length(a) + F.char_length(b))
        return let(
            running_starts(lengths),
            lambda starts: F.transform(matches, lambda m, i: _span(F.get(starts, i) + F.char_length(F.get(pieces, i)), m, F.get(pieces, i))),
        )

    found = let(F.split(text, pattern, -1), lambda pieces: let(F.regexp_extract_all(text, p, F.lit(0)), lambda matches: both(pieces, matches)))
    return F.when(F.rlike(text, p), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def _span(start: Column, match: Column, piece: Column) -> Column:
    return F.struct(
        start.cast("int").alias("start"),
        (start + F.char_length(match)).cast("int").alias("end"),
        match.alias("value"),
        F.right(piece, F.lit(CONTEXT)).alias("before"),
    )


def joined(spans: Column, kinds: list[str]) -> Column:
    """`kind:start:end` by start, then by the order of `kinds`, then by end, comma-joined. `spans` has the fields kind, start, end."""
    rank = F.array(*map(F.lit, kinds))
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.array_position(rank, s["kind"]).alias("rank"), s["end"].alias("end")))
    return F.array_join(F.transform(F.array_sort(keyed), lambda s: F.concat_ws(":", F.element_at(rank, s["rank"].cast("int")), s["start"], s["end"])), ",")
