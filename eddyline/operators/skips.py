"""After-match skip clauses: which of the possible matches a row-by-row search would take.

Every possible match is a row with the row it starts at and the row at which the search goes on after it. A search takes the first match
that starts at or after the place where it stands, so the taken ones form a chain from a key's first match on. Where all earlier matches have been
passed, whichever were taken, the chain begins anew: a running maximum finds these places, so a hot key falls apart into many stretches. Inside a stretch every
match points at the next one it would lead to, and the chain is followed by doubling the pointers: log steps, whatever its length.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.blocks import Width, once, running
from eddyline.operators.scans import changes

PAST_LAST, NEXT_ROW = "past last row", "to next row"
NOWHERE = -(2**63)


def resume_at(clause: str, start: Column, end: Column, first: Mapping[str, Column], last: Mapping[str, Column]) -> Column:
    """Where the search goes on: "past last row", "to next row", "to first X" or "to last X" with the rows of the pattern's variables.

    Positions are integers. `taken` fails on a match after which the search would stay at its first row, or go to a variable without a row.
    """
    if clause == PAST_LAST:
        return end + 1
    if clause == NEXT_ROW:
        return start + 1
    words = clause.split(" ")
    places = {"first": first, "last": last}.get(words[1], {}) if len(words) == 3 and words[0] == "to" else {}
    if words[-1] not in places:
        raise ValueError(f"unknown skip clause: {clause}")
    return places[words[-1]]


def _first_from(of: np.ndarray, place: np.ndarray, group: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Per (of, place) the first match of that group at or after the place, or the number of matches. Matches are sorted by (group, start)."""
    asked = len(place)
    order = np.lexsort((np.repeat([0, 1], [asked, len(start)]), np.concatenate([place, start]), np.concatenate([of, group])))
    is_match = order >= asked
    matches_before = np.empty(len(order), np.int64)
    matches_before[order] = np.cumsum(is_match) - is_match
    found = matches_before[:asked]
    inside = found < len(start)
    inside[inside] = group[found[inside]] == of[inside]
    return np.where(inside, found, len(start))


def _followed(keys: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows (keys, stretch, start, resume, ...) sorted by all of these to those on the chain. A stretch may go on in the next batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_: list[pa.Array] | None = None  # the stretch of the batch before, and where the search stands in it
        stands = NOWHERE
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            names = [batch.column(i) for i in range(keys + 1)]
            opens = changes(names)
            goes_on = open_ is not None and not changes([pa.concat_arrays([a, b.slice(0, 1)]) for a, b in zip(open_, names)])[1]
            start, resume = (batch.column(i).to_numpy(zero_copy_only=False) for i in (keys + 1, keys + 2))
            group = np.cumsum(opens)
            found = np.append(opens, False)
            if goes_on:
                found[0] = False
                found[_first_from(group[:1], np.array([stands]), group, start)] = True
                found[n] = False
            jump = np.append(_first_from(group, resume, group, start), n)
            while (jump < n).any():
                found[jump[found]] = True
                found[n] = False
                jump = jump[jump]
            found = found[:n]
            last = np.flatnonzero(found & (group == group[-1]))
            stands = int(resume[last[-1]]) if len(last) else stands
            open_ = [a.slice(n - 1, 1) for a in names]
            yield batch.filter(pa.array(found))

    return run


def taken(matches: DataFrame, key: str, start: str, resume: Column, width: Width) -> DataFrame:
    """The rows of `matches` (at most one per key and start) that a search takes which goes on at `resume` after each match."""
    ahead = F.coalesce(resume.cast("long") > F.col(start), F.lit(False))
    rows = matches.withColumns({"_resume": F.when(ahead, resume.cast("long")).otherwise(F.col(start) + 1), "_stuck": ~ahead})
    reached = running(rows, [key], [start], {"_reach": ("max", F.col("_resume"))}, width, exclusive=True)
    opened = once(reached.withColumn("_opens", F.when(F.coalesce("_reach", F.lit(NOWHERE)) <= F.col(start), F.col(start))).drop("_reach"), "matches")
    stretches = running(opened, [key], [start], {"_stretch": ("last", F.col("_opens"))}, width)
    others = [c for c in [*matches.columns, "_stuck"] if c not in (key, start)]
    dealt = stretches.select(key, "_stretch", start, "_resume", *others).repartition(key, "_stretch").sortWithinPartitions(key, "_stretch", start)
    chain = dealt.mapInArrow(_followed(1), dealt.schema)
    stuck = F.raise_error(F.concat(F.lit("the search does not go on behind the match that starts at "), F.col(start).cast("string")))
    return chain.where(F.when(F.col("_stuck"), stuck.cast("boolean")).otherwise(F.lit(True))).select(*matches.columns)
