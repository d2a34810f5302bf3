"""One-to-one pairing of two kinds of rows with a time limit, as a state machine that is scanned.

A key's slot is empty or holds one waiting row. A row meets a waiting row of the other kind that is at most `within` older: both are done and the slot is empty.
Otherwise it waits itself, in place of an older row of its kind. A waiting row that is still there when `within` has passed gives an alert.

Over a stretch of rows the slot matters only to the first of them: it meets the waiting row or it does not. So a stretch is known by its first row and the
slot it leaves behind in either case, and two stretches are joined by looking up which case the first one's slot makes of the second.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.operators.scans import BEFORE, LAST, Columns, Monoid, scan_by_key

EMPTY, LEFT, RIGHT = 0, 1, 2
CASES = ("alone", "met")  # the first row of the stretch finds no partner, or one


def slot_machine(within: int) -> Monoid:
    def lift(rows: Columns) -> Columns:
        kind, t, seq = rows["_kind_of"].astype(np.int64), rows["_at"], rows["_id"]
        none = np.zeros(len(kind), np.int64)
        return {"kind": kind, "t": t, "alone_kind": kind, "alone_id": seq, "alone_t": t, "met_kind": none, "met_id": none, "met_t": none}

    def combine(first: Columns, then: Columns) -> Columns:
        out = {"kind": first["kind"], "t": first["t"]}
        for case in CASES:
            waiting = first[f"{case}_kind"]
            meets = (waiting != EMPTY) & (waiting != then["kind"]) & (then["t"] - first[f"{case}_t"] <= within)
            out |= {f"{case}_{c}": np.where(meets, then[f"met_{c}"], then[f"alone_{c}"]) for c in ("kind", "id", "t")}
        return out

    slots = [f"{case}_{c} {'int' if c == 'kind' else 'bigint'}" for case in CASES for c in ("kind", "id", "t")]
    return Monoid(f"kind int, t bigint, {', '.join(slots)}", lift, combine)


def unpaired(rows: DataFrame, keys: Sequence[str], t: str, seq: str, is_left: Column, within: int) -> DataFrame:
    """(keys, is_left, t, seq) of every row that waited in vain: nobody met or replaced it before `within` had passed.

    Rows are taken in the order of (t, seq); both are integers and not null, seq is unique in a key. A partner exactly `within` later still counts.
    After the last row of a key time goes on, so a row that waits at the end gives an alert.
    """
    slim = rows.select(*keys, F.col(t).cast("long").alias("_at"), F.col(seq).cast("long").alias("_id"), F.when(is_left, LEFT).otherwise(RIGHT).alias("_kind_of"))
    met = scan_by_key(slim, keys, ["_at", "_id"], slot_machine(within), ["_kind_of", "_at", "_id"])
    kind, then = F.col(f"{BEFORE}_alone_kind"), F.col(f"{BEFORE}_alone_t")
    waits = F.col(BEFORE) & (kind != EMPTY)
    in_time = F.col("_at") - then <= within
    left_behind = F.when(waits & ~in_time, F.struct(kind.alias("kind"), F.col(f"{BEFORE}_alone_id").alias("id"), then.alias("t")))
    own = F.struct(F.col("_kind_of").alias("kind"), F.col("_id").alias("id"), F.col("_at").alias("t"))
    at_the_end = F.when(F.col(LAST) & ~F.coalesce(waits & in_time & (kind != F.col("_kind_of")), F.lit(False)), own)
    alerts = met.select(*keys, F.explode(F.array_compact(F.array(left_behind, at_the_end))).alias("_alert"))
    return alerts.select(*keys, (F.col("_alert.kind") == LEFT).alias("is_left"), F.col("_alert.t").alias(t), F.col("_alert.id").alias(seq))
