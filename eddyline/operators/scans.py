"""Reductions and running compositions with any associative function, in order, without a whole key in one task.

A `Monoid` turns rows into states (`lift`) and joins two neighbouring states (`combine`); both work on numpy columns, many rows at a time. It need not be
commutative: rows are range-partitioned by key and order, so a key that is larger than a task lies in neighbouring tasks, and states of stretches
are joined in their order. Inside a task neighbours are joined pairwise, so a key of n rows needs about log2(n) calls, not n.

* `reduce_by_key` - one state per key. Without an order (commutative functions) every task reduces its rows where they lie.
* `scan_by_key` - with every row the state of all rows of its key before it, and whether it is the key's last. What a task's first key brings along from
  earlier tasks is one state per task, chained and handed to those rows only.

This covers state machines: the state is then the function "state before the stretch -> state after it", and `combine` is composition.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eddyline.operators.blocks import is_small
from eddyline.session import cut

Columns = dict[str, np.ndarray]
Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Monoid:
    """`lift`: columns of rows to columns of states, one per row. `combine`: states and the states that follow them, pair by pair, to one each.
    `schema`: the state's columns as DDL. Nulls are None in columns of objects; number columns come as numpy gives them (with nulls: as floats)."""

    schema: str
    lift: Callable[[Columns], Columns]
    combine: Callable[[Columns, Columns], Columns]

    @property
    def fields(self) -> StructType:
        return StructType.fromDDL(self.schema)


def columns_of(batch: pa.RecordBatch, names: Sequence[str]) -> Columns:
    return {c: batch.column(c).to_numpy(zero_copy_only=False) for c in names}


def take(columns: Columns, at: np.ndarray | slice) -> Columns:
    return {c: v[at] for c, v in columns.items()}


def stacked(parts: Sequence[Columns]) -> Columns:
    return {c: np.concatenate([p[c] for p in parts]) for c in parts[0]}


def changes(arrays: Sequence[pa.Array]) -> np.ndarray:
    """Whether a row's key differs from the row's before; the first row's does. Nulls are equal."""
    out = np.ones(len(arrays[0]), bool)
    if len(out) > 1:
        out[1:] = False
        for a in arrays:
            now, before = a.slice(1), a.slice(0, len(a) - 1)
            out[1:] |= pc.fill_null(pc.not_equal(now, before), pc.not_equal(pc.is_null(now), pc.is_null(before))).to_numpy(zero_copy_only=False) if a.null_count == 0 else _differ(now, before)
    return out


def _differ(now: pa.Array, before: pa.Array) -> np.ndarray:
    one, other = pc.is_null(now), pc.is_null(before)
    return pc.if_else(pc.or_(one, other), pc.not_equal(one, other), pc.fill_null(pc.not_equal(now, before), False)).to_numpy(zero_copy_only=False)


def reduced(states: Columns, opens: np.ndarray, monoid: Monoid) -> Columns:
    """One state per stretch that begins where `opens`."""
    while not opens.all():
        at = np.flatnonzero(opens)
        place = np.arange(len(opens)) - np.repeat(at, np.diff(np.append(at, len(opens))))
        left = place % 2 == 0
        paired = left & np.append(~opens[1:], False)
        both = monoid.combine(take(states, paired), take(states, np.flatnonzero(paired) + 1))
        slot = np.cumsum(left) - 1
        kept = take(states, left)
        for c, v in both.items():
            kept[c] = kept[c].astype(np.result_type(kept[c], v)) if kept[c].dtype != object and v.dtype != object else kept[c].astype(object)
            kept[c][slot[paired]] = v
        states, opens = kept, opens[left]
    return states


def scanned(states: Columns, opens: np.ndarray, monoid: Monoid) -> Columns:
    """With every row the state of its stretch up to and with it: pairs are joined, scanned as half as many rows, and filled in again."""
    if opens.all():
        return states
    at = np.flatnonzero(opens)
    place = np.arange(len(opens)) - np.repeat(at, np.diff(np.append(at, len(opens))))
    left = place % 2 == 0
    paired = np.flatnonzero(left & np.append(~opens[1:], False))
    both = monoid.combine(take(states, paired), take(states, paired + 1))
    above = scanned(both, place[paired] == 0, monoid)  # of the second row of each pair
    out = {c: v.copy() if v.dtype == both[c].dtype else v.astype(both[c].dtype) for c, v in states.items()}
    for c, v in above.items():
        out[c] = out[c] if out[c].dtype == v.dtype else out[c].astype(v.dtype)
        out[c][paired + 1] = v
    later = np.flatnonzero(left & (place > 0))
    number = np.zeros(len(opens), np.int64)
    number[paired + 1] = np.arange(len(paired))
    for c, v in monoid.combine(take(above, number[later - 1]), take(states, later)).items():
        out[c][later] = v
    return out


def _arrays(states: Columns, schema: pa.Schema) -> list[pa.Array]:
    return [pa.array(states[f.name], f.type, from_pandas=True) for f in schema]


class _Stretches:
    """The stretches of a task's sorted rows, batch by batch; the one that is open at a batch's end goes on in the next."""

    def __init__(self, keys: Sequence[str], monoid: Monoid, inputs: Sequence[str]):
        self.keys, self.monoid, self.inputs = list(keys), monoid, list(inputs)
        self.key: list[pa.Array] | None = None  # of the open stretch
        self.state: Columns | None = None

    def lifted(self, batch: pa.RecordBatch) -> tuple[Columns, np.ndarray, bool]:
        """(states, opens, whether the first row continues the open stretch)."""
        states = self.monoid.lift(columns_of(batch, self.inputs))
        if not self.keys:
            opens = np.zeros(batch.num_rows, bool)
            opens[0] = True
            return states, opens, self.state is not None
        key = [batch.column(k) for k in self.keys]
        opens = changes(key)
        goes_on = self.key is not None and not changes([pa.concat_arrays([a, b.slice(0, 1)]) for a, b in zip(self.key, key)])[1]
        return states, opens, goes_on

    def close(self, batch: pa.RecordBatch, state: Columns) -> None:
        self.key = [batch.column(k).slice(batch.num_rows - 1, 1) for k in self.keys]
        self.state = state


def _reducer(keys: Sequence[str], monoid: Monoid, inputs: Sequence[str], place: str | None, result: pa.Schema) -> Callable[[Batches], Batches]:
    """Sorted rows to one row per stretch: keys, the place of its first row, its state."""
    schema = to_arrow_schema(monoid.fields)

    def run(batches: Batches) -> Batches:
        open_ = _Stretches(keys, monoid, inputs)
        head: list[pa.Array] = []  # key and place of the open stretch

        def row(arrays: list[pa.Array], states: Columns) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip([*arrays, *_arrays(states, schema)], result)], schema=result)

        names = [*keys, *([place] if place else [])]
        for batch in batches:
            if not batch.num_rows:
                continue
            states, opens, goes_on = open_.lifted(batch)
            found = reduced(states, opens, monoid)
            first = batch.take(pa.array(np.flatnonzero(opens)))
            heads = [first.column(c) for c in names]
            if goes_on:
                joined = monoid.combine(open_.state, take(found, slice(0, 1)))
                found = stacked([joined, take(found, slice(1, None))])
                heads = [pa.concat_arrays([h, a.slice(1)]) for h, a in zip(head, heads)]
            elif open_.state is not None:
                yield row(head, open_.state)
            n = int(opens.sum()) - 1
            if n:
                yield row([h.slice(0, n) for h in heads], take(found, slice(0, n)))
            head = [h.slice(n) for h in heads]
            open_.close(batch, take(found, slice(n, None)))
        if open_.state is not None:
            yield row(head, open_.state)

    return run


def _laid(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> tuple[DataFrame, bool]:
    """Rows in order, and whether a key may go on in the next task. Where no key can be hot, whole keys are dealt by hash, which needs no sample."""
    whole = bool(keys) and is_small(df)
    dealt = df.repartition(*keys) if whole else df.repartitionByRange(*keys, *order)
    return dealt.sortWithinPartitions(*keys, *order), not whole


def reduce_by_key(df: DataFrame, keys: Sequence[str], monoid: Monoid, inputs: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """(keys, state): the combination of all rows of a key, in `order` if one is given (unique within a key). Without keys, of all rows.

    Null keys are a key. A hot key sends one state per task to the second step. Rows without an order are sorted by key inside their task first.
    """
    keys, order, inputs = list(keys), list(order), list(inputs)
    rows = df.select(*dict.fromkeys([*keys, *order, *inputs]))
    place = "_place"
    if order:
        sorted_rows = _laid(rows, keys, order)[0].withColumn(place, F.monotonically_increasing_id())
    else:
        sorted_rows = rows.sortWithinPartitions(*keys).withColumn(place, F.monotonically_increasing_id()) if keys else rows.withColumn(place, F.monotonically_increasing_id())
    partial = StructType([*[df.schema[k] for k in keys], *StructType.fromDDL(f"{place} bigint"), *monoid.fields])
    parts = sorted_rows.mapInArrow(_reducer(keys, monoid, inputs, place, to_arrow_schema(partial)), partial)
    dealt = (parts.repartition(*keys) if keys else parts.repartition(1)).sortWithinPartitions(*keys, place)
    states = monoid.fields.names
    again = Monoid(monoid.schema, lambda columns: columns, monoid.combine)
    whole = StructType([*[df.schema[k] for k in keys], *monoid.fields])
    return dealt.mapInArrow(_reducer(keys, again, states, None, to_arrow_schema(whole)), whole)


BEFORE, LAST = "_before", "_last"


def _scanner(keys: Sequence[str], monoid: Monoid, inputs: Sequence[str], result: pa.Schema) -> Callable[[Batches], Batches]:
    """Sorted rows with the state before them inside the task; a final row per task sums it up.

    `_first` marks rows of the task's first key: an earlier task may hold more of it. The last row of the input is written when the next one is known.
    """
    schema = to_arrow_schema(monoid.fields)
    names = schema.names

    def run(batches: Batches) -> Batches:
        open_ = _Stretches(keys, monoid, inputs)
        task = TaskContext.get().partitionId()
        in_first, waiting, first_key, whole = True, None, None, True

        def out(batch: pa.RecordBatch, before: Columns, known: np.ndarray, first: np.ndarray, last: np.ndarray, kind: int, extra: dict | None = None) -> pa.RecordBatch:
            made = {f"{BEFORE}_{f.name}": a for f, a in zip(schema, [pa.array(before[f.name], f.type, mask=~known, from_pandas=True) for f in schema])}
            made |= {BEFORE: pa.array(known), "_first": pa.array(first), LAST: pa.array(last), "_task": pa.array(np.full(batch.num_rows, task, np.int32)), "_kind": pa.array(np.full(batch.num_rows, kind, np.int32))}
            made |= extra or {}
            columns = [made[f.name] if f.name in made else (batch.column(f.name) if f.name in batch.schema.names else pa.nulls(batch.num_rows, f.type)) for f in result]
            return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, result)], schema=result)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            states, opens, goes_on = open_.lifted(batch)
            if waiting is not None:
                yield out(*waiting, np.array([not goes_on]), 0)
            first_key = batch.slice(0, 1) if first_key is None else first_key
            upto = scanned(states, opens, monoid)
            if goes_on:
                more = int(np.append(np.flatnonzero(opens), n)[1])
                front = monoid.combine(take(open_.state, np.zeros(more, np.int64)), take(upto, slice(0, more)))
                upto = stacked([front, take(upto, slice(more, None))])
            start = open_.state if goes_on else take(upto, slice(0, 1))
            before = stacked([start, take(upto, slice(0, n - 1))])
            known = ~opens
            known[0] = goes_on
            new = opens.copy()
            new[0] = not goes_on and open_.state is not None
            first = (np.cumsum(new) == 0) & in_first
            in_first = bool(first[-1])
            last = np.append(opens[1:], False)
            head = n - 1
            if head:
                yield out(batch.slice(0, head), take(before, slice(0, head)), known[:head], first[:head], last[:head], 0)
            waiting = batch.slice(head), take(before, slice(head, None)), known[head:], first[head:]
            open_.close(batch, take(upto, slice(head, None)))
        if waiting is None:
            return
        # the task's last row, and one that says with which key the task begins and ends
        yield out(*waiting, np.array([True]), 1)
        keys_of = {k: first_key.column(k) for k in keys}
        sums = {f"{BEFORE}_{f.name}": a for f, a in zip(schema, _arrays(open_.state, schema))}
        yield out(waiting[0], open_.state, np.array([True]), np.array([in_first]), np.array([False]), 2, sums | {f"_begin_{k}": v for k, v in keys_of.items()})

    return run


def _chained(keys: Sequence[str], monoid: Monoid) -> Callable[[Batches], Batches]:
    """One row per task in their order to (task, state its first key brings along, whether its last key goes on in the next task)."""
    schema = to_arrow_schema(monoid.fields)

    def run(batches: Batches) -> Batches:
        rows = [r for b in batches for r in (b.slice(i, 1) for i in range(b.num_rows))]
        carry, tasks, found, goes_on = None, [], [], []
        for i, row in enumerate(rows):
            total = {f.name: row.column(f"{BEFORE}_{f.name}").to_numpy(zero_copy_only=False) for f in schema}
            same = i > 0 and all(rows[i - 1].column(k).equals(row.column(f"_begin_{k}")) for k in keys)
            brought = carry if same else None
            tasks.append(row.column("_task")[0].as_py())
            found.append(brought)
            goes_on.append(False)
            if same:
                goes_on[-2] = True
            # the total of the task's last key; it includes what was brought only if that key is also the first
            carry = monoid.combine(brought, total) if brought is not None and row.column("_first")[0].as_py() else total
        if not rows:
            return
        blank = [f is None for f in found]
        filler = next((f for f in found if f is not None), None)
        states = stacked([f if f is not None else filler for f in found]) if filler is not None else None
        arrays = [pa.array(states[f.name], f.type, mask=np.array(blank), from_pandas=True) if states is not None else pa.nulls(len(rows), f.type) for f in schema]
        yield pa.RecordBatch.from_arrays([pa.array(tasks, pa.int32()), pa.array([not b for b in blank]), pa.array(goes_on), *arrays], ["_task", "_brought", "_goes_on", *[f"_c_{f.name}" for f in schema]])

    return run


def scan_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], monoid: Monoid, inputs: Sequence[str]) -> DataFrame:
    """Every row with `_before` (false for a key's first row), `_before_<column>` for the state of all earlier rows of its key, and `_last`.

    `order` must be unique within a key. Null keys are a key. Where a key may lie in several tasks, the rows are written once, to the shared folder.
    """
    keys, states = list(keys), monoid.fields
    extra = f"{BEFORE} boolean, _first boolean, {LAST} boolean, _task int, _kind int"
    fields = [*df.schema, *[StructType.fromDDL(f"x {f.dataType.simpleString()}")[0] for f in states]]
    for f, s in zip(fields[len(df.schema) :], states):
        f.name = f"{BEFORE}_{s.name}"
    begins = [StructType.fromDDL(f"`_begin_{k}` {df.schema[k].dataType.simpleString()}")[0] for k in keys]
    schema = StructType([*fields, *StructType.fromDDL(extra), *begins])
    laid, split = _laid(df, keys, order)
    scan = laid.mapInArrow(_scanner(keys, monoid, list(inputs), to_arrow_schema(schema)), schema)
    kept = [*df.columns, BEFORE, *[f"{BEFORE}_{f.name}" for f in states], LAST]
    if not split:
        return scan.where("_kind < 2").select(*kept)
    rows = cut(scan, "scan")

    carry_schema = f"_task int, _brought boolean, _goes_on boolean, {', '.join(f'`_c_{f.name}` {f.dataType.simpleString()}' for f in states)}"
    tasks = rows.where("_kind = 2").coalesce(1).sortWithinPartitions("_task").mapInArrow(_chained(keys, monoid), carry_schema)
    carries = cut(tasks.where("_brought or _goes_on"), "carries")
    own = rows.where("_kind < 2")
    if carries.isEmpty():
        return own.select(*kept)

    # at most one row per task
    told = own.join(F.broadcast(carries), "_task", "left")
    told = told.withColumn(LAST, F.col(LAST) & ~((F.col("_kind") == 1) & F.coalesce("_goes_on", F.lit(False))))
    late = F.col("_first") & F.coalesce("_brought", F.lit(False))
    fixed_schema = StructType([*df.schema, *StructType.fromDDL(f"{BEFORE} boolean"), *fields[len(df.schema) :], *StructType.fromDDL(f"{LAST} boolean")])
    brought = told.where(late).mapInArrow(_bringer(monoid, to_arrow_schema(fixed_schema)), fixed_schema)
    return told.where(~late).select(*kept).unionByName(brought)


def _bringer(monoid: Monoid, result: pa.Schema) -> Callable[[Batches], Batches]:
    schema = to_arrow_schema(monoid.fields)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            if not batch.num_rows:
                continue
            known = batch.column(BEFORE).to_numpy(zero_copy_only=False).astype(bool)
            brought = {f.name: batch.column(f"_c_{f.name}").to_numpy(zero_copy_only=False) for f in schema}
            inside = {f.name: batch.column(f"{BEFORE}_{f.name}").filter(pa.array(known)).to_numpy(zero_copy_only=False) for f in schema}
            at = np.flatnonzero(known)
            both = monoid.combine(take(brought, at), inside) if len(at) else None
            made = {}
            for f in schema:
                values = brought[f.name].astype(object)
                if both is not None:
                    values[at] = both[f.name]
                made[f"{BEFORE}_{f.name}"] = pa.array(values.tolist(), f.type, from_pandas=True)
            made[BEFORE] = pa.array(np.ones(batch.num_rows, bool))
            columns = [made.get(f.name, batch.column(f.name) if f.name in batch.schema.names else None) for f in result]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, result)], schema=result)

    return run
