"""Surfaces for functions that users write: aggregates, table aggregates and table functions on Arrow batches.

* `TableAggregate` - create / accumulate / merge / finish over groups. Every task keeps a bounded accumulator per key and ships those only: `aggregate`
  is two Arrow passes around one shuffle of small states, so a hot key costs each task one accumulator. An accumulator is one or a few rows, a result may
  have any number of rows.
* `lateral` - a table function applied to each row, as an inner or a left join. `register_table_functions` has the same under a SQL name for LATERAL.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from eddyline.operators.scans import Columns, changes

HELD_ROWS = 50_000  # accumulator rows of a task

Batches = Iterator[pa.RecordBatch]
Grouped = tuple[np.ndarray, Columns]


class TableAggregate:
    """An aggregate over groups numbered 0 .. n - 1; all arrays are numpy columns, `group` has the number of each row.

    `state` and `result` are the columns of an accumulator row and of a result row as DDL. Each method returns (group numbers, columns); an accumulator
    may have several rows per group, of a bounded number. `merge` must not depend on the order of its rows.
    """

    state: str
    result: str

    def accumulate(self, group: np.ndarray, n: int, rows: Columns) -> Grouped:
        raise NotImplementedError

    def merge(self, group: np.ndarray, n: int, states: Columns) -> Grouped:
        raise NotImplementedError

    def finish(self, group: np.ndarray, n: int, states: Columns) -> Grouped:
        raise NotImplementedError


class Average(TableAggregate):
    """The average of the values that are not null, exact and cut to an integer; null without any."""

    state = "total bigint, n bigint"
    result = "average double, int_average bigint"

    def __init__(self, value: str):
        self.value = value

    def accumulate(self, group: np.ndarray, n: int, rows: Columns) -> Grouped:
        x = rows[self.value]
        known = ~np.isnan(x) if x.dtype.kind == "f" else np.ones(len(x), bool)
        total = np.zeros(n, np.int64)
        np.add.at(total, group[known], x[known].astype(np.int64))
        return np.arange(n), {"total": total, "n": np.bincount(group[known], minlength=n)}

    def merge(self, group: np.ndarray, n: int, states: Columns) -> Grouped:
        out = {c: np.zeros(n, np.int64) for c in ("total", "n")}
        for c, v in out.items():
            np.add.at(v, group, states[c])
        return np.arange(n), out

    def finish(self, group: np.ndarray, n: int, states: Columns) -> Grouped:
        count = np.where(states["n"] == 0, 1, states["n"])
        average = np.where(states["n"] == 0, np.nan, states["total"] / count)
        cut_off = np.sign(states["total"]) * (np.abs(states["total"]) // count)
        return group, {"average": average, "int_average": pa.array(cut_off, mask=states["n"] == 0)}


class Largest(TableAggregate):
    """The `n` largest values that are not null, duplicates kept, with their rank from 1 on."""

    def __init__(self, value: str, n: int, kind: str = "bigint"):
        self.value, self.size = value, n
        self.state, self.result = f"value {kind}", f"{value} {kind}, rank int"

    def _top(self, group: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        order = np.lexsort((-x, group))
        group, x = group[order], x[order]
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
        rank = np.arange(len(group)) - np.repeat(first, np.diff(np.append(first, len(group))))
        kept = rank < self.size
        return group[kept], x[kept], rank[kept] + 1

    def accumulate(self, group: np.ndarray, n: int, rows: Columns) -> Grouped:
        x = rows[self.value]
        if x.dtype.kind == "f":
            known = ~np.isnan(x)
            group, x = group[known], x[known]
        group, x, _ = self._top(group, x)
        return group, {"value": x}

    def merge(self, group: np.ndarray, n: int, states: Columns) -> Grouped:
        return self.accumulate(group, n, {self.value: states["value"]})

    def finish(self, group: np.ndarray, n: int, states: Columns) -> Grouped:
        group, x, rank = self._top(group, states["value"])
        return group, {self.value: x, "rank": rank}


def _numbered(keys: Sequence[pa.Array], rows: int) -> tuple[np.ndarray, np.ndarray]:
    """(group number of each row, first row of each group); nulls are a group."""
    if not keys:
        return np.zeros(rows, np.int64), np.zeros(min(1, rows), np.int64)
    code = np.zeros(rows, np.int64)
    for a in keys:
        own = pc.dictionary_encode(a, null_encoding="encode").indices.to_numpy(zero_copy_only=False)
        _, code = np.unique(code * (int(own.max(initial=0)) + 1) + own, return_inverse=True)
    _, first, code = np.unique(code, return_index=True, return_inverse=True)
    return code, first


def _columns(batch: pa.RecordBatch | pa.Table, names: Sequence[str]) -> Columns:
    return {c: batch.column(c).to_numpy() if isinstance(batch, pa.Table) else batch.column(c).to_numpy(zero_copy_only=False) for c in names}


def _step(method: Callable, keys: Sequence[str], names: Sequence[str], table: pa.Table, schema: pa.Schema) -> pa.Table:
    """`method` over the groups of `table`, with the keys in front of its columns."""
    table = table.combine_chunks()
    arrays = [table.column(k).chunk(0) if table.num_rows else pa.array([], table.schema.field(k).type) for k in keys]
    group, first = _numbered(arrays, table.num_rows)
    found, columns = method(group, len(first), _columns(table, names))
    heads = [a.take(pa.array(first)).take(pa.array(found)) for a in arrays]
    values = [columns[f.name] for f in list(schema)[len(keys) :]]
    values = [v if isinstance(v, pa.Array) else pa.array(v, f.type, from_pandas=True) for v, f in zip(values, list(schema)[len(keys) :])]
    return pa.Table.from_arrays([c.cast(f.type) for c, f in zip([*heads, *values], schema)], schema=schema)


def _partial(function: TableAggregate, keys: Sequence[str], inputs: Sequence[str], schema: pa.Schema) -> Callable[[Batches], Batches]:
    states = schema.names[len(keys) :]

    def run(batches: Batches) -> Batches:
        held: list[pa.Table] = []
        for batch in batches:
            if batch.num_rows:
                held.append(_step(function.accumulate, keys, inputs, pa.Table.from_batches([batch]), schema))
            if sum(t.num_rows for t in held) > HELD_ROWS:
                merged = _step(function.merge, keys, states, pa.concat_tables(held), schema)
                held = [merged]
                if merged.num_rows > HELD_ROWS // 2:  # many keys: the shuffle brings them together
                    yield from merged.to_batches()
                    held = []
        if held:
            yield from _step(function.merge, keys, states, pa.concat_tables(held), schema).to_batches()

    return run


def _final(function: TableAggregate, keys: Sequence[str], states: pa.Schema, result: pa.Schema) -> Callable[[Batches], Batches]:
    """States sorted by key; those of a key may go on in the next batch."""
    names = states.names[len(keys) :]

    def finished(table: pa.Table) -> pa.Table:
        return _step(function.finish, keys, names, _step(function.merge, keys, names, table, states), result)

    def run(batches: Batches) -> Batches:
        held: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]).cast(states)
            table = table if held is None else pa.concat_tables([held, table])
            table = table.combine_chunks()
            opens = changes([table.column(k).chunk(0) for k in keys]) if keys else np.arange(table.num_rows) == 0
            last = int(np.flatnonzero(opens)[-1])
            if last:
                yield from finished(table.slice(0, last)).to_batches()
            held = _step(function.merge, keys, names, table.slice(last), states)
        if held is not None:
            yield from finished(held).to_batches()

    return run


def aggregate(df: DataFrame, keys: Sequence[str], function: TableAggregate, inputs: Sequence[str]) -> DataFrame:
    """(keys, result columns) of a user's aggregate. Null keys are a key; no rows, no result."""
    keys, inputs = list(keys), list(inputs)
    key_fields = [df.schema[k] for k in keys]
    states = StructType([*key_fields, *StructType.fromDDL(function.state)])
    result = StructType([*key_fields, *StructType.fromDDL(function.result)])
    partial = df.select(*dict.fromkeys([*keys, *inputs])).mapInArrow(_partial(function, keys, inputs, to_arrow_schema(states)), states)
    dealt = partial.repartition(*keys).sortWithinPartitions(*keys) if keys else partial.repartition(1)
    return dealt.mapInArrow(_final(function, keys, to_arrow_schema(states), to_arrow_schema(result)), result)


TableFunction = Callable[[pa.RecordBatch], tuple[pa.Array, pa.Table]]


def lateral(df: DataFrame, function: TableFunction, inputs: Sequence[str], schema: str, outer: bool = False) -> DataFrame:
    """Every row with each row that a table function gives for it; with `outer` also rows without any, with nulls.

    `function` gets a batch of the input columns and returns (number of the input row, result rows), the numbers ascending. No row moves.
    """
    added = StructType.fromDDL(schema)
    whole = StructType([*df.schema, *added])
    result = to_arrow_schema(whole)

    def run(batches: Batches) -> Batches:
        for batch in batches:
            parents, rows = function(batch.select(list(inputs)))
            at, of = parents.to_numpy(zero_copy_only=False), np.arange(rows.num_rows)
            if outer:
                alone = np.setdiff1d(np.arange(batch.num_rows), at)
                order = np.argsort(np.concatenate([at, alone]), kind="stable")
                at, of = np.concatenate([at, alone])[order], np.concatenate([of, np.full(len(alone), -1)])[order]
            picked = pa.array(of, pa.int64(), mask=of < 0)
            left = batch.take(pa.array(at))
            right = [rows.column(f.name).combine_chunks().take(picked) for f in added]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip([*left.columns, *right], result)], schema=result)

    return df.mapInArrow(run, whole)


def split_words(batch: pa.RecordBatch) -> tuple[pa.Array, pa.Table]:
    """(word, length) of each bar-separated word; a null text has none."""
    lists = pc.split_pattern(batch.column(0), "|")
    words = pc.list_flatten(lists)
    return pc.list_parent_indices(lists), pa.table({"word": words, "length": pc.utf8_length(words)})


SPLIT_SCHEMA = "word string, length int"


class SplitWords:
    """The same row by row, for SQL."""

    def eval(self, text: str) -> Iterator[tuple[str, int]]:
        for word in text.split("|") if text is not None else ():
            yield word, len(word)


def register_table_functions(spark: SparkSession) -> None:
    """`split_words(text)` for FROM ..., LATERAL split_words(text) and LEFT JOIN LATERAL split_words(text) ON TRUE."""
    spark.udtf.register("split_words", udtf(SplitWords, returnType=SPLIT_SCHEMA))
