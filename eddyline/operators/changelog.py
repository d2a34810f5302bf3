"""Change logs: rows with a kind (+I, -U, +U, -D) and a sequence, and JSON change envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eddyline.operators.blocks import Width, running

INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The last row per key, with map-side partial aggregation."""
    row = F.struct(*df.columns)
    return df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(F.max_by(row, order).alias("_row")).select("_row.*")


def materialize(log: DataFrame, keys: Sequence[str], order: str, kind: str = "row_kind") -> DataFrame:
    """The table a change log describes. Retractions carry no news; a repeated +I or a lone +U is an upsert."""
    news = log.where(F.col(kind) != UPDATE_BEFORE)
    return latest_per_key(news, keys, F.col(order)).where(F.col(kind) != DELETE).drop(kind)


def emit_upserts(df: DataFrame, key: str, order: str, value: Column, width: Width, out: str = "total") -> DataFrame:
    """A keyed sum as upsert log: +I for the first row of a key, then +U, always the new total."""
    sums = running(df.select(key, order, value.alias("_x")), [key], [order], _sums("_x"), width)
    return sums.select(
        key, order, F.when(F.col("_n") == 1, INSERT).otherwise(UPDATE_AFTER).alias("row_kind"), F.col("_sum").alias(out)
    )


def emit_all(df: DataFrame, key: str, order: str, value: Column, width: Width, out: str = "total") -> DataFrame:
    """A keyed sum as full log: +I for the first row of a key, then the pair -U old, +U new."""
    sums = running(df.select(key, order, value.alias("_x")), [key], [order], _sums("_x"), width)

    def change(kind: str, total: Column) -> Column:
        return F.struct(F.lit(kind).alias("row_kind"), total.alias(out))

    first = F.array(change(INSERT, F.col("_sum")))
    later = F.array(change(UPDATE_BEFORE, F.col("_sum") - F.col("_x")), change(UPDATE_AFTER, F.col("_sum")))
    return sums.select(key, order, F.explode(F.when(F.col("_n") == 1, first).otherwise(later)).alias("_c")).select(
        key, order, "_c.row_kind", f"_c.{out}"
    )


def _sums(value: str) -> dict[str, tuple[str, Column]]:
    return {"_sum": ("sum", F.col(value)), "_n": ("sum", F.lit(1).cast("long"))}


def envelope_schema(row: T.StructType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
        ]
    )


def read_envelopes(messages: DataFrame, value: str, row: T.StructType) -> DataFrame:
    """Parse JSON change messages to before, after, op, ts_ms and row_kind."""
    parsed = messages.withColumn("_e", F.from_json(F.col(value), envelope_schema(row)))
    op = F.col("_e.op")
    kind = F.when(op == "d", DELETE).when(op == "u", UPDATE_AFTER).when(op.isin("c", "r"), INSERT)
    rest = [c for c in messages.columns if c != value]
    return parsed.select(*rest, "_e.before", "_e.after", "_e.op", "_e.ts_ms", kind.alias("row_kind"))


def apply_envelopes(envelopes: DataFrame, key: str, order: str) -> DataFrame:
    """Current table after create, update, snapshot (r) and delete messages."""
    keyed = envelopes.withColumn("_key", F.coalesce(F.col(f"after.{key}"), F.col(f"before.{key}")))
    return latest_per_key(keyed, ["_key"], F.col(order)).where(F.col("row_kind") != DELETE).select("after.*", order)


def snapshot_then_changes(snapshot: DataFrame, changes: DataFrame, order: str, kind: str = "row_kind") -> DataFrame:
    """A snapshot followed by its change log as one log; snapshot rows come first."""
    base = snapshot.withColumns({order: F.lit(-1).cast("long"), kind: F.lit(INSERT)})
    return base.unionByName(changes)
