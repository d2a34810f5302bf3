"""Proportional stratified interleaving: every shard gets the mixture of sources that the whole table has.

Rows of a source are put in a seeded random order and ranked; the row of rank r among n has the fractional rank
(2r + 1) / 2n. Sorting all rows by it deals the sources out evenly, so any stretch of the order has the mixture of the
whole, and cutting the order into equal stretches gives the shards.

Both ranks come from range-partitioned sorts of narrow rows, so a source of any size is spread over many tasks; texts are
read once and never shuffled. A source's rows in one task are counted first, and only these counts (at most one per
source and task) are added up along the source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.common import numbered, with_position
from eddyline.llm.registry import query, table
from eddyline.session import cut

OVERHEAD = 16


def interleaved_positions(rows: DataFrame, stratum: str, order: list[str]) -> DataFrame:
    """`rows` with `_position` and `_total`: places in the order by fractional rank within `stratum`, ranks by `order`.

    A null stratum is one of its own. `rows` must hold small columns only; no name may start with `_`.
    """
    ranked = numbered(rows, [stratum, *order], "strata")
    counts = ranked.groupBy("_task", F.col(stratum).alias("_stratum")).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    along = Window.partitionBy("_stratum").orderBy("_task")
    counts = counts.select(
        F.col("_task").alias("_of"),
        "_stratum",
        "_first",
        F.coalesce(F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.sum("_n").over(along.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_of_all"),
    )
    placed = ranked.join(counts, (F.col("_task") == F.col("_of")) & F.col(stratum).eqNullSafe(F.col("_stratum")))
    rank = F.col("_at") - F.col("_first") + F.col("_before")
    placed = placed.select(*rows.columns, rank.alias("rank_in_stratum"), ((2 * rank + 1) / (2 * F.col("_of_all"))).alias("fraction"))
    return with_position(numbered(placed, ["fraction", stratum, "rank_in_stratum"], "fractions")).drop("rank_in_stratum", "fraction")


def shard(documents: DataFrame, shards: int, seed: int = 20, key: str = "doc_id", text: str = "text", stratum: str = "source") -> DataFrame:
    """Rows (key, size, text_crc32, stratum, shard, slot): row counts of any two shards differ by one at most.

    Null key, text and stratum are ordinary values (a null text has size `OVERHEAD` and no checksum). Equal texts are
    ordinary rows and go where their ranks put them; repeated rows get slots of their own, and which of two rows equal in
    every returned column comes first makes no difference. An empty table gives no rows; other columns are not read.
    """
    rows = documents.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long")) + OVERHEAD).alias("size"),
        F.crc32(F.encode(F.col(text), "UTF-8")).alias("text_crc32"),
        F.col(stratum).alias("stratum"),
    )
    rows = cut(rows.withColumn("shuffled", F.xxhash64(F.lit(seed), "key", "text_crc32")), "sizes")
    placed = interleaved_positions(rows, "stratum", ["shuffled", "key", "text_crc32", "size"])

    # whole numbers all the way: shard k holds the positions p with k <= p * shards / total < k + 1
    k = F.expr(f"(_position * {shards}) div _total").cast("int")
    start = F.expr(f"(shard * _total + {shards - 1}) div {shards}")
    return placed.withColumn("shard", k).select("key", "size", "text_crc32", "stratum", "shard", (F.col("_position") - start).alias("slot"))


@query("op3_sharding")
def op3_sharding(spark, sf_dir):
    """All documents in 40 shards by row count; see `shard`."""
    placed = shard(table(spark, sf_dir, "documents"), 40)
    return placed.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("stratum").alias("source"),
    )
