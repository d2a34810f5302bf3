"""JDBC sinks: batched inserts, once-only inserts and upserts, as micro-batch functions.

Rows go from the executors to the database over as many connections as `partitions` allows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.operators.changelog import latest_per_key


@dataclass(frozen=True)
class JdbcTarget:
    url: str
    table: str
    batch_size: int = 1000
    partitions: int = 8
    connection: dict[str, str] = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "batchsize": str(self.batch_size),
            "numPartitions": str(self.partitions),
            **self.connection,
        }

    def append(self, batch: DataFrame) -> None:
        batch.write.format("jdbc").options(**self.options()).mode("append").save()


def insert_batches(target: JdbcTarget) -> Callable[[DataFrame, int], None]:
    """Plain inserts; a replayed micro-batch is inserted again."""
    return lambda batch, batch_id: target.append(batch)


def insert_once(target: JdbcTarget, committed: Callable[[int], bool], confirm: Callable[[int], None]) -> Callable[[DataFrame, int], None]:
    """Inserts tagged with their batch; a batch already confirmed is skipped.

    Rows carry `batch_id`, so what a crash left of an unconfirmed batch can be told apart (readers take confirmed batches only).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if not committed(batch_id):
            target.append(batch.withColumn("batch_id", F.lit(batch_id).cast("long")))
            confirm(batch_id)

    return write


def upsert_batches(staging: JdbcTarget, keys: list[str], order: str, merge: Callable[[int], None]) -> Callable[[DataFrame, int], None]:
    """The last change per key of a batch goes to a staging table; `merge` runs the database's own merge for that batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        changes = latest_per_key(batch, keys, F.col(order))
        staging.append(changes.withColumn("batch_id", F.lit(batch_id).cast("long")))
        merge(batch_id)

    return write
