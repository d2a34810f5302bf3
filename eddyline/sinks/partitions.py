"""Time partitions of a catalog table that are committed while the stream runs.

Each micro-batch puts its rows into a staging folder of its own and then settles the partitions: a ledger per batch lists every partition with staged
rows that no reader sees yet, and how far the watermark has come. A partition whose end the watermark has passed by `delay` is committed in three steps that may
all be repeated: its staged rows overwrite its folder, a marker file is put there, and the catalog gets the partition. Rows that come later make it
pending again, and the next commit writes it as a whole. A batch that is replayed finds the ledger of the batch before it and does the same
again, so nothing is doubled and no partition is added twice.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MARKER = "_SUCCESS"
# partition columns and their formats, from coarse to fine
COLUMNS = {"dt": "yyyyMMdd", "hr": "HH", "mm": "mm", "ss": "ss"}
ADD_AT_ONCE = 100


class PartitionCommit:
    """A sink for `foreachBatch` into the partitioned table `name` below `path`.

    Rows go by their time in `zone`, cut to `bucket` seconds, into partitions dt / hr / mm / ss. The watermark is the largest time seen minus `disorder`
    seconds; a partition is complete when it is `delay` seconds behind its end.
    """

    def __init__(self, spark: SparkSession, name: str, path: str, schema: StructType, ts: str, zone: str, bucket: int, disorder: int, delay: int) -> None:
        self.spark, self.name, self.path, self.schema = spark, name, path, schema
        self.ts, self.zone, self.bucket, self.disorder, self.delay = ts, zone, bucket, disorder, delay
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        parts = ", ".join(f"{c} string" for c in COLUMNS)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({fields}, {parts}) USING parquet PARTITIONED BY ({', '.join(COLUMNS)}) LOCATION '{path}/table'")
        self.staged = StructType([*schema.fields]).add("_begin", "long")

    def _begin(self) -> Column:
        """Start of the row's bucket in local time, as seconds; buckets divide a day."""
        local = F.unix_seconds(F.from_utc_timestamp(F.col(self.ts).cast("timestamp"), self.zone))
        return local - F.pmod(local, F.lit(self.bucket))

    def _ledger(self, batch_id: int) -> DataFrame | None:
        """Per partition whether it is committed, and the latest time seen in it, as of the end of a batch."""
        return None if batch_id < 0 else self.spark.read.schema("_begin long, committed boolean, seen long").parquet(f"{self.path}/ledger/batch={batch_id}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("_begin", self._begin())
        rows.hint("rebalance", "_begin").write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch_id}")
        staged = self.spark.read.schema(self.staged).parquet(f"{self.path}/rows/batch={batch_id}")
        before = self._ledger(batch_id - 1)
        mine = staged.groupBy("_begin").agg(F.lit(False).alias("committed"), F.max(F.unix_seconds(F.col(self.ts).cast("timestamp"))).alias("seen"))
        known = mine if before is None else before.unionByName(mine)
        # rows of this batch make their partition pending again
        merged = known.groupBy("_begin").agg(F.min("committed").alias("committed"), F.max("seen").alias("seen"))
        seen = merged.agg(F.max("seen").alias("s")).scalar()
        end = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(F.col("_begin") + self.bucket), self.zone))
        ready = ~F.col("committed") & (end <= seen - F.lit(self.disorder + self.delay))
        path = f"{self.path}/ledger/batch={batch_id}"
        ledger = merged.select("_begin", ready.alias("now"), (F.col("committed") | ready).alias("committed"), "seen")
        ledger.repartition(1).write.mode("overwrite").parquet(path)
        self._commit(self.spark.read.schema("_begin long, now boolean").parquet(path).where("now").select("_begin"))

    def _commit(self, ready: DataFrame) -> None:
        parts = [self._parts(r["_begin"]) for r in ready.collect()]  # partitions of one batch, not rows
        if not parts:
            return
        rows = self.spark.read.schema(StructType([*self.staged.fields]).add("batch", "long")).parquet(f"{self.path}/rows")
        due = rows.join(F.broadcast(ready), "_begin", "left_semi").withColumns({c: F.date_format(F.timestamp_seconds("_begin"), form) for c, form in COLUMNS.items()})
        due = due.select(*self.schema.names, *COLUMNS).hint("rebalance", *COLUMNS)
        due.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*COLUMNS).parquet(f"{self.path}/table")
        for p in parts:
            self._mark("/".join(f"{c}={v}" for c, v in p.items()))
        for a in range(0, len(parts), ADD_AT_ONCE):
            clauses = " ".join(f"PARTITION ({', '.join(f'''{c}='{v}' ''' for c, v in p.items())})" for p in parts[a : a + ADD_AT_ONCE])
            self.spark.sql(f"ALTER TABLE {self.name} ADD IF NOT EXISTS {clauses}")

    def _parts(self, begin: int) -> dict[str, str]:
        day, second = divmod(begin, 86_400)
        return {"dt": (date(1970, 1, 1) + timedelta(day)).strftime("%Y%m%d"), "hr": f"{second // 3600:02}", "mm": f"{second // 60 % 60:02}", "ss": f"{second % 60:02}"}

    def _mark(self, part: str) -> None:
        jvm = self.spark.sparkContext._jvm
        file = jvm.org.apache.hadoop.fs.Path(f"{self.path}/table/{part}/{MARKER}")
        file.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).create(file, True).close()

    def marked(self) -> list[str]:
        """Partitions with a marker."""
        jvm = self.spark.sparkContext._jvm
        files = jvm.org.apache.hadoop.fs.Path(f"{self.path}/table/{'/'.join(['*'] * len(COLUMNS))}/{MARKER}")
        found = files.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(files) or []
        return sorted("/".join(str(f.getPath().getParent()).split("/")[-len(COLUMNS) :]) for f in found)

    def read(self) -> DataFrame:
        """The table as readers see it: partitions that the catalog lists and that have a marker."""
        marked = self.spark.createDataFrame([(p,) for p in self.marked()], "_part string")
        name = F.concat_ws("/", *[F.concat(F.lit(f"{c}="), F.col(c)) for c in COLUMNS])
        return self.spark.table(self.name).withColumn("_part", name).join(F.broadcast(marked), "_part", "left_semi").drop("_part")

