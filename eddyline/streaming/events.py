"""Event-time aggregations on streams. The same functions run on batch input, where the watermark does nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from eddyline.streaming.run import read_batches


def windowed_total(df: DataFrame, key: str, ts: str, size: str, delay: str, value: str) -> DataFrame:
    """Tumbling sum per key; append mode emits a window when the watermark max(ts) - delay passes its end.

    A delay of "0 seconds" is the watermark of ascending timestamps.
    """
    w = df.withWatermark(ts, delay).groupBy(key, F.window(ts, size).alias("_w")).agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n"))
    return w.select(key, F.col("_w.start").alias("win_start"), F.col("_w.end").alias("win_end"), "total", "n")


def windowed_total_sql(df: DataFrame, delay: str, size: str) -> DataFrame:
    """The same as SQL text with a watermark clause; expects columns sid, ts, duration."""
    df.createOrReplaceTempView("watermarked_calls")
    return df.sparkSession.sql(
        f"""SELECT sid, window.start AS win_start, window.end AS win_end, sum(duration) AS total, count(*) AS n
            FROM watermarked_calls WATERMARK ts DELAY OF INTERVAL {delay} GROUP BY sid, window(ts, '{size}')"""
    )


def processing_time_total(df: DataFrame, key: str, size: str, value: str) -> DataFrame:
    """Tumbling sum on the time of processing. The watermark lets go of a window once a later batch has passed it."""
    w = df.withColumn("_now", F.current_timestamp()).withWatermark("_now", "0 seconds").groupBy(key, F.window("_now", size).alias("_w"))
    return w.agg(F.sum(value).alias("total"), F.count(F.lit(1)).alias("n")).select(
        key, F.col("_w.start").alias("win_start"), "total", "n"
    )


def session_total(df: DataFrame, key: str, ts: str, gap: str, delay: str, value: str) -> DataFrame:
    w = df.withWatermark(ts, delay).groupBy(key, F.session_window(ts, gap).alias("_w")).agg(F.sum(value).alias("total"))
    return w.select(key, F.col("_w.start").alias("win_start"), F.col("_w.end").alias("win_end"), "total")


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, distance: str, delay: str, how: str = "inner") -> DataFrame:
    """Equal keys and times at most `distance` apart; both watermarks and the range bound the state."""
    l, r = left.withWatermark(left_ts, delay).alias("l"), right.withWatermark(right_ts, delay).alias("r")
    step = F.expr(f"INTERVAL {distance}")
    near = F.col(f"l.{left_ts}").between(F.col(f"r.{right_ts}") - step, F.col(f"r.{right_ts}") + step)
    joined = l.join(r, (F.col(f"l.{key}") == F.col(f"r.{key}")) & near, how)
    return joined.drop(F.col(f"r.{key}")) if how not in ("left_semi",) else joined


def window_join(left: DataFrame, right: DataFrame, key: str, ts: str, size: str, delay: str, how: str = "inner") -> DataFrame:
    """Join on key and tumbling window; each side keeps only its window as time column."""
    lw = left.withWatermark(ts, delay).withColumn("win", F.window(ts, size)).drop(ts)
    rw = right.withWatermark(ts, delay).withColumn("win", F.window(ts, size)).drop(ts)
    return lw.join(rw, [key, "win"], how)


def merged_counts(left: DataFrame, right: DataFrame, ts: str, size: str, delay: str) -> DataFrame:
    """Windowed counts over two inputs, each with its own watermark; the slower input decides when a window closes."""
    both = left.withWatermark(ts, delay).unionByName(right.withWatermark(ts, delay))
    w = both.groupBy(F.window(ts, size).alias("_w")).agg(F.count(F.lit(1)).alias("n"))
    return w.select(F.col("_w.start").alias("win_start"), F.col("_w.end").alias("win_end"), "n")


class LateSplitter:
    """Micro-batch function that keeps rows of closed windows apart instead of dropping them.

    The watermark is the largest time seen in earlier batches minus `delay`. A row is late when its tumbling
    window ended `lateness` or longer before the watermark. A replayed batch decides the same, because only earlier batches count.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, ts: str, size: str, delay: str, lateness: str) -> None:
        self.spark, self.path, self.schema, self.ts = spark, path, schema, ts
        self.size, self.slack = size, F.expr(f"INTERVAL {delay}") + F.expr(f"INTERVAL {lateness}")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        late = F.lit(False)
        if batch_id > 0:
            seen = StructType().add("seen", self.schema[self.ts].dataType)
            marks = read_batches(self.spark, f"{self.path}/marks", seen).where(F.col("batch") < batch_id)
            limit = marks.agg((F.max("seen") - self.slack).alias("_l")).scalar()
            late = F.coalesce(F.window(self.ts, self.size).end <= limit, F.lit(False))
        batch.withColumn("late", late).write.mode("overwrite").partitionBy("late").parquet(f"{self.path}/rows/batch={batch_id}")
        batch.agg(F.max(self.ts).alias("seen")).write.mode("overwrite").parquet(f"{self.path}/marks/batch={batch_id}")

    def read(self, late: bool) -> DataFrame:
        layout = StructType([*self.schema.fields]).add("batch", "long").add("late", "boolean")
        return self.spark.read.schema(layout).parquet(f"{self.path}/rows").where(F.col("late") == late).select(*self.schema.names)
