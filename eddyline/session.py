"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ARROW_BATCH_BYTES = 8 << 20
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build(app: str = "eddyline", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with the settings the operators expect. On a cluster leave master and partitions unset."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Runtime settings only, so it is safe on a session somebody else made.

    UTC makes epoch arithmetic and window alignment agree; AQE splits skewed join partitions and sizes
    shuffles from what was really written; RocksDB keeps streaming state off the heap; batches handed to Python are bounded by bytes, not
    only by rows, so long texts don't add up.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BATCH_BYTES))
    _ship_package(spark.conf.get("spark.app.id"))
    return spark


@cache
def _ship_package(application: str) -> None:
    """Hand the package to the executors, whose Python tasks import it; once per application."""
    package = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix=f"eddyline-{application}-")) / "eddyline.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    SparkSession.active().sparkContext.addPyFile(str(archive))


@cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"eddyline-{application}-")


def work_path(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the folder all executors share (`spark.checkpoint.dir`)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = _own_folder(spark.conf.get("spark.app.id"))
    return f"{base.rstrip('/')}/eddyline/{label}-{uuid.uuid4().hex}"


def cut(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Used between two passes over the same derived rows: the second pass reads them twice, and without the
    cut Spark would run the first pass twice. The copy survives executor loss and keeps column pruning.
    """
    spark = df.sparkSession
    path = work_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
