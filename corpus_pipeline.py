"""The corpus pipeline: from `documents` to packed training sequences in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; `run` writes it to the shared folder and reads it again as the next
stage's input. All stages but the last return the columns of `documents`. A stage's decisions are a narrow table keyed by the row's values; it is
written first, measured, and broadcast only up to `MAX_BROADCAST_BYTES`; beyond that the join shuffles the documents.

Nulls in any column, empty texts, repeated rows and empty tables pass through: see the docstring of each stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eddyline.llm import decontaminate, language, near_dup, packing, secrets
from eddyline.llm.common import fits, join_null_safe, text_hash
from eddyline.session import cut, prepare, work_path

TOKENIZER = "word_bpe_49k.json"
MAX_BROADCAST_BYTES = 8 << 20

# language likelihoods, signatures and tokenizers are beyond SQL; tests/llm compares run() with a brute-force version
ORACLE_SQL = None


def _named(docs: DataFrame) -> DataFrame:
    """The whole row as one column, so that no name of the input meets a name used here, and the values that decisions are joined by."""
    return docs.select(F.struct("*").alias("row"), F.col("doc_id"), text_hash(F.col("text")).alias("text_hash"), F.col("lang"), F.col("source"))


def _rows(named: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    return named.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def _decided(rows: DataFrame, label: str, row_bytes: Column | None = None) -> DataFrame:
    """`rows` written once, for a join with the documents."""
    rows = cut(rows, label)
    return F.broadcast(rows) if fits(rows, F.lit(64) if row_bytes is None else row_bytes, MAX_BROADCAST_BYTES) else rows


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID. Documents without a recognised language go: no letters (null texts too), or explained by no language with
    the needed confidence. Rows that repeat are judged alike and all stay or all go."""
    names = ["doc_id", "text_hash", "lang", "source"]
    ids = docs.select("doc_id", text_hash(F.col("text")).alias("text_hash"), F.col("lang").alias("own_lang"), "source", "text", F.col("lang").alias("declared"), F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))
    judged = language.identify(ids)
    rejected = _decided(judged.where(~F.col("kept")).select("doc_id", "text_hash", F.col("own_lang").alias("lang"), "source").distinct(), "rejected")
    return _rows(join_null_safe(_named(docs), rejected, names, "left_anti"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup. Of each component the row with the smallest doc_id stays (nulls last, then the smallest text hash); of rows
    that repeat it entirely, one. Texts without words are linked with nothing and stay."""
    names = ["doc_id", "text_hash"]
    found = cut(near_dup.near_duplicates(docs), "components").withColumnRenamed("key", "doc_id")
    first = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("text_hash") == F.col("first_hash"))
    gone = _decided(found.where(~first).select(names).distinct(), "gone")
    copies = cut(found.where(first & (F.col("n_shingles") > 0)).groupBy(names).count().where("count > 1").select(names), "copies")
    stay = join_null_safe(_named(docs), gone, names, "left_anti")
    if not copies.isEmpty():
        once = join_null_safe(stay, copies, names, "left_semi").dropDuplicates(names)
        stay = join_null_safe(stay, copies, names, "left_anti").unionByName(once)
    return _rows(stay, docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination. Documents in which a benchmark window occurs go; documents without words stay."""
    names = ["doc_id", "text_hash"]
    found = decontaminate.contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    hit = _decided(found.where("n_hit > 0").select(F.col("key").alias("doc_id"), "text_hash").distinct(), "hit")
    return _rows(join_null_safe(_named(docs), hit, names, "left_anti"), docs)


def redact_live_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans. Every document stays; spans whose value few owners hold are replaced by a mark, widely copied examples are
    left as they are. n_chars of a changed text is counted anew."""
    names = ["doc_id", "text_hash", "source", "lang"]
    found = secrets.scan(docs, *secrets.by_source(docs))
    live = found.select(F.col("key").alias("doc_id"), "text_hash", F.col("owner").alias("source"), F.col("repository").alias("lang"), F.filter("spans", lambda s: s["verdict"] == "live").alias("live"))
    live = _decided(live.where(F.size("live") > 0).dropDuplicates(names), "live", 128 + 64 * F.size("live"))
    joined = join_null_safe(_named(docs), live, names, "left")
    old = F.col("row.text")
    marked = joined.withColumn("marked", F.when(F.col("live").isNotNull(), secrets.redacted(old, F.col("live"))))
    changed = F.col("live").isNotNull()
    return _rows(marked, docs, text=F.when(changed, F.col("marked")).otherwise(old), n_chars=F.when(changed, F.char_length("marked").cast("long")).otherwise(F.col("row.n_chars")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing into sequences of at most 4096 tokens: a row per piece, null texts as empty ones."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_live_secrets),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages on `documents`, each written to the shared folder and read again as the next one's input.

    With a `folder` of the caller's, a stage that is finished there is not computed again: after a lost driver the run goes on where it stood.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = f"{folder.rstrip('/')}/{name}" if folder else work_path(spark, f"pipeline-{name}")
        if not (folder and _finished(spark, path)):
            stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs


def _finished(spark: SparkSession, path: str) -> bool:
    """Whether a writer has put its mark there: Spark does so last."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(prepare(spark), sf_dir)
