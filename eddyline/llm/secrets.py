"""Secret scan: credential-like spans, judged by how widely their value is owned across the corpus.

A value found in the repositories of many owners is a copied example; one that a single owner (or two) holds looks live.
Candidate values are hashed; distinct (value, owner, repository) triples are counted with map-side aggregation, so a value
that sits in a third of all documents is a handful of rows per task before any shuffle. Texts are scanned once and never
shuffled; spans come from SQL functions (see `spans`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import text_hash
from eddyline.llm.registry import query, table
from eddyline.llm.spans import find_all, joined
from eddyline.session import cut

# fixed values: base kinds and their patterns
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = r"""\A(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?(.*)\z"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"[0-9a-f]{16,}+"
BASE_KINDS = ["assign", "access", "hex"]
MIN_ASSIGNED = 12

# what the method adds: random-looking tokens of any length from 24 on, outside base spans
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{24,}+(?![A-Za-z0-9+/_=-])"
MIN_DISTINCT = 14

KINDS = [*BASE_KINDS, "opaque"]

# a value in the repositories of this many owners is a copied example
COPIED_OWNERS = 3

SPANS = "array<struct<kind:string,start:int,end:int,hash:bigint,base:boolean>>"


def _as(kind: str, spans: Column, value, base: bool = True) -> Column:
    return F.transform(
        spans,
        lambda s: F.struct(F.lit(kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), F.xxhash64(value(s["value"])).alias("hash"), F.lit(base).alias("base")),
    )


def base_spans(text: Column) -> Column:
    """assign: a named value of 12 characters or more; access: AKIA and 14 or more; hex: 16 digits or more. Whole matches."""

    def assigned(v: Column) -> Column:
        return F.regexp_extract(v, ASSIGN_VALUE, 1)

    assigns = F.filter(find_all(text, ASSIGN), lambda s: F.char_length(assigned(s["value"])) >= MIN_ASSIGNED)
    whole = lambda v: v
    return F.concat(_as("assign", assigns, assigned), _as("access", find_all(text, ACCESS), whole), _as("hex", find_all(text, HEX), whole))


def opaque_spans(text: Column, base: Column) -> Column:
    """Tokens with upper, lower, digits and many different characters that no base span touches."""

    def random_looking(s: Column) -> Column:
        v = s["value"]
        kinds = F.rlike(v, F.lit("[A-Z]")) & F.rlike(v, F.lit("[a-z]")) & F.rlike(v, F.lit("[0-9]"))
        return kinds & (F.size(F.array_distinct(F.split(v, ""))) >= MIN_DISTINCT) & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

    return _as("opaque", F.filter(find_all(text, TOKEN), random_looking), lambda v: v, base=False)


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) of candidate rows (hash, owner, repository). Null owners count as one owner."""
    distinct = candidates.select("hash", F.struct("owner").alias("owner"), F.struct("owner", "repository").alias("repository")).distinct()
    owners = distinct.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return owners.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def scan(documents: DataFrame, owner: Column, repository: Column, key: str = "doc_id", text: str = "text", copied_owners: int = COPIED_OWNERS) -> DataFrame:
    """One row per row of `documents`: key, text_hash, owner, repository, spans (SPANS plus n_owners, n_repositories and verdict `live` or `copied`).

    A null text is empty. Keys, owners and repositories may be null, and keys may repeat: rows are told apart by a number of
    their own. Added spans whose value is widely copied are dropped; base spans always stay. Other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    found = documents.select(F.col(key).alias("key"), owner.alias("owner"), repository.alias("repository"), body.alias("body"))
    found = found.withColumn("base", base_spans(F.col("body"))).withColumn("spans", F.concat("base", opaque_spans(F.col("body"), F.col("base"))))
    rows = cut(found.select("key", text_hash(F.col("body")).alias("text_hash"), "owner", "repository", "spans", F.monotonically_increasing_id().alias("row")), "secrets")
    each = rows.where(F.size("spans") > 0).select("row", "owner", "repository", F.explode("spans").alias("span"))
    known = ownership(each.select(F.col("span.hash").alias("hash"), "owner", "repository"))
    verdict = F.when(F.col("n_owners") >= copied_owners, "copied").otherwise("live")
    judged = each.select("row", F.col("span.hash").alias("hash"), "span").join(known, "hash")
    judged = judged.select("row", F.struct("span.kind", "span.start", "span.end", "span.base", "n_owners", "n_repositories", verdict.alias("verdict")).alias("s"))
    judged = judged.where(F.col("s.base") | (F.col("s.verdict") == "live")).groupBy("row").agg(F.collect_list("s").alias("judged"))
    none = F.array().cast("array<struct<kind:string,start:int,end:int,base:boolean,n_owners:bigint,n_repositories:bigint,verdict:string>>")
    return rows.join(judged, "row", "left").select("key", "text_hash", "owner", "repository", F.coalesce("judged", none).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "[SECRET]") -> Column:
    """`text` with each stretch of overlapping `spans` (code-point start, end) replaced by `mark`."""
    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        between = F.concat(acc["done"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(new, between).otherwise(acc["done"]).alias("done"))

    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))
    return F.aggregate(ordered, zero, step, lambda acc: F.concat(acc["done"], F.substring(text, acc["at"] + 1, F.char_length(text))))


def by_source(documents: DataFrame) -> tuple[Column, Column]:
    """Owner and repository of `documents`, which names neither: its source, and the source's part in one language."""
    return F.col("source"), F.col("lang")


@query("op10_secret_scan")
def op10_secret_scan(spark, sf_dir):
    """Base and added secret spans of all documents with their verdicts; see `scan`."""
    documents = table(spark, sf_dir, "documents")
    found = scan(documents, *by_source(documents))
    spans = F.col("spans")
    base = F.filter(spans, lambda s: s["base"])
    count = lambda of: F.size(F.filter(spans, of)).cast("long")
    is_kind = lambda kind: lambda s: s["kind"] == kind
    return found.select(
        F.col("key").alias("doc_id"),
        *(count(is_kind(k)).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(joined(base, KINDS), 256).alias("base_sha256"),
        joined(spans, KINDS).alias("spans"),
        count(lambda s: s["verdict"] == "live").alias("n_live"),
        count(lambda s: s["verdict"] == "copied").alias("n_copied"),
    )
