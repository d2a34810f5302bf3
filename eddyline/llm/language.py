"""Language identification by Bayesian fusion of four kinds of evidence.

1. Text: naive Bayes over hashed byte trigrams of the letters, trained on a bounded sample of rows with a declared language.
2. Declared language (markup or metadata), 3. country suffix of the address: how far either can be trusted is estimated over the
   whole table, as P(declared | language) from the text's own verdicts.
4. Host: the mixture of languages on the host, smoothed towards its domain, that towards its suffix, that towards the whole table.
   The row itself is left out of its host's counts, so it does not vote twice.

A background class explains a text by uniform trigrams; what no language explains better is `und`. The texts are
read once for scoring; what remains is a narrow table. Host counts are grouped aggregations with map-side combine, and one
equi-join brings them back, with the large, skewed side free to be split.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import join_null_safe, release
from eddyline.llm.registry import query, table
from eddyline.llm.textbytes import LOWER, Texts, slices
from eddyline.llm.url_filter import host_and_path
from eddyline.session import cut

LANGUAGES = ("de", "en", "es", "fr")
UNKNOWN = "und"
BUCKETS = 1 << 15
TRAIN_ROWS = 20_000
SMOOTHING = 0.5
# trigrams of one text are not independent: beyond this many, a text counts no more
TEXT_WEIGHT = 60.0
HOST_WEIGHT = 20.0
MIN_CONFIDENCE = 0.5
BACKGROUND_PRIOR = 1e-3

# fixed values: country suffix -> language
SUFFIXES = {"de": "de", "at": "de", "fr": "fr", "es": "es", "mx": "es", "ar": "es", "co": "es", "cl": "es", "uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en"}

# bytes that take part in trigrams: letters, and all of a multi-byte character; anything else is a space
LETTER = np.full(256, 32, np.uint8)
LETTER[128:] = np.arange(128, 256)
LETTER[97:123] = np.arange(97, 123)
LETTER[65:91] = LOWER[65:91]


@dataclass
class TextModel:
    """log P(trigram | language), (languages, BUCKETS)."""

    languages: tuple[str, ...]
    log_p: np.ndarray


def trigrams(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every trigram with a letter in its middle that stays in one text."""
    x = LETTER[part.data]
    if len(x) < 3:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    owner = np.repeat(np.arange(part.n, dtype=np.int32), np.diff(part.starts))
    ok = (owner[:-2] == owner[2:]) & (x[1:-1] != 32)
    y = x.astype(np.uint32)
    key = ((y[:-2] << 16) | (y[1:-1] << 8) | y[2:])[ok]
    return owner[:-2][ok], ((key * np.uint32(0x9E3779B1)) >> np.uint32(17)).astype(np.int32)


def train(rows: DataFrame, languages: Sequence[str] = LANGUAGES, train_rows: int = TRAIN_ROWS) -> TextModel:
    """The text model from `rows` (text, declared): all distinct texts with a known language up to about `train_rows`, else a share of
    that expected size, chosen by the hash of the text; copies count once. Counts are added up on the executors; the driver gets languages x BUCKETS sums."""
    labelled = rows.where(F.col("declared").isin(*languages) & F.col("text").isNotNull()).select(F.xxhash64("text").alias("name"), "text", "declared")
    share = min(1.0, train_rows / max(labelled.agg(F.approx_count_distinct("name")).first()[0], 1))
    drawn = labelled.where(F.pmod("name", F.lit(1 << 30)) < int(share * (1 << 30)))
    sample = drawn.groupBy("name", "declared").agg(F.first("text").alias("text")).select("text", "declared")
    known = list(languages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(known), BUCKETS), np.int64)
        for batch in batches:
            which = np.array([known.index(d) for d in batch.column(1).to_pylist()], np.int64)
            for part in slices(batch.column(0)):
                owner, bucket = trigrams(part)
                counts += np.bincount(which[part.first + owner] * BUCKETS + bucket, minlength=counts.size).reshape(counts.shape)
        release()
        lang, bucket = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(lang), pa.array(bucket), pa.array(counts[lang, bucket])], ["lang", "bucket", "n"])

    summed = sample.mapInArrow(run, "lang long, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    counts = np.full((len(known), BUCKETS), SMOOTHING)
    counts[summed["lang"].to_numpy(), summed["bucket"].to_numpy()] += summed["n"].to_numpy()
    return TextModel(tuple(known), np.log(counts / counts.sum(1, keepdims=True)))


def text_evidence(rows: DataFrame, model: TextModel) -> DataFrame:
    """`rows` without text, with n_grams and evidence: per language the text's log-likelihood ratio to the background."""
    kept = [c for c in rows.columns if c != "text"]
    kinds = dict(rows.dtypes)
    ratio = model.log_p + np.log(BUCKETS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(len(kept))):
                owner, bucket = trigrams(part)
                n = np.bincount(owner, minlength=part.n)
                total = np.stack([np.bincount(owner, r[bucket], part.n) for r in ratio], axis=1)
                total = total * (np.minimum(n, TEXT_WEIGHT) / np.maximum(n, 1))[:, None]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.n + 1, dtype=np.int32) * len(ratio)), pa.array(total.reshape(-1)))
                yield pa.RecordBatch.from_arrays([*(c.slice(part.first, part.n) for c in batch.columns[: len(kept)]), pa.array(n), lists], [*kept, "n_grams", "evidence"])
        release()

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in kept)
    return rows.select(*kept, "text").mapInArrow(run, f"{schema}, n_grams long, evidence array<double>")


def posterior(log_odds: list[Column]) -> Column:
    """Probabilities of the languages and, last, the background (log-odds 0 before its prior), as an array."""
    scores = F.array(*log_odds, F.lit(float(np.log(BACKGROUND_PRIOR))))
    top = F.array_max(scores)
    weights = F.transform(scores, lambda s: F.exp(s - top))
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return F.transform(weights, lambda w: w / total)


def trust(counts: dict[tuple[str, int], float], values: Sequence[str], languages: Sequence[str]) -> dict[str, list[float]]:
    """log P(value | language) per value, from soft counts."""
    table = np.array([[counts.get((v, k), 0.0) + 1.0 for k in range(len(languages))] for v in values])
    return {v: row.tolist() for v, row in zip(values, np.log(table / table.sum(0)), strict=True)}


def identify(rows: DataFrame, languages: Sequence[str] = LANGUAGES, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """`rows` (any id columns, text, declared, host, suffix) without text, with lang, confidence, text_lang, n_grams and kept.

    Any column may be null: a missing declared language, host or suffix is no evidence, a null or letterless text leaves `und`. Only
    rows with `lang` other than `und` and a confidence of MIN_CONFIDENCE are kept. Rows may repeat. An empty table gives no rows.
    """
    model = train(rows, languages, train_rows)
    size = len(languages)
    suffix_language = F.coalesce(*(F.when(F.col("suffix") == s, F.lit(v)) for s, v in SUFFIXES.items()))
    rows = rows.withColumns({"declared": F.lower(F.substring(F.trim("declared"), 1, 2)), "_at": suffix_language})
    scored = text_evidence(rows, model)
    domain = F.regexp_extract(F.coalesce("host", F.lit("")), r"([^.]+\.[^.]+)\z", 1)
    each = [F.get("evidence", k) for k in range(size)]
    scored = cut(scored.withColumns({"domain": domain, "own": posterior(each)}), "evidence")

    soft = [F.sum(F.get("own", k)).alias(f"s{k}") for k in range(size)]
    said = {c: F.when(F.col(c).isin(*languages), F.col(c)).when(F.col(c).isNotNull() & (F.col(c) != ""), "other") for c in ("declared", "_at")}
    tables = {}
    for c, value in said.items():
        got = scored.where(value.isNotNull()).groupBy(value.alias("v")).agg(*soft).collect()
        tables[c] = trust({(r["v"], k): r[f"s{k}"] for r in got for k in range(size)}, [*languages, "other"], languages)

    # host -> domain -> suffix -> all, each level smoothed towards the next
    whole = scored.agg(*soft).first()
    overall = np.array([(whole[k] or 0.0) + 1.0 for k in range(size)])
    overall = (overall / overall.sum()).tolist()
    levels = scored.where(F.col("host").isNotNull()).groupBy("host", "domain", "suffix").agg(*soft)
    hosts = cut(levels, "hosts")

    def smoothed(counts: DataFrame, keys: list[str], above: DataFrame | None, above_keys: list[str], name: str) -> DataFrame:
        """Shares of a level by its keys; `above` has the shares of the level it leans on."""
        sums = counts.groupBy(*keys).agg(*(F.sum(f"s{k}").alias(f"s{k}") for k in range(size)))
        joined = sums if above is None else join_null_safe(sums, above, above_keys, "left")
        parent = [F.lit(p) for p in overall] if above is None else [F.col(f"{above_keys[-1]}_{k}") for k in range(size)]
        n = sum(F.col(f"s{k}") for k in range(size))
        return joined.select(*keys, *((F.col(f"s{k}") + HOST_WEIGHT * parent[k]).__truediv__(n + HOST_WEIGHT).alias(f"{name}_{k}") for k in range(size)))

    by_suffix = smoothed(hosts, ["suffix"], None, [], "suffix")
    by_domain = smoothed(hosts, ["suffix", "domain"], by_suffix, ["suffix"], "domain")
    known = join_null_safe(hosts, by_domain.withColumnsRenamed({f"domain_{k}": f"p{k}" for k in range(size)}), ["suffix", "domain"])
    known = known.select("host", "suffix", *(f"s{k}" for k in range(size)), *(f"p{k}" for k in range(size)))

    full = join_null_safe(scored, known, ["host", "suffix"], "left")
    others = [F.greatest(F.coalesce(F.col(f"s{k}") - F.get("own", k), F.lit(0.0)), F.lit(0.0)) for k in range(size)]
    n = sum(others)
    log_odds = []
    for k in range(size):
        host = F.log((others[k] + HOST_WEIGHT * F.coalesce(F.col(f"p{k}"), F.lit(overall[k]))) / (n + HOST_WEIGHT))
        total = each[k] + host
        for c, by_value in tables.items():
            total = total + F.coalesce(*(F.when(said[c] == v, F.lit(logs[k])) for v, logs in by_value.items()), F.lit(0.0))
        log_odds.append(total)
    names = F.array(*map(F.lit, [*languages, UNKNOWN]))
    final = full.withColumn("fused", F.when(F.col("n_grams") > 0, posterior(log_odds)))
    best, text_best = F.array_max("fused"), F.array_max("own")
    final = final.withColumns(
        {
            "confidence": F.coalesce(best, F.lit(0.0)),
            "lang": F.coalesce(F.element_at(names, F.array_position("fused", best).cast("int")), F.lit(UNKNOWN)),
            "text_lang": F.when(F.col("n_grams") > 0, F.element_at(names, F.array_position("own", text_best).cast("int"))).otherwise(UNKNOWN),
        }
    )
    ids = [c for c in rows.columns if c not in ("text", "_at")]
    return final.select(*ids, "lang", "confidence", "text_lang", "n_grams", ((F.col("lang") != UNKNOWN) & (F.col("confidence") >= MIN_CONFIDENCE)).alias("kept"))


def of_documents(documents: DataFrame) -> DataFrame:
    """Documents as evidence rows: the lang column is the declared language, the source stands for the host; there is no address."""
    return documents.select("doc_id", "text", F.col("lang").alias("declared"), F.col("source").alias("host"), F.lit(None).cast("string").alias("suffix"))


def of_pages(pages: DataFrame) -> DataFrame:
    """Pages as evidence rows: text without tags, scripts and styles, the html element's lang, host and suffix of the URL."""
    html = F.coalesce(F.col("html"), F.lit(""))
    text = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    host, _ = host_and_path(F.col("url"))
    declared = F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]+)", 1)
    return pages.select("page_id", text.alias("text"), F.nullif(declared, F.lit("")).alias("declared"), F.nullif(host, F.lit("")).alias("host"), F.nullif(F.substring_index(host, ".", -1), F.lit("")).alias("suffix"))


@query("op4_language_id")
def op4_language_id(spark, sf_dir):
    """Language of all documents; see `identify`."""
    return identify(of_documents(table(spark, sf_dir, "documents")))


@query("language_of_pages")
def language_of_pages(spark, sf_dir):
    """Language of all pages, with markup language and address suffix as evidence; see `identify`."""
    return identify(of_pages(table(spark, sf_dir, "pages")))
