"""URL filter: rules first, then a logistic regression on hashed character n-grams of host and path.

The model is trained on the driver from a labelled URL table of bounded size (`MAX_LABELLED` rows, by hash order beyond
it) and shipped with the scoring tasks: `BUCKETS` weights. Scoring is one pass without a shuffle; n-grams are hashed
with numpy over all URLs of a batch at once.
"""

from __future__ import annotations

import random
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import lower_ascii
from eddyline.llm.registry import query, table

BUCKETS = 1 << 15
GRAMS = (1, 2, 3, 4)
HELD_OUT = 5  # one labelled row in so many chooses the threshold
CLEAN_BLOCKED = 0.005  # of the clean held-out rows may be blocked
MAX_LABELLED = 20_000
SLICE_BYTES = 1 << 21
HOST, PATH = 1, 2
AFTER_SCHEME = r"(?s)\A.*?://([^/?#]*)([^?#]*)"

# fixed values: (host, path start, verdict)
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)

# fixed values: words that names of blocked and of allowed hosts are made of
BLOCKED_WORDS = """
lottery jackpot poker roulette gamble wager loans payday credit debt crypto bitcoin forex invest profit rich earn bonus prize gift voucher coupon
replica watches handbags rolex outlet discount bargain viagra diet slim keto detox pharma tablets rx meds cams dating hookup escort porn tube
warez crack serial keygen torrent phish login verify popup banner clicks seo links backlink traffic followers likes
quick instant cash money deals sale buy hot sexy nude webcam teen milf fetish blackjack slots odds tipster sportsbook bingo
mortgage refinance insurance trading broker stocks penny miracle cure botox steroids weightloss supplement hacks unlock generator coins giveaway survey
""".split()  # fmt: skip
ALLOWED_SYLLABLES = "ba be bel bo bri ca cal ce cor da del di dor el en er fa fen gar ge ha hel in ka la lan le lin lo ma mar me mi mor na ne no on or pa per ra re ri ro sa sel so ta ten ter th ti to un ur va ver wen wo".split()
ALLOWED_WORDS = """
museum garden library school weather river history travel music science forum harbor mountain theater orchard university health journal city village
bridge castle forest lake island market bakery pottery knitting chess football cricket cycling hiking astronomy physics chemistry biology grammar
dictionary archive gallery studio quartet choir orchestra festival academy institute council hospital clinic pharmacy dentist railway airport
software compiler database network recipes cooking breakfast vegetable butcher fishing sailing surfing climbing swimming
newspaper magazine publisher bookshop poetry novel cinema documentary photograph painting sculpture architecture carpenter workshop
""".split()  # fmt: skip
PREFIXES, SUFFIXES = ("", "", "www.", "m.", "blog."), ("test", "site.test", "page.test")
PATHS = ("/{n}", "/en/{n}", "/de/{n}.html", "/fr/{n}/", "/es/{n}", "/", "/en/{n}.html")
SEEDS = 6_000
HYPHENATED = 0.02  # of the allowed names


def seed_table(n: int = SEEDS, seed: int = 11) -> list[tuple[str, int]]:
    """Labelled URLs (url, blocked), half and half: names of two words of a trade joined by a hyphen, and common words or two to four syllables, a few of them
    joined by a hyphen as well. Prefix, suffix and path are drawn alike for both."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        blocked = i % 2
        if blocked:
            name = "-".join(rnd.sample(BLOCKED_WORDS, 2))
        else:
            parts = [rnd.choice(ALLOWED_WORDS) if rnd.random() < 0.4 else "".join(rnd.choices(ALLOWED_SYLLABLES, k=rnd.randint(2, 4))) for _ in range(2)]
            name = "-".join(parts) if rnd.random() < HYPHENATED else parts[0]
        path = rnd.choice(PATHS).format(n=rnd.randrange(1, 10_000))
        out.append((f"http://{rnd.choice(PREFIXES)}{name}.{rnd.choice(SUFFIXES)}{path}", blocked))
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased. Path: from there up to `?`, `#` or the
    end. Both are empty for a null or a URL without `://`."""
    whole = F.coalesce(url, F.lit(""))
    return lower_ascii(F.regexp_extract(whole, AFTER_SCHEME, 1)), F.regexp_extract(whole, AFTER_SCHEME, 2)


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as a struct (rule, verdict), null if none fits. A rule fits its host and all subdomains."""
    fitting = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(start))
        fitting = F.when(fits, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fitting)
    return fitting


def gram_hashes(values: Sequence[str], salt: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of every character n-gram, taken over UTF-8 bytes of ^value$; in hosts a dot ends a label and no n-gram goes over it."""
    encoded = [b"^" + v.encode("utf-8", "replace").replace(b".", b"$^") + b"$" for v in values] if salt == HOST else [b"^" + v.encode("utf-8", "replace") + b"$" for v in values]
    lengths = np.fromiter(map(len, encoded), np.int64, len(encoded))
    data = np.frombuffer(b"".join(encoded), np.uint8).astype(np.uint64)
    row = np.repeat(np.arange(len(encoded)), lengths)
    left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(data))  # bytes from here to the end of the value
    rows, buckets = [], []
    for n in GRAMS:
        if len(data) < n:
            continue
        h = np.full(len(data) - n + 1, (salt * 31 + n) * 0x9E3779B97F4A7C15 % 2**64, np.uint64)
        for k in range(n):
            h = (h ^ data[k : len(data) - n + 1 + k]) * np.uint64(0xFF51AFD7ED558CCD)
            h ^= h >> np.uint64(32)
        inside = left[: len(h)] >= n
        for k in range(n - 1):  # an end has to be last, so that a label's beginning is first
            inside &= data[k : len(data) - n + 1 + k] != ord("$")
        rows.append(row[: len(h)][inside])
        buckets.append((h[inside] >> np.uint64(20)).astype(np.int64) % BUCKETS)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *buckets])


def features(hosts: Sequence[str], paths: Sequence[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of hosts and of paths: (row, bucket, scale of each row). Each part weighs the same however long it is, so a long path cannot drown the host."""
    out = []
    for values, salt in ((hosts, HOST), (paths, PATH)):
        row, bucket = gram_hashes(values, salt)
        out.append((row, bucket, 1 / np.sqrt(np.maximum(np.bincount(row, minlength=len(values)), 1))))
    return out


def scores(hosts: Sequence[str], paths: Sequence[str], weights: np.ndarray, bias: float) -> np.ndarray:
    """Log-odds that a URL is to be blocked, from the threshold on."""
    return bias + sum(np.bincount(row, weights[bucket], len(hosts)) * scale for row, bucket, scale in features(hosts, paths))


def train(labelled: DataFrame, url: str = "url", label: str = "blocked", rounds: int = 300, rate: float = 2.0, ridge: float = 1e-4) -> tuple[np.ndarray, float]:
    """Weights and bias from labelled URLs (label 1: block). Rows with a null label are left out; at most `MAX_LABELLED`
    rows, the first by hash, are fetched. One in `HELD_OUT` does not train but sets the threshold: the least at which at most
    `CLEAN_BLOCKED` of the clean ones among them are blocked. Without rows the model allows everything."""
    host, path = host_and_path(F.col(url))
    rows = labelled.where(F.col(label).isNotNull()).select(host.alias("host"), path.alias("path"), F.col(label).cast("double").alias("y"))
    sample = rows.orderBy(F.xxhash64("host", "path"), "host", "path", "y").limit(MAX_LABELLED).toPandas()
    weights = np.zeros(BUCKETS)
    if sample.empty:
        return weights, -1.0
    held = np.arange(len(sample)) % HELD_OUT == HELD_OUT - 1
    used = sample[~held]
    y = used["y"].to_numpy()
    parts = features(used["host"].tolist(), used["path"].tolist())
    bias = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1)))
    for _ in range(rounds):
        z = bias + sum(np.bincount(row, weights[bucket], len(y)) * scale for row, bucket, scale in parts)
        miss = 1 / (1 + np.exp(-z)) - y
        step = sum(np.bincount(bucket, (miss * scale)[row], BUCKETS) for row, bucket, scale in parts)
        weights -= rate * (step / len(y) * 8 + ridge * weights)
        bias -= rate * miss.mean() * 0.1
    clean = sample[held & (sample["y"] == 0)]
    if len(clean):
        found = scores(clean["host"].tolist(), clean["path"].tolist(), weights, bias)
        bias -= max(0.0, float(np.quantile(found, 1 - CLEAN_BLOCKED, method="higher")) + 1e-9)
    return weights, bias


def judge(urls: DataFrame, model: tuple[np.ndarray, float], rules: Sequence[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """Rows (key, host, path, rule, verdict, score): the verdict of the longest fitting rule, else the model's.

    A URL that is null or has no `://` has an empty host and path, fits no rule and is judged by the model like any other.
    Keys may be null or repeat: every row is judged by itself. Other columns are not read.
    """
    weights, bias = model
    host, path = host_and_path(F.col(url))

    @F.pandas_udf("double")
    def log_odds(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in batches:
            hosts, paths, done = hosts.tolist(), paths.tolist(), []
            size = np.cumsum([len(h) + len(p) for h, p in zip(hosts, paths, strict=True)])
            cuts = [0, *(np.flatnonzero(np.diff(size // SLICE_BYTES)) + 1).tolist(), len(hosts)]
            for a, b in zip(cuts, cuts[1:]):
                done.append(scores(hosts[a:b], paths[a:b], weights, bias))
            yield pd.Series(np.concatenate(done))

    parts = urls.select(F.col(key).alias("key"), host.alias("host"), path.alias("path")).withColumn("score", log_odds("host", "path"))
    by_rule = rule_of(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("score") > 0, "block").otherwise("allow")
    return parts.withColumn("by", by_rule).select("key", "host", "path", F.col("by.rule").alias("rule"), F.coalesce("by.verdict", own).alias("verdict"), "score")


def seed_urls(spark) -> DataFrame:
    return spark.createDataFrame(seed_table(), "url string, blocked int")


@query("op1_url_filter")
def op1_url_filter(spark, sf_dir):
    """Rules and the model trained on the seed URLs, over all pages; see `judge`."""
    return judge(table(spark, sf_dir, "pages"), train(seed_urls(spark))).withColumnRenamed("key", "page_id")
