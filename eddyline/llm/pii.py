"""Personal data by weak supervision, in DataFrame functions only.

Regular expressions propose spans: four base kinds that are always reported, and further kinds that the method decides on.
Labelers (stricter patterns, gazetteers, words before the span) vote for or against each span or abstain. The counts of
all vote patterns over the whole corpus are one small hash aggregation; expectation-maximisation over them estimates how
reliable each labeler is and how likely each pattern is personal data. A logistic classifier over votes, kind and length is
trained on these posteriors, and its weights are applied to every span as one column expression.

Texts are scanned once and never shuffled. What the driver gets is the pattern table: at most kinds x 3^labelers x length
classes rows, however large the corpus is.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import let
from eddyline.llm.registry import query, table
from eddyline.llm.spans import SPAN, find_all, joined
from eddyline.session import cut

# fixed values: base kinds and their patterns. A run is entered at its start only (or right after the last match), which finds
# the same matches and keeps long runs linear.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9]){11,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:[0-9]|[1-9][0-9]|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
BASE_KINDS = ["email", "ip", "card", "phone"]

# fixed values: kinds the method adds when its classifier agrees
ADDED = {
    "local_phone": r"(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.\x20-])[0-9]{3}[.\x20-][0-9]{4}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "name": r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]+(?:\x20[A-Z][a-z]+)?(?![A-Za-z])",
}
KINDS = [*BASE_KINDS, *ADDED]

# fixed values: gazetteers
PROVIDERS = r"@(?:gmail|yahoo|hotmail|outlook|aol|icloud|gmx|web|mail|proton|protonmail|live|msn)[0-9]*\."
FIRST_NAMES = (
    "James Mary John Linda Robert Susan Michael Karen David Lisa William Nancy Richard Anna Thomas Maria Daniel Laura Paul Julia Mark Sarah "
    "Peter Emma Hans Ursula Klaus Monika Pierre Marie Jean Sophie Jose Carmen Juan Lucia Carlos Elena"
).split()
IBAN_COUNTRIES = "AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split()
TEST_CARDS = "4111111111111111 4242424242424242 5555555555554444 378282246310005 6011111111111117".split()
FOR_CUES = r"(?i)(?:mail|contact|phone|tel|call|fax|mobile|cell|write to|reach|card|visa|ssn|social security|iban|account|address|signed|dear|from)\W{0,3}(?:\w+\W{1,2}){0,2}\z"
AGAINST_CUES = r"(?i)(?:version|release|build|isbn|doi|section|serial|part no|sku|figure|table|rev|chapter|v)\W{0,2}\z"

LABELERS = ["strict", "gazetteer", "cue_for", "cue_against"]
LENGTHS = 4
SPANS = "array<struct<kind:string,start:int,end:int,base:boolean,strict:int,gazetteer:int,cue_for:int,cue_against:int,length:int>>"


def digits_of(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit is right; every second digit from the right is doubled."""

    def term(d: Column, i: Column) -> Column:
        n = F.ascii(d) - 48
        twice = 2 * n
        return F.when(i % 2 == 0, n).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    values = F.transform(F.split(F.reverse(digits), ""), term)
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def between(n: Column, low: int, high: int) -> Column:
    return (n >= low) & (n <= high)


def is_base(kind: str) -> Callable[[Column], Column]:
    """What a match of the kind's pattern must pass besides."""
    if kind == "ip":
        return lambda v: F.rlike(v, F.lit(rf"\A{OCTET}\.{OCTET}\.{OCTET}\.{OCTET}\z"))
    if kind == "card":
        return lambda v: let(digits_of(v), lambda d: between(F.length(d), 12, 19) & luhn(d))
    if kind == "phone":
        return lambda v: between(F.length(digits_of(v)), 9, 15)
    return lambda v: F.lit(True)


def strict_vote(kind: str, v: Column) -> Column:
    """A stricter form of the kind's pattern votes for, its violation against."""
    forms = {
        "email": r"\A[A-Za-z0-9][A-Za-z0-9._%+-]*@[^@]*\.[A-Za-z]{2,}\z",
        "ip": r"\A(?:[1-9]|[1-9][0-9]|1[0-9]{2}|2[01][0-9]|22[0-3])\.(?:0|[1-9][0-9]{0,2})\.(?:0|[1-9][0-9]{0,2})\.(?:0|[1-9][0-9]{0,2})\z",
        "card": r"\A(?:4|5[1-5]|2[2-7]|3[47]|6)",
        "phone": r"\A\+[1-9][0-9]{0,2}[\x20(.-]",
        "local_phone": r"\A\(?[2-9][0-9]{2}\)?[.\x20-]?[2-9]",
        "ssn": r"\A(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)",
        "iban": rf"\A(?:{'|'.join(IBAN_COUNTRIES)})[0-9]{{2}}",
        "name": r"\A(?:Mr|Mrs|Ms|Dr|Prof)\.",
    }
    return F.when(F.rlike(v, F.lit(forms[kind])), 1).otherwise(0 if kind == "name" else -1)


def gazetteer_vote(kind: str, v: Column) -> Column:
    known = {
        "email": F.when(F.rlike(v, F.lit(PROVIDERS)), 1).otherwise(0),
        "ip": F.when(F.rlike(v, F.lit(r"\A(?:0|10|127)\.|\A192\.168\.|\A172\.(?:1[6-9]|2[0-9]|3[01])\.")), -1).otherwise(0),
        "card": F.when(digits_of(v).isin(TEST_CARDS), -1).otherwise(0),
        "phone": F.when(F.rlike(v, F.lit(r"\A\+(?:1|33|34|39|41|43|44|49)[^0-9]")), 1).otherwise(0),
        "local_phone": F.when(F.rlike(v, F.lit(r"555.?01[0-9]{2}\z")), -1).otherwise(0),
        "ssn": F.when(v.isin("078-05-1120", "219-09-9999", "123-45-6789"), -1).otherwise(0),
        "iban": F.lit(0),
        "name": F.when(F.rlike(v, F.lit(rf"\x20(?:{'|'.join(FIRST_NAMES)})\b")), 1).otherwise(0),
    }
    return known[kind]


def candidates(text: Column) -> Column:
    """SPANS of a non-null text: base spans, and added kinds where no base span is."""

    def voted(kind: str, spans: Column, base: bool) -> Column:
        def one(s: Column) -> Column:
            v, before = s["value"], s["before"]
            return F.struct(
                F.lit(kind).alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.lit(base).alias("base"),
                strict_vote(kind, v).alias("strict"),
                gazetteer_vote(kind, v).alias("gazetteer"),
                F.rlike(before, F.lit(FOR_CUES)).cast("int").alias("cue_for"),
                (-F.rlike(before, F.lit(AGAINST_CUES)).cast("int")).alias("cue_against"),
                F.least(F.floor(F.char_length(v) / 8), F.lit(LENGTHS - 1)).cast("int").alias("length"),
            )

        return F.transform(spans, one)

    patterns = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
    needs = {"email": "@", "ip": ".", "phone": "+"}

    def found(kind: str) -> Column:
        test = is_base(kind)
        spans = F.filter(find_all(text, patterns[kind]), lambda s: test(s["value"]))
        return F.when(F.contains(text, F.lit(needs[kind])), spans).otherwise(F.array().cast(f"array<{SPAN}>")) if kind in needs else spans

    base = F.concat(*(voted(k, found(k), True) for k in BASE_KINDS))

    def with_added(own: Column) -> Column:
        def free(s: Column) -> Column:
            return ~F.exists(own, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))

        return F.concat(own, *(voted(k, F.filter(find_all(text, p), free), False) for k, p in ADDED.items()))

    return let(base, with_added)


def expectation_maximisation(votes: np.ndarray, kind: np.ndarray, weight: np.ndarray, rounds: int = 50) -> np.ndarray:
    """P(personal | votes, kind) of each pattern. Two classes, votes independent given the class, a prior per kind; starts
    from the majority vote. Smoothed, so rare votes keep finite odds."""
    post = 1 / (1 + np.exp(-1.5 * votes.sum(1) - 0.5))
    kinds = kind.max(initial=-1) + 1
    for _ in range(rounds):
        yes, no = weight * post, weight * (1 - post)
        prior = (np.bincount(kind, yes, kinds) + 2) / (np.bincount(kind, weight, kinds) + 4)
        odds = np.log(prior / (1 - prior))[kind]
        for k in range(votes.shape[1]):
            v = votes[:, k] + 1
            given_yes = (np.bincount(v, yes, 3) + [0.5, 2, 2]) / (yes.sum() + 4.5)
            given_no = (np.bincount(v, no, 3) + [2, 2, 0.5]) / (no.sum() + 4.5)
            odds = odds + np.log(given_yes / given_no)[v]
        post = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return post


def train(patterns: list[tuple[int, ...]], rounds: int = 500, rate: float = 1.0, ridge: float = 1e-3) -> np.ndarray:
    """Weights of the span classifier (one-hot kind, votes and length class, and a constant) from rows (kind, votes, length, n)."""
    table = np.array(patterns, int).reshape(len(patterns), len(LABELERS) + 3)
    kind, votes, length, n = table[:, 0], table[:, 1:-2], table[:, -2], table[:, -1].astype(float)
    x = np.hstack([np.eye(len(KINDS))[kind], *(np.eye(3)[v + 1] for v in votes.T), np.eye(LENGTHS)[length], np.ones((len(n), 1))])
    w = np.zeros(x.shape[1])
    if len(n):
        y = expectation_maximisation(votes, kind, n)
        share = np.sqrt(n) / np.sqrt(n).sum()  # frequent patterns count more, but don't drown the others
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-(x @ w)))
            w -= rate * (x.T @ (share * (p - y)) + ridge * w)
    return w


def score(span: Column, weights: np.ndarray) -> Column:
    """The classifier's log-odds for a span as one expression."""
    w = weights.tolist()
    by_kind = F.create_map(*chain.from_iterable((F.lit(k), F.lit(w[i])) for i, k in enumerate(KINDS)))
    at = len(KINDS)
    total = F.element_at(by_kind, span["kind"]) + w[-1]
    for name in LABELERS:
        total = total + F.element_at(F.array(*map(F.lit, w[at : at + 3])), span[name] + 2)
        at += 3
    return total + F.element_at(F.array(*map(F.lit, w[at : at + LENGTHS])), span["length"] + 1)


def personal_data(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of `documents`: key, spans (kind, start, end, base, score).

    Base spans always stay; a span of an added kind stays if the classifier's odds are above even. A null text is empty. Keys may be null or
    repeat; other columns are not read. Without any span the classifier is not used.
    """
    found = documents.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = cut(found.select("key", candidates(F.col("text")).alias("spans")), "spans")
    each = rows.where(F.size("spans") > 0).select(F.explode("spans").alias("s")).select("s.kind", *(f"s.{c}" for c in LABELERS), "s.length")
    patterns = each.groupBy("kind", *LABELERS, "length").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", *LABELERS, "length").collect()
    weights = train([(KINDS.index(p[0]), *p[1:]) for p in patterns])
    scored = F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"), score(s, weights).alias("score")))
    return rows.select("key", F.filter(scored, lambda s: s["base"] | (s["score"] > 0)).alias("spans"))


@query("op9_pii")
def op9_pii(spark, sf_dir):
    """Base and added personal-data spans of all documents; see `personal_data`."""
    spans = F.col("spans")
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return personal_data(table(spark, sf_dir, "documents")).select(
        F.col("key").alias("doc_id"), *map(count, BASE_KINDS), F.sha2(joined(F.filter(spans, lambda s: s["base"]), KINDS), 256).alias("base_sha256"), joined(spans, KINDS).alias("spans")
    )
