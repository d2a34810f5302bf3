"""Token counts of whole texts: pieces are counted once per distinct pre-token and summed over each document's pre-token frequencies.

First pass: each task lists its distinct pre-tokens with their occurrences; grouped over the corpus, every distinct
pre-token reaches the tokenizer's model once. Second pass: each document's pre-token frequencies meet the piece counts. The most frequent
pre-tokens (a bounded number, see `lookup`) are handed to the tasks, all others are joined by a shuffle. Ids of a document never exist.

Each text is read twice instead of writing its frequencies, which would be about as large as the text.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.lookup import HEAD, head_from, in_head
from eddyline.llm.packing import BYTE_LETTERS
from eddyline.llm.ragged import Words, as_lists, flat, gather, offsets_of, sums, words_of
from eddyline.llm.registry import query, table
from eddyline.session import cut

LIMIT = 512
SLICE_BYTES = 8 << 20
LONGEST_KEY = 64

# fixed values: how the byte-level tokenizer splits a text
PRE_TOKENS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# characters that are unknown to this library may be known to the tokenizer's
UNKNOWN = regex.compile(r"\p{Cn}")

Batches = Iterator[pa.RecordBatch]


class Counter:
    """Pre-tokens of words, and the number of pieces of a pre-token, for a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("added tokens that look at their neighbours are not handled")
        self.added = regex.compile("|".join(regex.escape(t.content) for t in added)) if added else None

    def pre_tokens(self, words: list[str]) -> tuple[list[list[str]], list[int]]:
        """The pre-tokens, and the number of added tokens, of each word. An added token in a text is one token and parts what stands around it."""
        every = "".join(words)
        if self.added and self.added.search(every):
            parts = [self.added.split(w) for w in words]
            found = [self.pre_tokens(p)[0] for p in parts]
            return [[t for part in f for t in part] for f in found], [len(p) - 1 for p in parts]
        if every.isascii() or not UNKNOWN.search(every):
            return list(map(PRE_TOKENS.findall, words)), [0] * len(words)
        return [[w[a:b] for _, (a, b) in self.split(w)] if UNKNOWN.search(w) else PRE_TOKENS.findall(w) for w in words], [0] * len(words)

    def pieces(self, pre_token: str) -> int:
        return len(self.tokenizer.model.tokenize("".join(map(BYTE_LETTERS.__getitem__, pre_token.encode()))))


def key_of(pre_token: str) -> bytes:
    """The pre-token itself, or a digest of a long one; 0xFF is in no UTF-8 text."""
    raw = pre_token.encode()
    return raw if len(raw) <= LONGEST_KEY else b"\xff" + hashlib.sha256(raw).digest()


class PreTokens:
    """The pre-tokens of some texts: word w of `words` has distinct[k] for k in its list of codes."""

    def __init__(self, counter: Counter, words: Words):
        self.words = words
        split, self.added = counter.pre_tokens(words.distinct.cast(pa.large_string()).to_pylist())
        codes: dict[str, int] = {}
        new = codes.setdefault
        self.codes, self.offsets = flat([[new(p, len(codes)) for p in found] for found in split])
        self.distinct = list(codes)

    def occurrences(self) -> np.ndarray:
        times = np.bincount(self.words.codes, minlength=len(self.words.distinct))
        return np.bincount(self.codes, np.repeat(times, np.diff(self.offsets)), len(self.distinct)).astype(np.int64)

    def frequencies(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(first, code, times, added): text i holds distinct[code[k]] times[k] times for k in first[i]:first[i + 1], and `added` tokens."""
        first, n = self.words.first, max(1, len(self.distinct))
        every, begin = gather(self.codes, self.offsets, self.words.codes)
        texts = np.arange(len(first))
        pair, times = np.unique(np.repeat(texts[:-1], np.diff(begin[first])) * n + every, return_counts=True)
        return np.searchsorted(pair, texts * n), pair % n, times, sums(np.array(self.added, np.int64)[self.words.codes], first)


def distinct_lister(path: str) -> Callable[[Batches], Batches]:
    """(pre_token, times) of a part of the texts at a time."""

    def run(batches: Batches) -> Batches:
        counter = Counter(path)
        for batch in batches:
            for _, _, words in words_of(batch.column(0), SLICE_BYTES):
                found = PreTokens(counter, words)
                yield pa.RecordBatch.from_arrays([pa.array(found.distinct, pa.string()), pa.array(found.occurrences())], ["pre_token", "times"])

    return run


def piece_counter(path: str) -> Callable[[Batches], Batches]:
    """(key, pieces, times) of distinct pre-tokens."""

    def run(batches: Batches) -> Batches:
        counter = Counter(path)
        for batch in batches:
            tokens = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array(map(key_of, tokens), pa.binary()), pa.array(map(counter.pieces, tokens), pa.int64()), batch.column(1)], ["key", "pieces", "times"])

    return run


def document_counter(path: str, head) -> Callable[[Batches], Batches]:
    """(key, n_bytes) documents with the tokens that `head` knows and the frequencies of all other pre-tokens."""

    def run(batches: Batches) -> Batches:
        counter, known = Counter(path), head.value
        for batch in batches:
            for at, n, words in words_of(batch.column(2), SLICE_BYTES):
                found = PreTokens(counter, words)
                first, code, times, added = found.frequencies()
                keys = list(map(key_of, found.distinct))
                pieces = np.fromiter((known.get(k, -1) for k in keys), np.int64, len(keys))[code]
                rest = pieces < 0
                tokens = sums(np.where(rest, 0, pieces) * times, first) + added
                more = pa.StructArray.from_arrays([pa.array(keys, pa.binary()).take(pa.array(code[rest])), pa.array(times[rest], pa.int64())], ["key", "times"])
                lists = as_lists(more, offsets_of(rest)[first])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, n), batch.column(1).slice(at, n), pa.array(tokens), lists], ["key", "n_bytes", "known", "more"])

    return run


def token_counts(documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """Rows (key, n_bytes, n_tokens), one per document: UTF-8 bytes and tokens of the whole text, no special tokens added, added tokens
    inside a text as the library's default takes them (one token).

    A null text is an empty one: no bytes, no tokens. Keys may be null or repeat, every row is counted for itself; an empty table gives an
    empty result. Other columns are not read. A pre-token is one string in a task however long it is, so a text without any space needs
    the memory that the tokenizer itself needs for it.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    listed = documents.select(body.alias("text")).mapInArrow(distinct_lister(tokenizer), "pre_token string, times bigint")
    grouped = listed.groupBy("pre_token").agg(F.sum("times").alias("times"))
    pieces = cut(grouped.mapInArrow(piece_counter(tokenizer), "key binary, pieces bigint, times bigint"), "pieces")

    least = head_from(pieces, "times", head)
    frequent = in_head("times", least)
    spark = documents.sparkSession
    few = pieces.where(frequent).select("key", "pieces").toArrow()
    known = spark.sparkContext.broadcast(dict(zip(few.column("key").to_pylist(), few.column("pieces").to_pylist())))

    kind = dict(documents.dtypes)[key]
    rows = documents.select(F.col(key).alias("key"), F.octet_length(body).cast("long").alias("n_bytes"), body.alias("text"))
    counted = rows.mapInArrow(document_counter(tokenizer, known), f"key {kind}, n_bytes bigint, known bigint, more array<struct<key:binary,times:bigint>>")
    counted = cut(counted.withColumn("row", F.monotonically_increasing_id()), "known")
    more = counted.where(F.size("more") > 0).select("row", F.explode("more").alias("m")).select("row", "m.key", "m.times")
    found = more.join(pieces.where(~frequent).select("key", "pieces"), "key").groupBy("row").agg(F.sum(F.col("times") * F.col("pieces")).alias("tail"))
    return counted.select("row", "key", "n_bytes", "known").join(found, "row", "left").select(
        F.col("key").alias(key), "n_bytes", (F.col("known") + F.coalesce("tail", F.lit(0))).alias("n_tokens")
    )


@query("op13_token_counts")
def op13_token_counts(spark, sf_dir):
    """Tokens of every document; see `token_counts`."""
    import public_tokenizers

    counts = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)
