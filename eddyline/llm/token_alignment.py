"""Two tokenizations of the same texts aligned by whitespace-token anchors.

Every text is tokenized as a whole by a byte-level BPE (A, with a space in front) and a sentencepiece BPE (B, which adds it). The tokenizers never join over a space between
two other characters, so the distinct words of a part of the texts are tokenized once and put together to the ids of whole texts. Where an A and a B token
end at the same byte and both next tokens are marked by a space, the text is split: an anchor. What lies between two anchors is a window of A ids
and B ids. A token's bytes depend on its id alone, so equal windows have the same groups and links: windows are told apart by their id tuples, each
distinct one of a part is aligned once, and every occurrence looks the result up.

The links of a document are written as (id pair, times). The number of documents that hold a pair is counted over the corpus and looked up again:
the most frequent pairs (a bounded number, see `lookup`) in the tasks, all others by a shuffle.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eddyline.llm.lookup import HEAD, head_from, in_head
from eddyline.llm.packing import BYTE_LETTERS
from eddyline.llm.ragged import Words, as_lists, flat, gather, offsets_of, sums, words_of
from eddyline.llm.registry import query, table
from eddyline.session import cut

SLICE_BYTES = 4 << 20
REMEMBERED = 150_000  # words of a generation; there are two
PACKED = 4  # ids of 16 bits in one number

Batches = Iterator[pa.RecordBatch]


class Side:
    """Token ids of words, and each id's bytes."""

    def __init__(self, spellings: list[bytes], encode: Callable[[list[str]], list[list[int]]]):
        self.spellings, self.encode = spellings, encode
        self.size = np.array([len(s) for s in spellings], np.int64)
        self.spaced = np.array([s[:1] == b" " for s in spellings])

    def spelt(self, ids: list[int]) -> bytes:
        return b"".join(map(self.spellings.__getitem__, ids))


def byte_level(path: str) -> Side:
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    letters = {c: b for b, c in enumerate(BYTE_LETTERS)}
    spellings = [b""] * (max(tokenizer.get_vocab(True).values()) + 1)
    for token, i in tokenizer.get_vocab(False).items():
        spellings[i] = bytes(letters[c] for c in token)
    return Side(spellings, lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)])


def sentence_pieces(path: str) -> Side:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)

    def spelling(i: int) -> bytes:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            return bytes([int(piece[3:5], 16)])
        if "▁" in piece.lstrip("▁"):
            raise ValueError("a piece goes on behind a space: words cannot be tokenized on their own")
        return piece.replace("▁", " ").encode()

    # the model puts a space in front of what it is given
    return Side([spelling(i) for i in range(model.vocab_size())], lambda words: model.encode([w[1:] for w in words], num_threads=1))


class Aligner:
    def __init__(self, a: Side, b: Side):
        self.a, self.b = a, b
        self.words: dict[bytes, tuple | None] = {}
        self.older: dict[bytes, tuple | None] = {}
        self.names = [list(map(str, range(len(side.spellings)))) for side in (a, b)]
        self.packable = max(len(a.spellings), len(b.spellings)) < (1 << 16) - 1

    def tokenized(self, words: list[bytes]) -> list[tuple | None]:
        """(A ids, B ids) of each word, None where one of them does not spell the word."""
        found = [self.words.get(w, ()) for w in words]
        for i, w in enumerate(words):
            if found[i] == () and (ids := self.older.get(w, ())) != ():
                found[i] = self.words[w] = ids
        places = [i for i, f in enumerate(found) if f == ()]
        new = [words[i] for i in places]
        spelt = [w.decode() for w in new]
        ids = [side.encode(spelt) for side in (self.a, self.b)]
        right = [self.spells(side, x, new) for side, x in zip((self.a, self.b), ids)]
        for i, w, x, y, one, other in zip(places, new, *ids, *right):
            found[i] = self.words[w] = (x, y) if one and other else None
        if len(self.words) > REMEMBERED:  # what is not used in the next generation is forgotten
            self.words, self.older = {}, self.words
        return found

    @staticmethod
    def spells(side: Side, ids: list[list[int]], words: list[bytes]) -> list[bool]:
        """Whether the ids' bytes are the word, for all words at once if they all are."""
        values, offsets = flat(ids)
        sizes = sums(side.size[values], offsets)
        if np.array_equal(sizes, np.fromiter(map(len, words), np.int64, len(words))) and side.spelt(values.tolist()) == b"".join(words):
            return [True] * len(words)
        return [side.spelt(x) == w for x, w in zip(ids, words)]

    def distinct(self, a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """One window for each distinct (A ids, B ids), and which of them each window is; window w is a[at_a[w]:at_a[w + 1]] and b[at_b[w]:at_b[w + 1]].

        Short ones are compared as two numbers of packed ids, the others as tuples.
        """
        n_a, n_b = np.diff(at_a), np.diff(at_b)
        short = (n_a <= PACKED) & (n_b <= PACKED) & self.packable
        which = np.zeros(len(n_a), np.int64)
        packed = []
        for ids, at, n in ((a, at_a, n_a), (b, at_b, n_b)):
            begin, size = at[:-1][short], n[short]
            number = np.zeros(len(size), np.uint64)
            for k in range(PACKED):
                inside = k < size
                number[inside] |= (ids[begin[inside] + k].astype(np.uint64) + np.uint64(1)) << np.uint64(16 * k)
            packed.append(number)
        by = np.lexsort(packed)
        opens = np.ones(len(by), bool)
        opens[1:] = (packed[0][by][1:] != packed[0][by][:-1]) | (packed[1][by][1:] != packed[1][by][:-1])
        code = np.empty(len(by), np.int64)
        code[by] = np.cumsum(opens) - 1
        which[short] = code
        found = np.flatnonzero(short)[by[opens]]
        memory: dict[tuple, int] = {}
        more = []
        for w in np.flatnonzero(~short):
            key = a[at_a[w] : at_a[w + 1]].tobytes(), b[at_b[w] : at_b[w + 1]].tobytes()
            number = memory.setdefault(key, len(memory))
            if number == len(more):
                more.append(w)
            which[w] = len(found) + number
        return np.concatenate([found, np.array(more, np.int64)]), which

    def aligned(self, a: np.ndarray, at_a: np.ndarray, b: np.ndarray, at_b: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(groups as text, number of groups) of each window, and its links as lists (pair numbers, offsets).

        Between two neighbouring ends, of either side, lies a stretch of one A and one B token: a link each.
        """
        ends_a, ends_b = np.cumsum(self.a.size[a]), np.cumsum(self.b.size[b])
        every = np.union1d(ends_a, ends_b)
        pairs = a[np.searchsorted(ends_a, every)] * len(self.b.spellings) + b[np.searchsorted(ends_b, every)]
        last = ends_a[at_a[1:] - 1]
        link_offsets = np.concatenate([[0], np.searchsorted(every, last, "right")])
        shared, in_a, in_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        group_offsets = np.concatenate([[0], np.searchsorted(shared, last, "right")])
        one, other = (list(map(names.__getitem__, ids.tolist())) for names, ids in zip(self.names, (a, b)))
        ends = zip([0, *(in_a[:-1] + 1).tolist()], (in_a + 1).tolist(), [0, *(in_b[:-1] + 1).tolist()], (in_b + 1).tolist())
        groups = [f"{one[i]}|{other[k]}" if j - i == m - k == 1 else f"{','.join(one[i:j])}|{','.join(other[k:m])}" for i, j, k, m in ends]
        texts = [";".join(groups[i:j]) for i, j in zip(group_offsets[:-1].tolist(), group_offsets[1:].tolist())]
        return texts, np.diff(group_offsets), pairs, link_offsets

    def align(self, words: Words) -> dict[str, np.ndarray | list]:
        """Of each text: n_a, n_b, n_groups, n_links, groups_sha256 and its distinct links as lists (pair, times)."""
        n = len(words.first) - 1
        split = self.tokenized(words.distinct.to_pylist())
        spelt = np.array([s is not None for s in split], bool)
        whole = sums(~spelt[words.codes], words.first) == 0
        kept = words.codes[np.repeat(whole, np.diff(words.first))]
        word_first = offsets_of(np.where(whole, np.diff(words.first), 0))
        ids, first, ends, spaced = [], [], [], []
        for side, k in ((self.a, 0), (self.b, 1)):
            values, begin = gather(*flat([s[k] if s else () for s in split], np.int64), kept)
            ids.append(values)
            first.append(begin[word_first])
            ends.append(np.cumsum(side.size[values]))
            spaced.append(side.spaced[values])
        # an anchor is a byte where tokens of both end and the next tokens of both begin with a space; a text's end is one in any case
        next_a, next_b = (np.append(s[1:], True) for s in spaced)
        shared, in_a, in_b = np.intersect1d(ends[0], ends[1], assume_unique=True, return_indices=True)
        last = np.zeros(len(ends[0]) + 1, bool)
        last[first[0]] = True  # the token before a text's first is some text's last
        anchor = (next_a[in_a] & next_b[in_b]) | last[in_a + 1]
        at_a, at_b = (np.concatenate([[0], x[anchor] + 1]) for x in (in_a, in_b))
        windows, which = self.distinct(ids[0], at_a, ids[1], at_b)
        texts, groups, links, link_first = self.aligned(*gather(ids[0], at_a, windows), *gather(ids[1], at_b, windows))
        window_first = np.searchsorted(at_a, first[0])
        n_groups = sums(groups[which], window_first)
        pairs, code = np.unique(links, return_inverse=True)
        every, begin = gather(code, link_first, which)
        first_link = begin[window_first]
        key, times = np.unique(np.repeat(np.arange(n), np.diff(first_link)) * max(1, len(pairs)) + every, return_counts=True)
        digests = []
        for i in range(n):
            mine = which[window_first[i] : window_first[i + 1]].tolist()
            digests.append(hashlib.sha256(";".join(map(texts.__getitem__, mine)).encode()).hexdigest() if mine else "")
        return {
            "n_a": np.diff(first[0]), "n_b": np.diff(first[1]), "n_groups": n_groups, "n_links": np.diff(first_link), "groups_sha256": digests,
            "pairs": as_lists(pa.array(pairs[key % max(1, len(pairs))], pa.int64()), np.searchsorted(key, np.arange(n + 1) * max(1, len(pairs)))),
            "times": as_lists(pa.array(times, pa.int32()), np.searchsorted(key, np.arange(n + 1) * max(1, len(pairs)))),
        }


COLUMNS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<int>"
COUNTED = "row bigint, key {key}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, n_best bigint, count_sum bigint, pairs array<bigint>, times array<int>"


def document_aligner(path_a: str, path_b: str) -> Callable[[Batches], Batches]:
    """(key, text) to the alignment of each text."""

    def run(batches: Batches) -> Batches:
        aligner = Aligner(byte_level(path_a), sentence_pieces(path_b))
        for batch in batches:
            texts = pc.binary_join_element_wise(pc.if_else(pc.equal(pc.binary_length(batch.column(1)), 0), "", " "), batch.column(1), "")
            for at, n, words in words_of(texts, SLICE_BYTES):
                found = aligner.align(words)
                columns = [batch.column(0).slice(at, n), *(c if isinstance(c, pa.Array) else pa.array(c) for c in found.values())]
                yield pa.RecordBatch.from_arrays(columns, ["key", *found])

    return run


def pair_counter(head) -> Callable[[Batches], Batches]:
    """Each document's sums over the pairs that `head` knows, and its other pairs."""

    def run(batches: Batches) -> Batches:
        known, count, best = head.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times")
            first = lists.offsets.to_numpy().astype(np.int64)
            pairs, n = lists.values.to_numpy()[first[0] : first[-1]], times.values.to_numpy()[times.offsets[0].as_py() : times.offsets[-1].as_py()].astype(np.int64)
            first = first - first[0]
            at = np.minimum(np.searchsorted(known, pairs), max(0, len(known) - 1))
            hit = known[at] == pairs if len(known) else np.zeros(len(pairs), bool)
            count_sum = sums(np.where(hit, count[at], 0) * n if len(known) else np.zeros(len(pairs), np.int64), first)
            n_best = sums((hit & best[at]) * n if len(known) else np.zeros(len(pairs), np.int64), first)
            rest = offsets_of(~hit)[first]
            kept = [batch.column(c) for c in ("row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")]
            more = [as_lists(pa.array(pairs[~hit]), rest), as_lists(pa.array(n[~hit], pa.int32()), rest)]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(n_best), pa.array(count_sum), *more], [c.split()[0] for c in COUNTED.split(", ")])

    return run


def align_tokens(documents: DataFrame, tokenizer_a: str, tokenizer_b: str, key: str = "doc_id", text: str = "text", head: int = HEAD) -> DataFrame:
    """One row per document: tokens of both sides, groups, links, links that are the best of their A id, the sum of the links' counts, and a digest of
    the groups.

    A text that is null, empty, or not spelt by the tokens of both sides has no tokens: zeros, and an empty digest. Keys may be null or repeat: every row is a
    document and counts as one; an empty table gives an empty result. Other columns are not read. What a text has between two single spaces is tokenized in one
    piece and needs the memory that the tokenizers need for it.
    """
    kind = dict(documents.dtypes)[key]
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = documents.select(F.col(key).alias("key"), body.alias("text"))
    aligned = rows.mapInArrow(document_aligner(tokenizer_a, tokenizer_b), f"key {kind}, {COLUMNS}").withColumn("row", F.monotonically_increasing_id())
    aligned = cut(aligned, "aligned")

    side_b = sentence_pieces(tokenizer_b)
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n_docs"))
    # an A id has no more pairs than B has ids
    of_a = Window.partitionBy(F.floor(F.col("pair") / F.lit(len(side_b.spellings))))
    pairs = cut(counts.withColumn("best", F.col("n_docs") == F.max("n_docs").over(of_a)), "pairs")

    least = head_from(pairs, "n_docs", head)
    frequent = in_head("n_docs", least)
    few = pairs.where(frequent).toArrow().sort_by("pair")
    known = documents.sparkSession.sparkContext.broadcast(tuple(few.column(c).to_numpy() for c in ("pair", "n_docs", "best")))

    counted = cut(aligned.select("row", "key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times").mapInArrow(pair_counter(known), COUNTED.format(key=kind)), "counted")
    more = counted.where(F.size("pairs") > 0).select("row", F.explode(F.arrays_zip("pairs", "times")).alias("m")).select("row", F.col("m.pairs").alias("pair"), F.col("m.times").alias("times"))
    tail = more.join(pairs.where(~frequent), "pair").groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"), F.sum(F.col("n_docs") * F.col("times")).alias("_sum"))
    whole = counted.drop("pairs", "times").join(tail, "row", "left")
    return whole.select(
        F.col("key").alias(key), "n_a", "n_b", "n_groups", "n_links",
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )


@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    """All documents in two tokenizations, aligned; see `align_tokens`."""
    import public_tokenizers as files

    return align_tokens(table(spark, sf_dir, "documents"), files.path("byte_bpe_50k.json"), files.path("piece_bpe_32k.model"))
