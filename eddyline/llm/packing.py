"""Best-fit packing by hierarchical residuals.

Documents are tokenized where they lie and the piece records written. The first round deals them by a hash of their number, so every
task has a fair share of all lengths however the table is ordered, and packs them best-fit, longest first. Bins that are nearly
full are final. An underfull bin becomes an item itself (its pieces stay together, its size is its fill) and goes up a tree: each
further round deals the underfull bins to a few times fewer tasks, where whole bins are combined best-fit again. Full-length pieces are
bins of their own and never move; an item is a number and a list of small piece records, so texts and ids never move either.

A task of the first round gets about `FIRST_ITEMS` pieces, of a further one about `MERGE_ITEMS` items, so its memory has a bound at every
size. Rounds end when one task held all items, or when a round closed too few bins to pay for another.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import release
from eddyline.llm.registry import query, table
from eddyline.session import cut

CAPACITY = 4096
END_ID = 1
NEARLY_FULL = 0.998
FIRST_ITEMS = 10_000
MERGE_ITEMS = 200_000
FAN_IN = 8
MIN_GAIN = 0.002

CACHED = 150_000
LONGEST_CACHED = 64
BATCH_CHARS = 1 << 20

# fixed values: how the tokenizer splits a lower-cased text, for ASCII and Latin-1 letters
PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[!-/:-@\[-`{-~]+")
PLAIN = re.compile(r"[\t-\r\x20-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")


def byte_letters() -> list[str]:
    """Byte-level BPE writes bytes as printable characters: printable Latin-1 as itself, the others from U+0100 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


BYTE_LETTERS = byte_letters()

PIECE = "struct<key:{key},piece:int,start:bigint,length:bigint,crc:bigint>"


class Cached(dict):
    """A cache of bounded size: beyond it, it starts anew. Long keys are not kept."""

    def __init__(self, make: Callable[[str], bytes], size: int):
        super().__init__()
        self.make, self.size = make, size

    def __missing__(self, key: str) -> bytes:
        got = self.make(key)
        if len(key) <= LONGEST_CACHED:
            if len(self) >= self.size:
                self.clear()
            self[key] = got
        return got


class PieceEncoder:
    """Token ids of whole texts, from the ids of their pieces.

    Texts of plain signs and Latin letters have one normal form and are split by `PIECES` as the tokenizer splits them; its model gives the ids
    of each piece. Other texts are split at spaces and line breaks, over which the tokenizer never joins (white space ends a
    piece and is dropped, normal forms do not reach over it), and words that aren't plain go through the whole tokenizer.
    """

    def __init__(self, path: str, size: int = CACHED):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pieces = Cached(self.piece, size)
        self.words = Cached(self.word, size)

    def piece(self, piece: str) -> bytes:
        text = piece if piece.isascii() else "".join(map(BYTE_LETTERS.__getitem__, piece.encode()))
        return array("I", [t.id for t in self.model.tokenize(text)]).tobytes()

    def word(self, word: str) -> bytes:
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, text: str) -> bytes:
        """Native-order (little-endian) 32-bit ids."""
        if PLAIN.fullmatch(text) and "<|" not in text:
            return b"".join(map(self.pieces.__getitem__, PIECES.findall(text.lower())))
        if " " in text or "\n" in text:
            return b"".join(self.encode(w) for w in text.replace("\n", " ").split(" ") if w)
        return self.words[text]


    def forget(self) -> None:
        self.pieces.clear()
        self.words.clear()
        release()


_ENCODERS: dict[str, PieceEncoder] = {}


def encoder(path: str) -> PieceEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item: longest first, each into the fullest bin with room, else into a new one."""
    bins = np.zeros(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms: list[int] = []  # sorted room values that have bins
    n = 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        k = bisect_left(rooms, size)
        if k < len(rooms):
            room = rooms[k]
            b = by_room[room].pop()
            if not by_room[room]:
                del rooms[k]
        else:
            room, b, n = capacity, n, n + 1
        bins[i] = b
        if left := room - size:
            if not by_room[left]:
                insort(rooms, left)
            by_room[left].append(b)
    return bins


def pack_items(items: pa.Array, sizes: np.ndarray, capacity: int, stage: int) -> pa.RecordBatch:
    """Items (lists of pieces) combined into bins: rows (bin, fill, pieces). Bin numbers hold round, task and number."""
    bins = best_fit(sizes, capacity)
    order = np.argsort(bins, kind="stable")
    members = items.take(pa.array(order))
    lengths = np.diff(members.offsets.to_numpy())
    found, first = np.unique(bins[order], return_index=True)
    piece_at = np.concatenate([[0], np.cumsum(lengths)])
    offsets = np.concatenate([piece_at[first], [piece_at[-1]]]).astype(np.int32) if len(found) else np.zeros(1, np.int32)
    fill = np.add.reduceat(sizes[order], first) if len(found) else np.zeros(0, np.int64)
    task = TaskContext.get().partitionId()
    number = (np.int64(stage) << 56) | (np.int64(task) << 32) | found
    values = members.values.slice(members.offsets[0].as_py(), int(lengths.sum())) if len(order) else members.values.slice(0, 0)
    return pa.RecordBatch.from_arrays([pa.array(number), pa.array(fill), pa.ListArray.from_arrays(pa.array(offsets), values)], ["bin", "fill", "pieces"])


def in_parts(batch: pa.RecordBatch, rows: int = 5_000) -> Iterator[pa.RecordBatch]:
    for a in range(0, batch.num_rows, rows):
        yield batch.slice(a, rows)


def piece_lister(encode_with: str, capacity: int, end_id: int | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tokenize (key, text) batches and cut longer documents: rows as of `pack_items`, each piece a bin of its own."""
    end = b"" if end_id is None else np.uint32(end_id).tobytes()

    def pieces_of(texts: list[str]) -> tuple[list, ...]:
        row, piece, start, length, crc = [], [], [], [], []
        for i, raw in enumerate(map(encoder(encode_with).encode, texts)):
            raw += end
            for p, a in enumerate(range(0, len(raw), 4 * capacity)):
                part = raw[a : a + 4 * capacity]
                row.append(i), piece.append(p), start.append(a // 4), length.append(len(part) // 4), crc.append(zlib.crc32(part))
        return row, piece, start, length, crc

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from listed(batches)
        finally:
            # the worker lives on and may serve other stages: it keeps the tokenizer, but not the caches
            encoder(encode_with).forget()

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = np.int64(TaskContext.get().partitionId()) << 32
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
            cuts = [0, *(np.flatnonzero(np.diff(sizes // BATCH_CHARS)) + 1).tolist(), len(texts)]
            for a, b in zip(cuts, cuts[1:]):
                row, *columns = pieces_of([t or "" for t in texts.slice(a, b - a).to_pylist()])
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
                arrays = [keys.slice(a, b - a).take(pa.array(row, pa.int64())), *(pa.array(c, t) for c, t in zip(columns, types))]
                found = pa.StructArray.from_arrays(arrays, ["key", "piece", "start", "length", "crc"])
                lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32)), found)
                yield from in_parts(pa.RecordBatch.from_arrays([pa.array(number + np.arange(len(found))), found.field("length"), lists], ["bin", "fill", "pieces"]))
                number += len(found)

    return run


def bin_merger(capacity: int, stage: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            got = pa.Table.from_batches(held).combine_chunks()
            yield from in_parts(pack_items(got.column("pieces").chunk(0), got.column("fill").to_numpy(), capacity, stage))

    return run


def pack(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = CAPACITY,
    end_id: int | None = END_ID,
    key: str = "doc_id",
    text: str = "text",
    nearly_full: float = NEARLY_FULL,
    merge_items: int = MERGE_ITEMS,
    fan_in: int = FAN_IN,
    first_items: int = FIRST_ITEMS,
) -> DataFrame:
    """Rows (key, piece, start, length, ids_crc32, sequence_id, offset), one per piece of at most `capacity` ids.

    A document's ids are those of its whole text (null: empty) and `end_id`; only longer ones are cut. Without `end_id` a text
    without ids has no piece. Keys may be null or repeat: every row is packed for itself. Other columns are not read.
    """
    record = PIECE.format(key=dict(documents.dtypes)[key])
    schema = f"bin bigint, fill bigint, pieces array<{record}>"
    texts = documents.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def is_open(stage: int) -> Column:
        return F.col("fill") < (int(capacity * nearly_full) if stage else capacity)

    def settled(packed: DataFrame, stage: int) -> tuple[DataFrame, int, int]:
        """The written bins of a round, how many there are, and how many of them are open."""
        bins = cut(packed, f"bins-{stage}")
        return bins, *bins.agg(F.count(F.lit(1)), F.count_if(is_open(stage))).first()

    stage = 0
    bins, _, left = settled(texts.mapInArrow(piece_lister(tokenizer, capacity, end_id), schema), stage)
    done = []
    tasks = -(-left // min(first_items, merge_items))
    while left > 1:
        done.append(bins.where(~is_open(stage)))
        dealt = bins.where(is_open(stage)).repartition(tasks, F.xxhash64(F.lit(stage), "bin"))
        stage += 1
        before = left
        bins, after, left = settled(dealt.mapInArrow(bin_merger(capacity, stage), schema), stage)
        if tasks == 1 or (stage > 1 and before - after < MIN_GAIN * before and tasks <= -(-before // merge_items)):
            break
        tasks = max(-(-tasks // fan_in), -(-left // merge_items))
    done.append(bins)
    every = done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    lengths = F.transform("pieces", lambda p: p["length"])
    offsets = F.aggregate(lengths, F.array(F.lit(0).cast("long")), lambda acc, n: F.array_append(acc, F.element_at(acc, -1) + n))
    placed = every.select("bin", F.explode(F.arrays_zip(F.col("pieces").alias("p"), F.slice(offsets, F.lit(1), F.size("pieces")).alias("offset"))).alias("at"))
    return placed.select("at.p.key", "at.p.piece", "at.p.start", "at.p.length", F.col("at.p.crc").alias("ids_crc32"), F.col("bin").alias("sequence_id"), "at.offset").withColumnRenamed("key", key)


@query("op5_best_fit_packing")
def op5_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens; see `pack`."""
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
