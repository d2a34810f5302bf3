"""Exact substring deduplication: every byte covered by a 200-byte string that starts more than once is removed.

Strings are brought together by content: the least hash of the 50-byte strings inside a 200-byte window is the same wherever the window
occurs. Neighbouring windows with the same least hash are one run, so a text is cut into runs of about 280 bytes that
start every 80 bytes, and equal windows always meet in a group of runs with the same hash. A hash that one run has alone is
dropped by a count with map-side aggregation; runs whose bytes are all the same are repeated as they are. The rest of a
group, its distinct byte strings with their weights, is indexed with a Burrows-Wheeler transform (`bwt`): breadth-first
backward extension gives common prefixes by increasing length and stops at 200.

A group with more than `MAX_GROUP` distinct strings (a passage in very many documents, with different text around it) is
divided again by the least hash of longer strings, in the end by the window itself, where a group is a single string. So
no task gets a group of unbounded size, and every row is judged.

Texts move twice: once to fetch the strings of undecided groups from one document each, once to apply the spans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.bwt import long_prefixes, suffix_order
from eddyline.llm.registry import query, table
from eddyline.llm.textbytes import Texts, mixed, slices
from eddyline.session import cut

LENGTH = 200
# lengths of the strings whose least hash names a group; the last is the window itself
LEVELS = (50, 150, 190, 200)
MAX_GROUP = 8_192
CHUNK_BYTES = 1 << 20
TASK_BYTES = 2 << 20

RUNS = "a long, b long, weight long, start int, n int, seed long, bytes long, inner boolean"


def sliding(values: np.ndarray, width: int, best: np.ufunc, fill: np.uint64) -> np.ndarray:
    """Minimum or maximum of every `width` neighbours: running values from both ends of blocks of that width."""
    n = len(values)
    blocks = np.full((-(-n // width), width), fill, values.dtype)
    blocks.reshape(-1)[:n] = values
    ahead = best.accumulate(blocks, axis=1).reshape(-1)
    back = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    m = n - width + 1
    return best(back[:m], ahead[width - 1 : width - 1 + m])


def runs_of(part: Texts, k: int, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, start, windows, seed, bytes, inner) of every run. `inner`: the seed string occurs again in the same text, so
    windows of one run may equal each other."""
    none = np.zeros(0, np.int64)
    if len(part.data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(bool)
    at = np.arange(len(part.data) - k + 1)
    h = part.hashes(at, at + k)
    width = length - k + 1
    least = sliding(h, width, np.minimum, ~np.uint64(0))
    owner = np.repeat(np.arange(part.n), np.diff(part.starts))[: len(least)]
    inside = np.arange(len(least)) + length <= part.starts[owner + 1]
    edge = np.ones(len(least) + 1, bool)
    edge[1:-1] = (least[1:] != least[:-1]) | (owner[1:] != owner[:-1]) | (inside[1:] != inside[:-1])
    edges = np.flatnonzero(edge)
    start, end = edges[:-1], edges[1:]
    start, end = start[inside[start]], end[inside[start]]
    # positions of seed strings: those that are the least of some window around them
    around = np.concatenate([np.zeros(width - 1, np.uint64), np.where(inside, least, np.uint64(0)), np.zeros(width - 1, np.uint64)])
    seeds = np.flatnonzero(sliding(around, width, np.maximum, np.uint64(0))[: len(h)] == h)
    seeds = seeds[seeds < len(owner) + width - 1]
    of_text = np.searchsorted(part.starts, seeds, "right") - 1
    names, counts = np.unique(mixed(h[seeds] + of_text.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_counts=True)
    own = mixed(least[start] + owner[start].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    found = np.minimum(np.searchsorted(names, own), max(len(names) - 1, 0))
    inner = counts[found] > 1 if len(names) else np.zeros(len(own), bool)
    return owner[start], start, end - start, least[start], part.hashes(start, end - 1 + length), inner


def find_runs(items: DataFrame, k: int, length: int) -> DataFrame:
    """RUNS of items (a, b, weight, text: string or binary)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(3)):
                text, start, n, seed, content, inner = runs_of(part, k, length)
                ids = [batch.column(c).slice(part.first, part.n).take(pa.array(text)) for c in range(3)]
                local = (start - part.starts[text]).astype(np.int32)
                columns = [*ids, pa.array(local), pa.array(n.astype(np.int32)), pa.array(seed.view(np.int64)), pa.array(content.view(np.int64)), pa.array(inner)]
                for a in range(0, len(text), 50_000):
                    yield pa.RecordBatch.from_arrays([c.slice(a, 50_000) for c in columns], ["a", "b", "weight", "start", "n", "seed", "bytes", "inner"])

    return items.select("a", "b", "weight", "text").mapInArrow(run, RUNS)


def fetched(items: DataFrame, contents: DataFrame, length: int) -> DataFrame:
    """(seed, bytes, weight, text) of `contents` (with a, b, start, n of one place each), cut out of `items`."""
    places = contents.groupBy("a", "b").agg(F.collect_list(F.struct("seed", "bytes", "weight", "start", "n")).alias("places"))
    held = items.select("a", "b", "text").join(places, ["a", "b"]).select("text", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"seed": [], "bytes": [], "weight": [], "text": []}
            size = 0
            for text, some in zip(batch.column(0), batch.column(1)):
                raw = text.as_buffer()
                for p in some.as_py():
                    rows["text"].append(raw[p["start"] : p["start"] + p["n"] - 1 + length].to_pybytes())
                    for c in ("seed", "bytes", "weight"):
                        rows[c].append(p[c])
                    size += p["n"] + length
                if size > CHUNK_BYTES:
                    yield pa.RecordBatch.from_pydict(rows, schema=schema)
                    rows, size = {c: [] for c in rows}, 0
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

    schema = pa.schema([("seed", pa.int64()), ("bytes", pa.int64()), ("weight", pa.int64()), ("text", pa.binary())])
    # an item that stands in the table more than once is cut out more than once
    return held.mapInArrow(run, "seed long, bytes long, weight long, text binary").dropDuplicates(["seed", "bytes"])


def repeated_windows(texts: list[bytes], weights: list[int], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the stretches made of windows that occur more than once in `texts`, by weight."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 1) - 1
    symbols = np.empty(int(sizes.sum()) + len(texts), np.int64)
    between = np.zeros(len(symbols), bool)
    between[ends] = True
    symbols[~between] = np.frombuffer(b"".join(texts), np.uint8).astype(np.int64) + len(texts)
    symbols[ends] = np.arange(len(texts))  # separators are all different, so nothing is common across them
    order = suffix_order(symbols, length)
    joins = long_prefixes(symbols, order, length)
    shared = joins | np.append(joins[1:], False)
    hit = np.zeros(len(symbols), bool)
    hit[order[shared]] = True
    heavy = np.repeat(np.array(weights) > 1, sizes + 1)
    left = np.repeat(ends, sizes + 1) - np.arange(len(symbols))
    hit |= heavy & (left >= length)
    edge = np.flatnonzero(np.diff(np.concatenate([[False], hit, [False]]).astype(np.int8)))
    begin, stop = edge[::2], edge[1::2]
    text = np.searchsorted(ends, begin)
    base = ends[text] - sizes[text]
    return text, begin - base, stop - base - 1 + length


def may_share(texts: list[bytes], seeds: np.ndarray, k: int, length: int) -> np.ndarray:
    """Whether a string may share a window with another, or with itself, of the same seed.

    A shared window holds the seed string at one place in both, and at least half of its other bytes lie on one side of it. So two places of the seed
    agree in the seed and that many bytes before, or behind it; a string whose places all stand alone in both is out. Equal strings have equal hashes,
    so none is lost.
    """
    starts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))])
    part = Texts(np.frombuffer(b"".join(texts), np.uint8), starts, 0)
    side = -(-(length - k) // 2)
    at = np.arange(len(part.data) - k + 1)
    owner = np.repeat(np.arange(part.n), np.diff(starts))[: len(at)]
    own = (part.hashes(at, at + k) == seeds[owner]) & (at + k <= starts[owner + 1])
    at, owner = at[own], owner[own]
    kept = np.zeros(len(texts), bool)
    for begin, end in ((at - side, at + k), (at, at + k + side)):
        inside = (begin >= starts[owner]) & (end <= starts[owner + 1])
        which = owner[inside]
        key = mixed(part.hashes(begin[inside], end[inside]) ^ mixed(seeds[which]))
        _, code, times = np.unique(key, return_inverse=True, return_counts=True)
        kept[which[times[code] > 1]] = True
    return kept


def expanded(contents: DataFrame, k: int, length: int) -> DataFrame:
    """(seed, bytes, from, to) of repeated stretches in groups of `contents`; a group lies within one task and one chunk."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        paired = may_share([r[3] for r in rows], np.array([r[0] for r in rows], np.int64).view(np.uint64), k, length)
        alone = [r for r, p in zip(rows, paired) if not p and r[2] > 1]  # whole strings that occur more than once
        rows = [r for r, p in zip(rows, paired) if p]
        text, begin, stop = repeated_windows([r[3] for r in rows], [r[2] for r in rows], length)
        text = np.concatenate([text, len(rows) + np.arange(len(alone))]).astype(np.int64)
        begin = np.concatenate([begin, np.zeros(len(alone), np.int64)])
        stop = np.concatenate([stop, np.array([len(r[3]) for r in alone], np.int64)])
        rows = rows + alone
        seeds, names = np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)
        return pa.RecordBatch.from_arrays([pa.array(seeds[text]), pa.array(names[text]), pa.array(begin.astype(np.int32)), pa.array(stop.astype(np.int32))], ["seed", "bytes", "from", "to"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size > CHUNK_BYTES and row[0] != held[-1][0]:
                    yield solve(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solve(held)

    # the transform's work goes by bytes, so tasks are made by bytes; left alone, small partitions would be put together
    total = contents.agg(F.sum(F.octet_length("text") + 24)).first()[0] or 0
    dealt = contents.select("seed", "bytes", "weight", "text").repartition(max(1, -(-total // TASK_BYTES)), "seed").sortWithinPartitions("seed")
    return dealt.mapInArrow(run, "seed long, bytes long, `from` int, `to` int")


def repeats(items: DataFrame, length: int = LENGTH, levels: tuple[int, ...] = LEVELS, max_group: int = MAX_GROUP) -> DataFrame:
    """(a, b, from, to): stretches of items (a, b, weight, text) covered by windows that start elsewhere too, weights counted."""
    k, last = levels[0], len(levels) == 1
    runs = cut(find_runs(items, k, length), f"runs-{k}")
    groups = runs.groupBy("seed").agg(F.sum("weight").alias("weight"), F.min("bytes").alias("low"), F.max("bytes").alias("high"), F.max("inner").alias("inner"))
    # at the last level a seed is the window, so all windows of a group are equal
    open_group = F.lit(False) if last else (F.col("low") != F.col("high")) | F.col("inner")
    groups = groups.where((F.col("weight") > 1) | F.col("inner")).select("seed", open_group.alias("open"))
    kept = cut(runs.join(groups, "seed"), f"kept-{k}")
    stretch = [F.col("start").alias("from"), (F.col("start") + F.col("n") - 1 + length).alias("to")]
    found = kept.where(~F.col("open")).select("a", "b", *stretch)
    if last:
        return found
    undecided = kept.where("open").groupBy("seed", "bytes").agg(F.sum("weight").alias("weight"), F.min(F.struct("a", "b", "start", "n")).alias("one"))
    undecided = cut(undecided.select("seed", "bytes", "weight", "one.*"), f"contents-{k}")
    large = undecided.groupBy("seed").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > max_group).select("seed", F.lit(True).alias("large"))
    sized = cut(fetched(items, undecided, length).join(large, "seed", "left"), f"texts-{k}")
    solved = expanded(sized.where(F.col("large").isNull()), k, length)
    hot = sized.where("large")
    if not hot.isEmpty():
        deeper = repeats(hot.select(F.col("seed").alias("a"), F.col("bytes").alias("b"), "weight", "text"), length, levels[1:], max_group)
        solved = solved.unionByName(deeper.select(F.col("a").alias("seed"), F.col("b").alias("bytes"), "from", "to"))
    solved = cut(solved, f"solved-{k}")
    placed = kept.where("open").join(solved, ["seed", "bytes"]).select("a", "b", (F.col("start") + F.col("from")).alias("from"), (F.col("start") + F.col("to")).alias("to"))
    return found.unionByName(placed)


def without_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per row of `documents`: key, n_bytes, n_removed, n_spans, kept (the remaining bytes), judged on the whole table.

    A null text is empty. Keys may be null or repeat: rows that are equal in key and text are two places of the same strings. Other columns are
    not read. Runs are named by 64-bit hashes: groups whose runs all have one name (whole copies), and what reaches the last level, where a
    seed is the window itself, are taken as equal by name. In all other groups the strings themselves decide, in the transform.
    """
    kind = dict(documents.dtypes)[key]
    body = F.coalesce(F.col(text), F.lit(""))
    items = documents.select(F.col(key).alias("key"), F.xxhash64(body).alias("a"), F.xxhash64(F.lit(1), F.col(key), body).alias("b"), F.lit(1).cast("long").alias("weight"), body.alias("text"))
    spans = repeats(items, length).groupBy("a", "b").agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    held = items.select("key", "a", "b", "text").join(spans, ["a", "b"], "left").select("key", "text", "spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, removed, counts, left = [], [], [], []
            for text, spans in zip(batch.column(1), batch.column(2)):
                raw = text.as_buffer().to_pybytes() if len(text.as_buffer()) else b""
                parts, at, cut_out, n = [], 0, 0, 0
                for s in sorted((s["from"], s["to"]) for s in spans.as_py() or ()):
                    if s[0] > at or not n:
                        parts.append(raw[at : s[0]])
                        n += 1
                        at = s[0]
                    cut_out += max(s[1] - at, 0)
                    at = max(at, s[1])
                parts.append(raw[at:])
                sizes.append(len(raw)), removed.append(cut_out), counts.append(n), left.append(b"".join(parts))
            kept = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(counts, pa.int64()), pa.array(left, pa.binary())]
            yield pa.RecordBatch.from_arrays(kept, ["key", "n_bytes", "n_removed", "n_spans", "kept"])

    return held.mapInArrow(run, f"key {kind}, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("key", key)


@query("op7_suffix_dedup")
def op7_suffix_dedup(spark, sf_dir):
    """All documents without their repeated 200-byte strings; see `without_repeats`."""
    found = without_repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
