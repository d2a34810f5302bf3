"""Near-duplicates by SuperMinHash: signatures, banding, verification on full sets, union-find grouping.

A document's set is its distinct 5-word shingles. Documents with the same set are one class, found by a 128-bit hash of
the set; only classes are sketched further, so a group of copies of any size is one node. A SuperMinHash signature draws
for every element a permutation of the slots and gives slot p(j) the value j + random; levels j are worked off for all
elements at once, and a document stops at the first level that no slot can gain from.

Bands of the signature are bucket keys. Links are found in two rounds:

1. Each bucket has a leader, the member that shares most with other classes; members are verified against it. A family of near
   copies thus hangs together by linear many pairs.
2. Members of a bucket that are still in different components may be linked past its leader. Exact prefix and overlap bounds (see
   `across`) leave few such pairs, also in large families of loosely similar texts, and these are verified too, so that no
   link between components is lost to the choice of leaders.

Verification intersects full shingle sets, fetched for classes in shared buckets only. Hot buckets and hot classes sit on
the large side of plain equi-joins, which AQE splits; all counting is map-side aggregation; components never leave Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import LOWER, UPPER, fits, join_null_safe, text_hash
from eddyline.llm.components import components
from eddyline.llm.registry import query, table
from eddyline.llm.textbytes import WORD_BASE, Texts, mixed, slices, windows
from eddyline.session import cut

SHINGLE = 5
SLOTS = 128
BANDS = 32
PERCENT = 75
LEVEL_BITS = np.uint64(48)
CHUNK = 1 << 17
# classes in shared buckets are looked up by a broadcast up to this measured size, by a shuffle beyond
MAX_BROADCAST_BYTES = 8 << 20

# of 128 slots two sets of similarity 0.75 share 96 on average, with a deviation under 4.9: 6.5 deviations below that
MIN_SHARED_SLOTS = 64

# in the second round, elements of at most so many open sets are join keys
RARE = 64

NODE_SALTS = (np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB))


def shingle_sets(part: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(text, shingle hash), distinct and sorted. A text of fewer words than a shingle has its whole word sequence as one."""
    text, begin, end = part.word_bounds()
    words = part.hashes(begin, end, fold=True)
    first, h = windows(text, words, SHINGLE)
    owner = text[first]
    counts = np.bincount(text, minlength=part.n)
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        at = np.searchsorted(text, short)
        whole = np.zeros(len(short), np.uint64)
        for k in range(SHINGLE - 1):
            has = counts[short] > k
            whole[has] = whole[has] * WORD_BASE + words[at[has] + k]
        owner, h = np.concatenate([owner, short]), np.concatenate([h, mixed(whole ^ counts[short].astype(np.uint64))])
    order = np.lexsort((h, owner))
    owner, h = owner[order], h[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    return owner[keep], h[keep]


def super_min_hash(owner: np.ndarray, h: np.ndarray, n: int, slots: int = SLOTS) -> np.ndarray:
    """Signatures (n, slots) of the sets given by (owner, element) sorted by owner; all ones where a set is empty.

    A value holds the level above LEVEL_BITS and the random part below. Permutations are kept only for sets that need more
    than one level, in chunks of about CHUNK elements.
    """
    out = np.full((n, slots), ~np.uint64(0), np.uint64)
    starts = np.searchsorted(owner, np.arange(n + 1))
    a = 0
    while a < n:
        b = max(a + 1, int(np.searchsorted(starts, starts[a] + CHUNK, "right")) - 1)
        rows, keys = owner[starts[a] : starts[b]] - a, h[starts[a] : starts[b]]
        values = out[a:b].reshape(-1)
        swaps = None
        for level in range(slots):
            if not len(keys):
                break
            draw = mixed(keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
            other = level + (((draw & np.uint64(0xFFFF)) * np.uint64(slots - level)) >> np.uint64(16)).astype(np.int64)
            if swaps is None:
                slot = other
            else:
                at = np.arange(len(keys))
                slot = swaps[at, other].astype(np.int64)
                swaps[at, other] = swaps[at, level]
            np.minimum.at(values, rows * slots + slot, (np.uint64(level) << LEVEL_BITS) | (draw >> np.uint64(16)))
            unfinished = values.reshape(-1, slots).max(1) >= (np.uint64(level + 1) << LEVEL_BITS)
            stay = unfinished[rows]
            rows, keys = rows[stay], keys[stay]
            if swaps is None:
                swaps = np.tile(np.arange(slots, dtype=np.uint8), (len(keys), 1))
                swaps[np.arange(len(keys)), slot[stay]] = 0
            else:
                swaps = swaps[stay]
        a = b
    return out


def node_ids(owner: np.ndarray, h: np.ndarray, n: int) -> np.ndarray:
    """128 bits that stand for each set, as 16 bytes."""
    out = np.zeros((n, 2), np.uint64)
    has, first = np.unique(owner, return_index=True)
    for k, salt in enumerate(NODE_SALTS):
        if len(has):
            out[has, k] = np.add.reduceat(mixed(h * salt + salt), first)
    return out.view(np.uint8).reshape(n, 16)


def _binary(rows: np.ndarray, valid: np.ndarray) -> pa.Array:
    """Rows of bytes as Arrow binaries, null where not valid."""
    n, width = rows.shape
    offsets = pa.array(np.arange(n + 1, dtype=np.int32) * width)
    flat = pa.BinaryArray.from_buffers(pa.binary(), n, [None, offsets.buffers()[1], pa.py_buffer(np.ascontiguousarray(rows).tobytes())])
    return flat if valid.all() else pc.if_else(pa.array(valid), flat, pa.scalar(None, flat.type))


def sketch(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text_hash, n_shingles, node, bands, slots) for every row; node, bands and slots are null for an empty set."""
    kind = dict(documents.dtypes)[key]
    per_band = SLOTS // BANDS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(2)):
                owner, h = shingle_sets(part)
                counts = np.bincount(owner, minlength=part.n)
                values = super_min_hash(owner, h, part.n)
                bands = np.zeros((part.n, BANDS), np.uint64)
                for k in range(per_band):
                    bands = bands * WORD_BASE + mixed(values[:, k::per_band])
                bands = mixed(bands * np.uint64(BANDS) + np.arange(BANDS, dtype=np.uint64)).view(np.int64)
                some = counts > 0
                lists = pa.ListArray.from_arrays(pa.array(np.arange(part.n + 1, dtype=np.int32) * BANDS), pa.array(bands.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.n),
                        batch.column(1).slice(part.first, part.n),
                        pa.array(counts),
                        _binary(node_ids(owner, h, part.n), some),
                        lists,
                        _binary((mixed(values) >> np.uint64(56)).astype(np.uint8), some),
                    ],
                    ["key", "text_hash", "n_shingles", "node", "bands", "slots"],
                )

    keyed = documents.select(F.col(key).alias("key"), text_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    return keyed.mapInArrow(run, f"key {kind}, text_hash long, n_shingles long, node binary, bands array<long>, slots binary")


def full_sets(documents: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, elements) of the classes `wanted` (node, key, text_hash of one document each), from those documents' texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(0)):
                owner, h = shingle_sets(part)
                ends = np.searchsorted(owner, np.arange(part.n + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(h.view(np.int64)))
                yield pa.RecordBatch.from_arrays([_binary(node_ids(owner, h, part.n), np.ones(part.n, bool)), lists], ["node", "elements"])

    texts = documents.select(F.col(key).alias("key"), text_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text"))
    places = cut(wanted.select("key", "text_hash").distinct(), "places")
    if fits(places, F.lit(64), MAX_BROADCAST_BYTES):
        places = F.broadcast(places)  # else the texts are shuffled
    held = join_null_safe(texts, places, ["key", "text_hash"]).select("text")
    # equal rows of a document give equal sets
    return held.mapInArrow(run, "node binary, elements array<long>").dropDuplicates(["node"])


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose sets have 100 * intersection >= percent * union."""
    left = sets.select(F.col("node").alias("u"), F.col("elements").alias("a"))
    right = sets.select(F.col("node").alias("v"), F.col("elements").alias("b"))
    both = F.size(F.array_intersect("a", "b"))
    enough = 100 * both >= percent * (F.size("a") + F.size("b") - both)
    return pairs.join(left, "u").join(right, "v").where(enough).select("u", "v")


def across(open_members: DataFrame, sizes: DataFrame, sets: DataFrame, percent: int, rare: int = RARE) -> DataFrame:
    """Pairs (u, v) of different components that can reach `percent`, for members (bucket, node, root) of buckets with several components.

    Elements are ordered by the number of open sets that have them. Two similar sets share an element in the prefix that a set of
    size n has beyond n * percent / 100, or else they share nothing but elements of more than `rare` sets. The first kind is found
    by a join on prefix elements, of at most `rare` sets each; for the second, both sets must have enough common elements to
    reach the overlap alone, and members of a bucket outside its largest component meet the bucket's other components.
    """
    nodes = cut(open_members.select("node", "root").distinct().join(sizes, "node"), "open-nodes")
    elements = nodes.join(sets, "node").select("node", F.explode("elements").alias("element"))
    shares = elements.groupBy("element").agg(F.count(F.lit(1)).cast("int").alias("df")).where("df > 1")
    held = elements.join(shares, "element").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("held"))
    held = cut(held.join(nodes, "node"), "held")
    # elements that no other open set has come first in every prefix; they are counted, not stored
    own = F.col("n") - F.size("held")
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100).cast("long") + 1
    some = F.slice("held", F.lit(1), F.greatest(prefix - own, F.lit(0)).cast("int"))
    prefixes = held.select("node", "root", "n", F.explode(F.filter(some, lambda e: e["df"] <= rare)).alias("e")).select(F.col("e.element").alias("element"), "node", "root", "n")

    def named(df: DataFrame, x: str) -> DataFrame:
        return df.withColumnsRenamed({"node": x, "root": f"r{x}", "n": f"n{x}", "common": f"c{x}"})

    long_enough = F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent
    by_prefix = named(prefixes, "u").join(named(prefixes, "v"), "element").where((F.col("ru") > F.col("rv")) & long_enough).select("u", "v")

    common = F.size(F.filter("held", lambda e: e["df"] > rare))
    capable = held.select("node", "n", common.alias("common")).where(F.col("common") * 100 >= F.col("n") * percent)
    members = open_members.join(capable, "node")
    largest = members.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("members")).groupBy("bucket").agg(F.max(F.struct("members", "root"))["root"].alias("largest"))
    outside = members.join(largest, "bucket").where("root <> largest").drop("largest")
    reach = F.least("cu", "cv") * (100 + percent) >= percent * (F.col("nu") + F.col("nv"))
    by_bucket = named(outside, "u").join(named(members, "v"), "bucket").where((F.col("ru") != F.col("rv")) & reach).select("u", "v")
    pairs = by_prefix.unionByName(by_bucket)
    return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per row of `documents`: key, text_hash, n_shingles, component_id (the smallest key of its component) and
    first_hash (the text_hash of the first row that has it, so key and hash name the component's first row).

    Null, empty and blank texts have an empty set and are linked with nothing. Null keys are passed over when the smallest
    is sought; a component of null keys only has a null id. Rows that repeat share a component. Other columns are not read.
    """
    sketches = cut(sketch(documents, key, text), "sketches")
    held = sketches.where(F.col("node").isNotNull())
    classes = cut(
        held.groupBy("node").agg(
            F.min(F.struct(F.col("key").isNull().alias("none"), F.col("key"), F.col("text_hash"))).alias("one"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
            F.first("slots").alias("slots"),
        ),
        "classes",
    )
    members = classes.select(F.explode("bands").alias("bucket"), "node")
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = cut(members.join(sizes, "bucket"), "shared")
    scores = shared.groupBy("node").agg(F.sum("size").alias("score"))
    leaders = shared.join(scores, "node").groupBy("bucket").agg(F.max(F.struct("score", "node")).alias("leader"))
    wanted = cut(scores.join(classes, "node").select("node", "n", "slots", F.col("one.key").alias("key"), F.col("one.text_hash").alias("text_hash")), "wanted")
    sets = cut(full_sets(documents, wanted, key, text), "sets")
    known = wanted.select("node", "n", "slots")

    first = shared.join(leaders.select("bucket", F.col("leader.node").alias("leader")), "bucket").where("node <> leader")
    first = first.select(F.greatest("node", "leader").alias("u"), F.least("node", "leader").alias("v")).distinct()
    first = cut(possible(first, known, percent), "first-pairs")
    edges = cut(verified(first, sets, percent), "first-links")
    groups = cut(components(edges), "groups")

    placed = shared.select("bucket", "node").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed_buckets = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    open_members = cut(placed.join(mixed_buckets, "bucket"), "open")
    second = across(open_members, known.select("node", "n"), sets, percent)
    second = possible(second, known, percent).join(first, ["u", "v"], "left_anti")
    more = cut(verified(second, sets, percent), "second-links")
    if not more.isEmpty():
        groups = cut(components(edges.unionByName(more)), "groups")

    of_class = classes.select("node", "one").join(groups, "node", "left").withColumn("root", F.coalesce("root", "node"))
    firsts = of_class.groupBy("root").agg(F.min("one").alias("first"))
    named = of_class.select("node", "root").join(firsts, "root").select("node", "first")
    found = held.select("key", "text_hash", "n_shingles", "node").join(named, "node")
    found = found.select("key", "text_hash", "n_shingles", F.col("first.key").alias("component_id"), F.col("first.text_hash").alias("first_hash"))
    alone = sketches.where(F.col("node").isNull()).select("key", "text_hash", "n_shingles", F.col("key").alias("component_id"), F.col("text_hash").alias("first_hash"))
    return found.unionByName(alone)


def possible(pairs: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """The pairs that set sizes and signatures leave possible."""
    left, right = (known.select(F.col("node").alias(x), F.col("n").alias(f"n{x}"), F.col("slots").alias(f"s{x}")) for x in "uv")
    sized = pairs.join(left, "u").join(right, "v").where(F.least("nu", "nv") * 100 >= F.greatest("nu", "nv") * percent)
    same = F.aggregate(F.sequence(F.lit(1), F.lit(SLOTS)), F.lit(0), lambda n, k: n + (F.substring("su", k, F.lit(1)) == F.substring("sv", k, F.lit(1))).cast("int"))
    return sized.where(same >= MIN_SHARED_SLOTS).select("u", "v")


SQL = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
  e AS (SELECT DISTINCT doc_id, unnest(list_transform(range(greatest(len(ws) - {SHINGLE - 1}, 1)), lambda i: array_to_string(ws[i + 1:i + {SHINGLE}], ' '))) AS x
    FROM d WHERE len(ws) > 0),
  n AS (SELECT doc_id, count(*) AS n FROM e GROUP BY doc_id),
  l AS (SELECT a.doc_id AS u, b.doc_id AS v FROM e a JOIN e b ON a.x = b.x AND a.doc_id <> b.doc_id
    JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY u, v, na.n, nb.n HAVING 100 * count(*) >= {PERCENT} * (na.n + nb.n - count(*))),
  r AS (SELECT u, v FROM l UNION SELECT r.u, l.v FROM r JOIN l ON r.v = l.u),
  c AS (SELECT u, min(v) AS v FROM r GROUP BY u)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, least(d.doc_id, coalesce(v, d.doc_id)) AS component_id, coalesce(v, d.doc_id) >= d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.u = d.doc_id"""


@query("op8_minhash_near_dup", SQL)
def op8_minhash_near_dup(spark, sf_dir):
    """Components of all documents at similarity 0.75; see `near_duplicates`."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(F.col("key").alias("doc_id"), "n_shingles", "component_id", F.col("key").eqNullSafe(F.col("component_id")).alias("kept"))
