"""The trie of all conversation prefixes, from sorted matrices of turn ids.

A turn's id is a digest of role and text with the text's size. Equal conversations are counted together, then all distinct ones are sorted by their ids
over the cluster, so the members of every node are neighbours. Each task lays its conversations out as a padded matrix, sorts it, and finds where
a column or one before it changes: there a node starts. One reduction per depth gives members, children, leaves and saved tokens of all nodes
that lie inside the task's range. Only the nodes that hold a range's first or last conversation may go on in a neighbouring range: two paths
per task. These recombine in rounds, `FAN_IN` neighbouring ranges at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eddyline.llm.common import fits
from eddyline.llm.ragged import offsets_of
from eddyline.llm.registry import query, table
from eddyline.session import cut

FAMILY = 5
HEADS = 9
ID = 3  # numbers per turn: two of its digest, one for the size of its text
RANGE_BYTES = 16 << 20
COLUMNS = 8  # turns laid out at a time
FAN_IN = 64
CHUNK_IDS = 4096
ROWS_OUT = 10_000
MAX_BROADCAST_BYTES = 8 << 20
NO_ENDS = hashlib.sha256(b"").hexdigest()

Batches = Iterator[pa.RecordBatch]

NODE = "node binary, parent binary, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, saved bigint, size bigint, ends bigint, lead bigint"
NODES = f"range int, place bigint, left boolean, right boolean, {NODE}"
TYPES = {"range": pa.int32(), "left": pa.bool_(), "right": pa.bool_(), "node": pa.binary(), "parent": pa.binary()}
NAMES = [part.split()[0] for part in NODES.split(", ")]


def turn_id(role: Column, text: Column) -> Column:
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    half = [F.conv(F.substring(digest, a, 15), 16, 10).cast("long") for a in (1, 16)]
    return F.array(*half, F.octet_length(text).cast("long"))


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, ids): the turn ids of each conversation in the order of `turn`, nulls first; turns that share a place by their id."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = turns.where(F.col("conv_id").isNotNull()).select(F.col("conv_id").cast("long").alias("conv_id"), F.struct(F.col("turn").alias("turn"), turn_id(role, text).alias("id")).alias("at"))
    listed = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("at")).alias("turns"))
    return listed.select("conv_id", F.flatten(F.transform("turns", lambda t: t["id"])).alias("ids"))


def rebuilt(convs: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """Every conversation with the first turns of its family's first one in place of its own: (conv_id, ids).

    h = crc32(conv_id) % heads turns are taken from conversation conv_id - conv_id % family, fewer if it has fewer and none if it doesn't exist; its
    own turns follow from the h-th on.
    """
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % family
    first = convs.where(F.col("conv_id") % family == 0).select(F.col("conv_id").alias("base"), F.slice("ids", 1, ID * (heads - 1)).alias("first"))
    told = convs.withColumn("base", base).join(first, "base", "left")
    ids = F.concat(F.coalesce(F.slice("first", F.lit(1), ID * h), F.array().cast("array<bigint>")), F.slice("ids", ID * h + 1, F.size("ids")))
    return told.select("conv_id", ids.alias("ids"))


class Range:
    """Distinct conversations of one task as rows of turn ids, and the nodes of their trie."""

    def __init__(self, ids: np.ndarray, offsets: np.ndarray, conv: np.ndarray, weight: np.ndarray):
        self.turns, self.begin, self.length = ids.reshape(-1, ID), offsets[:-1] // ID, np.diff(offsets) // ID
        self.order, self.shared = self.sorted()
        self.begin, self.length, self.conv, self.weight = (x[self.order] for x in (self.begin, self.length, conv, weight))

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """The rows in the order of their ids, and how many turns each shares with the row before it.

        The padded matrix is laid out `COLUMNS` turns at a time for the rows that are that long and still have an equal neighbour; `part` numbers the
        stretches of rows that are equal so far.
        """
        n = len(self.length)
        order, part, shared = np.arange(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
        place = np.arange(n)  # where in `order` the rows of this round stand
        depth = 0
        while len(place):
            rows = order[place]
            matrix = np.full((len(rows), COLUMNS, ID), -1, np.int64)
            inside = depth + np.arange(COLUMNS) < self.length[rows][:, None]
            matrix[inside] = self.turns[(self.begin[rows][:, None] + depth + np.arange(COLUMNS))[inside]]
            flat = matrix.reshape(len(rows), -1)
            by = np.lexsort((*flat.T[::-1], part))
            order[place], flat, inside = rows[by], flat[by], inside[by]
            matrix = flat.reshape(len(rows), COLUMNS, ID)
            changed = np.ones((len(rows), COLUMNS), bool)
            changed[1:] = (matrix[1:] != matrix[:-1]).any(axis=2) | ~inside[1:] | ~inside[:-1]
            opens = np.ones(len(rows), bool)
            opens[1:] = part[1:] != part[:-1]
            changed |= opens[:, None]
            np.logical_or.accumulate(changed, axis=1, out=changed)
            same = (~changed).sum(axis=1)
            shared[place] = np.where(opens, shared[place], depth + same)
            equal = same == COLUMNS
            again = equal | np.append(equal[1:], False)
            part = np.cumsum(~equal)[again]
            place = place[again]
            depth += COLUMNS
        return order, shared

    def nodes(self) -> dict[str, np.ndarray]:
        """All nodes in preorder. `end` is the first row behind a node's rows, `up` its parent's number (the root: -1)."""
        n, lcp, length = len(self.length), self.shared, self.length
        lcp = np.concatenate([[-1], lcp[1:]]) if n else lcp
        at = offsets_of(length - lcp)  # row i opens the nodes of depths lcp[i] + 1 to length[i]; the first row also the root
        total = int(at[-1])
        row = np.repeat(np.arange(n), np.diff(at))
        depth = np.arange(total) - at[row] + lcp[row] + 1
        end, up, members, least = (np.zeros(total, np.int64) for _ in range(4))
        alive, above = np.arange(n), np.full(n, -1, np.int64)  # rows of this length, and the node of the depth before that holds them
        d = 0
        while len(alive):
            starts = np.flatnonzero(lcp[alive] < d)
            first = alive[starts]
            number = at[first] + d - lcp[first] - 1
            count = np.diff(np.append(starts, len(alive)))
            end[number], up[number] = first + count, above[starts]
            members[number] = np.add.reduceat(self.weight[alive], starts)
            least[number] = np.minimum.reduceat(self.conv[alive], starts)
            longer = length[alive] > d
            above, alive = np.repeat(number, count)[longer], alive[longer]
            d += 1
        size = np.zeros(total, np.int64)
        deep = depth > 0
        size[deep] = self.turns[self.begin[row[deep]] + depth[deep] - 1, ID - 1]
        ends, lead = np.zeros(total, np.int64), np.zeros(total, np.int64)
        ends[at[1:] - 1], lead[at[1:] - 1] = self.weight, self.conv  # rows differ, so a row's last node begins with it
        children = np.bincount(up[up >= 0], minlength=total)
        return {"row": row, "depth": depth, "end": end, "up": up, "n_convs": members, "conv_id": least, "size": size, "ends": ends, "lead": lead, "n_children": children, "last": at[end]}

    def path(self, row: int) -> list[bytes]:
        """A digest per prefix of a row, the empty one first."""
        state = hashlib.sha256(b"")
        found = [state.digest()]
        for k in range(self.length[row]):
            state.update(self.turns[self.begin[row] + k].tobytes())
            found.append(state.digest())
        return found


def table_of(columns: dict[str, np.ndarray | list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[c], TYPES.get(c, pa.int64())) for c in NAMES], NAMES)


def range_builder() -> Callable[[Batches], Batches]:
    """(ids, conv_id, n) of one range to its nodes; `left` and `right` mark those that hold the range's first or last row.

    Counts of marked nodes leave out marked children and their subtrees: these may be the same nodes as a neighbour's.
    """

    def run(batches: Batches) -> Batches:
        held = [b for b in batches if b.num_rows]
        if not held:
            return
        got = pa.Table.from_batches(held).combine_chunks()
        lists = got.column("ids").chunk(0)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        values = lists.values.to_numpy()[offsets[0] : offsets[-1]]
        here = Range(values, offsets - offsets[0], got.column("conv_id").to_numpy(), got.column("n").to_numpy())
        x = here.nodes()
        left, right = x["row"] == 0, x["end"] == len(here.length)
        edge = left | right
        total = np.arange(len(edge))
        leaf = ~edge & (x["n_children"] == 0)
        saved = np.where(edge, 0, (x["n_convs"] - 1) * x["size"])
        inner = np.flatnonzero(edge & (x["up"] >= 0))  # marked nodes whose values go to a marked parent later
        # a subtree is a stretch of the preorder
        for name, value in (("n_leaves", leaf), ("saved", saved)):
            before = offsets_of(value)
            below = before[x["last"]] - before[total]
            x[name] = below.copy()
            np.subtract.at(x[name], x["up"][inner], below[inner])
        np.subtract.at(x["n_children"], x["up"][inner], 1)
        names: dict[int, bytes] = {}
        for side, r in ((left, 0), (right, len(here.length) - 1)):
            path = here.path(r)
            names.update((int(k), path[x["depth"][k]]) for k in np.flatnonzero(side))
        number = TaskContext.get().partitionId()
        for a in range(0, len(edge), ROWS_OUT):
            k = slice(a, a + ROWS_OUT)
            up = x["up"][k]
            out = {c: x[c][k] for c in ("depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved", "size", "ends")}
            out["lead"] = pa.array(x["lead"][k], mask=x["ends"][k] == 0)
            out |= {"range": np.full(len(up), number), "place": total[k], "left": left[k], "right": right[k]}
            out["node"] = [names.get(i) for i in range(a, a + len(up))]
            out["parent"] = [names.get(i) for i in up.tolist()]
            own = (up >= 0) & ~edge[up]
            out["parent_conv_id"] = pa.array(x["conv_id"][up], mask=~own)
            yield table_of(out)

    return run


class Paths:
    """The marked nodes of neighbouring ranges, put together by their digests."""

    def __init__(self):
        self.nodes: dict[bytes, dict] = {}
        self.first = self.final = None

    def add(self, row: dict) -> None:
        if self.first is None:
            self.first = row["range"]
        if self.final != row["range"]:
            self.final = row["range"]
            for node in self.nodes.values():
                node["right"] = False
        node = self.nodes.get(row["node"])
        if node is None:
            self.nodes[row["node"]] = row | {"left": row["left"] and row["range"] == self.first}
            return
        for c in ("n_convs", "n_children", "n_leaves", "saved", "ends"):
            node[c] += row[c]
        node["conv_id"] = min(node["conv_id"], row["conv_id"])
        node["right"] = row["right"]
        node["lead"] = row["lead"] if node["lead"] is None else node["lead"]

    def settle(self, last_round: bool) -> list[dict]:
        """Nodes without a mark are done: their values go to the parent. In the last round all are."""
        done = []
        for node in sorted(self.nodes.values(), key=lambda x: -x["depth"]):
            if (node["left"] or node["right"]) and not last_round:
                continue
            if not node["n_children"]:
                node["n_leaves"] += 1
            node["saved"] += (node["n_convs"] - 1) * node["size"]
            if node["parent"] is not None:
                up = self.nodes[node["parent"]]
                up["n_children"] += 1
                up["n_leaves"] += node["n_leaves"]
                up["saved"] += node["saved"]
            node["left"] = node["right"] = False
            done.append(node)
        return done


def path_merger(last_round: bool) -> Callable[[Batches], Batches]:
    """Marked nodes, sorted by (group, range, place), to the nodes of each group of ranges."""

    def rows(group: int, paths: Paths) -> Batches:
        paths.settle(last_round)
        found = list(paths.nodes.values())
        for i, node in enumerate(found):  # a node's parent is older than the node
            node["range"], node["place"] = group, i
        for a in range(0, len(found), ROWS_OUT):
            yield table_of({c: [x[c] for x in found[a : a + ROWS_OUT]] for c in NAMES})

    def run(batches: Batches) -> Batches:
        group, paths = None, Paths()
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != group:
                    if group is not None:
                        yield from rows(group, paths)
                    group, paths = row["group"], Paths()
                paths.add(row)
        if group is not None:
            yield from rows(group, paths)

    return run


def id_chunks(batches: Batches) -> Batches:
    """(name, conv_id) in order to (name, first, ids): the decimal ids of stretches of one name, comma-joined.

    Names with one id are left out, unless the task begins or ends with it: a neighbour may have more of them.
    """
    name, first, ids = None, None, []
    out: list[tuple] = []
    seen = 0

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.string(), pa.int64(), pa.string()))], ["name", "first", "ids"])

    for batch in batches:
        for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if n != name or len(ids) == CHUNK_IDS:
                if len(ids) > 1 or seen == 1 or (ids and n == name) or (ids and out and out[-1][0] == name):
                    out.append((name, first, ",".join(ids)))
                name, first, ids = n, c, []
                if len(out) >= CHUNK_IDS or len(out) > 16 and len(out[-1][2]) > 1000:
                    yield flushed()
                    out = out[-1:][:0]
            ids.append(str(c))
    if ids:
        out.append((name, first, ",".join(ids)))
    if out:
        yield flushed()


def id_digests(batches: Batches) -> Batches:
    """(name, first, ids) in order to (lead, digest): the least id of a name and the digest of all its ids, read as a stream."""
    name, lead, state, out = None, None, None, []

    def flushed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1] for x in out], pa.string())], ["lead", "ends_sha256"])

    for batch in batches:
        for n, first, ids in zip(*(batch.column(k).to_pylist() for k in range(3))):
            if n == name:
                state.update(b"," + ids.encode())
                continue
            if name is not None:
                out.append((lead, state.hexdigest()))
            name, lead, state = n, first, hashlib.sha256(ids.encode())
            if len(out) == ROWS_OUT:
                yield flushed()
                out.clear()
    if name is not None:
        out.append((lead, state.hexdigest()))
    if out:
        yield flushed()


def end_digests(members: DataFrame) -> DataFrame:
    """(lead, ends_sha256) of every distinct conversation with more than one member.

    A digest of a list is made in one piece, so the ids of a name are joined in stretches by all tasks first and the last step reads a hot name's few long
    stretches one after the other.
    """
    chunks = members.repartitionByRange("name", "conv_id").sortWithinPartitions("name", "conv_id").mapInArrow(id_chunks, "name string, first bigint, ids string")
    return chunks.repartition("name").sortWithinPartitions("name", "first").mapInArrow(id_digests, "lead bigint, ends_sha256 string")


def prefix_trie(convs: DataFrame, range_bytes: int = RANGE_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """One row per distinct prefix of the conversations (conv_id, ids), the empty one included; `ids` as of `conversations_of`, conv_id unique.

    conv_id: least member; depth; parent_conv_id: the parent's least member (root: null); n_convs: members; n_children; n_leaves: childless nodes of the
    subtree, the node itself included; saved_tokens: (n_convs - 1) x bytes of the last text, summed over the subtree; ends_sha256: digest of the comma-joined
    ids of the members that end here, ascending.

    No conversations, no nodes. A conversation's ids (24 bytes a turn) are one row; a range has about `range_bytes` of them.
    """
    distinct = cut(convs.groupBy("ids").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n")), "distinct-conversations")
    ids_bytes = distinct.agg(F.sum(F.size("ids") * 8 + 16)).first()[0] or 0
    parts = max(1, -(-ids_bytes // range_bytes))
    ranges = distinct.repartitionByRange(parts, "ids").mapInArrow(range_builder(), NODES)

    marked = F.col("left") | F.col("right")
    built = cut(ranges, "nodes-0")
    edge, ranges_left, stage = built.where(marked), built.where("place = 0").count(), 0
    merged = []
    while ranges_left:
        last_round, stage = ranges_left <= fan_in, stage + 1
        group = F.floor(F.col("range") / fan_in).cast("int") if not last_round else F.lit(0)
        dealt = edge.withColumn("group", group).repartition("group").sortWithinPartitions("group", "range", "place")
        level = cut(dealt.mapInArrow(path_merger(last_round), NODES), f"nodes-{stage}")
        merged.append(level.where(~marked))
        if last_round:
            break
        edge, ranges_left = level.where(marked), level.where("place = 0").count()
    paths = merged[0] if merged else built.limit(0)
    for more in merged[1:]:
        paths = paths.unionByName(more)

    # a node below a marked one learns its parent's least member now
    known = cut(paths, "paths")
    named = known.select(F.col("node").alias("parent"), F.col("conv_id").alias("told"))
    named = F.broadcast(named) if fits(named, F.lit(64), MAX_BROADCAST_BYTES) else named
    every = built.where(~marked).unionByName(known)
    below = every.where(F.col("parent").isNotNull()).join(named, "parent").withColumn("parent_conv_id", F.col("told"))
    nodes = every.where(F.col("parent").isNull()).unionByName(below.select(*every.columns))

    name = F.concat_ws(":", F.hex(F.xxhash64("ids")), F.hex(F.xxhash64(F.lit(1), "ids")))
    digests = cut(end_digests(convs.select(name.alias("name"), "conv_id")), "ends")
    own = F.when(F.col("ends") == 0, F.lit(NO_ENDS)).otherwise(F.sha2(F.col("lead").cast("string"), 256))
    alone = nodes.where("ends < 2").withColumn("ends_sha256", own)
    ended = nodes.where("ends > 1").join(digests, "lead")
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"]
    return alone.select(*columns).unionByName(ended.select(*columns))


# fixed values: CRC-32, bit by bit
SQL = f"""WITH RECURSIVE own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
every AS (
  SELECT DISTINCT c, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295::BIGINT) % {HEADS} AS h FROM own),
told AS (
  SELECT e.c, o.place, o.role, o.text FROM every e JOIN own o ON o.c = e.c - e.c % {FAMILY} AND o.place <= e.h
  UNION ALL SELECT e.c, o.place + 1000000, o.role, o.text FROM every e JOIN own o ON o.c = e.c AND o.place > e.h),
chained AS (
  SELECT c, row_number() OVER w AS depth, string_agg(sha256(role || chr(0) || text), '') OVER w AS prefix, strlen(text) AS size FROM told
  WINDOW w AS (PARTITION BY c ORDER BY place)),
steps AS (
  SELECT c, 0 AS depth, '' AS prefix, 0 AS size FROM every UNION ALL SELECT c, depth, sha256(prefix), size FROM chained),
lengths AS (SELECT c, max(depth) AS length FROM steps GROUP BY c),
nodes AS (
  SELECT depth, prefix, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE depth = length), '')) AS ends_sha256
  FROM steps JOIN lengths USING (c) GROUP BY depth, prefix),
linked AS (
  SELECT n.*, p.prefix AS up, q.conv_id AS parent_conv_id FROM nodes n
  LEFT JOIN steps p ON p.c = n.conv_id AND p.depth = n.depth - 1 LEFT JOIN nodes q ON q.depth = n.depth - 1 AND q.prefix = p.prefix),
children AS (SELECT depth - 1 AS depth, up AS prefix, count(*) AS n FROM linked WHERE depth > 0 GROUP BY ALL),
valued AS (SELECT l.*, coalesce(c.n, 0) AS n_children FROM linked l LEFT JOIN children c ON c.depth = l.depth AND c.prefix = l.prefix),
subtrees AS (
  SELECT a.depth, a.prefix, count(*) FILTER (WHERE v.n_children = 0) AS n_leaves, sum((v.n_convs - 1) * v.size) AS saved_tokens
  FROM valued v JOIN steps a ON a.c = v.conv_id AND a.depth <= v.depth GROUP BY a.depth, a.prefix)
SELECT v.conv_id, v.depth::BIGINT AS depth, v.parent_conv_id, v.n_convs, v.n_children::BIGINT AS n_children, s.n_leaves, s.saved_tokens::BIGINT AS saved_tokens, v.ends_sha256
FROM valued v JOIN subtrees s ON s.depth = v.depth AND s.prefix = v.prefix"""


@query("op12_prefix_trie", sql=SQL)
def op12_prefix_trie(spark, sf_dir):
    """The prefix trie of all rebuilt conversations; see `rebuilt` and `prefix_trie`."""
    convs = cut(conversations_of(table(spark, sf_dir, "conversations")), "conversations")
    return prefix_trie(cut(rebuilt(convs), "rebuilt"))
