"""Conversation prefix trie: ternary search trees per range shard, merged at the shards' edges.

Conversations are the rows of one conv_id, ordered by turn (nulls first), then role, then text; null
roles and texts are empty. Every conversation c is rebuilt: the first h turns of conversation c - c % 5,
then its own turns after its first h, with h = crc32 of c in decimal, modulo 9. A node is a
distinct sequence of first turns of rebuilt conversations; its members are those that start with it.

Turns get dictionary ids. Equal sequences of ids are folded, put in order, and dealt out by range, so that
a shard holds all sequences between two others. A task cuts its range into shards of ``SHARD_TURNS`` turns,
builds a ternary search tree of each by inserting medians first, and sums members, leaves and savings from the
last node back to the first. Only nodes on the paths of a shard's first and last sequence can be in
other shards too. These go on as parts with a key, which are merged by it; their subtree sums then
grow by doubling: each round, a node adds up what lies below it within twice the distance.

A conversation of any length passes in bands of ``BAND`` turns. The band below knows the one above by the hash
of the path to it, and the paths of conversations that go on are merged like those at edges.
Positions within a conversation are counted per range of the sorted rows, so that a conversation
with a third of all rows never meets in one task. The ids of a node's own conversations
are hashed as one stream, in pieces that were put in order before.

Rows without a conv_id belong to no conversation and are left out. Repeated rows are turns of their
own. For negative ids, c % 5 has the sign of c. No conversations give no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spokewise.llm.common import small_batches
from spokewise.session import stored

#: Turns in a shard, but for the last sequence.
SHARD_TURNS = 200_000
#: Turns of one conversation that are inserted at a time.
BAND = 1024
GROUP, MOST_SHARED = 5, 9
UNSEEN = 2**63 - 1
NOTHING = hashlib.sha256(b"").hexdigest()

NODES = (
    "key string, parent_key string, conv_id long, depth long, parent_conv_id long, n_convs long, "
    "size long, n_children long, n_leaves long, saved_tokens long, end string"
)
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]


def _numbered(conversations: DataFrame) -> DataFrame:
    """(part, conv, place, key, size), stored: turns in order; place counts within part and conversation."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    told = F.concat(role, F.lit("\0"), text)
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        told.alias("told"),
        F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), told), 256)).alias("key"),
        F.octet_length(text).alias("size"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, seen = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            heads = np.append(0, np.flatnonzero(conv[1:] != conv[:-1]) + 1)
            begins = heads.copy()
            if conv[0] == last:  # the first rows go on from the last batch
                begins[0] = -seen
            place = np.arange(len(conv)) - np.repeat(begins, np.diff(np.append(heads, len(conv))))
            last, seen = int(conv[-1]), int(place[-1]) + 1
            columns = [pa.array(np.full(len(conv), part), pa.int32()), batch.column(0), pa.array(place, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, *batch.columns[1:]], names=["part", "conv", "place", "key", "size"])

    dealt = rows.repartitionByRange("conv", "turn", F.substring("told", 1, 64))
    ordered = dealt.sortWithinPartitions("conv", "turn", "told").select("conv", "key", "size")
    return stored(ordered.mapInArrow(run, "part int, conv long, place long, key binary, size int"), "turns")


def _rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv, total, p, id, size), stored: turn p of a rebuilt conversation of ``total``; p is null where total is 0."""
    turns = _numbered(conversations)
    words = turns.groupBy("key").agg(F.count("*").alias("times"))
    words = stored(words.select("key", F.monotonically_increasing_id().alias("id")), "turn-dictionary")
    parts = turns.groupBy("conv", "part").agg(F.count("*").alias("n"))
    by_part = Window.partitionBy("conv").orderBy("part")
    parts = parts.withColumn("before", F.sum("n").over(by_part.rowsBetween(Window.unboundedPreceding, -1)))
    parts = stored(parts, "conversation-parts")
    begins = parts.where("before > 0").select("conv", "part", "before")
    turns = turns.join(begins, ["conv", "part"], "left").join(words, "key")
    turns = turns.select("conv", (F.col("place") + F.coalesce("before", F.lit(0))).alias("pos"), "id", "size")
    turns = stored(turns, "turn-ids")

    share = F.pmod(F.crc32(F.col("conv").cast("string")), F.lit(MOST_SHARED))
    known = parts.groupBy("conv").agg(F.sum("n").alias("n")).withColumn("h", share)
    heads = turns.where((F.col("conv") % GROUP == 0) & (F.col("pos") < MOST_SHARED - 1)).groupBy("conv")
    heads = heads.agg(F.sort_array(F.collect_list(F.struct("pos", "id", "size"))).alias("head"))
    heads = heads.withColumnRenamed("conv", "base")
    known = known.withColumn("base", F.col("conv") - F.col("conv") % GROUP).join(heads, "base", "left")
    known = known.withColumn("head", F.expr("slice(coalesce(head, array()), 1, CAST(h AS INT))"))
    known = known.withColumn("total", F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    known = stored(known.select("conv", "h", "total", "head"), "rebuilt-conversations")
    shared = known.select("conv", "total", F.explode("head").alias("t"))
    shared = shared.select("conv", "total", F.col("t.pos").alias("p"), "t.id", "t.size")
    own = turns.join(known.select("conv", "h", "total", F.size("head").alias("led")), "conv").where("pos >= h")
    own = own.select("conv", "total", (F.col("pos") - F.col("h") + F.col("led")).alias("p"), "id", "size")
    none = known.where("total = 0").selectExpr("conv", "total", "CAST(NULL AS LONG)", "CAST(NULL AS LONG)", "CAST(NULL AS INT)")
    return stored(shared.union(own).union(none), "rebuilt-turns")


def _path_key(above: str, ids_hash: str) -> str:
    return hashlib.sha256(f"{above}|{ids_hash}".encode()).hexdigest()


def _sequences(rebuilt: DataFrame, band: int) -> DataFrame:
    """(conv, above, band, more, key, turns): stored bands of conversations.

    above is the key of the path to the band, key that of the path to its end; more says that the conversation goes on.
    """
    turn = F.when(F.col("p").isNotNull(), F.struct("p", "id", "size"))
    number = F.floor(F.coalesce("p", F.lit(0)) / band).cast("long")
    rows = rebuilt.groupBy("conv", "total", number.alias("band")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    rows = rows.withColumn("turns", F.expr("transform(turns, t -> struct(t.id AS id, t.size AS size))"))
    joined = F.expr("array_join(transform(turns, t -> CAST(t.id AS STRING)), ',')")
    rows = stored(rows.withColumn("hash", F.sha2(joined, 256)), "bands")
    short, long = rows.where(F.col("total") <= band), rows.where(F.col("total") > band)

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, above = None, ""
        for batch in batches:
            out: list[list] = [[], []]
            for conv, digest in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                if conv != now:
                    now, above = conv, ""
                out[0].append(above)
                above = _path_key(above, digest)
                out[1].append(above)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], *(pa.array(v, pa.string()) for v in out)], names=["conv", "band", "above", "key"]
            )

    hashes = long.select("conv", "band", "hash").repartition("conv").sortWithinPartitions("conv", "band")
    chained = hashes.mapInArrow(chain, "conv long, band long, above string, key string")
    goes_on = ((F.col("band") + 1) * band < F.col("total")).alias("more")
    long = long.join(chained, ["conv", "band"]).select("conv", "above", "band", goes_on, "key", "turns")
    key = F.sha2(F.concat(F.lit("|"), F.col("hash")), 256)
    short = short.select("conv", F.lit("").alias("above"), "band", F.lit(False).alias("more"), key.alias("key"), "turns")
    return stored(short.union(long), "sequences")


class TernaryTree:
    """Sequences of turn ids under roots that are known by the key of the path to them.

    Nodes are numbered as they come, parents before children. Siblings form a binary search tree
    under their parent.
    """

    def __init__(self) -> None:
        self.turn: list[int] = []
        self.lower: list[int] = []
        self.higher: list[int] = []
        self.first: list[int] = []
        self.parent: list[int] = []
        self.depth: list[int] = []
        self.size: list[int] = []
        self.members: list[int] = []
        self.least: list[int] = []
        self.end: dict[int, str] = {}
        self.roots: dict[tuple[str, int], int] = {}

    def _node(self, turn: int, parent: int, depth: int, size: int) -> int:
        for column, value in (
            (self.turn, turn), (self.lower, -1), (self.higher, -1), (self.first, -1), (self.parent, parent),
            (self.depth, depth), (self.size, size), (self.members, 0), (self.least, UNSEEN),
        ):
            column.append(value)
        return len(self.turn) - 1

    def root(self, above: str, depth: int) -> int:
        if (above, depth) not in self.roots:
            self.roots[above, depth] = self._node(-1, -1, depth, 0)
        return self.roots[above, depth]

    def child(self, parent: int, turn: int, size: int) -> int:
        node = self.first[parent]
        if node < 0:
            self.first[parent] = node = self._node(turn, parent, self.depth[parent] + 1, size)
            return node
        while True:
            if turn == self.turn[node]:
                return node
            side = self.lower if turn < self.turn[node] else self.higher
            if side[node] < 0:
                side[node] = new = self._node(turn, parent, self.depth[parent] + 1, size)
                return new
            node = side[node]

    def insert(self, above: str, depth: int, ids: list[int], sizes: list[int], n: int, least: int) -> list[int]:
        """The path of a sequence that ``n`` conversations have, the smallest being ``least``."""
        path = [self.root(above, depth)]
        for turn, size in zip(ids, sizes):
            path.append(self.child(path[-1], turn, size))
        # a root below the first band has its members counted where it ends the band above
        for node in path if not above else path[1:]:
            self.members[node] += n
            self.least[node] = min(self.least[node], least)
        return path


def _medians(n: int) -> Iterator[int]:
    """0..n-1, the middle of every stretch before its halves."""
    open_ = [(0, n)]
    for begin, end in open_:
        if begin < end:
            middle = (begin + end) // 2
            yield middle
            open_ += [(begin, middle), (middle + 1, end)]


def _shard_nodes(rows: list[tuple], band: int) -> Iterator[tuple]:
    """NODES rows of one shard; rows are (above, band, more, key, n, least, ids, sizes) in order."""
    tree, shared = TernaryTree(), {}
    for k in _medians(len(rows)):
        above, number, more, key, n, least, ids, sizes = rows[k]
        path = tree.insert(above, number * band, ids, sizes, n, least)
        if not more:
            tree.end[path[-1]] = key
        if more or k in (0, len(rows) - 1):
            shared[path[0]], digest = above, hashlib.sha256()
            for depth, (node, turn) in enumerate(zip(path[1:], ids)):
                digest.update(f",{turn}".encode() if depth else str(turn).encode())
                if node not in shared:
                    shared[node] = _path_key(above, digest.hexdigest())
    shared.update((node, above) for (above, _), node in tree.roots.items())
    total = len(tree.turn)
    children, leaves, saved = [0] * total, [0] * total, [0] * total
    for node in reversed(range(total)):
        if node in shared:
            continue
        leaves[node] = leaves[node] if children[node] else 1
        saved[node] += (tree.members[node] - 1) * tree.size[node]
        up = tree.parent[node]
        children[up] += 1
        leaves[up] += leaves[node]
        saved[up] += saved[node]
    for node in range(total):
        up = tree.parent[node]
        key, up_key = shared.get(node), shared.get(up) if up >= 0 else None
        up_conv = tree.least[up] if up >= 0 and up_key is None else None
        least = tree.least[node] if tree.least[node] < UNSEEN else None
        yield (
            key, up_key, least, tree.depth[node], up_conv, tree.members[node], tree.size[node],
            children[node], leaves[node], saved[node], tree.end.get(node),
        )


def _nodes(sequences: DataFrame, band: int) -> DataFrame:
    """NODES rows of all shards, stored. Those with a key are parts of nodes that other shards may have too."""
    folded = sequences.groupBy("above", "band", "more", "key", "turns").agg(
        F.count("*").alias("n"), F.min("conv").alias("least")
    )
    folded = stored(folded, "distinct-sequences")
    columns = ["above", "band", "more", "key", "n", "least", "turns"]
    ordered = folded.repartitionByRange("above", "band", "turns").sortWithinPartitions("above", "band", "turns", "more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in NODES.split(", ")]
        kinds = [pa.string() if f.endswith("string") else pa.int64() for f in NODES.split(", ")]

        def finish() -> Iterator[pa.RecordBatch]:
            found = list(_shard_nodes(rows, band))
            for begin in range(0, len(found), 20_000):
                values = zip(*found[begin : begin + 20_000])
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names=names)

        rows, size = [], 0
        for batch in small_batches(batches, 2000):
            plain = [c.to_pylist() for c in batch.columns[:6]]
            turns = batch.column(6)
            ends = turns.offsets.to_numpy()
            ids, sizes = (turns.values.field(k).to_numpy(zero_copy_only=False) for k in ("id", "size"))
            for i, row in enumerate(zip(*plain)):
                mine = slice(ends[i], ends[i + 1])
                rows.append((*row, ids[mine].tolist(), sizes[mine].tolist()))
                size += len(rows[-1][-1]) + 1
                if size >= SHARD_TURNS:
                    yield from finish()
                    rows, size = [], 0
        if rows:
            yield from finish()

    return stored(ordered.select(columns).mapInArrow(run, NODES), "trie-parts")


def _merged(parts: DataFrame) -> DataFrame:
    """The RESULT columns, key and end of the nodes that have a key, over all shards."""
    merged = parts.where("key IS NOT NULL").groupBy("key").agg(
        *(F.max(c).alias(c) for c in ("parent_key", "depth", "size", "end")),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
        F.min("conv_id").alias("conv_id"),
    )
    merged = stored(merged, "shared-nodes")
    below = merged.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("more"))
    merged = merged.join(below, "key", "left").withColumn("n_children", F.expr("n_children + coalesce(more, 0)"))
    sums = stored(
        merged.select(
            "key",
            F.col("parent_key").alias("jump"),
            F.expr("n_leaves + CAST(n_children = 0 AS LONG)").alias("n_leaves"),
            F.expr("saved_tokens + (n_convs - 1) * size").alias("saved_tokens"),
        ),
        "subtree-sums",
    )
    while True:
        open_ = sums.where("jump IS NOT NULL")
        if not open_.head(1):
            break
        gained = open_.groupBy(F.col("jump").alias("key")).agg(
            F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
        )
        further = open_.select("key", "jump").join(
            sums.select(F.col("key").alias("jump"), F.col("jump").alias("next")), "jump"
        )
        sums = sums.join(gained, "key", "left").join(further.select("key", "next"), "key", "left")
        sums = sums.select(
            "key",
            F.col("next").alias("jump"),
            F.expr("n_leaves + coalesce(leaves, 0)").alias("n_leaves"),
            F.expr("saved_tokens + coalesce(saved, 0)").alias("saved_tokens"),
        )
        sums = stored(sums, "subtree-sums")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id"))
    nodes = merged.drop("n_leaves", "saved_tokens").join(sums.drop("jump"), "key")
    below_some = nodes.where("parent_key IS NOT NULL").join(above, "parent_key")
    root = nodes.where("parent_key IS NULL").withColumn("parent_conv_id", F.lit(None).cast("long"))
    return stored(below_some.unionByName(root).select("key", *RESULT, "end"), "merged-nodes")


def _ends(sequences: DataFrame) -> DataFrame:
    """(end, ends_sha256): hash of the ids of the conversations that end at a path, ascending."""
    ids = sequences.where("NOT more").select("key", "conv", F.shiftright("conv", 12).alias("piece"))
    pieces = ids.groupBy("key", "piece").agg(F.sort_array(F.collect_list("conv")).alias("convs"))
    pieces = pieces.select("key", "piece", F.expr("array_join(transform(convs, c -> CAST(c AS STRING)), ',')").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in small_batches(batches, 2000):
            out: list[tuple] = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if key == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((now, digest.hexdigest()))
                now, digest = key, hashlib.sha256(ids.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], names=["end", "ends_sha256"])
        if now is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now]), pa.array([digest.hexdigest()])], names=["end", "ends_sha256"])

    dealt = pieces.repartition("key").sortWithinPartitions("key", "piece").select("key", "ids")
    return dealt.mapInArrow(run, "end string, ends_sha256 string")


def prefix_trie(conversations: DataFrame, band: int | None = None) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    conv_id is a node's smallest member; saved_tokens sums, over the nodes of its subtree, the bytes of the last
    text times the members but one; n_leaves counts the subtree's nodes without children; ends_sha256 is the hash of the ascending ids
    of the conversations that end there, joined by commas.
    """
    band = band or BAND
    sequences = _sequences(_rebuilt(conversations), band)
    parts = _nodes(sequences, band)
    merged = _merged(parts)
    own = parts.where("key IS NULL")
    known = own.where("parent_key IS NULL")
    above = merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above_conv"))
    at_edge = own.where("parent_key IS NOT NULL").drop("parent_conv_id").join(above, "parent_key")
    at_edge = at_edge.withColumnRenamed("above_conv", "parent_conv_id")
    columns = [*RESULT, "end"]
    nodes = known.select(columns).union(at_edge.select(columns)).union(merged.select(columns))
    ended = nodes.where("end IS NOT NULL").join(_ends(sequences), "end").select(*RESULT, "ends_sha256")
    passed = nodes.where("end IS NULL").select(*RESULT, F.lit(NOTHING).alias("ends_sha256"))
    return ended.union(passed)
