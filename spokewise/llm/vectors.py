"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Equal vectors are folded into classes first. Classes are dealt into shards; each shard is indexed by
a hierarchy of small-world graphs, stored, and every class queries every shard in blocks. A block
begins with an audit: some of its queries, and at first some members turned away by just the
threshold's angle, are compared with the whole shard, and the beam is widened until the graph finds
``RECALL`` of their links, those of large groups too, and ``NEAREST`` of all samples' nearest vectors. A query whose beam is full of links has its own beam doubled, and beyond a quarter
of the shard it is compared with all of it. Found pairs are verified by cosine in double precision.
A shard's task passes on, per query, one link for each shard, the components its members form and how many
vectors found each member, so the links of a group of n vectors never become n² rows. A vector's links are
those it found or those that found it, whichever are more: a pair that one side alone finds counts for both.

Vectors that are null, zero, empty, or hold null or non-finite components link with nothing; vectors
of different lengths do not link. Null ids are passed over as component ids.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.llm.common import connected_components, join_labels
from spokewise.session import stored

THRESHOLD = 0.95
#: Shards of small tables, and the most vectors of one shard, which grows their number.
SHARDS = 8
SHARD_ROWS = 100_000
#: Tasks that share the queries of one shard, at least, and the queries of one task, which grow their number.
LANES = 4
LANE_QUERIES = 200_000
BLOCK = 512
NEIGHBOURS = 16
BUILD_BEAM = 48
FIRST_BEAM = 32
AUDIT_EVERY = 32
RECALL = 0.98
NEAREST = 0.9
#: Turned members in a shard's first audit.
TURNED = 64
#: Vertices opened at a time.
OPEN = 4
#: The key of an empty place in a beam, after all others and opened.
NONE = np.iinfo(np.int64).max


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision."""
    rows = raw.astype(np.float64)
    rows /= np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _keys(sims: np.ndarray, vertices: np.ndarray) -> np.ndarray:
    """Numbers that sort by falling similarity, then vertex; the last bit is free for those opened."""
    bits = sims.astype(np.float32).view(np.int32)
    rising = bits ^ ((bits >> 31) & 0x7FFFFFFF)
    return (~rising.astype(np.int64) << 32) | (vertices.astype(np.int64) << 1)


def _unkeyed(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(vertices, similarities) of keys; -1 and -2 where there is none."""
    rising = (~(keys >> 32)).astype(np.int32)
    sims = (rising ^ ((rising >> 31) & 0x7FFFFFFF)).view(np.float32)
    none = keys == NONE
    return np.where(none, -1, (keys & 0xFFFFFFFF) >> 1), np.where(none, np.float32(-2), sims)


def _heads(values: np.ndarray) -> np.ndarray:
    """Whether a sorted value differs from the one before."""
    return np.concatenate((np.ones(min(1, len(values)), dtype=bool), values[1:] != values[:-1]))


def beam_search(
    graph: np.ndarray, points: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` most similar vertices found for each query, best first (-1 where fewer).

    Only vertices that a query has not met are compared with it, and only those that enter its beam are sorted.
    """
    q, n = len(queries), len(graph)
    keys = np.full((q, beam), NONE, dtype=np.int64)
    visited = np.zeros(q * n, dtype=bool)
    kind = np.int32 if q * n < 1 << 31 else np.int64

    def meet(rows: np.ndarray, vertices: np.ndarray) -> None:
        pairs = np.where(vertices < 0, 0, vertices + (rows * n)[:, None].astype(kind)).ravel()
        pairs = np.sort(pairs[(vertices >= 0).ravel() & ~visited.take(pairs)])
        pairs = pairs[_heads(pairs)].astype(np.int64)
        visited[pairs] = True
        row = np.repeat(np.arange(q), np.diff(np.searchsorted(pairs, np.arange(q + 1) * n)))
        vertex = pairs - row * n
        new = _keys(np.einsum("ij,ij->i", points.take(vertex, axis=0), queries.take(row, axis=0)), vertex)
        enters = new < keys[:, -1].take(row)
        row, new = row[enters], new[enters]
        heads = np.flatnonzero(_heads(row))
        counts = np.diff(np.append(heads, len(row)))
        wider = np.full((len(heads), beam + counts.max(initial=0)), NONE, dtype=np.int64)
        wider[:, :beam] = keys[row[heads]]
        nth = np.arange(len(row)) - np.repeat(heads, counts)
        wider[np.repeat(np.arange(len(heads)), counts), beam + nth] = new
        wider.sort(axis=1)
        keys[row[heads]] = wider[:, :beam]

    active = np.arange(q)
    meet(active, entries)
    while True:
        closed = (keys[active] & 1) == 0
        going = closed.any(axis=1)
        active, closed = active[going], closed[going]
        if not len(active):
            return _unkeyed(keys)
        row, place = np.nonzero(closed & (np.cumsum(closed, axis=1, dtype=np.int32) <= OPEN))
        row = active[row]
        vertex = (keys[row, place] & 0xFFFFFFFF) >> 1
        keys[row, place] |= 1
        meet(row, graph.take(vertex, axis=0))


def _select(points: np.ndarray, ids: np.ndarray, sims: np.ndarray, keep: int) -> np.ndarray:
    """Of candidates, best first, those nearer to the vertex than to any chosen before."""
    vectors = points[np.maximum(ids, 0)]
    between = np.matmul(vectors, vectors.transpose(0, 2, 1))
    rows, width = ids.shape
    chosen = np.zeros((rows, width), dtype=bool)
    closest = np.full((rows, width), -2.0, dtype=np.float32)
    for k in range(width):
        ok = (ids[:, k] >= 0) & (sims[:, k] > closest[:, k]) & (chosen.sum(axis=1) < keep)
        chosen[:, k] = ok
        closest = np.where(ok[:, None], np.maximum(closest, between[:, k]), closest)
    # fill up with the nearest of the others
    rank = np.argsort(np.where(ids < 0, 2, ~chosen), axis=1, kind="stable")[:, :keep]
    return np.take_along_axis(ids, rank, axis=1)


def _best(ids: np.ndarray, sims: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(sims, order, axis=1)


def _descend(layers: list[np.ndarray], points: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """Entry vertices, one per query, from the layers above."""
    entry = np.zeros((len(queries), 1), dtype=np.int64)
    for graph in layers:
        entry = beam_search(graph, points, queries, entry, 4)[0][:, :1]
    return entry


def build(points: np.ndarray, seed: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(order, layers): vertices are the points in ``order``; a layer holds the first so many.

    Vertices enter in order of falling level, in blocks that search the graph so far and each other.
    """
    n = len(points)
    rng = np.random.default_rng(seed)
    levels = np.floor(-np.log(rng.random(n)) / np.log(NEIGHBOURS)).astype(int)
    order = np.argsort(-levels, kind="stable")
    points, layers = points[order], []
    for level in reversed(range(int(levels.max()) + 1 if n else 0)):
        size = int((levels >= level).sum())
        keep = NEIGHBOURS * (2 if level == 0 else 1)
        graph = np.full((size, keep), -1, dtype=np.int64)
        begin = 0
        while begin < size:
            end = min(size, begin + max(32, min(BLOCK, begin)))
            new = np.arange(begin, end)
            queries = points[begin:end]
            inner = (queries @ queries.T).astype(np.float32)
            np.fill_diagonal(inner, -2)
            ids, sims = np.broadcast_to(new, inner.shape), inner
            if begin:
                entries = _descend(layers, points, queries) if layers else np.zeros((len(new), 1), np.int64)
                entries[entries >= begin] = 0
                found = beam_search(graph[:begin], points, queries, entries, BUILD_BEAM)
                ids, sims = np.concatenate((found[0], ids), axis=1), np.concatenate((found[1], sims), axis=1)
            ids, sims = _best(ids, sims, BUILD_BEAM)
            ids = np.where(sims > -2, ids, -1)
            links = _select(points, ids, sims, keep)
            graph[new, : links.shape[1]] = links
            _link_back(graph, points, new, links)
            begin = end
        layers.append(graph)
    return order, layers


def _link_back(graph: np.ndarray, points: np.ndarray, new: np.ndarray, links: np.ndarray) -> None:
    keep = graph.shape[1]
    to, source = links.ravel(), np.repeat(new, links.shape[1])
    to, source = to[to >= 0], source[to >= 0]
    if not len(to):
        return
    near = np.einsum("ij,ij->i", points[to], points[source])
    by = np.lexsort((-near, to))
    to, source = to[by], source[by]
    heads = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1])))
    counts = np.diff(np.append(heads, len(to)))
    nth = np.arange(len(to)) - np.repeat(heads, counts)
    inside = nth < keep
    vertices = to[heads]
    incoming = np.full((len(vertices), keep), -1, dtype=np.int64)
    incoming[np.repeat(np.arange(len(vertices)), counts)[inside], nth[inside]] = source[inside]
    for part in range(0, len(vertices), BLOCK):
        v = vertices[part : part + BLOCK]
        both = np.sort(np.concatenate((graph[v], incoming[part : part + BLOCK]), axis=1), axis=1)
        both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
        sims = np.matmul(points[np.maximum(both, 0)], points[v][:, :, None])[:, :, 0]
        sims = np.where(both >= 0, sims, -2).astype(np.float32)
        graph[v] = _select(points, *_best(both, sims, 2 * keep), keep)


class Shard:
    """A stored index, ready for queries."""

    def __init__(self, blob: bytes, threshold: float):
        raw, self.cids, self.times, self.layers = pickle.loads(blob)
        self.exact = unit(raw)
        self.points = self.exact.astype(np.float32)
        self.threshold, self.beam, self.n = threshold, FIRST_BEAM, len(raw)
        self.labels, self.asked = np.arange(self.n), np.zeros(self.n, dtype=np.int64)
        self.turned = self._turned()
        # the audits so far: queries, their nearest similarity, and whether the beam in use finds it
        self.sample, self.nearest, self.met = self.points[:0], np.zeros(0, np.float32), np.zeros(0, bool)

    def _turned(self) -> np.ndarray:
        """Members turned in a random direction to a cosine just over the threshold."""
        rng = np.random.default_rng(self.n)
        members = self.exact[rng.integers(0, self.n, TURNED)]
        away = rng.normal(size=members.shape)
        away -= (away * members).sum(axis=1, keepdims=True) * members
        length = np.sqrt((away * away).sum(axis=1, keepdims=True))
        cosine = min(1.0, self.threshold + 0.005)
        aside = np.sqrt(1 - cosine * cosine) * away / np.maximum(length, 1e-300)
        return (cosine * members + aside).astype(np.float32)

    def graph_search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        beam = min(beam, self.n)
        entry = _descend(self.layers[:-1], self.points, queries)
        return beam_search(self.layers[-1], self.points, queries, entry, beam)

    def candidates(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, vertex) of the pairs found by a beam that widens where it is full, and each query's best similarity."""
        slack = self.threshold - 1e-4
        pairs, open_ = [], np.arange(len(queries))
        best = np.full(len(queries), -2, dtype=np.float32)
        while len(open_):
            if 4 * beam >= self.n:
                sims = queries[open_] @ self.points.T
                row, vertex = np.nonzero(sims >= slack)
                best[open_] = sims.max(axis=1)
                pairs.append((open_[row], vertex))
                break
            rest = []
            room = max(1, (1 << 26) // self.n)
            for begin in range(0, len(open_), room):
                part = open_[begin : begin + room]
                ids, sims = self.graph_search(queries[part], beam)
                best[part] = sims[:, 0]
                full = sims[:, -1] >= slack
                row, column = np.nonzero((sims >= slack) & ~full[:, None])
                pairs.append((part[row], ids[row, column]))
                rest.append(part[full])
            open_, beam = np.concatenate(rest), 4 * beam
        query, vertex = (np.concatenate(c) for c in zip(*pairs))
        return query, vertex, best

    def audit(self, queries: np.ndarray) -> None:
        """Widen the beam until the search finds what the whole shard has for the sample.

        Links are held to account block by block, over all of them and query by query, so that neither the queries
        of many links nor those of few hide the others; the beam is doubled where they are missed. A block's sample
        is too small to tell a share of nearest vectors from ``NEAREST``, so these are held to account over all
        samples of the task, and the beam grows by a quarter. Beyond a quarter of the shard the search is exact.
        """
        sample = np.concatenate((queries[::AUDIT_EVERY], self.turned))
        self.turned = self.turned[:0]
        sims = sample @ self.points.T
        wanted, nearest = sims >= self.threshold, sims.max(axis=1)
        counts = wanted.sum(axis=1)
        linked = counts > 0
        past = self.sample, self.nearest
        self.sample, self.nearest = np.concatenate((past[0], sample)), np.append(past[1], nearest)
        while 4 * self.beam < self.n:
            query, vertex, best = self.candidates(sample, self.beam)
            found = np.bincount(query[wanted[query, vertex]], minlength=len(sample))
            whole = found.sum() >= RECALL * counts.sum()
            each = (found[linked] / counts[linked]).sum() >= RECALL * linked.sum()
            met = np.append(self.met, best >= nearest - 1e-6)
            near = met.mean() >= NEAREST
            if whole and each and near:
                self.met = met
                return
            self.beam = self.beam * 2 if not (whole and each) else self.beam * 5 // 4
            if len(past[0]):
                self.met = self.candidates(past[0], self.beam)[2] >= past[1] - 1e-6

    def links(self, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, vertex) of all pairs found, verified."""
        exact = unit(raw)
        queries = exact.astype(np.float32)
        self.audit(queries)
        query, vertex, _ = self.candidates(queries, self.beam)
        cosine = np.einsum("ij,ij->i", exact[query], self.exact[vertex])
        good = cosine >= self.threshold
        return query[good], vertex[good]


def _pack(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(shard, cid, times, raw) in blocks of at most ``rows`` of one shard."""
    for batch in batches:
        shard, cid, times = (batch.column(i).to_numpy() for i in range(3))
        cut = np.concatenate(([0], np.flatnonzero(shard[1:] != shard[:-1]) + 1, [len(shard)]))
        for a, b in zip(cut[:-1], cut[1:]):
            for begin in range(a, b, rows):
                end = min(b, begin + rows)
                part = batch.column(3).slice(begin, end - begin)
                raw = part.flatten().to_numpy().reshape(end - begin, -1)
                yield int(shard[begin]), cid[begin:end], times[begin:end], raw


def links(classes: DataFrame, threshold: float = THRESHOLD, lanes: int = LANES) -> DataFrame:
    """(cid, other, linked, asked) of stored classes (cid, shard, dim, times, embedding).

    Rows with ``linked`` count the vectors that a class found in one shard, rows with ``asked`` those that found
    it; rows with ``other`` are links that connect the same classes as all pairs do.
    """

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts = None, []

        def finish() -> pa.RecordBatch:
            cid, times, raw = (np.concatenate(c) for c in zip(*parts))
            order, layers = build(unit(raw).astype(np.float32), now)
            small = [g.astype(np.int32) for g in layers]
            blob = pickle.dumps((raw[order], cid[order], times[order], small))
            return pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int64()), pa.array([-1], pa.int64()), pa.array([blob], pa.binary())],
                names=["shard", "seq", "blob"],
            )

        for shard, *part in _pack(batches, 1 << 30):
            if parts and shard != now:
                yield finish()
                parts = []
            now = shard
            parts.append(part)
        if parts:
            yield finish()

    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, cid, times, raw in _pack(batches, BLOCK):
            yield pa.RecordBatch.from_arrays(
                [pa.array([raw.shape[1]], pa.int64()), pa.array(cid[:1]), pa.array([pickle.dumps((cid, times, raw))], pa.binary())],
                names=["dim", "seq", "blob"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, key, names = None, None, ["cid", "other", "linked", "asked"]

        def out(a: np.ndarray, **values: np.ndarray) -> pa.RecordBatch:
            columns = [pa.array(values[n]) if n in values else pa.nulls(len(a), pa.int64()) for n in names[1:]]
            return pa.RecordBatch.from_arrays([pa.array(a), *columns], names=names)

        def finish() -> Iterator[pa.RecordBatch]:
            if shard is not None:
                leaf = np.flatnonzero(shard.labels != np.arange(shard.n))
                yield out(shard.cids[leaf], other=shard.cids[shard.labels[leaf]])
                found = np.flatnonzero(shard.asked)
                yield out(shard.cids[found], asked=shard.asked[found])

        for batch in batches:
            for slot, seq, blob in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if seq == -1:
                    yield from finish()
                    shard, key = Shard(blob, threshold), slot
                    continue
                assert key == slot
                cid, times, raw = pickle.loads(blob)
                query, vertex = shard.links(raw)
                itself = cid[query] == shard.cids[vertex]
                query, vertex = query[~itself], vertex[~itself]
                if not len(query):
                    continue
                np.add.at(shard.asked, vertex, times[query])
                order = np.argsort(query, kind="stable")
                query, vertex = query[order], vertex[order]
                heads = np.concatenate(([True], query[1:] != query[:-1]))
                first = vertex[heads][np.cumsum(heads) - 1]
                join_labels(shard.labels, first, vertex)
                total = np.add.reduceat(shard.times[vertex], np.flatnonzero(heads))
                yield out(cid[query[heads]], other=shard.cids[vertex[heads]], linked=total)
        yield from finish()

    ordered = classes.repartition("shard").sortWithinPartitions("shard", "cid")
    columns = ["shard", "cid", "times", "embedding"]
    indexes = stored(ordered.select(*columns).mapInArrow(index, "shard long, seq long, blob binary"), "hnsw")
    dims = classes.groupBy("dim").agg(F.collect_set("shard").alias("shards"))
    blocks = ordered.select(*columns).mapInArrow(block, "dim long, seq long, blob binary").join(F.broadcast(dims), "dim")
    lane = F.pmod(F.xxhash64("seq"), F.lit(lanes))
    asked = blocks.select(F.explode("shards").alias("shard"), lane.alias("lane"), "seq", "blob")
    every = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long")))
    ready = indexes.select("shard", every.alias("lane"), "seq", "blob")
    together = ready.union(asked).withColumn("slot", F.col("shard") * lanes + F.col("lane"))
    # a search takes far longer than its bytes tell, so slots must not be merged into tasks by size
    slots = max(1, indexes.count() * lanes)
    dealt = together.repartition(2 * slots, "slot").sortWithinPartitions("slot", "seq")
    return dealt.select("slot", "seq", "blob").mapInArrow(search, "cid long, other long, linked long, asked long")


def near_duplicates(embeddings: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    rows = embeddings.select("vec_id", "embedding")
    fine = (
        "embedding IS NOT NULL AND size(embedding) > 0 "
        "AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) "
        "AND exists(embedding, x -> x <> 0)"
    )
    sound = F.coalesce(F.expr(fine), F.lit(False))
    folded = rows.where(sound).groupBy("embedding").agg(F.count("*").alias("times"), F.min("vec_id").alias("least"))
    numbered = stored(
        folded.select(F.monotonically_increasing_id().alias("cid"), F.size("embedding").cast("long").alias("dim"), "*"),
        "vector-classes",
    )
    most = numbered.groupBy("dim").count().agg(F.max("count")).first()[0] or 0
    shards = max(SHARDS, -(-most // SHARD_ROWS))
    place = F.col("dim") * shards + F.pmod(F.xxhash64("cid"), F.lit(shards))
    lanes = max(LANES, -(-most // LANE_QUERIES))
    found = stored(links(numbered.withColumn("shard", place), threshold, lanes), "vector-links")
    edges = found.where("other IS NOT NULL").select(F.col("cid").alias("a"), F.col("other").alias("b"))
    members = connected_components(edges, "vector-components").withColumnRenamed("id", "cid")
    counts = found.groupBy("cid").agg(F.greatest(F.sum("linked"), F.sum("asked")).alias("linked"))
    known = numbered.join(members, "cid", "left").join(counts, "cid", "left")
    known = known.withColumn("root", F.coalesce("root", "cid"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    named = known.join(least, "root").select(
        "embedding", (F.coalesce("linked", F.lit(0)) + F.col("times") - 1).alias("n_links"), "component_id"
    )
    linked = rows.where(sound).join(named, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~sound).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
