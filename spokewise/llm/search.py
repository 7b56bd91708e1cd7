"""Ranked lexical search over a length-stratified index.

Terms are ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` with A-Z in lower case. With N documents that
have a term, L terms in all of them and n in one, a document's normaliser is
``m = 50 + (50 n N) div L``; a term that df documents hold weighs ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``;
and a document's score sums ``w * ((10^9 tf) div (1000 tf + 20 m))`` over the different terms of a query.

The index is a table with one row per shard of documents, which covers every term of every text. A
shard's documents stand in the order of their length, so that documents with equal m, a stratum, stand
together whatever N and L turn out to be. A term's postings are ordered by stratum and, within it, by
tf; all postings of such a group have the same impact, which is computed once. A query sums over its
terms the impact of the largest tf in each stratum: no document of the stratum can score more. Strata are visited
in falling order of that bound until it is below the score that the last of the best ``top`` documents has; strata
with an equal bound are still visited, since a smaller id wins a tie. Shards are dealt out to lanes, a few to each.
Queries reach a lane once, in blocks of terms, and wait there, on disk if they are many; a task has one shard and
one block in memory at a time. Shards and blocks are packed and compressed on their way, so that the rows
in which they are stored and shuffled stay small; row groups of the stored index hold a few shards however many a
task writes.

Null and empty texts have no term, are not counted in N and are never found; a null doc_id is the smallest
and comes back null; documents with equal ids are ranked one by one. A query row with a null or empty text has no result; equal
query rows have equal results, each ranked by itself. Other columns are not read.
"""

from __future__ import annotations

import pickle
from collections import defaultdict
from collections.abc import Iterator
from itertools import count
from tempfile import SpooledTemporaryFile

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spokewise.llm.common import NULL_ID, id_key, small_batches
from spokewise.llm.decontaminate import words_of
from spokewise.session import stored

TOP = 50
#: Bytes of text in a shard, but for a single longer document.
SHARD_BYTES = 6_000_000
#: Terms of the queries that are asked together.
BLOCK_TERMS = 20_000
#: Shards to which a block of queries is sent at once.
LANE_SHARDS = 4
#: Bytes of packed blocks that a task keeps in memory, before it puts them on disk.
SPOOL_BYTES = 4_000_000
#: Documents in the strata that are visited at a time.
VISIT = 256

INDEX = "shard long, n_docs long, n_terms long, held array<struct<term: binary, n: int>>, body binary"
#: Rows are large: the sizes of a page and of a row group are looked at after each.
INDEX_FILES = {
    "compression": "zstd",
    "parquet.block.size": 8 << 20,
    "parquet.page.size.row.check.min": 1,
    "parquet.page.size.row.check.max": 1,
}


def _packed(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _unpacked(body: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(body).read_next_batch()


def _one(values: pa.Array) -> pa.Array:
    """A column of one row that holds all values."""
    return pa.ListArray.from_arrays([0, len(values)], values)


class OpenShard:
    """The documents of a shard that is being filled, with a number for each of their words."""

    def __init__(self):
        self.ids, self.codes, self.size = [], [], 0
        self.known: dict[bytes, int] = defaultdict(count().__next__)

    def add(self, key: int, body: bytes) -> None:
        words = words_of(body)
        self.ids.append(key)
        self.codes.append(np.fromiter(map(self.known.__getitem__, words), np.int32, len(words)))
        self.size += len(body)

    def row(self, shard: int) -> pa.RecordBatch:
        """The index row; the documents of a term are written as steps from the one before, for better packing."""
        n = len(self.ids)
        lengths = np.fromiter(map(len, self.codes), np.int64, n)
        by_length = np.argsort(lengths, kind="stable")
        pairs = np.concatenate([self.codes[k] for k in by_length]).astype(np.int64) * n
        pairs += np.repeat(np.arange(n), lengths[by_length])
        pairs, tfs = np.unique(pairs, return_counts=True)
        words, counts = list(self.known), np.bincount(pairs // n, minlength=len(self.known))
        steps = np.diff(pairs % n, prepend=0)
        body = {
            "ids": _one(pa.array(np.array(self.ids, dtype=np.int64)[by_length])),
            "lengths": _one(pa.array(lengths[by_length])),
            "terms": pa.array([b" ".join(words)], pa.large_binary()),
            "counts": _one(pa.array(counts.astype(np.int32))),
            "steps": _one(pa.array(steps.astype(np.int16 if n < 1 << 15 else np.int32))),
            "tfs": _one(pa.array(tfs.astype(np.int32))),
        }
        terms = pa.array(words, pa.binary())
        held = pa.StructArray.from_arrays([terms, pa.array(counts, pa.int32())], ["term", "n"])
        numbers = (shard, int((lengths > 0).sum()), int(lengths.sum()))
        columns = [pa.array([v], pa.int64()) for v in numbers] + [_one(held)]
        columns.append(pa.array([_packed(pa.RecordBatch.from_pydict(body))], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, names=["shard", "n_docs", "n_terms", "held", "body"])


def index(documents: DataFrame) -> DataFrame:
    """The stored index of all documents (doc_id, text): one row per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, now = TaskContext.get().partitionId() << 32, OpenShard()
        for batch in small_batches(batches):
            for key, body in zip(*(c.to_pylist() for c in batch.columns)):
                if not body:
                    continue
                now.add(key, body)
                if now.size >= SHARD_BYTES:
                    yield now.row(shard)
                    shard, now = shard + 1, OpenShard()
        if now.ids:
            yield now.row(shard)

    rows = documents.select(id_key().alias("key"), F.col("text").cast("binary").alias("body"))
    return stored(rows.mapInArrow(run, INDEX), "lexical-index", INDEX_FILES)


class Shard:
    """The body of an index row, ready for queries."""

    def __init__(self, body: bytes, n_docs: int, n_terms: int):
        row = _unpacked(body)
        self.ids, lengths, counts, steps, self.tfs = (
            row.column(c)[0].values.to_numpy() for c in ("ids", "lengths", "counts", "steps", "tfs")
        )
        self.docs = np.cumsum(steps, dtype=np.int32)
        self.number = {t: k for k, t in enumerate(row.column("terms")[0].as_py().split(b" "))}
        self.ends = np.cumsum(counts, dtype=np.int64)
        m = 50 + 50 * lengths.astype(np.int64) * n_docs // max(1, n_terms)
        new = np.concatenate(([True], m[1:] != m[:-1]))
        self.stratum, self.m = np.cumsum(new) - 1, m[new]
        self.sizes = np.bincount(self.stratum)
        self.known: dict[bytes, tuple | None] = {}

    def postings(self, term: bytes) -> tuple | None:
        """(documents, group lengths, strata of the groups, impacts of the groups, last group of each stratum)."""
        if term not in self.known:
            self.known[term] = self._postings(term)
        return self.known[term]

    def _postings(self, term: bytes) -> tuple | None:
        k = self.number.get(term)
        if k is None:
            return None
        begin = self.ends[k - 1] if k else 0
        docs, tfs = self.docs[begin : self.ends[k]], self.tfs[begin : self.ends[k]]
        strata = self.stratum[docs]
        order = np.lexsort((tfs, strata))
        docs, tfs, strata = docs[order], tfs[order], strata[order]
        heads = np.flatnonzero(np.concatenate(([True], (strata[1:] != strata[:-1]) | (tfs[1:] != tfs[:-1]))))
        tfs, strata = tfs[heads].astype(np.int64), strata[heads]
        impacts = 1_000_000_000 * tfs // (1000 * tfs + 20 * self.m[strata])
        last = np.flatnonzero(np.append(strata[1:] != strata[:-1], True))
        return docs, np.diff(np.append(heads, len(docs))), strata, impacts, last

    def search(self, terms: list[tuple[bytes, int]], top: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best documents, best first, leaving out scores below ``least``."""
        parts = [(w, *p) for t, w in terms if w > 0 and (p := self.postings(t)) is not None]
        ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
        bound = np.zeros(len(self.m), dtype=np.int64)
        for w, _, _, strata, impacts, last in parts:
            bound[strata[last]] += w * impacts[last]
        order = np.argsort(-bound, kind="stable")
        reached = np.cumsum(self.sizes[order])
        begin, least = 0, max(1, least)
        while begin < len(order) and bound[order[begin]] >= least:
            before = reached[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(reached, before + VISIT, side="right")))
            visited = np.zeros(len(self.m), dtype=bool)
            visited[order[begin:end]] = True
            total = np.zeros(len(self.ids), dtype=np.int64)
            for w, docs, lengths, strata, impacts, _ in parts:
                groups = visited[strata]
                total[docs[np.repeat(groups, lengths)]] += np.repeat(w * impacts[groups], lengths[groups])
            found = np.flatnonzero(total >= least)
            ids, scores = np.append(ids, self.ids[found]), np.append(scores, total[found])
            best = np.lexsort((ids, -scores))[:top]
            ids, scores = ids[best], scores[best]
            if len(ids) == top:
                least = max(least, int(scores[-1]))
            begin = end
        return ids, scores


def _terms(items: DataFrame) -> DataFrame:
    """(q, term): the different terms of each query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            qs, terms = [], []
            for q, body in zip(*(c.to_pylist() for c in batch.columns)):
                mine = sorted(set(words_of(body)))
                qs += [q] * len(mine)
                terms += mine
            yield pa.RecordBatch.from_arrays([pa.array(qs, pa.int64()), pa.array(terms, pa.binary())], names=["q", "term"])

    return items.select("q", "body").mapInArrow(run, "q long, term binary")


def _asked(items: DataFrame, shards: DataFrame, n_docs: int) -> DataFrame:
    """(body): the blocks of queries, packed; queries are (q, [(term, w)])."""
    terms = stored(_terms(items), "query-terms")
    held = shards.select(F.explode("held").alias("t")).select("t.term", "t.n")
    held = held.join(terms.select("term").distinct(), "term", "left_semi")
    df = held.groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2 * n_docs + 2).cast("double") / (2 * F.col("df") + 1).cast("double")))
    weighed = terms.join(df.select("term", weight.cast("long").alias("w")), "term")
    queries = weighed.groupBy("q").agg(F.collect_list(F.struct("term", "w")).alias("terms"))
    blocks = max(1, -(-terms.count() // BLOCK_TERMS))
    block = F.pmod(F.xxhash64("q"), F.lit(blocks)).cast("int")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 1):
            yield pa.RecordBatch.from_arrays([pa.array([_packed(batch)], pa.binary())], names=["body"])

    packed = queries.groupBy(block.alias("block")).agg(F.collect_list(F.struct("q", "terms")).alias("queries"))
    return packed.select("queries").mapInArrow(pack, "body binary")


def rank(documents: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the best ``top`` documents with a score above 0 for every item.

    ``items`` has item_id and text; equal scores stand by ascending doc_id.
    """
    asked_for = items.select(
        F.monotonically_increasing_id().alias("q"), "item_id", F.col("text").cast("binary").alias("body")
    )
    asked_for = stored(asked_for, "query-items")
    shards = index(documents)
    sums = shards.agg(F.count("*"), F.sum("n_docs"), F.sum("n_terms")).first()
    n_shards, n_docs, n_terms = (int(v or 0) for v in sums)
    lanes = max(1, -(-n_shards // LANE_SHARDS))

    def search(shard: Shard, queries: list[dict], lowest: dict[int, int]) -> pa.RecordBatch:
        out: list[list] = [[], [], []]
        for query in queries:
            q, terms = query["q"], [(t["term"], t["w"]) for t in query["terms"]]
            ids, scores = shard.search(terms, top, lowest.get(q, 1))
            if len(ids) == top:  # what scores less is not among the best of all shards
                if len(lowest) > 1_000_000:
                    lowest.clear()
                lowest[q] = int(scores[-1])
            for column, values in zip(out, ([q] * len(ids), ids.tolist(), scores.tolist())):
                column += values
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in out], names=["q", "key", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, lowest = None, {}
        with SpooledTemporaryFile(SPOOL_BYTES) as asked:
            for batch in small_batches(batches, 1):
                to, number, body = (c[0].as_py() for c in batch.columns)
                if to != lane:
                    lane = to
                    asked.seek(0)
                    asked.truncate()
                if number < 0:
                    pickle.dump(body, asked)
                    continue
                shard, end = Shard(body, n_docs, n_terms), asked.tell()
                asked.seek(0)
                while asked.tell() < end:
                    yield search(shard, _unpacked(pickle.load(asked)).column(0)[0].as_py(), lowest)

    ready = shards.select(F.pmod(F.xxhash64("shard"), F.lit(lanes)).cast("int").alias("lane"), "shard", "body")
    queries = _asked(asked_for, shards, n_docs)
    lane = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1)))
    together = ready.union(queries.select(lane.alias("lane"), F.lit(-1).cast("long"), "body"))
    dealt = together.repartition("lane").sortWithinPartitions("lane", "shard")
    found = dealt.mapInArrow(run, "q long, key long, score long")
    place = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "key"))
    best = found.withColumn("rank", place).where(F.col("rank") <= top)
    doc_id = F.when(F.col("key") != NULL_ID, F.col("key")).cast(documents.schema["doc_id"].dataType)
    return asked_for.select("q", "item_id").join(best, "q").select("item_id", "rank", doc_id.alias("doc_id"), "score")
