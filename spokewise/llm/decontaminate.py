"""Benchmark decontamination with an FM-index per shard of the training documents.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A phrase is a window of
``window`` consecutive words of a benchmark item; an item with fewer words is one phrase. Every task
cuts its documents into shards, indexes each shard's words (suffix array, Burrows-Wheeler transform,
wavelet levels with block ranks, sampled suffix positions), searches all phrases backwards at once,
locates their occurrences, and merges the words they cover into spans. The pass over the
documents has no shuffle.

Words that no phrase has are a separator in the index, and a stretch between separators that is
shorter than the shortest phrase holds none, so it is left out. Suffixes end at separators.

Null texts and texts without words have zero words and no hits; rows with equal ids are judged one
by one; benchmark rows with a null text have no phrases; a null item id is named ``null``; equal
phrases of several items count for each of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokewise.llm.common import expand, runs, small_batches

WINDOW = 13
#: Words of one shard, but for a single longer document.
SHARD_WORDS = 500_000
#: Benchmark bytes whose phrases are searched at a time; a larger benchmark is cut into blocks.
BLOCK_BYTES = 4_000_000
SAMPLE = 16
DOCUMENT_END = b"\x01"

_WORDS = bytearray(range(256))
for _c in (*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)):
    _WORDS[_c] = 0x20
for _c in range(0x41, 0x5B):
    _WORDS[_c] = _c + 32
WORD_TABLE = bytes(_WORDS)

RESULT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("items", T.ArrayType(T.StringType())),
        T.StructField(
            "spans",
            T.ArrayType(
                T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())])
            ),
        ),
    ]
)


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(WORD_TABLE).split()


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; each separator (0) is a symbol of its own."""
    apart = symbols == 0
    rank = symbols + int(apart.sum())
    rank[apart] = np.arange(int(apart.sum()))
    n, h = len(symbols), 0
    while True:
        ahead = np.zeros(n, dtype=np.int64)
        if h:
            ahead[:-h] = rank[h:] + 1
        key = rank * (max(n, int(rank.max()) + 1) + 1) + ahead
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        new = np.empty(n, dtype=np.int64)
        new[order] = np.concatenate(([0], np.cumsum(ordered[1:] != ordered[:-1])))
        rank = new
        if int(rank[order[-1]]) == n - 1 or h >= n:
            return order
        h = max(1, 2 * h)


class BitRanks:
    """A bit vector with the number of ones before every 64-bit word."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate((packed, np.zeros(16 - len(packed) % 8, np.uint8))).view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def ones(self, i: np.ndarray) -> np.ndarray:
        """Ones in bits [0, i)."""
        word = i >> 6
        below = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & below)

    def get(self, i: np.ndarray) -> np.ndarray:
        return (self.words[i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1) != 0


class FMIndex:
    """Backward search over symbols 1..; 0 separates and ends the text and is never searched."""

    def __init__(self, symbols: np.ndarray):
        order = suffix_array(symbols)
        n = len(symbols)
        sequence = symbols[order - 1]
        self.n, self.depth = n, max(1, int(symbols.max()).bit_length())
        counts = np.bincount(symbols, minlength=(1 << self.depth) + 1)
        self.below = np.concatenate(([0], np.cumsum(counts)))
        self.last = sequence
        self.levels, self.zeros = [], []
        for level in reversed(range(self.depth)):
            bits = (sequence >> level) & 1 != 0
            self.levels.append(BitRanks(bits))
            self.zeros.append(int(n - bits.sum()))
            sequence = np.concatenate((sequence[~bits], sequence[bits]))
        starts = np.flatnonzero(np.concatenate(([True], symbols[:-1] == 0)))
        from_start = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        sampled = from_start[order] % SAMPLE == 0
        self.marked, self.positions = BitRanks(sampled), order[sampled]

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol in the first i symbols of the transform."""
        start = np.zeros_like(i)
        for level, bits, zeros in zip(reversed(range(self.depth)), self.levels, self.zeros):
            one = (symbol >> level) & 1 != 0
            s, e = bits.ones(start), bits.ones(i)
            start = np.where(one, zeros + s, start - s)
            i = np.where(one, zeros + e, i - e)
        return i - start

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix intervals [low, high) of phrases of equal length, one per row."""
        low = np.zeros(len(phrases), dtype=np.int64)
        high = np.full(len(phrases), self.n, dtype=np.int64)
        alive = np.flatnonzero((phrases < (1 << self.depth)).all(axis=1))
        high[np.setdiff1d(np.arange(len(phrases)), alive)] = 0
        for column in reversed(range(phrases.shape[1])):
            symbol = phrases[alive, column]
            low[alive] = self.below[symbol] + self.rank(symbol, low[alive])
            high[alive] = self.below[symbol] + self.rank(symbol, high[alive])
            alive = alive[high[alive] > low[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows, walking back to a sampled one."""
        rows, out, steps = rows.copy(), np.empty(len(rows), dtype=np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            found = self.marked.get(at)
            out[open_[found]] = self.positions[self.marked.ones(at[found])] + steps
            open_, at = open_[~found], at[~found]
            symbol = self.last[at]
            rows[open_] = self.below[symbol] + self.rank(symbol, at)
            steps += 1
        return out


def compile_phrases(items: list[tuple[str, bytes]], window: int) -> dict:
    """The distinct windows of a block of benchmark items, with the items that have each.

    ``groups`` has, per phrase length: rows of symbols, and the item numbers of row k at
    ``owners[ends[k - 1]:ends[k]]``.
    """
    owners: dict[tuple[bytes, ...], set[int]] = {}
    names = sorted({item for item, _ in items})
    number = {item: k for k, item in enumerate(names)}
    for item, text in items:
        words = words_of(text)
        for i in range(max(len(words) - window, 0) + 1 if words else 0):
            owners.setdefault(tuple(words[i : i + window]), set()).add(number[item])
    symbols = {w: k + 1 for k, w in enumerate(sorted({w for phrase in owners for w in phrase}))}
    groups = []
    for length in sorted({len(p) for p in owners}):
        of = [p for p in owners if len(p) == length]
        rows = np.array([[symbols[w] for w in p] for p in of], dtype=np.int64)
        sets = [sorted(owners[p]) for p in of]
        ends = np.cumsum([len(s) for s in sets])
        groups.append((rows, ends, np.array([k for s in sets for k in s], dtype=np.int64)))
    shortest = min((len(p) for p in owners), default=0)
    return {"items": names, "symbols": symbols, "groups": groups, "shortest": shortest}


def _search_shard(words: list[bytes], starts: np.ndarray, phrases: dict, hit: np.ndarray):
    """Mark the words that phrases cover; pairs (document, item) found. starts: of each document."""
    none = np.empty((0, 2), dtype=np.int64)
    if not phrases["groups"] or not words:
        return none
    get = phrases["symbols"].get
    encoded = np.fromiter([get(w, 0) for w in words], dtype=np.int64, count=len(words))
    first, end = runs(encoded != 0)
    kept = end - first >= phrases["shortest"]
    first, end = first[kept], end[kept]
    if not len(first):
        return none
    owner, offset = expand(end - first + 1)
    place = first[owner] + offset
    symbols = np.where(place < end[owner], encoded[np.minimum(place, len(words) - 1)], 0)
    index = FMIndex(symbols)
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    pairs = []
    for rows, item_ends, item_list in phrases["groups"]:
        low, high = index.search(rows)
        phrase, offset = expand(high - low)
        if not len(phrase):
            continue
        at = place[index.locate(low[phrase] + offset)]
        np.add.at(cover, at, 1)
        np.add.at(cover, at + rows.shape[1], -1)
        document = np.searchsorted(starts, at, side="right") - 1
        found = np.unique(document * len(rows) + phrase)
        document, phrase = found // len(rows), found % len(rows)
        item_starts = np.concatenate(([0], item_ends[:-1]))
        which, offset = expand(item_ends[phrase] - item_starts[phrase])
        pairs.append(np.stack((document[which], item_list[item_starts[phrase][which] + offset]), axis=1))
    hit |= np.cumsum(cover[:-1]) > 0
    return np.concatenate(pairs) if pairs else none


def _judge_shard(texts: list[bytes], blocks: list) -> pa.Array:
    words: list[bytes] = (b" " + DOCUMENT_END + b" ").join(t.translate(WORD_TABLE) for t in texts).split()
    ends = np.array([i for i, w in enumerate(words) if w == DOCUMENT_END], dtype=np.int64)
    starts = np.concatenate(([0], ends + 1))
    counts = np.append(ends, len(words)) - starts
    hit = np.zeros(len(words), dtype=bool)
    items: list[set[str]] = [set() for _ in texts]
    for block in blocks:
        phrases = block.value
        for document, item in _search_shard(words, starts, phrases, hit):
            items[document].add(phrases["items"][item])
    spans: list[list[dict]] = [[] for _ in texts]
    first, end = runs(hit)
    for a, b, d in zip(first, end, np.searchsorted(starts, first, side="right") - 1):
        spans[d].append({"first": int(a - starts[d]), "last": int(b - 1 - starts[d])})
    total = np.concatenate(([0], np.cumsum(hit)))
    hits = total[starts + counts] - total[starts]
    return pa.StructArray.from_arrays(
        [
            pa.array(counts, pa.int64()),
            pa.array(hits, pa.int64()),
            pa.array([sorted(s) for s in items], pa.list_(pa.string())),
            pa.array(spans, pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64())]))),
        ],
        names=["n_words", "n_hit", "items", "spans"],
    )


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    keep: list[str],
    window: int = WINDOW,
    result: str = "contamination",
) -> DataFrame:
    """The columns ``keep`` of every document and a struct ``result``.

    The struct has n_words, n_hit (words inside any phrase), items (ids with occurring phrases, in
    string order) and spans (first and last word of each maximal stretch of hit words). A kept
    column of the same name as ``result`` gives way to it.
    """
    spark = documents.sparkSession
    keep = [c for c in keep if c != result]
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"),
        F.col("text").cast("binary").alias("body"),
    ).where("body IS NOT NULL")
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    parts = max(1, -(-total // BLOCK_BYTES))
    blocks = []
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(parts)) == part).collect()
        blocks.append(spark.sparkContext.broadcast(compile_phrases([(r[0], bytes(r[1])) for r in mine], window)))

    # the text goes to the workers once, kept or not
    inside = "text" in keep
    columns = [F.col(f"`{c}`") for c in keep]
    if not inside:
        columns.append(F.col("text").cast("binary").alias("__body"))
    text_at = keep.index("text") if inside else len(keep)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, texts, size = [], [], 0

        def finish() -> pa.RecordBatch:
            done = pa.Table.from_batches(rows).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays([*done.columns, _judge_shard(texts, blocks)], names=[*keep, result])

        for batch in small_batches(batches):
            bodies = [t or b"" for t in batch.column(text_at).cast(pa.binary()).to_pylist()]
            begin = 0
            for i, body in enumerate(bodies):
                size += len(body)
                if size >= 6 * SHARD_WORDS or i == len(bodies) - 1:
                    rows.append(batch.slice(begin, i + 1 - begin).select(range(len(keep))))
                    texts += bodies[begin : i + 1]
                    begin = i + 1
                    if size >= 6 * SHARD_WORDS:
                        yield finish()
                        rows, texts, size = [], [], 0
        if texts:
            yield finish()

    schema = T.StructType([*[documents.schema[c] for c in keep], T.StructField(result, RESULT)])
    return documents.select(*columns).mapInArrow(judge, schema)
