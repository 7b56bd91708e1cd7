"""SimHash near-duplicates by bit-sliced comparison.

A text's words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z. Its shingles are the runs of
``shingle`` words, repeats included, joined by one space (fewer words: the whole sequence). A bit of
the fingerprint is set where more than half of the shingles' XXH64 (seed 42) have it set. Null texts
and texts without words have fingerprint zero, which is linked like any other.

Fingerprints link at ``radius`` or fewer differing bits. Equal ones are folded first, so copies cost
nothing. Of four 16-bit blocks, two fingerprints within two bits share at least two, so each
fingerprint goes to the six buckets of its block pairs. Inside a bucket the fingerprints stand as
bit planes, 64 to a machine word; one fingerprint is compared with 64 at a time, the differing bits
are counted by carry-save counters (ones, twos, over), and words whose lanes are all over the radius
are abandoned. A bucket yields a star for each group that it connects, never all pairs.

A bucket of more than ``MOST_IN_BUCKET`` different fingerprints is not held in memory: its members
pass through to a second round over the 28 choices of six out of eight 8-bit blocks. There a bucket
has 16 free bits, hence at most 65,536 fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokewise.llm.common import connected_components, expand, id_key, join_labels, placed
from spokewise.session import stored

SHINGLE = 3
RADIUS = 2
MOST_IN_BUCKET = 4096
#: Comparisons (fingerprint, machine word) made at a time.
TASKS_AT_ONCE = 1 << 19

LOWER = bytes(c + 32 if 0x41 <= c <= 0x5A else 0x20 if c in range(0x09, 0x0E) else c for c in range(256))


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    words = (text or b"").translate(LOWER).split(b" ")
    words = [w for w in words if w]
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        [digest(joined[a:b], 42) for a, b in zip(starts[:n].tolist(), last.tolist())], np.uint64, n
    )
    set_ = np.zeros(64, dtype=np.int64)
    for begin in range(0, n, 65536):
        part = hashes[begin : begin + 65536]
        set_ += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_ > n, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, keep: list[str], shingle: int = SHINGLE) -> DataFrame:
    """The columns ``keep`` of every row and ``fingerprint``, a long that holds the 64 bits."""
    keep = [c for c in keep if c != "fingerprint"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            found = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            columns = [*batch.columns[:-1], pa.array(found.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, "fingerprint"])

    schema = T.StructType([*[documents.schema[c] for c in keep], T.StructField("fingerprint", T.LongType())])
    body = F.col("text").cast("binary").alias("__body")
    return documents.select(*keep, body).mapInArrow(run, schema)


def close_pairs(
    values: np.ndarray, group_starts: np.ndarray, radius: int
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (a < b) of one group whose values differ in at most ``radius`` bits.

    Groups are consecutive. Small ones share machine words; lanes of other groups are masked out.
    """
    n = len(values)
    group_ends = np.append(group_starts[1:], n)
    lanes = np.zeros(-(-n // 64) * 64, dtype=np.uint64)
    lanes[:n] = values
    bits = np.unpackbits(lanes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    planes = np.packbits(bits.T.copy(), axis=1, bitorder="little").view("<u8")
    end = np.repeat(group_ends, group_ends - group_starts)
    row = np.arange(n)
    first_word, last_word = (row + 1) >> 6, (end - 1) >> 6
    counts = np.where(end > row + 1, last_word - first_word + 1, 0)
    total = np.cumsum(counts)
    begin = 0
    while begin < n:
        done = total[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(total, done + TASKS_AT_ONCE, side="right")))
        owner, offset = expand(counts[begin:stop])
        owner += begin
        word = first_word[owner] + offset
        low = np.clip(owner + 1 - 64 * word, 0, 64)
        high = np.clip(end[owner] - 64 * word, 0, 64)
        alive = _ones_below(high) & ~_ones_below(low)
        yield from _compare(values, planes, owner, word, alive, radius)
        begin = stop


def _ones_below(n: np.ndarray) -> np.ndarray:
    """Words with the lowest n bits set, n from 0 to 64."""
    some = (np.uint64(1) << np.minimum(n, 63).astype(np.uint64)) - np.uint64(1)
    return np.where(n == 64, ~np.uint64(0), some)


def _compare(values, planes, owner, word, alive, radius) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    counters = np.zeros((max(1, radius.bit_length()), len(owner)), dtype=np.uint64)
    zero = np.uint64(0)
    for bit in range(64):
        mine = zero - ((values[owner] >> np.uint64(bit)) & np.uint64(1))
        carry = planes[bit, word] ^ mine
        # add one to the lanes that differ; a lane that passes the radius dies
        over = carry.copy()
        for k, counter in enumerate(counters):
            over &= counter if (radius >> k) & 1 else ~counter
        alive = alive & ~over
        for k in range(len(counters)):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        if bit % 8 == 7:
            kept = alive != 0
            if not kept.all():
                owner, word, alive, counters = owner[kept], word[kept], alive[kept], counters[:, kept]
            if not len(owner):
                return
    for begin in range(0, len(owner), 1 << 14):
        part = alive[begin : begin + (1 << 14)]
        lanes = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        task, lane = np.nonzero(lanes)
        yield owner[begin + task], 64 * word[begin + task] + lane


def _stars(values: np.ndarray, group_starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    labels = np.arange(len(values))
    for a, b in close_pairs(values, group_starts, radius):
        join_labels(labels, a, b)
    leaf = np.flatnonzero(labels != np.arange(len(values)))
    return values[leaf], values[labels[leaf]]


def _masks(blocks: int, equal: int) -> list[int]:
    width = 64 // blocks
    return [
        sum(((1 << width) - 1) << (width * b) for b in chosen) for chosen in combinations(range(blocks), equal)
    ]


def _bucket_links(distinct: DataFrame, blocks: int, radius: int, most: int | None) -> DataFrame:
    """Links (a, b) inside the buckets; (a, null) for members of buckets beyond ``most``."""
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in _masks(blocks, blocks - radius)]
    keys = [F.struct(F.lit(t).alias("t"), F.col("f").bitwiseAND(F.lit(m)).alias("bits")) for t, m in enumerate(signed)]
    placed = distinct.select("f", F.explode(F.array(*keys)).alias("k")).select("k.t", "k.bits", "f")
    placed = placed.repartition("t", "bits").sortWithinPartitions("t", "bits")

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((3, 0), dtype=np.int64)
        passing = None  # key of a bucket that is too large and goes through

        def out(a: np.ndarray, b: np.ndarray | None) -> pa.RecordBatch:
            second = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b.view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), second], names=["a", "b"])

        def settle(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            new = np.any(rows[:2, 1:] != rows[:2, :-1], axis=0)
            starts = np.concatenate(([0], np.flatnonzero(new) + 1))
            sizes = np.diff(np.append(starts, rows.shape[1]))
            if most is not None and (sizes > most).any():
                large = np.repeat(sizes > most, sizes)
                yield out(rows[2, large], None)
                rows, sizes = rows[:, ~large], sizes[sizes <= most]
            several = np.repeat(sizes > 1, sizes)
            sizes = sizes[sizes > 1]
            if len(sizes):
                values = np.ascontiguousarray(rows[2, several]).view(np.uint64)
                yield out(*_stars(values, np.cumsum(sizes) - sizes, radius))

        for batch in batches:
            rows = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)])
            if not rows.shape[1]:
                continue
            rows = np.concatenate((rest, rows), axis=1)
            key = tuple(rows[:2, -1])
            open_ = np.all(rows[:2] == rows[:2, -1:], axis=0)
            whole, rest = rows[:, ~open_], rows[:, open_]
            if passing is not None:
                same = np.all(whole[:2] == np.array(passing)[:, None], axis=0)
                yield out(whole[2, same], None)
                whole = whole[:, ~same]
                passing = passing if passing == key else None
            if whole.shape[1]:
                yield from settle(whole)
            if most is not None and (passing is not None or rest.shape[1] > most):
                yield out(rest[2], None)
                passing, rest = key, rest[:, :0]
        if rest.shape[1]:
            yield from settle(rest)

    return placed.mapInArrow(link, "a long, b long")


def near_duplicates(marked: DataFrame, radius: int = RADIUS, most: int = MOST_IN_BUCKET) -> DataFrame:
    """(fingerprint, component) of every fingerprint that has a partner.

    component is a fingerprint too, the same for all that reach each other by links. ``marked``
    should be stored: it is read twice. The radius may be 1 or 2.
    """
    distinct = marked.select(F.col("fingerprint").alias("f")).distinct()
    first = stored(_bucket_links(distinct, 4, radius, most), "simhash-links")
    crowded = first.where("b IS NULL").select(F.col("a").alias("f")).distinct()
    again = _bucket_links(crowded, 8, radius, None)
    links = first.where("b IS NOT NULL").union(again)
    found = connected_components(links, "simhash-components")
    return found.select(F.col("id").alias("fingerprint"), F.col("root").alias("component"))


def components(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Every row of ``marked`` (doc_id, fingerprint) with component_id, the smallest doc_id reached.

    Null ids are passed over in that choice; a component of null ids alone has a null component_id.
    """
    linked = near_duplicates(marked, radius)
    least = marked.groupBy("fingerprint").agg(F.min("doc_id").alias("own"))
    known = least.join(linked, "fingerprint", "left").withColumn(
        "component", F.coalesce("component", "fingerprint")
    )
    smallest = known.groupBy("component").agg(F.min("own").alias("component_id"))
    named = known.join(smallest, "component").select("fingerprint", "component_id")
    return marked.join(named, "fingerprint").select("doc_id", "fingerprint", "component_id")


def keep_one(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents without all but one of each component.

    The one with the smallest id stays, of equal ids the first in the table; null counts as the
    smallest id. Rows are told apart by their place in the table: see ``common.placed``.
    """
    names = {c: f"c{i}" for i, c in enumerate(documents.columns)}
    kept = [F.col(f"`{c}`").alias(name) for c, name in names.items()]
    rows = placed(documents, id_key().alias("k1"), *kept)
    texts = rows.select("rid", "k1", F.col(names["text"]).alias("text"))
    marked = stored(fingerprints(texts, ["k1", "rid"], shingle), "fingerprints")
    linked = near_duplicates(marked, radius)
    place = F.struct("k1", "rid")
    first = marked.groupBy("fingerprint").agg(F.min(place).alias("own"))
    known = first.join(linked, "fingerprint", "left").withColumn("root", F.coalesce("component", "fingerprint"))
    stays = known.groupBy("root").agg(F.min("own").alias("stays"))
    chosen = known.join(stays, "root").select("fingerprint", "stays")
    gone = marked.join(chosen, "fingerprint").where(place != F.col("stays")).select("rid")
    left = rows.join(stored(gone, "removed"), "rid", "left_anti")
    return left.drop("rid", "k1").toDF(*documents.columns)
