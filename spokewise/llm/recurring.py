"""Passages that recur: candidate search by anchors, shared by the two substring operators.

A window is ``window`` consecutive units (words or bytes) of one document. Its anchor is the leftmost
of its ``gram``-unit grams with the least hash, so equal windows have equal anchors at equal places. A
stretch of consecutive windows with one anchor is a region, about half a window more than a window
long. Only regions whose anchor occurs at least twice can hold a window that recurs; the search
counts anchors over all documents, brings the recurring ones back to their documents, and emits those
regions. Equal regions then meet in one group per anchor.

Documents are told apart by their place in the table, by which those with equal ids are ordered: see
``common.placed``.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.llm.common import id_key, placed, small_batches
from spokewise.session import stored

BASE = 0x9E3779B97F4A7C15
#: Units that are hashed at a time; longer documents are cut with an overlap of a window.
SEGMENT = 1 << 19
#: Different regions of one anchor that are compared in memory; more are compared window by window.
MOST_VARIANTS = 20_000
#: Different regions that a task folds at a time, and their bytes.
MOST_FOLDED, MOST_FOLDED_BYTES = 100_000, 32 << 20
#: Windows that are compared at a time.
CHUNK_WINDOWS = 40_000

REGION = "h long, rh long, k1 long, rid binary, lo long, n int, rel int, body binary, times int"
COVER = "rid binary, lo long, n int, h long, w1 long, w2 long, k1 long"


@dataclass(frozen=True)
class Units:
    """How a text is cut into units, and a stretch of them written down."""

    window: int
    gram: int
    cut: Callable[[bytes], object]
    codes: Callable[[object], np.ndarray]
    write: Callable[[object, int, int], bytes]
    window_of: Callable[[bytes, int, int], bytes]


def powers() -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        p = np.full(SEGMENT + 1, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def regions_of(codes: np.ndarray, units: Units, table: tuple[np.ndarray, np.ndarray]):
    """(anchor hash, first window, number of windows, anchor's distance from it) of each region."""
    found = []
    step = SEGMENT - units.window + 1
    for begin in range(0, max(len(codes) - units.window + 1, 0), step):
        part = codes[begin : begin + SEGMENT]
        n = len(part) - units.window + 1
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(part * table[0][: len(part)], dtype=np.uint64)))
        grams = (sums[units.gram :] - sums[: -units.gram]) * table[1][: len(part) - units.gram + 1]
        grams ^= grams >> np.uint64(32)
        grams *= np.uint64(0xD6E8FEB86659FD93)
        grams ^= grams >> np.uint64(32)
        low = np.uint64((1 << 20) - 1)
        least = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
        width, size = units.window - units.gram + 1, 1
        while 2 * size <= width:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        least = np.minimum(least[:n], least[width - size : width - size + n])
        at = (least & low).astype(np.int64)
        lo = np.concatenate(([0], np.flatnonzero(at[1:] != at[:-1]) + 1))
        found.append((grams[at[lo]], begin + lo, np.diff(np.append(lo, n)), at[lo] - lo))
    if not found:
        empty = np.empty(0, dtype=np.int64)
        return empty.astype(np.uint64), empty, empty, empty
    return tuple(np.concatenate(c) for c in zip(*found))


def numbered(documents: DataFrame) -> DataFrame:
    """(rid, k1, doc_id, body): place in the table, comparable id, id, text as bytes."""
    return placed(documents, id_key().alias("k1"), "doc_id", F.col("text").cast("binary").alias("body"))


def _anchors(documents: DataFrame, units: Units) -> DataFrame:
    """(h, rid) of the anchors of every document; one that a document repeats is there twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = powers()
        for batch in small_batches(batches):
            hashes, rows = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for row, body in enumerate(batch.column(1).to_pylist()):
                h = regions_of(units.codes(units.cut(body or b"")), units, table)[0]
                h, times = np.unique(h, return_counts=True)
                h = np.repeat(h, np.minimum(times, 2))
                hashes.append(h)
                rows.append(np.full(len(h), row))
            rids = batch.column(0).take(pa.array(np.concatenate(rows)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(hashes).view(np.int64)), rids], names=["h", "rid"]
            )

    return documents.select("rid", "body").mapInArrow(run, "h long, rid binary")


def _regions(documents: DataFrame, units: Units) -> DataFrame:
    """Regions at recurring anchors; ``documents`` has their hashes in ``hs``.

    A task folds the equal regions that it meets: the earliest goes on with their number, and the
    others leave at once as rows without a body, under a key that spreads them.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = powers()
        names = ["h", "rh", "k1", "rid", "lo", "n", "rel", "body", "times"]
        kinds = [pa.int64()] * 3 + [pa.binary(), pa.int64()] + [pa.int32()] * 2 + [pa.binary(), pa.int32()]
        folded: dict[tuple[int, int], list] = {}
        size, out = 0, []

        def batch_of(rows: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names=names)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal size
            whole = [(*key, *place, n, rel, body, times) for key, (place, n, rel, body, times) in folded.items()]
            for begin in range(0, len(whole), 20_000):
                yield batch_of(whole[begin : begin + 20_000])
            folded.clear()
            size = 0

        for batch in small_batches(batches):
            rids, k1s = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            wanted = batch.column(3)
            for i, (rid, k1, body) in enumerate(zip(rids, k1s, batch.column(2).to_pylist())):
                text = units.cut(body or b"")
                h, lo, n, rel = regions_of(units.codes(text), units, table)
                hs = wanted[i].values.to_numpy().view(np.uint64)
                spread = xxhash.xxh64_intdigest(rid) - (1 << 63)
                chosen = np.isin(h, hs)
                columns = (h.view(np.int64)[chosen], lo[chosen], n[chosen], rel[chosen])
                for a, b, c, d in zip(*(v.tolist() for v in columns)):
                    content = units.write(text, b, b + c - 1 + units.window)
                    key, place = (a, xxhash.xxh64_intdigest(content, d) - (1 << 63)), (k1, rid, b)
                    known = folded.get(key)
                    if known is None or known[2] != d or known[3] != content:
                        if known is None:
                            folded[key] = [place, c, d, content, 1]
                            size += len(content)
                        else:  # another region with this hash goes on by itself
                            out.append((*key, *place, c, d, content, 1))
                        continue
                    known[4] += 1
                    later = max(place, known[0])
                    known[0] = min(place, known[0])
                    out.append((spread, 0, *later, c, 0, None, 0))
            if len(out) >= 20_000:
                yield batch_of(out)
                out.clear()
            if len(folded) > MOST_FOLDED or size > MOST_FOLDED_BYTES:
                yield from flush()
        yield from flush()
        if out:
            yield batch_of(out)

    return documents.select("rid", "k1", "body", "hs").mapInArrow(run, REGION)


def recurring_regions(documents: DataFrame, units: Units) -> DataFrame:
    """REGION rows of ``documents`` (from ``numbered``) whose anchor occurs at least twice."""
    anchors = stored(_anchors(documents, units), "anchors")
    recurring = anchors.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h")
    back = anchors.join(recurring, "h", "left_semi").groupBy("rid").agg(F.collect_set("h").alias("hs"))
    return _regions(documents.join(back, "rid"), units)


def covered(
    regions: DataFrame, units: Units, keep_first: bool, compare: Callable[[list[list[tuple]], Units], Iterator[tuple]]
) -> DataFrame:
    """(rid, lo, n): windows lo, lo + 1, ... of a document that recur.

    Equal regions of different tasks are folded as they stream by: with ``keep_first`` every one but the first is
    covered, else all of them. ``compare`` takes groups of the different regions of one anchor,
    each (k1, rid, lo, n, rel, body, times), and yields (rid, lo, n). The regions of an anchor that
    has more than ``MOST_VARIANTS`` different ones go through as single windows and are compared
    by their 128-bit hash in an ordinary aggregation.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["rid", "lo", "n", "h", "w1", "w2", "k1"]
        kinds = [pa.binary(), pa.int64(), pa.int32()] + [pa.int64()] * 4
        out: list[tuple] = []
        ready: list[list[tuple]] = []
        waiting = 0
        group_h, group, crowded = None, [], False
        run_rh, rep, times = None, None, 0

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        def single(region: tuple) -> Iterator[tuple]:
            k1, rid, lo, n, rel, body, _ = region
            for i in range(n):
                digest = xxhash.xxh3_128_digest(units.window_of(body, i, units.window))
                w1, w2 = np.frombuffer(digest, "<i8").tolist()
                yield rid, lo + i, 1, group_h, w1, w2, k1

        def end_run() -> None:
            nonlocal rep, crowded
            if rep is None:
                return
            region = (*rep, times)
            if times > 1 and not keep_first:
                out.append((rep[1], rep[2], rep[3], None, None, None, None))
            group.append(region)
            rep = None
            if len(group) > MOST_VARIANTS or crowded:
                crowded = True
                for r in group:
                    out.extend(single(r))
                group.clear()

        def end_group() -> None:
            nonlocal waiting, crowded, group
            end_run()
            if len(group) > 1:
                ready.append(group)
                waiting += sum(r[3] for r in group)
            group, crowded = [], False

        for batch in small_batches(batches, 2000):
            for h, rh, k1, rid, lo, n, rel, body, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if body is None:  # folded before
                    out.append((rid, lo, n, None, None, None, None))
                    continue
                if h != group_h:
                    end_group()
                    group_h, run_rh = h, None
                    if waiting >= CHUNK_WINDOWS:
                        out.extend((*c, None, None, None, None) for c in compare(ready, units))
                        ready, waiting = [], 0
                if rh == run_rh and rep is not None and rep[5] == body and rep[4] == rel:
                    times += copies
                    out.append((rid, lo, n, None, None, None, None))
                else:
                    end_run()
                    run_rh, rep, times = rh, (k1, rid, lo, n, rel, body), copies
                if len(out) >= 50_000:
                    yield batch_of(out)
                    out.clear()
        end_group()
        out.extend((*c, None, None, None, None) for c in compare(ready, units))
        if out:
            yield batch_of(out)

    ordered = regions.repartition("h").sortWithinPartitions("h", "rh", "k1", "rid", "lo")
    found = stored(ordered.mapInArrow(run, COVER), "recurring")
    windows = found.where("w1 IS NOT NULL")
    place = F.struct("k1", "rid", "lo")
    known = windows.groupBy("h", "w1", "w2").agg(F.min(place).alias("first"), F.count("*").alias("times"))
    judged = windows.join(known, ["h", "w1", "w2"])
    judged = judged.where(place != F.col("first")) if keep_first else judged.where("times > 1")
    return found.where("w1 IS NULL").select("rid", "lo", "n").union(judged.select("rid", "lo", "n"))


def with_covers(documents: DataFrame, covers: DataFrame) -> DataFrame:
    """(doc_id, body, covers): every document with its covered windows as arrays of (lo, n), or null."""
    lists = covers.groupBy("rid").agg(F.collect_list(F.struct("lo", "n")).alias("covers"))
    return documents.join(lists, "rid", "left").select("doc_id", "body", "covers")


def mask_of(covers: pa.Scalar, length: int, window: int) -> np.ndarray:
    """Units of a document that its covered windows cover."""
    edge = np.zeros(length + 1, dtype=np.int64)
    if covers.is_valid:
        lo = covers.values.field("lo").to_numpy()
        n = covers.values.field("n").to_numpy()
        np.add.at(edge, lo, 1)
        np.add.at(edge, lo + n - 1 + window, -1)
    return np.cumsum(edge[:-1]) > 0
