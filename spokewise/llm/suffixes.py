"""Suffix dedup by a depth-limited radix sort.

Texts are UTF-8 bytes; a byte goes if it lies in a string of ``WINDOW`` bytes that also starts
anywhere else, in its own document or another. Strings are judged on the input.

Suffixes are ordered through ``WINDOW`` bytes only, by most-significant-digit passes: groups of
suffixes that agree so far are split by their next eight bytes, and groups of one are dropped. What
is left after the last pass agrees in the whole window; these equal groups are the repeated
strings. The first digit is the anchor (see ``recurring``) and the suffix's distance from it, by
which Spark deals the suffixes out; equal regions were folded before.

Null texts are empty; texts shorter than a window lose nothing; equal rows are each other's copies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from spokewise.llm.common import expand, runs, small_batches
from spokewise.llm.recurring import Units, covered, mask_of, numbered, recurring_regions, with_covers

WINDOW = 200
GRAM = 32
DIGIT = 8


def _codes(body: bytes) -> np.ndarray:
    return np.frombuffer(body, np.uint8).astype(np.uint64) + np.uint64(1)


def byte_units(window: int = WINDOW, gram: int = GRAM) -> Units:
    return Units(window, min(gram, window), bytes, _codes, _write, _window_of)


def _write(body: bytes, start: int, end: int) -> bytes:
    return body[start:end]


def _window_of(body: bytes, i: int, window: int) -> bytes:
    return body[i : i + window]


def equal_groups(data: bytes, at: np.ndarray, first: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(index into ``at``, group) of the suffixes that agree with another in ``first`` and ``depth`` bytes."""
    padded = data + bytes(DIGIT)
    digits = np.ndarray((len(data) + 1,), dtype=">u8", buffer=padded, strides=(1,))
    index, group = np.arange(len(at)), first

    def split(keys: np.ndarray) -> None:
        nonlocal index, group
        order = np.lexsort((keys, group))
        g, k = group[order], keys[order]
        new = np.concatenate(([True], (g[1:] != g[:-1]) | (k[1:] != k[:-1])))
        alone = new & np.append(new[1:], True)
        group = np.cumsum(new)[~alone]
        index = index[order][~alone]

    split(np.zeros(len(at), dtype=np.uint64))
    for done in range(0, depth, DIGIT):
        if not len(index):
            break
        keys = digits[at[index] + done].astype(np.uint64)
        if depth - done < DIGIT:
            keys >>= np.uint64(8 * (DIGIT - depth + done))
        split(keys)
    return index, group


def sort_windows(groups: list[list[tuple]], units: Units) -> Iterator[tuple]:
    """(rid, lo, n) of windows in the given regions that occur more than once among them."""
    regions = [(g, r) for g, group in enumerate(groups) for r in group]
    if not regions:
        return
    bodies = [r[5] for _, r in regions]
    n = np.array([r[3] for _, r in regions], dtype=np.int64)
    lengths = np.fromiter(map(len, bodies), np.int64, len(bodies))
    owner, offset = expand(n)
    at = (np.cumsum(lengths) - lengths)[owner] + offset
    g = np.array([g for g, _ in regions], dtype=np.int64)
    rel = np.array([r[4] for _, r in regions], dtype=np.int64)
    first = g[owner] * units.window + rel[owner] - offset
    index, _ = equal_groups(b"".join(bodies), at, first, units.window)
    repeated = np.zeros(len(at), dtype=bool)
    repeated[index] = True
    begin = np.cumsum(n) - n
    for k, (_, r) in enumerate(regions):
        if r[6] == 1:  # regions with copies are covered already
            for a, b in zip(*runs(repeated[begin[k] : begin[k] + n[k]])):
                yield r[1], r[2] + int(a), int(b - a)


def drop_repeated_bytes(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_bytes, n_removed, removed, kept) of every document.

    removed has the first and last byte of each stretch that goes; kept is the rest, as binary, since
    a stretch may end inside a character.
    """
    units = byte_units(window, gram)
    rows = numbered(documents)
    covers = covered(recurring_regions(rows, units), units, False, sort_windows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_bytes", "n_removed", "removed", "kept"]
        span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
        kinds = [pa.int64(), pa.int64(), pa.list_(span), pa.binary()]
        for batch in small_batches(batches):
            out: list[list] = [[] for _ in kinds]
            for i, body in enumerate(batch.column(1).to_pylist()):
                body = body or b""
                gone = mask_of(batch.column(2)[i], len(body), units.window)
                spans = [{"first": int(a), "last": int(b) - 1} for a, b in zip(*runs(gone))]
                kept = np.frombuffer(body, np.uint8)[~gone].tobytes() if spans else body
                for column, value in zip(out, (len(body), len(body) - len(kept), spans, kept)):
                    column.append(value)
            columns = [batch.column(0), *(pa.array(v, k) for v, k in zip(out, kinds))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_bytes long, n_removed long, removed array<struct<first:long,last:long>>, kept binary"
    return with_covers(rows, covers).mapInArrow(run, schema)
