"""Substring dedup by repeated-phrase automata.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; a window is ``WINDOW`` consecutive words of a document.
A word goes if it lies in a window whose word sequence also starts earlier: in a document with a
smaller id, in a document with the same id that stands before in the table, or before in the same
document. Windows are judged on the input.

Passages that may recur are brought together by their anchors (see ``recurring``). Each task takes the
passages of its anchors, shard by shard: it counts their windows, which confirms those that recur, compiles one
Aho-Corasick automaton over the confirmed ones, and streams the shard's stretches of all documents through it
to locate every occurrence; the earliest one stays. Stretches without a recurring anchor hold no
recurring window and are never sent; equal stretches are folded on the way, and the automaton meets
one of them. An automaton's alphabet is the shard's words, one character for each, so matches are exact.

Null texts and texts of fewer words than a window lose nothing. A null id counts as the smallest.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from spokewise.llm.common import runs, small_batches
from spokewise.llm.recurring import Units, covered, mask_of, numbered, recurring_regions, with_covers

WINDOW = 20
GRAM = 6
SPACES = bytes(0x20 if c in range(0x09, 0x0E) else c for c in range(256))


def cut_words(body: bytes) -> list[bytes]:
    return [w for w in body.translate(SPACES).split(b" ") if w]


def _codes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.fromiter([digest(w) for w in words], np.uint64, len(words))


def _write(words: list[bytes], start: int, end: int) -> bytes:
    return b" ".join(words[start:end])


def _window_of(body: bytes, i: int, window: int) -> bytes:
    return b" ".join(body.split(b" ")[i : i + window])


def word_units(window: int = WINDOW, gram: int = GRAM) -> Units:
    return Units(window, min(gram, window), cut_words, _codes, _write, _window_of)


def locate(groups: list[list[tuple]], units: Units) -> Iterator[tuple]:
    """(rid, lo, n) of windows in the given passages that occur earlier in another of them."""
    if not groups:
        return
    letters: dict[bytes, str] = {}
    passages = []
    for k1, rid, lo, n, rel, body, times in (r for group in groups for r in group):
        words = body.split(b" ")
        for w in words:
            if w not in letters:
                code = len(letters) + 1
                letters[w] = chr(code if code < 0xD800 else code + 0x800)
        passages.append(((k1, rid, lo), "".join(map(letters.__getitem__, words))))
    once: set[str] = set()
    automaton = ahocorasick.Automaton()
    for _, text in passages:
        for i in range(len(text) - units.window + 1):
            window = text[i : i + units.window]
            if window not in once:
                once.add(window)
            elif window not in automaton:  # confirmed
                automaton.add_word(window, len(automaton))
    if not len(automaton):
        return
    automaton.make_automaton()
    first: dict[int, tuple] = {}
    found = []
    for (k1, rid, lo), text in passages:
        for end, pattern in automaton.iter(text):
            place = (k1, rid, lo + end - units.window + 1)
            found.append((pattern, place))
            if pattern not in first or place < first[pattern]:
                first[pattern] = place
    for pattern, place in found:
        if place != first[pattern]:
            yield place[1], place[2], 1


def drop_repeated_passages(documents: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, n_words, n_removed, removed, text) of every document.

    removed has the first and last word of each stretch that goes; text is the rest, joined by one
    space.
    """
    units = word_units(window, gram)
    rows = numbered(documents)
    covers = covered(recurring_regions(rows, units), units, True, locate)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "n_words", "n_removed", "removed", "text"]
        span = pa.struct([("first", pa.int64()), ("last", pa.int64())])
        kinds = [pa.int64(), pa.int64(), pa.list_(span), pa.string()]
        for batch in small_batches(batches):
            out: list[list] = [[] for _ in kinds]
            for i, body in enumerate(batch.column(1).to_pylist()):
                words = cut_words(body or b"")
                gone = mask_of(batch.column(2)[i], len(words), units.window)
                kept = words
                if gone.any():
                    kept = [words[k] for k in np.flatnonzero(~gone)]
                spans = [{"first": int(a), "last": int(b) - 1} for a, b in zip(*runs(gone))]
                values = (len(words), len(words) - len(kept), spans, b" ".join(kept).decode())
                for column, value in zip(out, values):
                    column.append(value)
            columns = [batch.column(0), *(pa.array(v, k) for v, k in zip(out, kinds))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_words long, n_removed long, removed array<struct<first:long,last:long>>, text string"
    return with_covers(rows, covers).mapInArrow(run, schema)
