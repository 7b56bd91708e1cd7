"""Packing by cutting-stock column generation.

A document is its token ids followed by an end id. It is cut into whole sequences and a rest; rests
are the items of a cutting-stock problem over their length histogram, which has at most
``length - 1`` bars however large the corpus. A linear program over patterns (how many rests of each
length fill a sequence) is solved by column generation from a triangular basis of full sequences: the simplex multipliers price lengths, and an
unbounded-knapsack dynamic program finds the best new pattern. Patterns are rounded down and given
to the rests by their rank within their length, an arithmetic of counts that needs no join with the
other rests. Rests beyond the rounded patterns, and those of patterns that would waste more than
``MOST_WASTE`` of a sequence, form one stream that is cut at sequence borders, so it is padded at its end
only; that end is cut into powers of two, which need no padding.

Null texts are empty and consist of the end id; rows with equal ids are packed one by one; a null
doc_id stays null. An empty table gives no pieces.
"""

from __future__ import annotations

import sys
import types
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.llm.common import expand, small_batches
from spokewise.session import stored

LENGTH = 1024
END_ID = 0
#: Share of a sequence that a pattern may leave empty.
MOST_WASTE = 0.004
#: Simplex steps at most; the plan is valid after any number.
MOST_STEPS = 200
#: The linear program ends this close to the bound of no waste at all.
GAP = 5e-4
#: A worker forgets the older half of its words beyond so many different ones.
MOST_TOKENS_KNOWN = 1 << 19
#: Characters whose words are looked up together.
GROUP_CHARACTERS = 1 << 19
HASH_BASE = 0x9E3779B97F4A7C15

CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")


def character_kinds() -> np.ndarray:
    """For each code point 0 letter, 1 number, 2 white space, 3 other, as the pre-tokenizer sees it."""
    import regex

    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    kinds = np.full(0x110000, 3, dtype=np.uint8)
    for kind, pattern in ((0, r"\p{L}+"), (1, r"\p{N}+"), (2, r"\s+")):
        for found in regex.finditer(pattern, everything):
            skip = [0x800 if at >= 0xD800 else 0 for at in (found.start(), found.end() - 1)]
            kinds[found.start() + skip[0] : found.end() + skip[1]] = kind
    return kinds


def words_from(points: np.ndarray, kinds: np.ndarray) -> np.ndarray:
    """Starts of the pre-tokenizer's words in a text of code points.

    A word is a run of one kind with the blank before it; white space before that blank is a word;
    the usual English contractions stand alone.
    """
    n = len(points)
    if not n:
        return np.empty(0, dtype=np.int64)
    kind = kinds[points]
    start = np.concatenate(([True], kind[1:] != kind[:-1]))
    # the last white-space character before something else leaves its run, and a blank joins that
    last_space = np.flatnonzero((kind[:-1] == 2) & (kind[1:] != 2))
    start[last_space] = True
    start[last_space[points[last_space] == 0x20] + 1] = False
    for at in np.flatnonzero(points == 0x27):
        if start[at] and points[at] == 0x27 and at + 1 < n and kind[at + 1] == 0:
            tail = "'" + "".join(map(chr, points[at + 1 : at + 3]))
            for c in CONTRACTIONS:
                if tail.startswith(c):
                    start[at + 1] = False
                    if at + len(c) < n:
                        start[at + len(c)] = True
                    break
    return np.flatnonzero(start)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary: its own where it prints."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(others)}


class Encoder:
    """Token ids of texts, a word at a time, as words do not influence each other.

    The words of some texts are told apart by hashes of their characters, checked character by
    character, so that each different word is cut out and looked up once; its ids are remembered.
    Texts that hold a special token, and tokenizers of another make than byte-level pairs, go through
    the tokenizer whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.width.itemsize == 2 else "I"
        self.by_word = type(self.tokenizer.pre_tokenizer).__name__ == "ByteLevel" and not self.tokenizer.normalizer
        self.kinds = character_kinds() if self.by_word else None
        self.letters = "".join(byte_letters()[b] for b in range(256))
        self.known: dict[str, bytes] = {}
        self.powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def _ids(self, word: str) -> bytes:
        letters = word.encode().decode("latin-1").translate(self.letters)
        return array(self.code, [t.id for t in self.tokenizer.model.tokenize(letters)]).tobytes()

    def _look_up(self, words: list[str]) -> list[bytes]:
        out = list(map(self.known.get, words))
        for i, ids in enumerate(out):
            if ids is None:
                if len(self.known) >= MOST_TOKENS_KNOWN:  # the older half goes
                    self.known = dict(islice(self.known.items(), len(self.known) // 2, None))
                self.known[words[i]] = out[i] = self._ids(words[i])
        return out

    def _hashes(self, points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """A hash of the characters of each word, whatever its place."""
        n = len(points)
        if len(self.powers[0]) <= n:
            for k, base in enumerate((HASH_BASE, pow(HASH_BASE, -1, 1 << 64))):
                table = np.full(n + 1, base, dtype=np.uint64)
                table[0] = 1
                self.powers[k] = np.multiply.accumulate(table)
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((points + np.uint32(1)) * self.powers[0][:n], out=sums[1:])
        found = (sums[ends] - sums[starts]) * self.powers[1][starts]
        return found ^ (found >> np.uint64(31)) ^ ((ends - starts).astype(np.uint64) << np.uint64(48))

    def _encode_words(self, text: str, points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each word) of a text whose words begin at ``starts``, the first at 0."""
        ends = np.append(starts[1:], len(points))
        lengths = ends - starts
        _, first, which = np.unique(self._hashes(points, starts, ends), return_index=True, return_inverse=True)
        owner, offset = expand(lengths)
        same = (lengths == lengths[first][which]).all()
        if not (same and (points == points[starts[first][which][owner] + offset]).all()):
            first = which = np.arange(len(starts))  # two words with one hash
        cut = [text[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        found = self._look_up(cut)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width.itemsize
        begins = np.cumsum(sizes) - sizes
        owner, offset = expand(sizes[which])
        return np.frombuffer(b"".join(found), self.width)[begins[which][owner] + offset], sizes[which]

    def _whole(self, text: str) -> bool:
        return not self.by_word or any(s in text for s in self.special)

    def encode(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list = [None] * len(texts)
        group: list[tuple[int, str, np.ndarray, np.ndarray]] = []
        size = 0
        for i, text in enumerate(texts):
            if self._whole(text):
                out[i] = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.width)
                continue
            points = np.frombuffer(text.encode("utf-32-le"), "<u4")
            starts = words_from(points, self.kinds)
            if len(points) > GROUP_CHARACTERS:
                out[i] = self._long(text, points, starts)
                continue
            group.append((i, text, points, starts))
            size += len(points)
            if size >= GROUP_CHARACTERS:
                self._settle(group, out)
                group, size = [], 0
        self._settle(group, out)
        return out

    def _settle(self, group: list, out: list) -> None:
        group, none = [g for g in group if len(g[3])], [g for g in group if not len(g[3])]
        for i, *_ in none:
            out[i] = np.empty(0, self.width)
        if not group:
            return
        at = np.cumsum([0] + [len(points) for _, _, points, _ in group])
        starts = np.concatenate([starts + begin for (_, _, _, starts), begin in zip(group, at)])
        text, points = "".join(g[1] for g in group), np.concatenate([g[2] for g in group])
        ids, sizes = self._encode_words(text, points, starts)
        words = np.cumsum([0] + [len(g[3]) for g in group])
        cuts = np.concatenate(([0], np.cumsum(sizes)))[words]
        for k, (i, *_) in enumerate(group):
            out[i] = ids[cuts[k] : cuts[k + 1]]

    def _long(self, text: str, points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A long text, by stretches of words."""
        found, k = [], 0
        while k < len(starts):
            after = max(k + 1, int(np.searchsorted(starts, starts[k] + GROUP_CHARACTERS)))
            a, b = int(starts[k]), int(starts[after]) if after < len(starts) else len(points)
            found.append(self._encode_words(text[a:b], points[a:b], starts[k:after] - a)[0])
            k = after
        return np.concatenate(found)


def worker_encoder(path: str) -> Encoder:
    """One encoder for each worker process and tokenizer, which outlives a task.

    Tasks get this module by value, so it is kept under a name of its own.
    """
    kept = sys.modules.setdefault("_spokewise_encoders", types.ModuleType("_spokewise_encoders"))
    if path not in vars(kept):
        setattr(kept, path, Encoder(path))
    return getattr(kept, path)


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def tokenize(documents: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """Pieces of every document: whole sequences, and a rest with its ids.

    (doc_id, start, size, crc, doc_tokens, part, number, ids): ids is null for whole sequences;
    part and number tell the rests apart and give each its place among those of its size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path)
        part, seen = TaskContext.get().partitionId(), np.zeros(length, dtype=np.int64)
        names = ["doc_id", "start", "size", "crc", "doc_tokens", "part", "number", "ids"]
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
        for batch in small_batches(batches):
            row, out = [], [[] for _ in kinds]
            for i, ids in enumerate(encoder.encode_all([t or "" for t in batch.column(1).to_pylist()])):
                ids = np.append(ids, np.array([END_ID], dtype=encoder.width))
                written = memoryview(ids.astype("<u4").tobytes())
                for start in range(0, len(ids), length):
                    size = min(length, len(ids) - start)
                    rest = size < length
                    number = int(seen[size]) if rest else 0
                    if rest:
                        seen[size] += 1
                    row.append(i)
                    body = ids[start:].tobytes() if rest else None
                    checked = zlib.crc32(written[4 * start : 4 * (start + size)])
                    for column, value in zip(out, (start, size, checked, len(ids), part, number, body)):
                        column.append(value)
            columns = [batch.column(0).take(pa.array(row, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(v, k) for v, k in zip(out, kinds))], names=names)

    kind = documents.schema["doc_id"].dataType.simpleString()
    schema = (
        f"doc_id {kind}, start long, size int, crc long, doc_tokens long, part int, number long, ids binary"
    )
    return documents.select("doc_id", "text").mapInArrow(run, schema)


def _price(prices: np.ndarray, sizes: np.ndarray, length: int) -> tuple[float, np.ndarray]:
    """The most valuable pattern: an unbounded knapsack over the sizes."""
    value = np.zeros(length + 1)
    for room in range(int(sizes[0]), length + 1):
        fits = sizes[: np.searchsorted(sizes, room, side="right")]
        value[room] = max(value[room - 1], (value[room - fits] + prices[: len(fits)]).max())
    pattern, room = np.zeros(len(sizes)), length
    while room >= sizes[0]:
        if value[room] <= value[room - 1] + 1e-15:
            room -= 1
            continue
        fits = sizes[: np.searchsorted(sizes, room, side="right")]
        k = int((value[room - fits] + prices[: len(fits)]).argmax())
        pattern[k] += 1
        room -= int(sizes[k])
    return float(value[length]), pattern


def _first_columns(sizes: np.ndarray, demand: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A feasible basis of full sequences, and its inverse; each step uses up one size.

    The largest size left is filled up by one size, two sizes, or else the fullest knapsack of what is
    left. No later column has the size that a column uses up, so the basis is triangular.
    """
    m, left = len(sizes), demand.copy()
    basis, inverse, at = np.zeros((m, m)), np.eye(m), np.full(length + 1, -1)
    at[sizes] = np.arange(m)
    for step in range(m):
        there = np.flatnonzero(left > 0)
        column = np.zeros(m)
        column[there[-1]] = 1
        room = length - int(sizes[there[-1]])
        while room >= sizes[there[0]]:
            other = at[room]
            if other >= 0 and left[other] > 0:
                column[other] += 1
                break
            small = there[sizes[there] < room]
            pair = at[room - sizes[small]]
            amount = np.where(pair >= 0, np.minimum(left[small], left[pair]), 0)
            if len(amount) and amount.max() > 0:
                k = int(amount.argmax())
                column[small[k]] += 1
                column[pair[k]] += 1
                break
            column[there] += _price(sizes[there].astype(float), sizes[there], room)[1]
            break
        used = np.flatnonzero(column)
        times = left[used] / column[used]
        out = used[int(times.argmin())]
        left[used] = np.maximum(left[used] - times.min() * column[used], 0)
        left[out] = 0
        basis[:, out] = column
        _exchange(inverse, _applied(inverse, column), out)
        emptied = used[left[used] <= 1e-9]
        left[emptied[emptied != out]] = 1e-7  # keeps its own column, of nearly nothing
    return basis, inverse


def _applied(inverse: np.ndarray, column: np.ndarray) -> np.ndarray:
    """inverse @ column for a column of few entries; small sums need no threads of a linear-algebra library."""
    used = np.flatnonzero(column)
    return (inverse[:, used] * column[used]).sum(axis=1)


def _exchange(inverse: np.ndarray, change: np.ndarray, leave: int) -> None:
    """Update the inverse, in place, for a basis column replaced by one that ``change`` comes from."""
    row = inverse[leave] / change[leave]
    rows = np.flatnonzero(change)
    inverse[rows] -= change[rows, None] * row
    inverse[leave] = row


def patterns(histogram: dict[int, int], length: int = LENGTH, steps: int = MOST_STEPS) -> list[tuple[dict[int, int], int]]:
    """Patterns {size: pieces} with their whole numbers of sequences, within the histogram."""
    sizes = np.array(sorted(s for s, n in histogram.items() if n), dtype=np.int64)
    if not len(sizes):
        return []
    demand = np.array([histogram[int(s)] for s in sizes], dtype=float)
    basis, inverse = _first_columns(sizes, demand, length)
    amount = (inverse * demand).sum(axis=1)
    bound = (sizes * demand).sum() / length
    for _ in range(steps):
        if amount.sum() <= bound * (1 + GAP):
            break
        value, column = _price(inverse.sum(axis=0), sizes, length)
        if value <= 1 + 1e-9:
            break
        change = _applied(inverse, column)
        ratio = np.full(len(sizes), np.inf)
        up = change > 1e-9
        ratio[up] = np.maximum(amount[up], 0) / change[up]
        leave = int(ratio.argmin())
        basis[:, leave] = column
        _exchange(inverse, change, leave)
        amount = (inverse * demand).sum(axis=1)
    out, left = [], demand.copy()
    for k in np.argsort(-amount, kind="stable"):
        column = basis[:, k]
        used = column > 0
        times = int(max(0, min(np.floor(amount[k] + 1e-6), (left[used] // column[used]).min())))
        if times and length - sizes @ column <= MOST_WASTE * length:
            left -= times * column
            out.append(({int(s): int(c) for s, c in zip(sizes[used], column[used])}, times))
    return out


def plan(histogram: dict[int, int], first: int, length: int = LENGTH) -> dict:
    """Where a rest goes, by its size and rank; sequences are numbered from ``first``.

    rows: per size and rank range (size, from, to, pieces a sequence, sequence, offset), sorted.
    Ranks past the last range lie in the stream: base[size] + (rank - taken[size]) * size.
    """
    rows, taken, sequence = [], np.zeros(length, dtype=np.int64), first
    for pattern, times in patterns(histogram, length):
        offset = 0
        for size, pieces in sorted(pattern.items()):
            rows.append((size, taken[size], taken[size] + times * pieces, pieces, sequence, offset))
            taken[size] += times * pieces
            offset += size * pieces
        sequence += times
    left = np.array([histogram.get(s, 0) for s in range(length)], dtype=np.int64) - taken
    volume = left * np.arange(length)
    total = int(volume.sum())
    ends, tail = [], total % length
    for power in reversed(range(length.bit_length())):
        if tail >> power & 1:
            ends.append((ends[-1] if ends else total - tail) + (1 << power))
    rows.sort()
    return {
        "rows": np.array(rows, dtype=np.int64).reshape(-1, 6),
        "taken": taken,
        "base": np.cumsum(volume) - volume,
        "stream": sequence,
        "whole": total - total % length,
        "ends": np.array(ends, dtype=np.int64),
    }


def _borders(at: np.ndarray, plan_: dict, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sequence, its start and its end in the stream, of stream positions."""
    whole, ends = plan_["whole"], plan_["ends"]
    k = np.searchsorted(ends, at, side="right")
    starts = np.concatenate(([whole], ends))
    tail = at >= whole
    start = np.where(tail, starts[np.minimum(k, len(ends))], at // length * length)
    end = np.where(tail, np.append(ends, 0)[np.minimum(k, len(ends))], start + length)
    return plan_["stream"] + np.where(tail, whole // length + k, at // length), start, end


def pack(documents: DataFrame, tokenizer_path: str, length: int = LENGTH) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) of every piece."""
    spark = documents.sparkSession
    if length & (length - 1):
        raise ValueError("the length must be a power of two")
    kind = documents.schema["doc_id"].dataType.simpleString()
    cut = stored(tokenize(documents, tokenizer_path, length), "pieces")
    narrow = cut.drop("ids")
    rests = narrow.where(F.col("size") < length)
    counts = stored(rests.groupBy("size", "part").agg(F.max("number").alias("most")), "piece-counts")
    total = F.sum(F.col("most") + 1)
    histogram = {r[0]: r[1] for r in counts.groupBy("size").agg(total).collect()}
    before = counts.alias("c").selectExpr(
        "size", "part", "sum(most + 1) OVER (PARTITION BY size ORDER BY part) - most - 1 AS before"
    )
    # whole sequences: numbered by part, then by order inside it
    wholes = narrow.where(F.col("size") == length)
    whole_counts = stored(wholes.groupBy("part").count(), "sequence-counts")
    n_whole = whole_counts.agg(F.sum("count")).first()[0] or 0
    shared = spark.sparkContext.broadcast(plan(histogram, n_whole, length))
    place = whole_counts.selectExpr("part", "sum(count) OVER (ORDER BY part) - count AS before")
    numbered = wholes.join(place, "part").withColumn(
        "own", F.expr("row_number() OVER (PARTITION BY part ORDER BY doc_id, start, crc) - 1")
    )
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    done = numbered.select(
        "doc_id", "start", F.col("size").cast("long"), "crc", "doc_tokens", F.expr("before + own"), F.lit(0).cast("long")
    ).toDF(*names)

    ranked = stored(
        rests.join(before, ["size", "part"]).withColumn("rank", F.col("before") + F.col("number")).drop("before"),
        "ranked-pieces",
    )

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        rows = known["rows"]
        span = 1 << 44
        keys = rows[:, 0] * span + rows[:, 1]
        for batch in batches:
            size = batch.column("size").to_numpy().astype(np.int64)
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, size * span + rank, side="right") - 1
            inside = rank < known["taken"][size]
            sequence, offset = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            if inside.any():
                row = rows[at[inside]]
                nth = rank[inside] - row[:, 1]
                sequence[inside] = row[:, 4] + nth // row[:, 3]
                offset[inside] = row[:, 5] + nth % row[:, 3] * size[inside]
            stream = known["base"][size] + (rank - known["taken"][size]) * size
            number, start, end = _borders(stream, known, length)
            sequence = np.where(inside, sequence, number)
            offset = np.where(inside, offset, stream - start)
            torn = ~inside & (stream + size > end)
            columns = [batch.column(c) for c in ("doc_id", "start", "size", "crc", "doc_tokens", "part", "number")]
            columns += [pa.array(sequence), pa.array(offset), pa.array(np.where(torn, stream, -1))]
            yield pa.RecordBatch.from_arrays(
                columns,
                names=["doc_id", "start", "size", "crc", "doc_tokens", "part", "number", "sequence_id", "offset", "stream"],
            )

    assigned = ranked.mapInArrow(
        assign,
        f"doc_id {kind}, start long, size int, crc long, doc_tokens long, part int, number long, "
        "sequence_id long, offset long, stream long",
    )
    kept = assigned.where("stream < 0").selectExpr(
        "doc_id", "start", "CAST(size AS LONG)", "crc", "doc_tokens", "sequence_id", "offset"
    )

    def tear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            row, out = [], [[] for _ in range(6)]
            for i, (start, size, tokens, stream, body) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("start", "size", "doc_tokens", "stream", "ids")))
            ):
                ids, done_ = np.frombuffer(body, np.dtype(f"<u{len(body) // size}")), 0
                while done_ < size:
                    number, begin, end = (int(v[0]) for v in _borders(np.array([stream + done_]), known, length))
                    n = min(size - done_, end - stream - done_)
                    row.append(i)
                    values = (start + done_, n, crc(ids[done_ : done_ + n]), tokens, number, stream + done_ - begin)
                    for column, value in zip(out, values):
                        column.append(value)
                    done_ += n
            columns = [batch.column(0).take(pa.array(row, pa.int64()))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.array(v, pa.int64()) for v in out)], names=names)

    torn = assigned.where("stream >= 0").select("size", "part", "number", "stream")
    with_ids = cut.where("ids IS NOT NULL").join(torn, ["size", "part", "number"])
    pieces = with_ids.select("doc_id", "start", "size", "doc_tokens", "stream", "ids").mapInArrow(
        tear, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:])
    )
    return done.union(kept.toDF(*names)).union(pieces)
