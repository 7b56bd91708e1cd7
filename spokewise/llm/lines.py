"""Near-duplicate lines by a segment-partition edit join.

Texts are cut at newlines. A line is compared without surrounding white space; blank lines always
stay. Equal lines link at any length. Two lines of ``LEAST`` characters or more, enough for an edit to
mean little, also link if at most ``EDITS`` single-character edits turn one into the other. Of the
lines that reach each other by links the earliest stays (smallest id, then place in the table, then
line number) and the others go.

Equal lines are folded by their ids, without keys. A line of ``least`` characters or more is cut into
EDITS + 1 even segments; whatever EDITS edits do, one segment survives at a place that the lengths
bound. So each different line is stored under its segments (length, number, text) and probes the
substrings that could equal a segment of a line no longer than itself. Keys that meet make
candidates, which are verified by a bit-parallel edit distance: for each number of edits one word
whose bits are the ``2 EDITS + 1`` diagonals of the band. A key's lines yield a spanning set of
links, never all pairs, and a key is done as soon as its lines are connected.

Lines made from one template share segments in any number. A key with more than ``MOST_IN_KEY`` lines
is put off until the others have been verified and goes on only if its lines are still in several
classes. What all its lines have in common at their ends is stripped, which leaves edit distances as
they are; keys with the same lines become one; what is left is cut into segments again. Where
nothing can be stripped, the shared segment gives way to a line break, which shortens the rest by a
third. This ends when no key is crowded: rests of up to ``2 EDITS`` characters, which have too few
segments, and those that share nothing but line breaks are compared in one go.

Null texts are empty and come back null; the number of lines of a text that loses some falls, and
a text may become empty. Rows with equal ids are told apart by their place in the table: see
``common.placed``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spokewise.llm.common import connected_components, id_key, placed, small_batches
from spokewise.session import stored

EDITS = 2
#: Characters that a line must have to link with lines that differ from it, unless the caller says otherwise.
LEAST = 20
#: Lines of one key that are compared with each other in one go.
MOST_IN_KEY = 1000


PLACES: dict[tuple[int, int], list[tuple[int, int, int, bool]]] = {}


def places(length: int, edits: int) -> list[tuple[int, int, int, bool]]:
    """What ``_places`` gives, remembered for lengths up to 4096."""
    if length > 4096:
        return _places(length, edits)
    if (length, edits) not in PLACES:
        PLACES[length, edits] = _places(length, edits)
    return PLACES[length, edits]


def _places(length: int, edits: int) -> list[tuple[int, int, int, bool]]:
    """(seed, start, end, own) of the substrings under which a text of ``length`` is stored or probes.

    The seed tells the stored line's length and the segment's number. Own ones are the text's
    segments; the others could equal a segment of a text that is up to ``edits`` shorter: those that
    both the edits before and the edits after the segment can still reach.
    """
    out = []
    for less in range(edits + 1):
        short = length - less
        if short < edits + 1:
            continue
        size, longer = divmod(short, edits + 1)
        at = 0
        for i in range(edits + 1):
            n = size + (i >= edits + 1 - longer)
            after = edits - i
            low = max(0, at - i, at + less - after)
            high = min(length - n, at + i, at + less + after)
            out += [(short * (edits + 1) + i, p, p + n, less == 0 and p == at) for p in range(low, high + 1)]
            at += n
    return out


def keys_of(text: str, edits: int, salt: int = 0) -> list[tuple[int, bool]]:
    digest = xxhash.xxh64_intdigest
    if text.isascii():
        body = text.encode()
        return [(digest(body[a:b], seed ^ salt), own) for seed, a, b, own in places(len(text), edits)]
    return [(digest(text[a:b].encode(), seed ^ salt), own) for seed, a, b, own in places(len(text), edits)]


def within(a: str, b: str, edits: int) -> bool:
    """Is the edit distance at most ``edits``? Bit-parallel in a band of 2 edits + 1 diagonals."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > edits:
        return False
    start, end, most = 0, 0, len(a)
    while start < most:  # the common beginning, by halves
        step = most - start
        while step and a[start : start + step] != b[start : start + step]:
            step //= 2
        if not step:
            break
        start += step
    most -= start
    while end < most and a[len(a) - end - 1] == b[len(b) - end - 1]:
        end += 1
    a, b = a[start : len(a) - end], b[start : len(b) - end]
    if not a:
        return len(b) <= edits
    # level e has bit i - j + edits where a[:i] becomes b[:j] by e edits
    band = (1 << 2 * edits + 1) - 1
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i + edits
    levels = [1 << edits]
    for _ in range(edits):
        levels.append((levels[-1] | levels[-1] << 1) & band)
    for j, c in enumerate(b):
        match = at.get(c, 0) >> j & band
        inside = (1 << max(0, min(2 * edits + 1, len(a) - j + edits))) - 1
        before, new, alive = 0, 0, 0
        for e, level in enumerate(levels):
            new = (level & match | before | before >> 1 | new << 1) & inside
            levels[e], before = new, level
            alive |= new
        if not alive:
            return False
    return any(v >> len(a) - len(b) + edits & 1 for v in levels)


def _lines(body: str | None) -> Iterator[tuple[int, str]]:
    for number, line in enumerate((body or "").split("\n")):
        line = line.strip()
        if line:
            yield number, line


def line_id(line: str) -> bytes:
    return xxhash.xxh3_128_digest(line.encode())


def _half(digest: bytes) -> int:
    """The part of an id that travels with keys."""
    return int.from_bytes(digest[:8], "little") >> 1


def _occurrences(rows: DataFrame) -> DataFrame:
    """(half, id, k1, rid, number) of every line that is not blank."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2000):
            out: list[list] = [[] for _ in range(4)]
            for row, body in enumerate(batch.column(2).to_pylist()):
                for number, line in _lines(body):
                    digest = line_id(line)
                    for column, value in zip(out, (_half(digest), digest, row, number)):
                        column.append(value)
            half, ids, owner, number = (pa.array(c, k) for c, k in zip(out, (pa.int64(), pa.binary(), pa.int64(), pa.int32())))
            columns = [half, ids, batch.column(1).take(owner), batch.column(0).take(owner), number]
            yield pa.RecordBatch.from_arrays(columns, names=["half", "id", "k1", "rid", "number"])

    return rows.mapInArrow(run, "half long, id binary, k1 long, rid binary, number int")


def _keys(rows: DataFrame, edits: int, least: int) -> DataFrame:
    """(key, mark) of the lines of ``least`` characters or more; mark is the line's half id and, in the lowest bit, own.

    A task gives the keys of a line once, however often it meets the line.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: set[int] = set()
        for batch in small_batches(batches, 2000):
            keys, marks = [], []
            for body in batch.column(0).to_pylist():
                for _, line in _lines(body):
                    if len(line) < least:
                        continue
                    half = _half(line_id(line))
                    if half in known:
                        continue
                    if len(known) >= 500_000:
                        known.clear()
                    known.add(half)
                    for key, own in keys_of(line, edits):
                        keys.append(key)
                        marks.append(2 * half + own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(v, dtype=np.uint64).view(np.int64)) for v in (keys, marks)], names=["key", "mark"]
            )

    return rows.select("text").mapInArrow(run, "key long, mark long")


def _meetings(keys: DataFrame) -> DataFrame:
    """(meeting, half, crowded): lines that share a key, one stored under it at least.

    Sets of lines that meet under several keys get one name by their members. A set of more than
    MOST_IN_KEY lines keeps its key and is marked.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = np.empty((2, 0), dtype=np.uint64)
        passing = None

        def out(meeting: np.ndarray, half: np.ndarray, crowded: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(meeting.view(np.int64)), pa.array(half.view(np.int64)), pa.array(crowded)],
                names=["meeting", "half", "crowded"],
            )

        def settle(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
            half, own = rows[1] >> np.uint64(1), rows[1] & np.uint64(1)
            new_key = np.concatenate(([True], rows[0, 1:] != rows[0, :-1]))
            new = new_key | np.concatenate(([True], half[1:] != half[:-1]))
            at = np.flatnonzero(new)
            own = np.maximum.reduceat(own, at)
            key, half, heads = rows[0, at], half[at], np.flatnonzero(new_key[at])
            sizes = np.diff(np.append(heads, len(at)))
            meets = (sizes > 1) & (np.maximum.reduceat(own, heads) == 1)
            mixed = half * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            name = np.add.reduceat(mixed ^ (mixed >> np.uint64(32)), heads)
            large = sizes > MOST_IN_KEY
            name = np.where(large, key[heads], name)
            chosen = np.repeat(meets, sizes)
            if chosen.any():
                yield out(np.repeat(name, sizes)[chosen], half[chosen], np.repeat(large, sizes)[chosen])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(i).to_numpy().view(np.uint64) for i in range(2)])
            rows = np.concatenate((rest, rows), axis=1)
            open_ = rows[0] == rows[0, -1]
            whole, rest = rows[:, ~open_], rows[:, open_]
            if passing is not None:
                same = whole[0] == passing
                yield out(whole[0, same], whole[1, same] >> np.uint64(1), np.ones(int(same.sum()), bool))
                whole = whole[:, ~same]
                passing = passing if rest[0, 0] == passing else None
            if whole.shape[1]:
                yield from settle(whole)
            if passing is not None or rest.shape[1] > 1 << 20:
                passing = rest[0, 0]
                yield out(rest[0], rest[1] >> np.uint64(1), np.ones(rest.shape[1], bool))
                rest = rest[:, :0]
        if rest.shape[1]:
            yield from settle(rest)

    dealt = keys.repartition("key").sortWithinPartitions("key", "mark")
    return dealt.mapInArrow(run, "meeting long, half long, crowded boolean").distinct()


def _texts(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(meeting, crowded, id, rest) of the lines in ``wanted`` (rid, number, meeting, crowded)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 500):
            out: list[list] = [[] for _ in range(4)]
            for body, chosen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = (body or "").split("\n")
                for c in chosen:
                    line = lines[c["number"]].strip()
                    for column, value in zip(out, (c["meeting"], c["crowded"], line_id(line), line)):
                        column.append(value)
            kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.string()]
            names = ["meeting", "crowded", "id", "rest"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    lists = wanted.groupBy("rid").agg(F.collect_list(F.struct("number", "meeting", "crowded")).alias("chosen"))
    schema = "meeting long, crowded boolean, id binary, rest string"
    return rows.select("rid", "text").join(lists, "rid").select("text", "chosen").mapInArrow(run, schema)


def spanning_links(members: list[tuple], edits: int) -> list[tuple]:
    """(a, b) of ids that link and connect the same classes as all pairs do; members are (id, class, text)."""
    number: dict = {}
    label = [number.setdefault(c, len(number)) for _, c, _ in members]
    parts = list(range(len(number)))
    left, out = len(parts), []

    def root(k: int) -> int:
        while parts[k] != k:
            parts[k] = k = parts[parts[k]]
        return k

    order = sorted(range(len(members)), key=lambda k: len(members[k][2]))
    for x, i in enumerate(order):
        if left == 1:
            break
        text = members[i][2]
        mine = root(label[i])
        for j in order[x + 1 :]:
            if len(members[j][2]) - len(text) > edits:
                break
            other = root(label[j])
            if other != mine and within(text, members[j][2], edits):
                parts[other] = mine
                out.append((members[i][0], members[j][0]))
                left -= 1
    return out


def _verified(meetings: DataFrame, edits: int) -> DataFrame:
    """(a, b) links within meetings; ``meetings`` is (meeting, id, class, rest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        now, members = None, {}
        for batch in small_batches(batches, 2000):
            for meeting, digest, known, rest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if meeting != now:
                    out += spanning_links(list(members.values()), edits)
                    now, members = meeting, {}
                members[digest, rest] = (digest, known, rest)
            if len(out) > 5000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["a", "b"])
                out = []
        out += spanning_links(list(members.values()), edits)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*out)], names=["a", "b"])

    dealt = meetings.select("meeting", "id", "class", "rest").repartition("meeting").sortWithinPartitions("meeting", "id")
    return dealt.mapInArrow(run, "a binary, b binary")


def common_start(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def _stripped(crowded: DataFrame, edits: int) -> DataFrame:
    """``crowded`` (meeting, salt, id, class, rest) with shorter rests, and one meeting for each set of them.

    The least and the greatest rest of a meeting have the beginning in common that all have; the
    least and greatest of the reversed ones, the end. Where there is none, the segment that made the key is
    replaced by a line break.
    """

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 2000):
            out: list[list] = [[], []]
            for low, high, low_end, high_end, shortest in zip(*(c.to_pylist() for c in batch.columns[1:])):
                start = min(common_start(low, high), shortest)
                out[0].append(start)
                out[1].append(min(common_start(low_end, high_end), shortest - start))
            columns = [batch.column(0), *(pa.array(v, pa.int32()) for v in out)]
            yield pa.RecordBatch.from_arrays(columns, names=["meeting", "start", "end"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["meeting", "id", "class", "rest"]
        for batch in small_batches(batches, 2000):
            out: list[list] = [[] for _ in names]
            columns = [batch.column(c).to_pylist() for c in ("meeting", "salt", "id", "class", "rest", "start", "end")]
            for meeting, salt, digest, known, rest, start, end in zip(*columns):
                rests = {rest[start : len(rest) - end]}
                if not start and not end:
                    keys = zip(keys_of(rest, edits, salt), places(len(rest), edits))
                    rests = {rest[:a] + "\n" + rest[b:] for (key, _), (_, a, b, _) in keys if key == meeting % (1 << 64)}
                for left in rests:
                    for column, value in zip(out, (meeting, digest, known, left)):
                        column.append(value)
            kinds = [pa.int64(), pa.binary(), pa.binary(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)

    bounds = crowded.groupBy("meeting").agg(
        F.min("rest"), F.max("rest"), F.min(F.reverse("rest")), F.max(F.reverse("rest")), F.min(F.char_length("rest"))
    )
    bounds = bounds.mapInArrow(ends, "meeting long, start int, end int")
    shorter = crowded.join(bounds, "meeting").mapInArrow(cut, "meeting long, id binary, class binary, rest string")
    shorter = stored(shorter, "line-rests")
    member = F.xxhash64("id", "rest")
    sets = shorter.groupBy("meeting").agg(
        F.count("*").alias("n"), F.bit_xor(member).alias("mixed"), F.bit_xor(F.xxhash64(member)).alias("again")
    )
    chosen = sets.groupBy("n", "mixed", "again").agg(F.min("meeting").alias("meeting")).select("meeting")
    return shorter.join(chosen, "meeting", "left_semi")


def _rekeyed(shorter: DataFrame, edits: int) -> DataFrame:
    """(meeting, salt, tiny, own, id, class, rest): rests under the keys of their segments within their meeting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["meeting", "salt", "tiny", "own", "id", "class", "rest"]
        kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary(), pa.binary(), pa.string()]
        for batch in small_batches(batches, 1000):
            out: list[list] = [[] for _ in names]
            for meeting, digest, known, rest in zip(*(batch.column(i).to_pylist() for i in range(4))):
                salt = (meeting % (1 << 64)) >> 1
                cuts = zip(keys_of(rest, edits, salt), places(len(rest), edits))
                keys = list({(key, not rest[a:b].strip("\n"), own) for (key, own), (_, a, b, _) in cuts})
                if len(rest) <= 2 * edits:
                    keys.append((xxhash.xxh64_intdigest(b"tiny", salt), True, True))
                for key, tiny, own in keys:
                    signed = key - (1 << 64) if key >> 63 else key
                    for column, value in zip(out, (signed, salt, tiny, own, digest, known, rest)):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out, kinds)], names=names)

    schema = "meeting long, salt long, tiny boolean, own boolean, id binary, class binary, rest string"
    return shorter.select("meeting", "id", "class", "rest").mapInArrow(run, schema)


def _in_classes(crowded: DataFrame, links: DataFrame) -> DataFrame:
    """``crowded`` with the class of each line by the links so far, without meetings of one class."""
    classes = connected_components(links, "line-components").select("id", F.col("root").alias("class"))
    known = crowded.drop("class").join(classes, "id", "left").withColumn("class", F.coalesce("class", "id"))
    known = stored(known, "line-crowded")
    open_ = known.groupBy("meeting").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    return known.join(open_.select("meeting"), "meeting", "left_semi")


def line_classes(rows: DataFrame, occurrences: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """(id, root) of the lines that link with another one."""
    met = stored(_meetings(_keys(rows, edits, least)), "line-meetings")
    first = occurrences.join(met.select("half").distinct(), "half").groupBy("half", "id")
    place = first.agg(F.min(F.struct("k1", "rid", "number")).alias("at")).select("half", "at.rid", "at.number")
    member = F.xxhash64("half")
    sets = met.where("crowded").groupBy("meeting").agg(
        F.count("*").alias("n"), F.bit_xor(member).alias("mixed"), F.bit_xor(F.xxhash64(member)).alias("again")
    )
    chosen = sets.groupBy("n", "mixed", "again").agg(F.min("meeting").alias("meeting")).select("meeting")
    many = met.where("crowded").join(chosen, "meeting", "left_semi")
    wanted = met.where("NOT crowded").unionByName(many).join(place, "half").select("rid", "number", "meeting", "crowded")
    texts = stored(_texts(rows, wanted).withColumn("class", F.col("id")), "line-texts")
    links = stored(_verified(texts.where("NOT crowded"), edits), "line-links")
    crowded = texts.where("crowded").withColumn("salt", F.lit(0).cast("long"))
    while crowded.head(1):
        open_ = stored(_in_classes(crowded, links), "line-open")
        if not open_.head(1):
            break
        keyed = stored(_rekeyed(_stripped(open_, edits), edits), "line-rekeyed")
        sizes = keyed.groupBy("meeting").agg(
            F.count("*").alias("n"),
            F.max("own").alias("met"),
            F.min("class").alias("low"),
            F.max("class").alias("high"),
        )
        sizes = sizes.where("met AND low < high AND n > 1").select("meeting", "n")
        judged = stored(keyed.join(sizes, "meeting"), "line-judged")
        few = (F.col("n") <= MOST_IN_KEY) | F.col("tiny")
        links = links.union(stored(_verified(judged.where(few), edits), "line-links"))
        crowded = judged.where(~few).select("meeting", "salt", "id", "class", "rest")
    return connected_components(links, "line-components")


def dedupe_lines(
    documents: DataFrame,
    keep: list[str],
    edits: int = EDITS,
    counts: tuple[str, str] = ("n_lines", "n_removed"),
    least: int = LEAST,
) -> DataFrame:
    """The columns ``keep`` of every document, its text without repeated lines, and the counts.

    Equal lines link at any length; lines that differ, by up to ``edits`` edits, only from ``least``
    characters on, 20 by default.

    ``text`` is replaced; the columns named by ``counts``, lines before and lines lost, are added, or
    replace kept columns of these names.
    """
    keep = [c for c in keep if c not in ("text", *counts)]
    kept = [F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)]
    rows = placed(documents, id_key().alias("k1"), F.col("text").cast("string").alias("text"), *kept)
    occurrences = stored(_occurrences(rows.select("rid", "k1", "text")), "line-occurrences")
    classes = line_classes(rows, occurrences, edits, least)
    named = occurrences.join(classes, "id", "left").select(
        F.coalesce("root", "id").alias("root"), F.struct("k1", "rid", "number").alias("at")
    )
    named = stored(named, "line-classes")
    several = named.groupBy("root").agg(F.min("at").alias("first"), F.count("*").alias("times")).where("times > 1")
    gone = named.join(several, "root").where("at <> first").groupBy("at.rid").agg(F.collect_list("at.number").alias("gone"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts, before, lost = [], [], []
            for text, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                lines = [] if text is None else text.split("\n")
                drop = set(numbers or ())
                if drop:
                    text = "\n".join(line for k, line in enumerate(lines) if k not in drop)
                texts.append(text)
                before.append(len(lines))
                lost.append(len(drop))
            columns = [*batch.columns[2:], pa.array(texts, pa.string()), pa.array(before, pa.int64()), pa.array(lost, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[2:], "text", "n_lines", "n_removed"])

    joined = rows.join(gone, "rid", "left").select("text", "gone", *(f"keep_{i}" for i in range(len(keep))))
    fields = [f"keep_{i} {documents.schema[c].dataType.simpleString()}" for i, c in enumerate(keep)]
    done = joined.mapInArrow(run, ", ".join([*fields, "text string", "n_lines long", "n_removed long"]))
    return done.toDF(*keep, "text", *counts)
