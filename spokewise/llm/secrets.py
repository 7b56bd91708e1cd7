"""Secret scans: fixed patterns, and a character convolutional network over every looser candidate.

Base findings are what ``PATTERNS`` match, kind by kind, leftmost and without overlap; a match that is too short
is dropped. They always stay. Candidates are all runs of ``RUN`` characters with a digit or mixed case, and all values that
follow one of the wider ``NAMES``. The network sees a candidate as a whole, however long, with ``BEFORE``
characters before it and ``AFTER`` behind: one-hot characters (those of the candidate and those around it are told
apart), ``FILTERS`` filters over ``TAPS`` characters, the largest and the mean response of each, and a logistic unit.

It is trained on all different labelled findings of the documents, whatever their number and length: base findings, candidates
outside base findings, base findings moved into other surroundings, and made secrets and harmless strings set into
surroundings of the corpus. These examples are a stored table in shards of about ``SHARD``. In each of ``EPOCHS`` rounds every
shard is learnt from by a task that begins with the network of the round before, and the networks of all shards are
averaged. A fifth is held out. On one half of that the score is calibrated by a logistic fit; on the other the threshold of each
way of finding candidates is set: the highest one that still finds ``RECALL`` of the secrets, exactly. Both are sums and counts over
all those rows. Candidates above the threshold that no base finding overlaps are added.

Null texts are empty; empty texts have no spans; texts of any length are scanned whole; equal rows have equal
results, one each. Without documents there is no row. A kept column named like the result gives way to it.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spokewise.functions.statistics import exact_ranked
from spokewise.llm.common import small_batches
from spokewise.session import stored

# The base patterns and the least length of a finding.
PATTERNS = {
    "assign": r"""(?ia)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{24,}",
}
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Name of what the network adds.
ADDED = "secret"

NAMES = r"pass(?:[ _-]?(?:word|wd|phrase|code))?|pwd|secret|token|api[ _-]?key|credentials?|bearer|private[ _-]?key|client[ _-]?id"
RUN = r"[A-Za-z0-9+/_.=~-]"
BEFORE, AFTER = 24, 8
TAPS, FILTERS, CODES = 5, 16, 256
RECALL = 0.95
EPOCHS, STEP, BATCH = 8, 0.01, 128
#: Examples that one task learns from in a round, about, and made pairs of a secret and a harmless string, at least.
SHARD, LEAST_MADE = 1 << 14, 1000
#: Positions that are convolved at a time, and characters of a batch beyond which it takes in no further example.
POSITIONS, CHARACTERS = 1 << 16, 1 << 21
#: Parts of a unit in which the shards' values are added, so that a sum does not depend on its order.
PARTS = 1 << 28

_BASE = {kind: re.compile(p) for kind, p in PATTERNS.items()}
_RUNS = re.compile(rf"(?<!{RUN}){RUN}{{8,}}")
_MIXED = re.compile(r"[0-9]|[a-z][A-Z].*[a-z][A-Z]")
_NAMED = re.compile(
    rf"(?ia)(?<![a-z])(?:{NAMES})(?![a-z])[\"']?\s{{0,3}}(?:is|was|:=|=>|->|=|:)?\s{{0,3}}[\"'`]?([^\s\"'`<>,;]{{6,}})"
)

# Beginnings, lengths and alphabets of secrets as services issue them, and words that lead to them.
LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
FORMS = [
    ("ghp_", 36, LOWER + UPPER + DIGITS),
    ("glpat-", 20, LOWER + UPPER + DIGITS + "-_"),
    ("npm_", 36, LOWER + UPPER + DIGITS),
    ("xoxb-", 48, LOWER + UPPER + DIGITS + "-"),
    ("sk_live_", 24, LOWER + UPPER + DIGITS),
    ("AIza", 35, LOWER + UPPER + DIGITS + "-_"),
    ("SG.", 66, LOWER + UPPER + DIGITS + "-_."),
    ("eyJ", 120, LOWER + UPPER + DIGITS + "-_."),
    ("AKIA", 16, UPPER + DIGITS),
    ("", 40, LOWER + UPPER + DIGITS + "+/"),
    ("", 32, DIGITS + "ABCDEF"),
    ("", 40, DIGITS + "abcdef"),
    ("", 14, LOWER + UPPER + DIGITS + "!@#$%^&*"),
]
LEADS = ["password is ", "passphrase: ", "Authorization: Bearer ", "api key ", "client_secret -> ", "pwd=", "token = ", "secret: ", "", ""]

SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType()),
    ]
)
RESULT = T.StructType([T.StructField("base", T.ArrayType(SPAN)), T.StructField("spans", T.ArrayType(SPAN))])


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, number of the kind, end) of the base findings, in order."""
    found = []
    for number, (kind, pattern) in enumerate(_BASE.items()):
        for m in pattern.finditer(text):
            last = m.lastindex or 0
            if m.end(last) - m.start(last) >= LEAST[kind]:
                found.append((m.start(), number, m.end()))
    return sorted(found)


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, named) of the looser candidates that no base finding overlaps; of overlapping ones the first stays."""
    found = [(m.start(1), m.end(1), 1) for m in _NAMED.finditer(text)]
    found += [(m.start(), m.end(), 0) for m in _RUNS.finditer(text) if _MIXED.search(m[0])]
    taken = sorted([(a, b, -1) for a, _, b in base] + found, key=lambda c: (c[0], c[2] >= 0, -c[2]))
    out, reach = [], 0
    base_starts = np.array([a for a, _, _ in base] + [len(text) + 1])
    for a, b, named in taken:
        if named < 0:
            reach = max(reach, b)
        elif a >= reach and base_starts[np.searchsorted(base_starts, a)] >= b:
            out.append((a, b, named))
            reach = b
    return out


def encode(before: str, body: str, after: str) -> np.ndarray:
    """Codes of a candidate (128 and up) and of what is around it; 1 stands for all beyond ASCII."""

    def plain(text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        return np.where(points < 128, np.maximum(points, 1), 1)

    codes = np.concatenate((plain(before), plain(body) + 128, plain(after)))
    return codes.astype(np.int64)


@dataclass
class Network:
    """Filters over characters, pooled, and a logistic unit; calibration and thresholds come with it."""

    table: np.ndarray
    bias: np.ndarray
    weight: np.ndarray
    offset: float = 0.0
    scale: tuple[float, float] = (0.0, 1.0)
    thresholds: tuple[float, float] = (0.5, 0.5)
    report: dict = field(default_factory=dict)

    @classmethod
    def fresh(cls, rng: np.random.Generator) -> Network:
        table = rng.normal(0, 0.3, (TAPS, CODES, FILTERS)).astype(np.float32)
        return cls(table, np.zeros(FILTERS, np.float32), rng.normal(0, 0.1, 2 * FILTERS).astype(np.float32))

    def responses(self, parts: list[np.ndarray]) -> np.ndarray:
        """One row per code of all parts; the last TAPS - 1 of each part, which are only looked at, have zeros."""
        codes = np.concatenate([*parts, np.zeros(TAPS - 1, np.int64)])
        n = len(codes) - TAPS + 1
        total = np.broadcast_to(self.bias, (n, FILTERS)).copy()
        for k in range(TAPS):
            total += self.table[k][codes[k : k + n]]
        ends = np.cumsum([len(p) for p in parts])
        total[(ends[:, None] - np.arange(1, TAPS)).ravel()] = 0
        return np.maximum(total, 0)

    def pooled(self, examples: list[np.ndarray]) -> np.ndarray:
        """Largest and mean responses of each example, whatever its length."""
        gap = np.zeros(TAPS - 1, np.int64)
        most, mean = np.zeros((len(examples), FILTERS), np.float32), np.zeros((len(examples), FILTERS), np.float32)
        parts, owners, size = [], [], 0

        def settle() -> None:
            heads = np.cumsum([0] + [len(p) for p in parts[:-1]])
            answer = self.responses(parts)
            np.maximum.at(most, owners, np.maximum.reduceat(answer, heads, axis=0))
            np.add.at(mean, owners, np.add.reduceat(answer, heads, axis=0))
            parts.clear()
            owners.clear()

        for owner, codes in enumerate(examples):
            padded = np.concatenate((codes, gap))
            for begin in range(0, len(codes), POSITIONS):
                parts.append(padded[begin : begin + POSITIONS + TAPS - 1])
                owners.append(owner)
                size += len(parts[-1])
                if size >= POSITIONS:
                    settle()
                    size = 0
        if parts:
            settle()
        lengths = np.array([max(1, len(c)) for c in examples], dtype=np.float32)
        return np.concatenate((most, mean / lengths[:, None]), axis=1)

    def scores(self, examples: list[np.ndarray]) -> np.ndarray:
        """Calibrated probabilities."""
        if not examples:
            return np.empty(0)
        return self.calibrated(self.pooled(examples) @ self.weight + self.offset)

    def calibrated(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale[0] + self.scale[1] * z.astype(float), -60, 60)))

    def gradients(self, examples: list[np.ndarray], y: np.ndarray) -> list[np.ndarray]:
        """Of the mean logistic loss, with respect to table, bias, weight and offset; long examples pass in pieces."""
        gap = np.zeros(TAPS - 1, np.int64)
        pooled = self.pooled(examples)
        z = pooled @ self.weight + self.offset
        error = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / len(y)
        back = error[:, None] * self.weight
        true = np.array([max(1, len(c)) for c in examples])
        table = np.zeros(self.table.shape, dtype=np.float32)
        bias = np.zeros(FILTERS)
        parts, owners, size = [], [], 0

        def settle() -> None:
            codes = np.concatenate([*parts, gap])
            owner = np.repeat(owners, [len(p) for p in parts])
            answer = self.responses(parts)
            below = (answer == pooled[owner, :FILTERS]) * back[owner, :FILTERS] + (back[:, FILTERS:] / true[:, None])[owner]
            below = np.where(answer > 0, below, 0)
            n = len(answer)
            for k in range(TAPS):
                for f in range(FILTERS):
                    table[k, :, f] += np.bincount(codes[k : k + n], weights=below[:, f], minlength=CODES)
            bias[:] += below.sum(axis=0)
            parts.clear()
            owners.clear()

        for owner, codes in enumerate(examples):
            padded = np.concatenate((codes, gap))
            for begin in range(0, max(1, len(codes)), POSITIONS):
                parts.append(padded[begin : begin + POSITIONS + TAPS - 1])
                owners.append(owner)
                size += len(parts[-1])
                if size >= POSITIONS:
                    settle()
                    size = 0
        if parts:
            settle()
        return [table, bias, pooled.T @ error, np.array(error.sum())]

    def train(self, batches: Iterator[tuple[list[np.ndarray], np.ndarray]]) -> None:
        """Adam over batches of examples and their labels, from where the network is."""
        values = [self.table, self.bias, self.weight, np.array(self.offset)]
        first = [np.zeros_like(v) for v in values]
        second = [np.zeros_like(v) for v in values]
        for t, (examples, y) in enumerate(batches, 1):
            for k, g in enumerate(self.gradients(examples, y)):
                first[k] = 0.9 * first[k] + 0.1 * g
                second[k] = 0.99 * second[k] + 0.01 * g * g
                step = (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.99**t)) + 1e-8)
                values[k] = values[k] - STEP * step.astype(np.float32)
            self.table, self.bias, self.weight = values[:3]
            self.offset = float(values[3])

    def values(self) -> np.ndarray:
        """All learnt values in one row."""
        return np.concatenate((self.table.ravel(), self.bias, self.weight, [self.offset])).astype(np.float64)

    @classmethod
    def of_values(cls, values: np.ndarray) -> Network:
        table, bias, weight = np.split(values[:-1].astype(np.float32), np.cumsum([TAPS * CODES * FILTERS, FILTERS]))
        return cls(table.reshape(TAPS, CODES, FILTERS), bias, weight, float(values[-1]))


def _around(text: str, a: int, b: int) -> tuple[str, str, str]:
    return text[max(0, a - BEFORE) : a], text[a:b], text[b : b + AFTER]


def labelled_findings(documents: DataFrame) -> DataFrame:
    """(secret, mark, named, before, body, after), stored: every different base finding and other candidate of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["secret", "named", "before", "body", "after", "mark"]
        kinds = [pa.bool_(), pa.int32(), pa.string(), pa.string(), pa.string(), pa.int64()]
        known: set[int] = set()
        for batch in small_batches(batches):
            rows = []
            for text in batch.column(0).to_pylist():
                text = text or ""
                base = base_findings(text)
                found = [(True, int(kind == 0), a, b) for a, kind, b in base]
                found += [(False, named, a, b) for a, b, named in candidates(text, base)]
                for secret, named, a, b in found:
                    parts = _around(text, a, b)
                    if secret and named:  # the value, as the network meets it
                        m = _BASE["assign"].match(text, a, b)
                        parts = _around(text, m.start(2), m.end(2))
                    mark = xxhash.xxh64_intdigest("\0".join(parts)) - (1 << 63)
                    if (secret, mark) not in known:
                        known.add((secret, mark))
                        rows.append((secret, named, *parts, mark))
            if len(known) > 1_000_000:  # only what is folded before the shuffle depends on it
                known.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    schema = "secret boolean, named int, before string, body string, after string, mark long"
    found = documents.select(F.col("text").cast("string")).mapInArrow(run, schema)
    return stored(
        found.groupBy("secret", "mark").agg(*(F.min(c).alias(c) for c in ("named", "before", "body", "after"))),
        "secret-findings",
    )


def _harmless(rng: np.random.Generator, words: list[str]) -> str:
    """A string that looks like a candidate and is no secret."""
    pick = lambda n: [words[i] for i in rng.integers(0, len(words), n)]
    number = lambda n: "".join(rng.choice(list(DIGITS), n))
    return [
        lambda: "-".join([*pick(2), number(2)]),
        lambda: "_".join(pick(3)) + number(1),
        lambda: f"{number(4)}-{number(2)}-{number(2)}",
        lambda: f"{number(4)}-{number(2)}-{number(2)}T{number(2)}.{number(2)}",
        lambda: f"www.{pick(1)[0]}.com/{number(3)}/{pick(1)[0]}",
        lambda: f"{pick(1)[0]}.{number(1)}.{number(2)}.tar.gz",
        lambda: "".join(w.capitalize() for w in pick(3)),
        lambda: number(int(rng.integers(8, 20))),
        lambda: f"{number(3)}.{number(3)}.{number(3)}",
        lambda: "".join(pick(3)),
    ][rng.integers(0, 10)]()


def _examples(findings: DataFrame, n_plain: int, n_secret: int) -> DataFrame:
    """(shard, part, mark, secret, named, before, body, after), stored: the findings, base findings moved elsewhere, made
    secrets and made harmless strings. part is 0 for calibrating, 1 for judging and 2 for training.

    Findings pass in the order of their marks, which are hashes: a base finding moves to where the candidate before it is, and
    made strings take their words from the last candidates. What is made of a finding depends on its mark alone otherwise.
    """
    made = max(LEAST_MADE, n_plain // 2) / max(1, n_plain)
    shards = max(1, -(-(2 * n_secret + n_plain + 2 * max(LEAST_MADE, n_plain // 2)) // SHARD))
    if not n_plain:
        nothing = findings.sparkSession.range(1).selectExpr(
            "false AS secret", "id AS mark", "0 AS named", "'' AS before", "'' AS body", "'' AS after"
        )
        findings = findings.unionByName(nothing)
    names = ["shard", "part", "mark", "secret", "named", "before", "body", "after"]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.string(), pa.string(), pa.string()]
    first = ["shard", "mark", "secret", "named", "before", "body", "after"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, place, recent = None, ("", ""), deque(maxlen=64)

        def further(rng: np.random.Generator, around: tuple[str, str]) -> Iterator[tuple]:
            """A made secret and a made harmless string."""
            words = sorted({w for found in recent for w in found}) or ["word"]
            start, length, alphabet = FORMS[rng.integers(0, len(FORMS))]
            lead = LEADS[rng.integers(0, len(LEADS))]
            body = start + "".join(rng.choice(list(alphabet), length))
            yield True, int(lead != ""), (around[0] + lead)[-BEFORE:], body, around[1]
            lead = LEADS[rng.integers(0, len(LEADS))] if rng.random() < 0.25 else ""
            if lead:  # a name that is followed by a word
                yield False, 1, (around[0] + lead)[-BEFORE:], words[rng.integers(0, len(words))], around[1]
            else:
                yield False, 0, around[0], _harmless(rng, words), around[1]

        for batch in small_batches(batches):
            rows = []
            for shard, mark, secret, named, before, body, after in zip(*(c.to_pylist() for c in batch.columns)):
                if shard != now:
                    now, place = shard, ("", "")
                    recent.clear()
                rng = np.random.default_rng((13, mark & ((1 << 64) - 1)))
                mine = [(secret, named, before, body, after)]
                if secret:
                    mine.append((True, 0, place[0], body, place[1]))
                else:
                    place = (before, after)
                    recent.append(re.findall(r"[A-Za-z]{2,12}", body[:4096]))
                    for _ in range(int(made + rng.random())):
                        mine += further(rng, place)
                for row in mine:
                    part = int(rng.integers(0, 10))
                    rows.append((shard, min(part, 2), int(rng.integers(-(1 << 63), (1 << 63) - 1)), *row))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    dealt = findings.withColumn("shard", F.pmod("mark", F.lit(shards)).cast("int")).select(*first)
    ordered = dealt.repartition(shards, "shard").sortWithinPartitions("shard", "mark", "secret")
    schema = "shard int, part int, mark long, secret boolean, named int, before string, body string, after string"
    return stored(ordered.mapInArrow(run, schema).select(*names), "secret-examples")


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray], np.ndarray]]:
    """(shard, codes, labels) of up to BATCH examples of one shard, from rows (shard, secret, before, body, after)."""
    codes, labels, size, now = [], [], 0, None
    for batch in small_batches(batches, BATCH):
        for shard, secret, *parts in zip(*(c.to_pylist() for c in batch.columns)):
            if codes and (shard != now or len(codes) == BATCH or size >= CHARACTERS):
                yield now, codes, np.array(labels, float)
                codes, labels, size = [], [], 0
            now = shard
            codes.append(encode(*parts))
            labels.append(secret)
            size += len(codes[-1])
    if codes:
        yield now, codes, np.array(labels, float)


def _round(examples: DataFrame, network: Network, shards: int, number: int) -> Network:
    """The mean of what the network becomes in each shard by one pass over it, in an order that differs by round."""
    shared = examples.sparkSession.sparkContext.broadcast(network.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, group in groupby(_batches(batches), key=lambda b: b[0]):
            mine = Network.of_values(shared.value)
            mine.train((codes, labels) for _, codes, labels in group)
            values = np.round(mine.values() * PARTS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], names=["place", "value"])

    order = F.xxhash64("mark", F.lit(number))
    rows = examples.where("part = 2").select("shard", "secret", "before", "body", "after", order.alias("order"), "mark")
    rows = rows.repartition(shards, "shard").sortWithinPartitions("shard", "order", "mark", "secret", "body").drop("order", "mark")
    learnt = rows.mapInArrow(run, "place long, value long").groupBy("place").agg((F.sum("value") / F.count("*")).alias("value"))
    found = sorted(learnt.collect())
    return Network.of_values(np.array([r.value for r in found]) / PARTS) if found else network


def _scored_examples(examples: DataFrame, network: Network) -> DataFrame:
    """(part, secret, named, z), stored: the held-out examples and their uncalibrated scores."""
    shared = examples.sparkSession.sparkContext.broadcast(network.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Network.of_values(shared.value)
        for batch in small_batches(batches):
            codes = [encode(*parts) for parts in zip(*(batch.column(k).to_pylist() for k in (3, 4, 5)))]
            z = known.pooled(codes) @ known.weight + known.offset
            columns = [*batch.columns[:3], pa.array(z.astype(np.float64))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "secret", "named", "z"])

    held = examples.where("part < 2").select("part", "secret", "named", "before", "body", "after")
    return stored(held.mapInArrow(run, "part int, secret boolean, named int, z double"), "secret-scores")


def _logistic(rows: DataFrame) -> tuple[float, float]:
    """Intercept and slope of a calibrating fit of secret by z, with a weak pull to (0, 1); each step is one sum over all rows."""
    beta = np.array([0.0, 1.0])
    for _ in range(50):
        p = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(beta[0])) + F.lit(float(beta[1])) * F.col("z")))))
        off, spread = F.col("secret").cast("double") - p, p * (1 - p)
        sums = rows.agg(*(
            F.coalesce(F.sum(c), F.lit(0.0)) for c in (off, off * F.col("z"), spread, spread * F.col("z"), spread * F.col("z") ** 2)
        )).first()
        gradient = np.array(sums[:2]) - 0.1 * (beta - [0, 1])
        hessian = np.array([[sums[2], sums[3]], [sums[3], sums[4]]]) + 0.1 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -1, 1)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(max(1e-3, beta[1]))


def fit(documents: DataFrame) -> Network:
    """The trained, calibrated network with its thresholds; ``report`` has its held-out recall and precision."""
    findings = labelled_findings(documents)
    n_plain, n_secret = findings.agg(F.count_if(~F.col("secret")), F.count_if("secret")).first()
    examples = _examples(findings, n_plain, n_secret)
    n, shards = examples.agg(F.count("*"), F.coalesce(F.max("shard"), F.lit(0)) + 1).first()
    network = Network.fresh(np.random.default_rng(13))
    for number in range(EPOCHS):
        network = _round(examples, network, shards, number)
    held = _scored_examples(examples, network)
    network.scale = _logistic(held.where("part = 0"))
    judging = held.where("part = 1")
    ways = judging.where("secret").select(*(F.when(F.col("named") == way, F.col("z")).alias(f"way{way}") for way in (0, 1)))
    lowest = exact_ranked(ways, ["way0", "way1"], lambda n: int((1 - RECALL) * n) + 1)
    even = -network.scale[0] / network.scale[1]  # where the probability is a half
    least = [even if z is None else z for z in lowest.values()]
    network.thresholds = tuple(float(network.calibrated(np.float64(z))) for z in least)
    passed = F.col("z") >= F.when(F.col("named") == 0, least[0]).otherwise(least[1])
    counts = judging.agg(F.count_if("secret"), F.count_if(passed), F.count_if(F.col("secret") & passed)).first()
    network.report = {
        "examples": n,
        "recall": counts[2] / counts[0] if counts[0] else None,
        "precision": counts[2] / counts[1] if counts[1] else None,
    }
    return network


def scan(documents: DataFrame, network: Network, keep: list[str], result: str = "secrets") -> DataFrame:
    """The columns ``keep`` and a struct ``result`` of base and all spans (kind, start, end, score), in order.

    Positions are code points, ends exclusive; base findings have score 1. One pass, no shuffle.
    """
    keep = [c for c in keep if c != result]
    parts = (network.table, network.bias, network.weight, network.offset, network.scale, network.thresholds)
    shared = documents.sparkSession.sparkContext.broadcast(parts)
    kinds = [*PATTERNS, ADDED]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Network(*shared.value)
        span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])
        for batch in small_batches(batches):
            bases, loose, codes = [], [], []
            for row, text in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                text = text or ""
                bases.append(base_findings(text))
                for a, b, named in candidates(text, bases[-1]):
                    loose.append((row, a, b, named))
                    codes.append(encode(*_around(text, a, b)))
            spans = [[(a, k, b, 1.0) for a, k, b in base] for base in bases]
            for (row, a, b, named), score in zip(loose, known.scores(codes).tolist()):
                if score >= known.thresholds[named]:
                    spans[row].append((a, len(PATTERNS), b, score))
            columns = []
            for rows in ([[(a, k, b, 1.0) for a, k, b in base] for base in bases], [sorted(s) for s in spans]):
                written = [[dict(zip(("kind", "start", "end", "score"), (kinds[k], a, b, s))) for a, k, b, s in r] for r in rows]
                columns.append(pa.array(written, pa.list_(span)))
            struct = pa.StructArray.from_arrays(columns, names=["base", "spans"])
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], struct], names=[*batch.schema.names[:-1], result])

    schema = T.StructType([*[documents.schema[c] for c in keep], T.StructField(result, RESULT)])
    kept = [F.col(f"`{c}`") for c in keep]
    return documents.select(*kept, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)
