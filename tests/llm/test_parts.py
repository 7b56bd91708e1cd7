"""The parts of the operators against brute force, without Spark where it takes no part."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from spokewise.llm import common, decontaminate, lines, packing, private, simhash, suffixes, toxicity, vectors
from tests.llm import brute, tables


def test_index_finds_every_occurrence():
    rng = np.random.default_rng(3)
    for _ in range(30):
        symbols = np.append(rng.integers(0, 4, rng.integers(1, 200)), 0).astype(np.int64)
        index = decontaminate.FMIndex(symbols)
        for n in (1, 2, 5):
            rows = rng.integers(1, 5, (20, n))
            for row, low, high in zip(rows, *index.search(rows)):
                found = sorted(index.locate(np.arange(low, high)).tolist())
                wanted = [i for i in range(len(symbols) - n + 1) if (symbols[i : i + n] == row).all()]
                assert found == wanted


def test_close_pairs():
    rng = np.random.default_rng(5)
    sizes = [1, 70, 3, 200, 2]
    values = np.array([int(rng.integers(0, 2**62)) for _ in range(40)], dtype=np.uint64)[rng.integers(0, 40, sum(sizes))]
    for k in range(len(values)):
        for b in rng.integers(0, 64, rng.integers(0, 3)):
            values[k] ^= np.uint64(1) << np.uint64(b)
    starts = np.cumsum(sizes) - sizes
    group = np.repeat(np.arange(len(sizes)), sizes)
    for radius in (1, 2, 3):
        found = {(int(a), int(b)) for x, y in simhash.close_pairs(values, starts, radius) for a, b in zip(x, y)}
        wanted = {
            (a, b)
            for b in range(len(values))
            for a in range(b)
            if group[a] == group[b] and int(values[a] ^ values[b]).bit_count() <= radius
        }
        assert found == wanted


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(k, k + 1) for k in range(500, 560)]
    found = {r.id: r.root for r in common.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    label = brute.classes(600, edges)
    assert found == {k: label[k] for e in edges for k in e if e[0] != e[1]}


def test_segments_are_the_maximal_ones():
    def by_definition(scores):
        """Best segment first, then left and right of it; the shortest of equals."""
        best = max(
            ((sum(scores[a:b]), a - b, -a) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)),
            default=(0, 0, 0),
        )
        if best[0] <= 0:
            return []
        a, b = -best[2], -best[2] - best[1]
        left, right = by_definition(scores[:a]), by_definition(scores[b:])
        return left + [(a, b - 1)] + [(x + b, y + b) for x, y in right]

    rng = np.random.default_rng(6)
    for _ in range(300):
        scores = rng.integers(-9, 9, rng.integers(0, 14)) + rng.random() / 64
        found = toxicity.segments(np.array(scores, dtype=np.float32))
        assert [s[:2] for s in found] == by_definition(list(scores))


def test_edit_distance_and_keys():
    rng = random.Random(8)
    for _ in range(3000):
        a = "".join(rng.choice("abc") for _ in range(rng.randint(0, 24)))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            at = rng.randint(0, len(b))
            b[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b"])
        b = "".join(b)
        distance = brute.edit_distance(a, b)
        for edits in (1, 2, 3):
            assert lines.within(a, b, edits) == (distance <= edits)
        short, long = sorted((a, b), key=len)
        if distance <= 2 and len(short) >= 3:
            own = {k for k, mine in lines.keys_of(short, 2) if mine}
            assert own & {k for k, _ in lines.keys_of(long, 2)}


def test_equal_groups():
    rng = np.random.default_rng(9)
    for depth in (1, 8, 13, 24):
        data = bytes(rng.integers(97, 99, 300, dtype=np.uint8))
        at = np.arange(len(data) - depth + 1)
        index, group = suffixes.equal_groups(data, at, np.zeros(len(at), np.int64), depth)
        found = {}
        for i, g in zip(index, group):
            found.setdefault(g, set()).add(int(i))
        wanted = {}
        for i in at:
            wanted.setdefault(data[i : i + depth], set()).add(int(i))
        assert sorted(map(sorted, found.values())) == sorted(sorted(v) for v in wanted.values() if len(v) > 1)


def test_encoder_agrees_with_the_tokenizer():
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(10)
    letters = list("ab  'smtdlrev1९\n\t\r!?.é　 ²日 ")
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(4000)]
    texts += ["I'll don't 's ''s they've 'REs it's's", "a<|endoftext|>b", "  x", "x  ", "'", "' s", " 's", ""]
    texts += [t for _, t in tables.read("documents", ["doc_id", "text"])]
    encoder = packing.Encoder(path)
    wanted = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [encoder.encode(t).tolist() for t in texts] == [w.ids for w in wanted]


def test_patterns_stay_within_the_histogram():
    rng = np.random.default_rng(11)
    for n in (1, 40, 400):
        histogram = {}
        for size in rng.integers(1, 64, n).tolist():
            histogram[size] = histogram.get(size, 0) + 1
        used = {}
        for pattern, times in packing.patterns(histogram, 64):
            assert sum(s * c for s, c in pattern.items()) <= 64 and times > 0
            for size, c in pattern.items():
                used[size] = used.get(size, 0) + c * times
        assert all(used[s] <= histogram[s] for s in used)
    assert packing.patterns({}) == []
    assert packing.patterns({1: 5000}) == [({1: 1024}, 4)]


def check_packing(rows, docs, path):
    encoded = Tokenizer.from_file(path).encode_batch([t or "" for _, t in docs], add_special_tokens=False)
    pool = {}
    for (d, _), e in zip(docs, encoded):
        pool.setdefault(d, []).append(np.array([*e.ids, 0], "<u4"))
    by, sequences = {}, {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(by) == set(pool)
    for d, pieces in by.items():
        if len(pool[d]) == 1:
            ids, at = pool[d][0], 0
            for r in sorted(pieces, key=lambda r: r.start):
                assert r.start == at and r.length > 0 and r.doc_tokens == len(ids)
                assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
                at += r.length
            assert at == len(ids)
        else:
            assert sum(r.length for r in pieces) == sum(map(len, pool[d]))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024
        padding += 1024 - at if at & (at - 1) else 0
    assert padding <= packing.MOST_WASTE * 1024 * len(sequences)


def test_packing(spark, tmp_path):
    docs = tables.documents()
    tables.write_documents(spark, str(tmp_path), docs)
    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = packing.pack(spark.read.parquet(f"{tmp_path}/documents.parquet"), path).collect()
    check_packing(rows, docs, path)


def test_reliabilities_favour_the_true_spans():
    table = [("card", (1, 1, -1, 1), 90), ("card", (0, 0, -1, 1), 80), ("card", (0, 1, 0, 0), 20), ("card", (1, 1, 1, 1), 9)]
    table = [(kind, (*votes, -1, -1), n) for kind, votes, n in table]
    share, skill, posterior = private.reliabilities(table)
    assert posterior[0] > 0.9 and posterior[3] > 0.9 and posterior[1] < 0.1 and posterior[2] < 0.5
    assert all(0 < v < 1 for pair in skill.values() for v in pair) and 0 < share["card"] < 1


def test_graph_recall():
    rng = np.random.default_rng(12)
    centres = rng.normal(size=(300, 24))
    raw = (centres[rng.integers(0, 300, 3000)] + 0.12 * rng.normal(size=(3000, 24))).astype(np.float32)
    points = vectors.unit(raw).astype(np.float32)
    order, layers = vectors.build(points, 1)
    import pickle

    blob = pickle.dumps((raw[order], np.arange(3000)[order], np.ones(3000, np.int64), layers))
    shard = vectors.Shard(blob, 0.95)
    asked = raw[::10]
    query, vertex = shard.links(asked)
    exact = vectors.unit(asked) @ vectors.unit(raw[order]).T
    wanted = set(zip(*np.nonzero(exact >= 0.95)))
    found = set(zip(query.tolist(), vertex.tolist()))
    assert found <= wanted
    assert len(found) >= 0.9 * len(wanted) and len(wanted) > 1000


@pytest.mark.parametrize("rows", [0, 1, 2])
def test_graph_of_few_points(rows):
    order, layers = vectors.build(np.eye(4, dtype=np.float32)[:rows], 1)
    assert len(order) == rows and all(len(g) <= rows for g in layers)
