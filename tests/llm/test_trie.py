"""The conversation prefix trie against brute force: many shards, bands, long and awkward conversations."""

import random

import pytest

from spokewise.llm import queries, trie
from tests.llm import brute, tables

SCHEMA = "conv_id long, turn long, role string, text string, conv string, key string, n_convs string"


def odd_rows():
    rng = random.Random(1)
    rows = [
        (c, t, rng.choice(["user", "assistant", None]), rng.choice(["a", "é", "bb", None, "a,b"]))
        for c in [*range(-12, 60), 1000, 1003]
        for t in [None] * rng.randint(0, 2) + list(range(rng.randint(0, 7)))
    ]
    rows += [(c, t, "user", str(t % 3)) for c, n in ((500, 40), (501, 40), (503, 37)) for t in range(n)]
    rows += [(600 + k, t, "user", "same") for k in range(30) for t in range(3)]
    return rows + [(None, 0, "user", "x"), (700, 0, "user", "twice"), (700, 0, "user", "twice"), (701, 0, "u", "long " * 30_000)]


def found(spark, rows, band=None):
    extra = [(*r, "c", "k", "n") for r in rows]
    return tables.sorted_rows(trie.prefix_trie(spark.createDataFrame(extra, SCHEMA).repartition(5), band).collect())


@pytest.mark.parametrize("turns, band", [(trie.SHARD_TURNS, None), (1, 2), (7, None), (30, 3)])
def test_trie(spark, monkeypatch, turns, band):
    monkeypatch.setattr(trie, "SHARD_TURNS", turns)
    rows = odd_rows()
    assert found(spark, rows, band) == tables.sorted_rows(brute.prefix_trie(rows))


def test_conversation_over_batches_and_ranges(spark):
    rows = [(c, t, "user", str(t % 7)) for c, n in ((0, 20), (1, 900), (4, 1200), (6, 901)) for t in range(n)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 100)
    try:
        mine = found(spark, rows, 500)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert mine == tables.sorted_rows(brute.prefix_trie(rows))


def test_query(spark, tmp_path):
    rows = tables.read("conversations", ["conv_id", "turn", "role", "text"]) + odd_rows()
    extra = [(*r, "c", "k", "n") for r in rows]
    spark.createDataFrame(extra, SCHEMA).coalesce(2).write.parquet(f"{tmp_path}/conversations.parquet")
    assert tables.sorted_rows(queries.op11_conversation_trie(spark, str(tmp_path)).collect()) == tables.sorted_rows(brute.prefix_trie(rows))


def test_no_conversations(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 0, "user", "x")]) == []


def test_medians_come_first():
    order = list(trie._medians(7))
    assert order[0] == 3 and sorted(order) == list(range(7)) and set(order[1:3]) == {1, 5}


def test_tree_is_balanced():
    tree, n = trie.TernaryTree(), 1 << 10
    for k in trie._medians(n):
        tree.insert("", 0, [k], [1], 1, k)
    depth = {tree.first[0]: 1}
    for node in range(2, n + 1):
        up = next(u for u in range(1, n + 1) if node in (tree.lower[u], tree.higher[u])) if node <= 40 else None
        if up is not None:
            depth[node] = depth[up] + 1
    assert max(depth.values()) <= 7
