"""Ranked search in many shards: what is stored, sent and kept while it runs."""

import random

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from spokewise.llm import search
from tests.llm import brute, tables


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    return [(k, " ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(rng.randint(0, 80)))) for k in range(400)]


def frame(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} long, text string").coalesce(1)


def test_row_groups_of_the_index_hold_a_few_shards(spark, monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", 500_000)
    text = F.expr("concat_ws(' ', transform(sequence(1, 4000), k -> md5(concat(id, '-', k))))")
    documents = spark.range(0, 240, 1, 1).select(F.col("id").alias("doc_id"), text.alias("text"))
    shards = search.index(documents)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in shards.inputFiles()]
    groups = [f.row_group(k) for f in files for k in range(f.num_row_groups)]
    assert sum(g.num_rows for g in groups) == shards.count() == 60
    assert len(groups) > 3 and max(g.total_byte_size for g in groups) < 12_000_000


def test_a_block_of_queries_is_sent_once_to_several_shards(spark, rows, monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", 2_000)
    items = frame(spark, rows[:20], "item_id").select(F.col("item_id").alias("q"), F.col("text").cast("binary").alias("body"))
    shards = search.index(frame(spark, rows, "doc_id"))
    assert shards.count() > 20
    assert search._asked(items, shards, len(rows)).count() == 1


@pytest.mark.parametrize("lane, spool, block", [(1, 4_000_000, 20_000), (3, 10, 40), (1_000, 10, 40)])
def test_lanes_and_blocks_on_disk(spark, rows, monkeypatch, lane, spool, block):
    monkeypatch.setattr(search, "SHARD_BYTES", 5_000)
    monkeypatch.setattr(search, "LANE_SHARDS", lane)
    monkeypatch.setattr(search, "SPOOL_BYTES", spool)
    monkeypatch.setattr(search, "BLOCK_TERMS", block)
    items = rows[:30] + [(None, "aa bb"), (5, None)]
    found = search.rank(frame(spark, rows, "doc_id"), frame(spark, items, "item_id"))
    assert tables.sorted_rows(found.collect()) == tables.sorted_rows(brute.ranked(rows, items))


@pytest.mark.parametrize("n", [300, 40_000])
def test_a_shard_comes_back_as_it_was(n):
    rng = np.random.default_rng(3)
    texts = [b" ".join(b"%d" % w for w in rng.integers(0, 50, rng.integers(1, 4))) for _ in range(n)]
    filled = search.OpenShard()
    for key, text in enumerate(texts):
        filled.add(key, text)
    row = filled.row(7)
    shard = search.Shard(row.column("body")[0].as_py(), n, row.column("n_terms")[0].as_py())
    counts = {h["term"]: h["n"] for h in row.column("held")[0].as_py()}
    for term in (b"0", b"7", b"49"):
        k = shard.number[term]
        here = slice(shard.ends[k] - counts[term], shard.ends[k])
        found = dict(zip(shard.ids[shard.docs[here]].tolist(), shard.tfs[here].tolist()))
        assert found == {key: t for key, text in enumerate(texts) if (t := text.split().count(term))}
