"""Embeddings, conversations, toxicity and the pipeline."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from spokewise.llm import chat, queries
from tests.llm import brute, tables

NAN, INF = float("nan"), float("inf")


def test_embeddings(spark, tmp_path):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(30, 8))
    rows = [(k, (base[k % 30] + 0.1 * rng.normal(size=8)).astype(np.float32).tolist()) for k in range(240)]
    rows += [(300 + k, rows[3][1]) for k in range(20)] + [rows[5], (None, rows[5][1]), (None, [9.0] * 8)]
    rows += [(400, None), (401, []), (402, [0.0] * 8), (403, [NAN] * 8), (404, [INF] + [1.0] * 7)]
    rows += [(405, [None] + [1.0] * 7), (406, [2.0 * x for x in rows[7][1]]), (407, [1.0, 2.0]), (408, [1.0, 2.0])]
    extra = [(*r, 1, "x") for r in rows]
    schema = "vec_id long, embedding array<float>, label int, shard string"
    spark.createDataFrame(extra, schema).coalesce(2).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op5_embedding_near_dedup(spark, str(tmp_path)).collect()
    assert tables.sorted_rows(found) == tables.sorted_rows(brute.vector_links(rows))


def test_no_embeddings(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>").write.parquet(f"{tmp_path}/embeddings.parquet")
    assert queries.op5_embedding_near_dedup(spark, str(tmp_path)).collect() == []


def odd_turns():
    rng = random.Random(3)
    parts = ["[INST]", "[/INST]", "</s>", "<s>", "\\", "[", "<", "\n", "a", "é", "assistant", "/INST]", "s>"]
    rows = [
        (900 + k, t, rng.choice(["user", "assistant", "system", "[INST]", "a\\b"]), "".join(rng.choices(parts, k=9)))
        for k in range(40)
        for t in range(rng.randint(1, 6))
    ]
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", None), (990, 0, None, "y"), (991, None, "user", "z")]
    rows += [(992, 0, "assistant", "twice"), (992, 0, "assistant", "twice"), (993, 0, "user", "long " * 30_000)]
    return rows


def test_conversations(spark, tmp_path):
    rows = tables.read("conversations", ["conv_id", "turn", "role", "text"]) + odd_turns()
    schema = "conv_id long, turn long, role string, text string, formatted string, piece string"
    extra = [(*r, "f", "p") for r in rows]
    spark.createDataFrame(extra, schema).coalesce(2).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op7_chat_prefix_targets(spark, str(tmp_path)).collect()
    text = "</s>[INST] ok [/INST]"
    known = [(-7, 0, "user", text), (-7, 1, "assistant", text)]
    assert tables.sorted_rows(found) == tables.sorted_rows(brute.conversations(rows + known))


def test_conversation_over_many_tasks(spark, tmp_path):
    rng = random.Random(5)
    rows = [(k % 3 or None, t, rng.choice(["user", "assistant"]), f"<s>{k}{t}") for k in range(9) for t in range(60)]
    rows += [(7, None, "user", "same")] * 50 + [(7, 1, "assistant", "a" * 40 + str(t)) for t in range(50)]
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        turns = spark.read.parquet(f"{tmp_path}/conversations.parquet")
        assert chat.in_order(chat.format_turns(turns)).select(F.spark_partition_id(), "conv_id").distinct().count() > 8
        found = queries.op7_chat_prefix_targets(spark, str(tmp_path)).where("conv_id IS NULL OR conv_id >= 0").collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tables.sorted_rows(found) == tables.sorted_rows(brute.conversations(rows))


def test_written_examples(spark):
    rows = odd_turns()
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    examples = chat.render(chat.examples(chat.pieces(turns))).collect()
    by = {}
    for e in examples:
        by.setdefault(e.conv_id, []).append(e)
    for c, turns in {r[0]: [t for t in rows if t[0] == r[0]] for r in rows}.items():
        turns = sorted(((t[1] is not None, t[1] or 0, t[2] or "", t[3] or "") for t in turns))
        mine = sorted(by[c], key=lambda e: e.example)
        trained = [chat.unescape(e.text[e.loss_start : e.loss_end]) for e in mine if e.loss_start is not None]
        assert trained == [t[3] for t in turns if t[2] == "assistant"]
        assert mine[-1].example == len(turns) - 1
        for e in mine:
            assert e.text.count(chat.END) == e.example + 1


def test_no_conversations(spark, tmp_path):
    schema = "conv_id long, turn long, role string, text string"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in queries.op7_chat_prefix_targets(spark, str(tmp_path)).collect()] == [-7]


def test_toxicity_learns(spark):
    sf_dir = "/root/testdata/sf0.1"
    scored = queries.op3_toxicity(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = scored.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    toxic, clean = ([r.score for r in rows if r.toxic == k] for k in (1, 0))
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.95
    order = np.mean([t > c for t in toxic for c in clean])
    assert order > 0.9
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_takes_odd_rows(spark, tmp_path):
    docs = tables.odd_documents()
    tables.write_documents(spark, str(tmp_path), docs)
    labels = [(1003, 1, 1), (1003, 1, 0), (None, 1, 1), (1010, 1, None)]
    for name, rows in (("one", labels), ("none", [])):
        path = tmp_path / name
        tables.write_documents(spark, str(path), docs)
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
        found = queries.op3_toxicity(spark, str(path)).collect()
        assert len(found) == len(docs) and all(0 <= r.score <= 1 for r in found)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Rows before and after each stage."""
    path = str(tmp_path_factory.mktemp("pipeline"))
    tables.write_documents(spark, path, tables.documents())
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{tables.SF_DIR}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    docs, out = spark.read.parquet(f"{path}/documents.parquet"), [path]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.parquet(f"{path}/{k}")
        before, docs = docs, spark.read.parquet(f"{path}/{k}")
        out.append((before, docs))
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns(stages):
    for before, after in stages[1:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_stages_decide_as_their_operators(spark, stages):
    _, toxic, lines_, copies, bench, packs = stages
    assert {r[0] for r in rows_of(toxic[1])} <= {r[0] for r in rows_of(toxic[0])}
    assert len(rows_of(toxic[1])) > 0.8 * len(rows_of(toxic[0]))
    assert len(rows_of(lines_[1])) == len(rows_of(lines_[0]))
    assert len(rows_of(copies[1])) == len(set(brute.simhash_classes(rows_of(copies[0]))[1]))
    items = tables.read("benchmark", ["item_id", "text"])
    judged = brute.contamination(rows_of(bench[0]), items)
    clean = sorted((j[0] is not None, j[0]) for j in judged if not j[5])
    assert sorted((r[0] is not None, r[0]) for r in rows_of(bench[1])) == clean
    assert {r[0] for r in packs[1].select("doc_id").collect()} == {r[0] for r in rows_of(packs[0])}

