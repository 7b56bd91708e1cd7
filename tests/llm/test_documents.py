"""Operators on documents against brute force: real rows, awkward rows, none at all."""

import pytest

from spokewise.llm import lines, queries, recurring, search, simhash
from spokewise.llm.common import placed
from tests.llm import brute, tables

ITEMS = [(1, "the quick brown fox"), (None, "the quick"), (3, None), (4, ""), (4, "one two " * 20)]


@pytest.fixture(scope="module")
def docs():
    return tables.documents() + [(1100, "He saw the quick, brown FOX."), (1101, "one two " * 30), (1100, "the quick")]


@pytest.fixture(scope="module")
def items():
    return tables.read("benchmark", ["item_id", "text"]) + ITEMS


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, docs, items):
    path = str(tmp_path_factory.mktemp("tables"))
    tables.write_documents(spark, path, docs)
    schema = "item_id long, text string"
    spark.createDataFrame(items, schema).coalesce(1).write.parquet(f"{path}/benchmark.parquet")
    labels = tables.read("labels", ["doc_id", "quality", "toxic"]) + [(None, 1, 1), (1003, 1, None), (1003, 0, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").coalesce(1).write.parquet(
        f"{path}/labels.parquet"
    )
    return path


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("empty"))
    for name in ("documents", "benchmark", "labels"):
        spark.read.parquet(f"{tables.SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return path


def in_table_order(spark, folder):
    """Rows in the order that ties go by."""
    rows = placed(spark.read.parquet(f"{folder}/documents.parquet"), "doc_id", "text").orderBy("rid").collect()
    return [tuple(r)[1:] for r in rows]


def agree(result, wanted):
    assert tables.sorted_rows(result.collect()) == tables.sorted_rows(wanted)


def test_contamination(spark, folder, docs, items):
    agree(queries.op1_benchmark_decontamination(spark, folder), brute.contamination(docs, items))


def test_contamination_in_blocks_and_shards(spark, folder, docs, items, monkeypatch):
    from spokewise.llm import decontaminate

    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 2000)
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 500)
    agree(queries.op1_benchmark_decontamination(spark, folder), brute.contamination(docs, items))


def test_simhash(spark, folder, docs):
    agree(queries.op2_simhash_near_dedup(spark, folder), brute.simhash_components(docs))


def test_simhash_with_crowded_buckets(spark, folder, docs, monkeypatch):
    monkeypatch.setattr(simhash.near_duplicates, "__defaults__", (2, 1))
    agree(queries.op2_simhash_near_dedup(spark, folder), brute.simhash_components(docs))


def test_simhash_keeps_one(spark, folder, docs):
    kept = simhash.keep_one(spark.read.parquet(f"{folder}/documents.parquet"))
    assert kept.count() == len(set(brute.simhash_classes(docs)[1]))
    assert kept.columns == spark.read.parquet(f"{folder}/documents.parquet").columns


@pytest.mark.parametrize("most", [recurring.MOST_VARIANTS, 1])
def test_phrases(spark, folder, monkeypatch, most):
    monkeypatch.setattr(recurring, "MOST_VARIANTS", most)
    agree(queries.op8_phrase_automata(spark, folder), brute.phrases_removed(in_table_order(spark, folder)))


@pytest.mark.parametrize("most", [recurring.MOST_VARIANTS, 1])
def test_suffixes(spark, folder, docs, monkeypatch, most):
    monkeypatch.setattr(recurring, "MOST_VARIANTS", most)
    agree(queries.op10_suffix_radix(spark, folder), brute.bytes_removed(docs))


def test_segments_of_long_texts(spark, folder, docs, monkeypatch):
    monkeypatch.setattr(recurring, "SEGMENT", 1024)
    monkeypatch.setattr(recurring, "MOST_FOLDED", 50)
    agree(queries.op10_suffix_radix(spark, folder), brute.bytes_removed(docs))


@pytest.mark.parametrize("most", [lines.MOST_IN_KEY, 2])
def test_lines(spark, folder, monkeypatch, most):
    monkeypatch.setattr(lines, "MOST_IN_KEY", most)
    near = lambda a, b: 0 if lines.within(a, b, 2) else 9
    wanted = brute.lines_removed(in_table_order(spark, folder), near=near)
    agree(queries.op6_line_dedup(spark, folder), wanted)


def test_search(spark, folder, docs, items):
    agree(queries.op12_lexical_search(spark, folder), brute.ranked(docs, items))


def test_search_in_shards_blocks_and_strata(spark, folder, docs, items, monkeypatch):
    monkeypatch.setattr(search, "SHARD_BYTES", 40_000)
    monkeypatch.setattr(search, "BLOCK_TERMS", 50)
    monkeypatch.setattr(search, "VISIT", 3)
    agree(queries.op12_lexical_search(spark, folder), brute.ranked(docs, items))


def test_private(spark, folder, docs):
    rows = queries.op9_private_data(spark, folder).collect()
    wanted = brute.private(docs)
    assert tables.sorted_rows(r[:6] for r in rows) == tables.sorted_rows(w[:6] for w in wanted)
    spans = {}
    for w in wanted:
        spans.setdefault((w[0], w[5]), w[6])
    for r in rows:
        assert set(spans[r.doc_id, r.base_sha256]) <= set(r.spans.split(",")) | {""}
        assert r.n_spans == len([s for s in r.spans.split(",") if s])


@pytest.mark.parametrize("name", [n for n in queries.QUERIES if n.split("_")[0] not in ("op5", "op7", "op11")])
def test_no_rows(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).collect() == []
