"""The pipeline's first stages, row for row."""

import corpus_pipeline
from spokewise.llm import queries
from tests.llm import brute, tables
from tests.llm.test_documents import in_table_order
from tests.llm.test_short_lines import near


def test_line_stage(spark, tmp_path):
    tables.write_documents(spark, str(tmp_path), tables.documents())
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    wanted = [(d, sha) for d, _, _, sha in brute.lines_removed(in_table_order(spark, str(tmp_path)), near=near)]
    kept = corpus_pipeline.without_repeated_lines(spark, docs, str(tmp_path)).select("doc_id", "text").collect()
    found = [(d, None if t is None else brute.sha(t)) for d, t in kept]
    assert tables.sorted_rows(found) == tables.sorted_rows(wanted)


def test_toxicity_stage(spark):
    docs = spark.read.parquet(f"{tables.SF_DIR}/documents.parquet")
    scored = queries.op3_toxicity(spark, tables.SF_DIR).collect()
    kept = corpus_pipeline.without_toxic(spark, docs, tables.SF_DIR).select("doc_id").collect()
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in scored if r.score < 0.5)
