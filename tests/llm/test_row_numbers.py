"""Results stay right when a scan is split otherwise from one pass to the next, as with lost executors."""

import pytest

from spokewise.llm import common, lines, queries, recurring, simhash
from spokewise.session import stored
from tests.llm import brute, tables
from tests.llm.test_documents import in_table_order

SPLITS = "spark.sql.files.minPartitionNum"
OPEN_COST = "spark.sql.files.openCostInBytes"


@pytest.fixture
def moving(spark, tmp_path, monkeypatch):
    """A folder of documents whose scan has one split at first and 50 after a stored table."""

    def store(df, label):
        done = stored(df, label)
        spark.conf.set(SPLITS, 50)
        return done

    for module in (common, lines, simhash, recurring):
        monkeypatch.setattr(module, "stored", store)
    tables.write_documents(spark, str(tmp_path), tables.odd_documents())
    spark.conf.set(OPEN_COST, 1)
    spark.conf.set(SPLITS, 1)
    yield str(tmp_path)
    spark.conf.unset(SPLITS)
    spark.conf.unset(OPEN_COST)


@pytest.mark.parametrize(
    "query, wanted",
    [
        (queries.op6_line_dedup, lambda docs: brute.lines_removed(docs, near=lambda a, b: 0 if lines.within(a, b, 2) else 9)),
        (queries.op8_phrase_automata, brute.phrases_removed),
        (queries.op10_suffix_radix, brute.bytes_removed),
    ],
)
def test_moving_splits(spark, moving, query, wanted):
    docs = in_table_order(spark, moving)
    assert tables.sorted_rows(query(spark, moving).collect()) == tables.sorted_rows(wanted(docs))


def test_moving_splits_keep_one(spark, moving):
    docs = spark.read.parquet(f"{moving}/documents.parquet")
    rows = in_table_order(spark, moving)
    label = brute.simhash_classes(rows)[1]
    order = sorted(range(len(rows)), key=lambda k: (brute.NULL_FIRST(rows[k][0]), k))
    first = {}
    for k in order:
        first.setdefault(label[k], rows[k])
    kept = [tuple(r) for r in simhash.keep_one(docs).select("doc_id", "text").collect()]
    assert sorted(map(str, kept)) == sorted(map(str, first.values()))


def test_rows_that_are_no_scan_are_stored(spark):
    """Places of other inputs are written down once."""
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "doc_id long, text string").repartition(3)
    found = common.placed(rows, "doc_id", "text")
    assert len({bytes(r.rid) for r in found.collect()}) == 3 and "parquet" in found._jdf.queryExecution().executedPlan().toString().lower()


def test_scans_are_not_copied(spark):
    scan = spark.read.parquet(f"{tables.SF_DIR}/documents.parquet")
    text = common.placed(scan.where("doc_id >= 0"), "doc_id")._jdf.queryExecution().executedPlan().toString()
    assert "file_path" in text and tables.SF_DIR in text
