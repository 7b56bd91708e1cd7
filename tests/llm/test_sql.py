"""Queries of the subpackage that have SQL, against DuckDB on the whole small tables."""

import duckdb
import pytest

from spokewise.llm import queries
from tests.llm import tables


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tables.SF_DIR}/{t}.parquet'")
    result = queries.QUERIES[name](spark, tables.SF_DIR)
    wanted = duck.execute(queries.ORACLE[name])
    assert result.columns == [d[0] for d in wanted.description]
    assert tables.sorted_rows(result.collect()) == tables.sorted_rows(wanted.fetchall())
