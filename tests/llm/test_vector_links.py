"""Links end to end with shards that are searched by graph: recall, precision and both sides of a link."""

import numpy as np
import pytest

from spokewise.llm import vectors


@pytest.mark.parametrize("n", [10_000, 24_000])
def test_links_of_large_shards(spark, monkeypatch, n):
    monkeypatch.setattr(vectors, "SHARDS", 2)
    rng = np.random.default_rng(n)
    rows = rng.normal(size=(n, 32))
    # pairs just over the threshold, some groups, and a large one
    pairs = n // 10
    rows[pairs : 2 * pairs] = rows[:pairs] + 0.3 * rng.normal(size=(pairs, 32))
    for k in range(20):
        rows[3 * pairs + 50 * k : 3 * pairs + 50 * (k + 1)] = rng.normal(size=32) + 0.2 * rng.normal(size=(50, 32))
    rows[5 * pairs : 6 * pairs] = rng.normal(size=32) + 0.1 * rng.normal(size=(pairs, 32))
    rows = rows.astype(np.float32)
    unit = vectors.unit(rows)
    wanted = np.concatenate([(unit[a : a + 1000] @ unit.T >= 0.95).sum(axis=1) - 1 for a in range(0, n, 1000)])
    table = spark.createDataFrame(list(enumerate(rows.tolist())), "vec_id long, embedding array<float>").repartition(4)
    got = np.zeros(n, dtype=np.int64)
    for r in vectors.near_duplicates(table).select("vec_id", "n_links").collect():
        got[r.vec_id] = r.n_links
    assert (got <= wanted).all()
    linked = wanted > 0
    recall = got.sum() / wanted.sum(), (got[linked] / wanted[linked]).mean(), (got == wanted).mean()
    print(n, int(wanted.sum()), recall)
    assert min(recall) >= 0.95
