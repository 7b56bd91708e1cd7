"""Lines of one template, in any number, against brute force."""

import random

import pytest

from spokewise.llm import lines, queries
from tests.llm import brute, tables
from tests.llm.test_documents import in_table_order
from tests.llm.test_short_lines import near

WORDS = "a line of a log that says the same but for a number, at some length, so that most segments agree: "


def rows_of(texts, each=50):
    return [(k, "\n".join(texts[i : i + each])) for k, i in enumerate(range(0, len(texts), each))]


def found(spark, tmp_path, docs):
    tables.write_documents(spark, str(tmp_path), docs)
    return queries.op6_line_dedup(spark, str(tmp_path))


@pytest.mark.parametrize("most", [10, 1000])
def test_templates(spark, tmp_path, monkeypatch, most):
    """Numbers at the end, at the start, in the middle, twice; far and near ones, of several lengths."""
    monkeypatch.setattr(lines, "MOST_IN_KEY", most)
    rng = random.Random(9)
    texts = [f"{WORDS}{k * k}" for k in range(40)] + [f"{k * 7919} {WORDS}" for k in range(40)]
    texts += [f"{WORDS}{rng.randrange(10**9)} done" for _ in range(40)]
    texts += [f"{WORDS[:40]}{rng.randrange(10**4)}{WORDS[40:]}{rng.randrange(10**4)}" for _ in range(80)]
    texts += [f"{WORDS[:30]}{rng.choice('abcé')}{WORDS[30:60]}{rng.choice('abc')}{WORDS[60:]}{rng.choice(['', 'x', 'yy'])}" for _ in range(60)]
    rng.shuffle(texts)
    docs = rows_of(texts, 7)
    result = found(spark, tmp_path, docs)
    wanted = brute.lines_removed(in_table_order(spark, str(tmp_path)), near=near)
    assert tables.sorted_rows(result.collect()) == tables.sorted_rows(wanted)


def test_many_lines_of_one_template(spark, tmp_path):
    """5,000 numbers of up to four digits, all connected, and 3,000 that are far from each other."""
    rng = random.Random(2)
    far = [f"{WORDS}{k}" for k in sorted({rng.randrange(10**15) * 1000 for _ in range(3000)})]
    docs = rows_of([f"{WORDS}{k}" for k in range(5000)] + far)
    result = found(spark, tmp_path, docs).collect()
    assert sum(r.n_lines - r.n_removed for r in result) == 1 + len(far)


def test_spanning_links_stop_when_all_are_connected():
    members = [(k, k, f"{k:05d}") for k in range(3000)]
    assert len(lines.spanning_links(members, 2)) == 2999
    assert lines.spanning_links([(1, "c", "same"), (2, "c", "same")], 2) == []
