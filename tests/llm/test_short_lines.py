"""Equal lines go at any length; only differing lines must be long enough to link."""

from spokewise.llm import lines, queries
from tests.llm import brute, tables
from tests.llm.test_documents import in_table_order


def near(a, b):
    return 0 if lines.within(a, b, 2) else 9


def test_short_lines(spark, tmp_path):
    docs = [(1, "Menu\nHome page\n\nA line of more than twenty characters.\n x"), (2, "  Menu\nMenus\n\t\nhome page")]
    docs += [(3, "Home page\nx\nA line of more than twenty character"), (4, "n" * 19 + "\n" + "n" * 20 + "\n" + "n" * 21)]
    docs += [(4, "n" * 19 + "\n" + "n" * 20), (None, "Menu\n\n\n"), (None, None), (5, "Menu"), (5, "Menu"), (6, "")]
    docs += tables.documents()
    tables.write_documents(spark, str(tmp_path), docs)
    wanted = brute.lines_removed(in_table_order(spark, str(tmp_path)), near=near)
    found = queries.op6_line_dedup(spark, str(tmp_path)).collect()
    assert tables.sorted_rows(found) == tables.sorted_rows(wanted)
    long = [(d, t and "\n".join(x for x in t.split("\n") if len(x.strip()) >= 20)) for d, t in docs]
    assert sum(r.n_removed for r in found) > sum(n for _, _, n, _ in brute.lines_removed(long, near=near))
