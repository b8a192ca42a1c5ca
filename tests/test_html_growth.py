"""HTML tables: only the cells that are asked for are read, and only pages with spans make a grid."""

from lakefold.sources import html_table


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_only_wanted_cells_of_plain_pages_are_read(spark):
    pages = spark.createDataFrame([("p", "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td><b>x</b> &amp; y</td></tr>"
                                         "<tr><td></td><td>open <i</td></tr></table>")], "doc_id string, conteudo string")
    rows = html_table(pages, {"A": "a", "B": "b"})
    assert [tuple(r) for r in rows.select("a", "b").collect()] == [("1", "x & y"), (None, "open")]
    marks = [plan_of(rows.select(*cols)).count("(?s)<[^>]*>") for cols in (["a"], ["a", "b"])]
    assert marks[0] < marks[1]


def test_spans_in_one_page_leave_the_others_plain(spark):
    pages = spark.createDataFrame([("p", "<table><tr><th>A</th><th>B</th></tr><tr><td COLSPAN=2>1</td></tr></table>"),
                                   ("q", "<table><tr><th>B</th><th>A</th></tr><tr><td>2</td><td>3</td></tr></table>")], "doc_id string, conteudo string")
    got = {tuple(r) for r in html_table(pages, {"A": "a", "B": "b"}).collect()}
    assert got == {("p", 0, "1", "1"), ("q", 0, "3", "2")}
