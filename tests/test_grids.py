"""Spans, headings and columns of HTML tables."""

from lamina.sources import grids


def grid(spark, html):
    cells = grids.grid_cells(spark.createDataFrame([(1, html), (2, None), (3, "<p>none</p>")], "page int, html string"), "page", "html").collect()
    assert all(c.page == 1 for c in cells)
    return {(c.table_no, c.row_no, c.col_no): c.text for c in cells}, cells


def test_spans(spark):
    html = """<table><tr><th rowspan="2">Grade</th><th colspan='2'>Limits &amp; more</th></tr><TR><td>min</td><td>max<sup>A</sup></td></tr>
    <tr><td rowspan=9>X</td><td>1</td><td>2</td></tr><tr><td>3<td>4</tr></table> text <table class="b"><tr><td></td></tr></table>"""
    places, cells = grid(spark, html)
    assert places == {
        (0, 0, 0): "Grade", (0, 0, 1): "Limits & more", (0, 0, 2): "Limits & more", (0, 1, 0): "Grade", (0, 1, 1): "min", (0, 1, 2): "maxA",
        (0, 2, 0): "X", (0, 2, 1): "1", (0, 2, 2): "2", (0, 3, 0): "X", (0, 3, 1): "3", (0, 3, 2): "4", (1, 0, 0): "",
    }
    assert sum(c.origin for c in cells) == 10 and sum(c.head for c in cells) == 4
    members = grids.members_by_column(grids.grid_cells(spark.createDataFrame([(1, html)], "page int, html string"), "page", "html"), ["page", "table_no"]).collect()
    assert [r.members for r in members] == [["Grade", "X", "Limits & more", "min", "1", "3", "maxA", "2", "4"]]


def test_places_between_spans(spark):
    """A cell goes to the first free place: between what reaches down, and beyond it."""
    places, _ = grid(spark, "<table><tr><td>a</td><td rowspan=3>b</td><td>c</td><td rowspan=2>d</td></tr><tr><td>e</td><td>f</td><td>g</td></tr><tr><td>h</td><td>i</td><td>j</td></tr></table>")
    rows = [[places.get((0, r, c)) for c in range(5)] for r in range(3)]
    assert rows == [["a", "b", "c", "d", None], ["e", "b", "f", "d", "g"], ["h", "b", "i", "j", None]]


def test_heading_paths(spark):
    rows = [(1, 0, "A"), (2, 1, "a:"), (3, None, "x"), (4, 2, "deep"), (5, None, "y"), (6, 1, "b:"), (7, None, "z"), (8, 0, "B"), (9, None, "w"), (10, 2, "d"), (11, None, "v")]
    df = spark.createDataFrame([(1, *r) for r in rows] + [(2, 1, None, "alone")], "doc int, n int, level int, title string")
    got = {(r.doc, r.n): r.path for r in grids.heading_paths(df, ["doc"], ["n"], "level", "title").collect()}
    expected = [[], ["A"], ["A", "a:"], ["A", "a:"], ["A", "a:", "deep"], ["A"], ["A", "b:"], [], ["B"], ["B"], ["B", "d"]]
    assert [got[1, n] for n in range(1, 12)] == expected and got[2, 1] == []
