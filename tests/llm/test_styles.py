"""What style sheets hide, and tables within tables to any depth."""

import pytest

from probelake.llm.html import extract, rendered


@pytest.mark.parametrize(
    "sheet,hides",
    [
        (".x{display:none}", True),
        ("p.x { color: red; Display : NONE }", True),
        ("div.x{display:none}", False),
        ("#i{visibility:hidden}", True),
        ("p#i.x.y{display:none}", True),
        (".x.z{display:none}", False),
        ("*.x{display:none}", True),
        ("h1, .y , b{display:none}", True),
        (".x{display:none} .x{display:block}", False),
        ("#i{display:block} .x{display:none}", False),
        (".x{display:none!important} #i{display:block}", True),
        ("/* .x{display:none} */ .q{}", False),
        ("@media print{.x{display:none}}", False),
        ("@media print{.q{a:b}} .x{display:none}", True),
        ("div .x{display:none}", False),
        (".x:hover{display:none}", False),
        ("@import url(a.css); .x{display:none}", True),
        (".x{display:none", True),
        ("}}{ .x{display:none}", False),
        (".x{-moz-display:none; x-visibility:hidden}", False),
    ],
)
def test_rules_of_style_sheets(sheet, hides):
    page = f"<style>{sheet}</style><p>seen<p id=i class='x y'>told<p>end"
    assert ("told" not in rendered(page)) == hides and "seen" in rendered(page)


def test_style_attributes_come_last():
    sheet = "<style>.x{display:none}.v{visibility:hidden}</style>"
    assert rendered(f"{sheet}<p class=x style='display:block'>a") == "a"
    assert rendered(f"{sheet}<p class=v>a<b style='visibility:visible'>b</b>") == "b"
    assert rendered("<p style='display:none;display:inline'>a") == "a"
    assert rendered(f"<p class=x>first{sheet}") == ""  # a sheet holds for the whole page


def test_deep_tables_keep_their_columns():
    for depth in (1, 10, 400):
        page = "<table><tr><td>a<td>" * depth + "x<table><tr><td>left<td>right<tr><td>l<td>r</table>" + "</table>" * depth
        lines = rendered(page).split("\n")
        left, short = (next(line for line in lines if w in line) for w in ("left", " r"))
        assert left.index("right") == short.index("r")


def test_spans_of_many_columns():
    cells = "".join(f"<td>{i}" for i in range(1200))
    page = f"<table><tr>{cells}<td rowspan=2>down<tr>{cells}<td>last</table>"
    first, second = rendered(page).split("\n")
    assert first.index("down") < second.index("last")


def test_empty_tables_and_other_columns(spark):
    pages = spark.createDataFrame([(1, "<p>a", 5, "x")], "page_id long, html string, n_lines int, text string")
    assert [tuple(r) for r in extract(pages).collect()] == [(1, "a", 1, 1)]
    assert extract(pages.limit(0)).isEmpty()
