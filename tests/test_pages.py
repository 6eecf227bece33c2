"""The page reader on malformed pages."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest

from touchline.sources import pages
from touchline.sources.markup import Forest, parse

PAGE = "<table id='t'><tr><th colspan='{span}'>G</th></tr><tr><th>Player</th><th>N</th></tr><tr><td>Ann</td><td>1</td></tr></table>"


@pytest.mark.parametrize("unit", ["<script ", "<!--", "<a ", "<a href=\"", "<a '\"", "</", "<script>", "<style></script", "<![CDATA[", "<div></p>"])
def test_time_is_linear(unit):
    taken = []
    for size in (50_000, 400_000):
        began = time.process_time()
        parse(unit * (size // len(unit)) + "<b>x</b>")
        taken.append(time.process_time() - began)
    assert taken[1] < 5 and taken[1] < 30 * max(taken[0], 0.02)


def test_deep_nesting_and_unclosed_parts():
    root, _ = parse("<div>" * 3000 + "deep <b>text</b>")
    assert root.text() == "deep text" and sum(1 for _ in root.walk()) == 3001
    root, comments = parse("a <!-- b --> c <!-- d <i>e</i> 1 < 2 <p title='>'>f</p>")
    assert comments == [" b "] and root.text("|") == "a|c <!-- d|e|1 < 2|f"
    assert next(root.all("p")).attrs == {"title": ">"}


@pytest.mark.parametrize("span", ["x", "", "0", "2", "99999999999", "-1"])
def test_spans(rows, span):
    got = pages.extract_html_table(rows([(1, PAGE.format(span=span))], "id int, html string"), ["id"], "t").collect()
    assert len(got) == 1 and "Ann" in got[0]["cells"].values()


def test_empty_tables_and_pages(rows):
    df = rows([(1, "<table id='t'></table>"), (2, None), (3, ""), (4, "<table id='t'><tr></tr><tr></tr><tr></tr></table>")], "id int, html string")
    got = pages.extract_html_table(df, ["id"], "t").collect()
    assert [(r["id"], r["cells"]) for r in got] == [(4, {})]
    assert pages.extract_squad_rows(df, ["id"]).count() == 0 and pages.extract_transfer_rows(df, ["id"]).count() == 0


def test_leaves_quotes_and_open_ends():
    """A leaf is read in one step and gives the same tree; a search for quotes says nothing about places before it."""
    page = "<div class='box'><table><tr><td>1</td><td title=\"a>b\">2 &amp; 3</td><td>4<td>5</td></tr></table><br></br>x</div>y"
    root, _ = parse(page)
    row = root.first("tr")
    assert [c.text() for c in row.all("td")] == ["1", "2 & 3", "4", "5"] == [c.text() for c in row.children]
    assert [c.parent for c in row.children] == [row] * 4 and row.parent.tag == "table"
    assert row.children[1].attrs == {"title": "a>b"} and root.first("br").text() == "" and root.first("div").text("|") == "1|2 & 3|4|5|x"
    assert parse("<script a=\"1\" <p title='q>r'>z</p>")[0].first("p").attrs == {"title": "q>r"}
    assert parse("<td>a<th>b</th>c<td>d</td>")[0].text("|") == "a|b|c|d"


BOX = "<div class={kind}><h2>{title}</h2>{between}<table>{rows}</table></div>"
TEXTS = ["x", "", ".", " y ", "&amp;", "&lt", "caf\u00e9", "\u20ac5", "\u3000z", "\x1cq\x85", "<a>q</a> &lt; <b> z</b>", "<br>", "<!DOCTYPE html>", "< b >"]
ODD = ["<!-- c -->", "<script>'<td>'</script>", "</p>", "<p>", "</br>", "a > b", "1 < 2", "<a title='>'>", "<td>", "</div>", "<tr>", "\"", "<"]


def transfer_page(r):
    def text():
        return r.choice(ODD) if r.random() < mess else r.choice(TEXTS)

    def row():
        cells = "".join(f"<td{r.choice(['', ' a=1', ' title=\"b c\"'])}>{text()}</td>" for _ in range(r.randrange(10, 15)))
        return f"<tr class={r.choice(['odd', 'even', '\"x odd\"', 'x'])}>{cells}</tr>"

    def box(depth=2):
        rows = "".join(row() for _ in range(r.randrange(3))) + (box(depth - 1) if depth and r.random() < 0.2 else "")
        title = r.choice(["Arrivals", "Departures", " Departures ", "News", "Arr<b>iv</b>als", "&#65;rrivals"])
        return BOX.format(kind=r.choice(["box", '"x box"', "boxer"]), title=title, between=text(), rows=rows)

    mess = r.choice([0, 0, 0, 0.02])
    return r.choice([None, ""]) if r.random() < 0.05 else "<html><body>" + "".join(box() for _ in range(r.randrange(4))) + "</BODY></html>"


def test_regular_pages_are_read_together(rows):
    """Many pages at once give the elements, texts and rows that each page alone gives; other pages are left out."""
    r = random.Random(8)
    given = [transfer_page(r) for _ in range(400)]
    forest = Forest(pa.array(["<td>before</td>", *given])[1:])
    page, columns = pages._read_regular_transfers(forest)
    found = list(zip(page.tolist(), *(c.to_pylist() for c in columns)))
    elements = np.flatnonzero(forest.opens & forest.regular[forest.page])
    texts = list(zip(forest.page[elements].tolist(), forest.texts(elements).to_pylist()))
    want = [(i, *row) for i, p in enumerate(given) if forest.regular[i] for row in pages._read_transfers(p)]
    assert found == want and len(want) > 100 and 100 < forest.regular.sum() < 390
    assert texts == [(i, e.text()) for i, p in enumerate(given) if forest.regular[i] for e in parse(p)[0].walk()]
    df = rows(list(enumerate(given)), "id int, html string").coalesce(1)
    got = [(x.id, x.direction, x.player, x.position) for x in pages.extract_transfer_rows(df, ["id"]).collect()]
    assert got == [(i, *row[:3]) for i, p in enumerate(given) for row in pages._read_transfers(p)]


def test_regular_pages_take_little_time():
    cells = "".join(f"<td>{t}</td>" for t in (".", ".", ".", "Ann", "Left Winger", "23", ".", ".", ".", "CLUB_1", ".", "\u20ac5"))
    page = '<html><body><div class="box"><h2>Arrivals</h2><table><tr class="even">' + cells + "</tr></table></div></body></html>"
    given = pa.array([page] * 5000)
    began = time.process_time()
    count = sum(len(pages._read_transfers(p)) for p in given.to_pylist())
    alone = time.process_time() - began
    began = time.process_time()
    found, _ = pages._read_regular_transfers(Forest(given))
    assert len(found) == count == 5000 and time.process_time() - began < alone / 2
