"""Table readers over a table of pages: cells come out of Arrow batches in Python, values from column functions.

Every reader takes a DataFrame with an ``html`` column and key columns, and keeps the keys.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from touchline.config import DEFAULTS
from touchline.functions import (
    first_srcset_url,
    parse_age,
    parse_fee,
    parse_market_value,
    profile_id,
    profile_slug,
)
from touchline.sources.markup import Element, Forest, expand, parse

# Marks of the pages that are read.
ROW_CLASSES = ("odd", "even")
SQUAD_CELLS = 9
MAX_SPAN = 1000  # as browsers do
TRANSFER_CELLS = 12
DIRECTIONS = {"Arrivals": "in", "Departures": "out"}
PROFILE_LABELS = {
    "dob": ["Date of birth", "Geburtsdatum"],
    "height": ["Height", "Größe"],
    "foot": ["Foot", "Fuß"],
    "nationality_full": ["Citizenship", "Nationality", "Staatsangehörigkeit"],
    "contract_expires": ["Contract expires", "Contract until", "Vertrag bis"],
    "agent": ["Player agent", "Agent"],
}
VALUE_POINTS_PATTERN = r"(?s)var\s+marketValueDevelopment\s*=\s*(\[.*?\])\s*;"
PART_BYTES = 1 << 21
IMAGE_ATTRS = ["data-src", "data-srcset", "srcset", "src"]


def _rows(
    pages: DataFrame, keys: Sequence[str], fields: str, read: Callable[[str], list[tuple]],
    read_regular: Callable[[Forest], tuple[np.ndarray, list[pa.Array]]] | None = None,
) -> DataFrame:
    """Run ``read`` on every page; its tuples become rows next to the page's keys.

    ``read_regular`` gives the same rows for the regular pages of many at once, as page numbers and columns.
    """
    row_type = T.StructType.fromDDL(fields)
    schema = T.StructType([pages.schema[k] for k in keys] + row_type.fields)
    maps = [isinstance(f.dataType, T.MapType) for f in row_type]

    def one_by_one(found: list[list[tuple]], types: list[pa.DataType]) -> tuple[np.ndarray, list[pa.Array]]:
        page = np.repeat(np.arange(len(found)), [len(rows) for rows in found])
        cells = zip(*(row for rows in found for row in rows), strict=True) if len(page) else [()] * len(maps)
        listed = ([c if c is None else list(c.items()) for c in column] if is_map else column for column, is_map in zip(cells, maps, strict=True))
        return page, [pa.array(c, t) for c, t in zip(listed, types, strict=True)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = to_arrow_schema(schema)
        types = arrow.types[len(keys) :]
        for batch in batches:
            for part in _parts(batch, len(keys)) if read_regular else [batch]:
                html = part.column(len(keys))
                if read_regular:
                    forest = Forest(html)
                    page, cells = read_regular(forest)
                    others = np.flatnonzero(~forest.regular)
                    if len(others):
                        more, extra = one_by_one([read(h) for h in html.take(pa.array(others)).to_pylist()], types)
                        page = np.concatenate([page, others[more]])
                        cells = [pa.concat_arrays([c.cast(t), x]) for c, x, t in zip(cells, extra, types, strict=True)]
                        order = pa.array(np.argsort(page, kind="stable"))
                        page, cells = page[order], [c.take(order) for c in cells]
                else:
                    page, cells = one_by_one([read(h) for h in html.to_pylist()], types)
                given = [part.column(i).take(pa.array(page)).cast(arrow.field(i).type) for i in range(len(keys))]
                yield pa.RecordBatch.from_arrays([*given, *(c.cast(t) for c, t in zip(cells, types, strict=True))], schema=arrow)

    return pages.select(*keys, "html").mapInArrow(run, schema)


def _parts(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Slices of about ``PART_BYTES`` of pages; a larger page is one of its own."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    begin = 0
    while begin < batch.num_rows:
        most = (ends[begin - 1] if begin else 0) + PART_BYTES
        end = max(begin + 1, int(np.searchsorted(ends, most, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def _header(rows: list[list[Element]]) -> list[str]:
    """Column names of one or two header rows: 'Group_Name', or the name alone under an empty group."""
    levels = []
    for row in rows:
        names: list[str] = []
        for cell in row:
            span = cell.attrs.get("colspan") or ""
            names += [cell.text()] * (min(int(span), MAX_SPAN) if span.isdecimal() else 1)
        levels.append(names)
    if len(levels) < 2:
        return levels[0] if levels else []
    groups, names = levels[-2:]
    groups = groups + [""] * (len(names) - len(groups))
    return [n if not g else f"{g}_{n}" if n else g for g, n in zip(groups, names)]


def _read_table(html: str, table_id: str, header_rows: int) -> list[tuple]:
    root, comments = parse(html)
    hidden = (parse(c)[0].first("table", id=table_id) for c in comments if table_id in c)
    table = next((t for t in hidden if t is not None), None) or root.first("table", id=table_id)
    if table is None:
        return []
    grid = [[c for c in tr.children if c.tag in ("td", "th")] for tr in table.all("tr")]
    names = _header(grid[:header_rows])
    out = []
    for row_no, cells in enumerate(grid[header_rows:]):
        row = {n: c.text() for n, c in zip(names, cells)}
        if "Player" in names and row.get("Player", "") in ("", "Player"):
            continue
        out.append((row_no, row))
    return out


def extract_html_table(pages: DataFrame, keys: Sequence[str], table_id: str, header_rows: int = 2) -> DataFrame:
    """Rows of the table with this id, looked for in comments first, as a map from column name to text."""
    return _rows(
        pages, keys, "row_no bigint, cells map<string,string>", lambda html: _read_table(html, table_id, header_rows)
    )


def _image(element: Element | None) -> tuple:
    return tuple((element.attrs.get(a) if element else None) for a in IMAGE_ATTRS)


def _in_second_cell(image: Element, row: Element) -> bool:
    e = image
    while e != row:
        if e.tag == "td" and [c for c in e.parent.children if c.tag == "td"][1:2] == [e]:
            return True
        e = e.parent
    return False


def _link(row: Element, cells: list[Element]) -> str | None:
    for cell in (cells[1], cells[3]):
        for a in cell.all("a"):
            if "href" in a.attrs:
                return a.attrs["href"]
    links = (a.attrs.get("href") or "" for a in row.all("a"))
    return next((h for h in links if re.search("/profil/spieler/", h, re.I)), None)


def _read_squad(html: str) -> list[tuple]:
    table = parse(html)[0].first("table", ["items"])
    out = []
    for row in table.all("tr", ROW_CLASSES) if table else ():
        cells = list(row.all("td"))
        if len(cells) < SQUAD_CELLS or not cells[3].text():
            continue
        images = list(row.all("img"))
        photo = next((i for i in images if _in_second_cell(i, row)), None)
        photo = photo or row.first("img", ["bilderrahmen-fixed"]) or (images[0] if images else None)
        flag = row.first("img", ["flaggenrahmen"])
        nation = (flag.attrs.get("title") or "") if flag else ""
        texts = [cells[i].text() for i in (3, 4, 5, 8)]
        out.append((*texts, nation, _link(row, cells), *_image(photo)))
    return out


def _photo_url(base: str) -> Column:
    return first_srcset_url(*[F.col(f"_{a.replace('-', '_')}") for a in IMAGE_ATTRS], base=base)


IMAGE_FIELDS = ", ".join(f"_{a.replace('-', '_')} string" for a in IMAGE_ATTRS)


def extract_squad_rows(pages: DataFrame, keys: Sequence[str], base: str = DEFAULTS.site_base) -> DataFrame:
    cells = _rows(
        pages, keys,
        f"player string, position string, dob string, _value string, nationality string, _href string, {IMAGE_FIELDS}",
        _read_squad,
    )
    return cells.select(
        *keys, "player",
        profile_id(F.col("_href")).alias("player_id"),
        profile_slug(F.col("_href")).alias("player_slug"),
        "position", "nationality",
        F.col("nationality").alias("nationality_full"),
        parse_age(F.col("dob")).alias("age"),
        parse_market_value(F.col("_value")).alias("market_value_eur"),
        _photo_url(base).alias("photo_url"),
        "dob",
        *[F.lit("").alias(c) for c in ("height", "foot", "contract_expires")],
    )


def _read_transfers(html: str) -> list[tuple]:
    out = []
    for box in parse(html)[0].all("div", ["box"]):
        title, table = box.first("h2"), box.first("table")
        direction = DIRECTIONS.get(title.text()) if title else None
        if direction is None or table is None:
            continue
        for row in table.all("tr", ROW_CLASSES):
            cells = list(row.all("td"))
            if len(cells) >= TRANSFER_CELLS and cells[3].text():
                out.append((direction, *[cells[i].text() for i in (3, 4, 5, 9, 11)]))
    return out


def _read_regular_transfers(forest: Forest) -> tuple[np.ndarray, list[pa.Array]]:
    """:func:`_read_transfers` of all regular pages."""
    boxes, titles, tables = forest.all("div", ["box"]), forest.all("h2"), forest.all("table")
    title, many = forest.below(titles, boxes)
    table, more = forest.below(tables, boxes)
    whole = (many > 0) & (more > 0)
    titles, tables = titles[title[whole]], tables[table[whole]]
    names = list(DIRECTIONS)
    direction = pc.index_in(forest.texts(titles), pa.array(names, pa.large_string())).fill_null(-1).to_numpy()
    known = direction >= 0
    direction, tables = direction[known], tables[known]
    rows = forest.all("tr", ROW_CLASSES)
    first, count = forest.below(rows, tables)
    direction, rows = np.repeat(direction, count), rows[expand(first, count)]
    cells = forest.all("td")
    first, count = forest.below(cells, rows)
    long = count >= TRANSFER_CELLS
    direction, rows, first = direction[long], rows[long], first[long]
    named = pc.binary_length(forest.texts(cells[first + 3])).to_numpy() > 0
    direction, rows, first = direction[named], rows[named], first[named]
    ways = pa.array([DIRECTIONS[n] for n in names], pa.large_string()).take(pa.array(direction))
    return forest.page[rows], [ways, *(forest.texts(cells[first + i]) for i in (3, 4, 5, 9, 11))]


def extract_transfer_rows(pages: DataFrame, keys: Sequence[str], focal: str = DEFAULTS.focal_team) -> DataFrame:
    cells = _rows(
        pages, keys, "direction string, player string, position string, _age string, _club string, _fee string",
        _read_transfers, _read_regular_transfers,
    )
    arriving = F.col("direction") == "in"
    fee = parse_fee(F.col("_fee"))
    return cells.select(
        *keys, "player", F.lit("").alias("player_id"), "direction",
        F.when(arriving, F.col("_club")).otherwise(focal).alias("from_club"),
        F.when(arriving, focal).otherwise(F.col("_club")).alias("to_club"),
        fee["fee_eur"].alias("fee_eur"),
        fee["fee_text"].alias("fee_text"),
        F.lit(None).cast("date").alias("transfer_date"),
        "position",
        F.when(F.col("_age").rlike(r"^\d+$"), F.col("_age").try_cast("bigint")).alias("age_at_transfer"),
    )


def _read_profile(html: str) -> list[tuple]:
    root = parse(html)[0]
    bio: dict[str, str] = {}
    for table in root.all("table", ["auflistung"]):
        for tr in table.all("tr"):
            cells = list(tr.all("td"))
            if len(cells) >= 2 and cells[0].text(" "):
                bio[cells[0].text(" ")] = cells[1].text(" ")
    entries = [{"label": k, "value": v} for k, v in bio.items()]
    return [(entries, *_image(root.first("img", ["data-header__profile-image"])))]


def _bio_value(labels: list[str]) -> Column:
    """Value of the first entry whose label contains one of ``labels``, tried in turn, in any case."""

    def entry(label: str) -> Column:
        hits = F.filter("_bio", lambda e: F.lower(e["label"]).contains(label.lower()))
        return F.get(hits, 0)["value"]

    return F.coalesce(*[entry(label) for label in labels], F.lit(""))


def extract_profile_rows(pages: DataFrame, keys: Sequence[str], base: str = DEFAULTS.site_base) -> DataFrame:
    """One row per page: the biography by its labels, and the value points as JSON text."""
    points = F.regexp_extract("html", VALUE_POINTS_PATTERN, 1)
    with_points = pages.withColumn("_points", F.when(F.json_array_length(points) > 0, points))
    cells = _rows(
        with_points, [*keys, "_points"], f"_bio array<struct<label: string, value: string>>, {IMAGE_FIELDS}",
        _read_profile,
    )
    return cells.select(
        *keys,
        _photo_url(base).alias("photo_url"),
        *[_bio_value(labels).alias(name) for name, labels in PROFILE_LABELS.items()],
        F.col("_points").alias("mv_history_json"),
    )
