"""HTML tables out of raw pages.

Only pages that hold a table go to Python. There a small parser turns each table
into one row of nested cells; header pairing, null rules and casts are column
work afterwards, on that row, so a page is never shuffled.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from dugout.functions import clean
from dugout.operators.names import once, ref, refs

TABLE_FIELDS = "table_index int, table_id string, origin string, container string, caption string, rows array<{row}>"
ROW_FIELDS = (
    "struct<part:string,css:string,texts:array<string>,heads:array<string>,datas:array<string>,"
    "spans:array<int>,links:array<string>>"
)
#: Pages whose tables are held as Python objects at once.
PAGES_AT_ONCE = 64
LINK_PATTERN = r'(?is)<a\s[^>]*?href="([^"]*)"[^>]*>(.*?)</a>'

# Fixed value: the class of elements that hold a table with its caption.
TABLE_CONTAINER = "table_container"

_TOKEN = re.compile(
    r"<!--(?P<comment>.*?)-->|<(?P<skip>script|style)\b.*?</(?P=skip)\s*>"
    r"|<(?P<end>/?)(?P<tag>table|thead|tbody|tfoot|tr|td|th|caption|a|div)\b(?P<rest>[^>\"']*(?:(?:\"[^\"]*\"|'[^']*')[^>\"']*)*)>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"([\w-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_TAG = re.compile(r"<[^>]+>")


def _attributes(text: str) -> dict[str, str]:
    if "=" not in text:
        return {}
    found = {name.lower(): a or b or c for name, a, b, c in _ATTRIBUTE.findall(text)}
    return {name: entities.unescape(value) for name, value in found.items()}


def _plain(text: str) -> str:
    bare = _TAG.sub("", text) if "<" in text else text
    return entities.unescape(bare) if "&" in bare else bare


class _Open:
    """A table that is being read, with the row and cell in hand."""

    def __init__(self, table: dict) -> None:
        self.table, self.part, self.row, self.cell, self.caption = table, "", None, None, False

    def add(self, text: str) -> None:
        if self.cell is not None:
            self.cell[1] += text
        elif self.caption:
            self.table["caption"] = (self.table["caption"] or "") + text


def _scan(html: str, origin: str = "page") -> list[dict]:
    """Tables of a page, then those in its comments; missing end tags are implied."""
    done, commented, stack, divs, last = [], [], [], [], 0
    held = []  # tables with the container they lie in
    outside = None  # the container whose caption is being read, outside any table
    for token in _TOKEN.finditer(html):
        comment, _, end, tag, rest = token.groups()
        start = token.start()
        if start > last and (stack or outside is not None):
            text = _plain(html[last:start])
            if outside is not None:
                outside["text"] += text
            for state in stack:
                state.add(text)
        last = token.end()
        if tag is None:
            if comment and "<table" in comment.lower():
                commented += _scan(comment, "comment")
            continue
        tag = tag.lower()
        if end:
            if tag in ("caption", "div"):
                outside = None
            _close(tag, stack, divs)
        elif tag == "div":
            divs.append({"class": _attributes(rest).get("class", ""), "caption": None})
        elif tag == "caption" and not stack:
            outside = {"text": ""}
            for div in divs:  # the first caption anywhere inside, at any depth
                if div["caption"] is None:
                    div["caption"] = outside
        elif tag == "table":
            table = {
                "table_index": len(done),
                "table_id": _attributes(rest).get("id"),
                "origin": origin,
                "container": (box := _container(divs)) and box["class"],
                "caption": None,
                "rows": [],
            }
            done.append(table)
            stack.append(_Open(table))
            outside = None
            held.append((table, box))
        elif stack:
            _open(tag, rest, stack[-1])
    for table, container in held:  # a caption that stands in the container, before or after the table
        if table["caption"] is None and container is not None and container["caption"] is not None:
            table["caption"] = container["caption"]["text"]
    for position, table in enumerate(commented):
        table["table_index"] = position
    return done + commented


def _container(divs: list[dict]) -> dict | None:
    """The element that a table belongs to: the nearest one made for tables, or else the nearest."""
    return next((div for div in reversed(divs) if div["class"] == TABLE_CONTAINER), divs[-1] if divs else None)


def _open(tag: str, rest: str, state: _Open) -> None:
    if tag in ("thead", "tbody", "tfoot"):
        state.part, state.row, state.cell = tag, None, None
    elif tag == "caption":
        state.caption = True
    elif tag == "tr":
        state.row, state.cell = {"part": state.part, "css": _attributes(rest).get("class"), "cells": [], "links": []}, None
        state.table["rows"].append(state.row)
    elif tag in ("td", "th") and state.row is not None:
        span = _attributes(rest).get("colspan", "1")
        state.cell = [tag, "", int(span) if span.isdigit() else 1]
        state.row["cells"].append(state.cell)
    elif tag == "a" and state.row is not None:
        href = _attributes(rest).get("href")
        if href:
            state.row["links"].append(href)


def _close(tag: str, stack: list[_Open], divs: list[dict]) -> None:
    if tag == "div":
        divs[-1:] = []
    elif tag == "table":
        stack[-1:] = []
    elif stack:
        state = stack[-1]
        if tag in ("td", "th"):
            state.cell = None
        elif tag == "tr":
            state.row = state.cell = None
        elif tag == "caption":
            state.caption = False
        elif tag in ("thead", "tbody", "tfoot"):
            state.part = ""


def _row(row: dict) -> dict:
    cells = [(kind, text.strip(), span) for kind, text, span in row["cells"]]
    return {
        "part": row["part"],
        "css": row["css"],
        "texts": [text for _, text, _ in cells],
        "heads": [text for kind, text, _ in cells if kind == "th"],
        "datas": [text for kind, text, _ in cells if kind == "td"],
        "spans": [span for _, _, span in cells],
        "links": row["links"],
    }


def page_tables(pages: DataFrame, keys: Sequence[str], html: str = "html", id_prefix: str | None = None) -> DataFrame:
    """One row per table of a page, also of tables inside comments.

    With ``id_prefix`` only the first table whose ID starts with it.
    """
    with_tables = pages.where(F.contains(F.lower(ref(html)), F.lit("<table"))).select(*refs(keys), ref(html))
    fields = T.StructType.fromDDL(TABLE_FIELDS.format(row=ROW_FIELDS))
    schema = T.StructType([*with_tables.schema.fields[:-1], *fields.fields])
    arrow = to_arrow_schema(schema)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few pages at a time: tables as Python objects are many times the page.
            for start in range(0, batch.num_rows, PAGES_AT_ONCE):
                found = [
                    key | table | {"rows": [_row(row) for row in table["rows"]]}
                    for key, page in _keyed(batch.slice(start, PAGES_AT_ONCE))
                    for table in _chosen(_scan(page), id_prefix)
                ]
                yield pa.RecordBatch.from_pylist(found, schema=arrow)

    return with_tables.mapInArrow(extract, schema)


def _chosen(tables: list[dict], id_prefix: str | None) -> list[dict]:
    if id_prefix is None:
        return tables
    return [t for t in tables if t["origin"] == "page" and (t["table_id"] or "").startswith(id_prefix)][:1]


def _keyed(batch: pa.RecordBatch) -> Iterator[tuple[dict, str]]:
    *names, html = batch.schema.names
    columns = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
    for *key, page in zip(*columns, strict=True):
        yield dict(zip(names, key, strict=True)), page


def page_links(pages: DataFrame, keys: Sequence[str], html: str = "html") -> DataFrame:
    """Target and text of every link, with regular expressions inside the JVM."""
    hits = F.arrays_zip(
        F.regexp_extract_all(ref(html), F.lit(LINK_PATTERN), 1).alias("href"),
        F.regexp_extract_all(ref(html), F.lit(LINK_PATTERN), 2).alias("text"),
    )
    rows = pages.select(*refs(keys), F.posexplode(hits).alias("position", "_hit"))
    return rows.select(*refs(keys), "position", "_hit.href", clean.strip_tags(F.col("_hit.text")).alias("text"))


def in_part(rows: Column, part: str) -> Column:
    return F.filter(rows, lambda r: r["part"] == part)


def last_header(rows: Column) -> Column:
    """The last ``thead`` row, or the first row without a ``thead``."""
    return F.coalesce(F.try_element_at(in_part(rows, "thead"), F.lit(-1)), F.try_element_at(rows, F.lit(1)))


def tail(values: Column, skip: int | Column = 1) -> Column:
    """All but the first elements."""
    return F.slice(values, F.lit(skip) + 1, F.greatest(F.size(values) - skip, F.lit(0)))


def body_rows(rows: Column) -> Column:
    """Rows of ``tbody``, or all but the first row without one."""
    body = in_part(rows, "tbody")
    return F.when(F.size(body) > 0, body).otherwise(tail(rows))


def paired_rows(tables: DataFrame, keys: Sequence[str], head: Column, rows: Column, values, null_rule) -> DataFrame:
    """One row per table row with a ``cells`` map of header to value.

    Which cells are wanted is settled once per table: unnamed headers are
    skipped, and the last of equal names wins. ``values`` takes the cell texts
    out of a row struct; cells past the end of a short row are null.
    """
    shaped = once(tables, _head=head, _rows=rows).select(*refs(keys), "_head", "_rows")
    positions = F.filter(
        F.transform("_head", lambda h, i: F.struct(h.alias("name"), i.alias("at"))),
        lambda p: (p["name"] != "") & (F.array_position(tail(F.col("_head"), p["at"] + 1), p["name"]) == 0),
    )
    placed = once(shaped.where(F.size("_head") > 0), _wanted=positions)
    named = placed.select(*refs(keys), F.col("_wanted.name").alias("_names"), F.col("_wanted.at").alias("_at"), "_rows")
    exploded = named.select(*refs(keys), "_names", "_at", F.posexplode("_rows").alias("row_index", "_row"))
    texts = once(exploded, _texts=values(F.col("_row"))).where(F.size("_texts") > 0)
    cells = F.map_from_arrays("_names", F.transform("_at", lambda i: null_rule(F.get("_texts", i))))
    return once(texts, cells=cells).select(*refs(keys), "row_index", "cells")
