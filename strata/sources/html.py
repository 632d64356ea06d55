"""Extraction over a pages table.

The reference fetched pages in a driver loop and parsed them with a
single-machine HTML library.  Here pages are rows of a DataFrame
``(keys..., html)``; fetching is out of scope.  Markup as it is found
(nested tables, any quoting, unclosed cells) needs a parser: ``parse_pages``
runs a small tag tokenizer (one regular expression plus a state machine) over
Arrow batches (``mapInArrow``); links and everything after the parse are JVM
expressions.
"""

from __future__ import annotations

import re
from html import unescape

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.columns import q
from strata.session import ship

# ---- fixed values -----------------------------------------------------------
CONTAINER_PREFIX = "treemap-table-"
AMOUNT_CLASS = "value-value"
STATUS_OK = 200
# -----------------------------------------------------------------------------

PARSED = "container string, reason string, rows array<struct<pos:int,row_class:string,cells:array<struct<text:string,amount:string>>>>"


def url_frontier(entities: DataFrame, entity_col: str, lo: Column, hi: Column, base: str,
                 period_col: str = "period") -> DataFrame:
    """S11 + J9: one URL per entity and period.  The period range is
    expanded per entity with ``explode(sequence(lo, hi))`` (no join);
    names are percent-encoded with %20 for spaces."""
    enc = F.replace(F.url_encode(F.col(entity_col)), F.lit("+"), F.lit("%20"))
    out = entities.withColumn(period_col, F.explode(F.sequence(lo, hi)))
    return out.withColumn("url", F.concat(F.lit(base), enc, F.lit("/"), F.col(period_col).cast("string")))


def nav_links(pages: DataFrame, keys, html: str = "html") -> DataFrame:
    """S12 on navigation lists: (keys, pos, href, label) for every
    ``<li><a href=...>label</a></li>``."""
    pat = r'<li><a href="([^"]*)">([^<]*)</a></li>'
    z = F.arrays_zip(F.regexp_extract_all(html, F.lit(pat), 1).alias("href"),
                     F.regexp_extract_all(html, F.lit(pat), 2).alias("label"))
    return pages.select(*keys, F.posexplode(z).alias("pos", "l")) \
        .select(*keys, "pos", "l.href", "l.label")


# Tokens of an HTML page: comments and script/style bodies (skipped), tags, text.
_TOKEN = re.compile(r"<!--.*?-->|<(script|style)\b.*?</\1\s*>|<(/?)([A-Za-z][\w:-]*)([^>]*)>|([^<]+|<)",
                    re.S | re.I)
_ATTR = re.compile(r"""([\w:-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""")


def _attrs(raw: str) -> dict:
    return {m.group(1).lower(): unescape(next(g for g in m.groups()[1:] if g is not None))
            for m in _ATTR.finditer(raw)}


def _norm(parts: list[str]) -> str:
    return " ".join(unescape("".join(parts)).split())


class _Table:
    """Rows of one table as its tags arrive.  A cell or row that is never
    closed ends where the next one, or the table, does; a table inside a
    cell is text of that cell."""

    def __init__(self):
        self.rows, self.cells, self.row_class, self.cell, self.span, self.depth = [], None, "", None, 0, 1

    def end_cell(self):
        if self.cell is not None:
            self.cells.append({"text": _norm(self.cell[0]), "amount": _norm(self.cell[1])})
        self.cell, self.span = None, 0

    def end_row(self):
        self.end_cell()
        if self.cells is not None:
            self.rows.append({"pos": len(self.rows), "row_class": self.row_class, "cells": self.cells})
        self.cells = None

    def tag(self, tag: str, closing: bool, raw: str) -> bool:
        """Takes a tag; true if it ends the table."""
        if tag == "table":
            self.depth += -1 if closing else 1
            if self.depth == 0:
                self.end_row()
                return True
        elif self.depth > 1:
            return False
        elif tag == "tr":
            self.end_row()
            if not closing:
                self.cells, self.row_class = [], _attrs(raw).get("class", "")
        elif tag in ("td", "th"):
            self.end_cell()
            if not closing and self.cells is not None and tag == "td":
                self.cell = ([], [])
        elif tag == "span" and self.cell is not None:
            if self.span:
                self.span += -1 if closing else 1
            elif not closing and AMOUNT_CLASS in _attrs(raw).get("class", "").split():
                self.span = 1
        return False

    def text(self, text: str):
        if self.cell is not None:
            self.cell[0].append(text)
            if self.span:
                self.cell[1].append(text)


def parse_page(html: str | None, wanted: str | None, prefix: str) -> dict:
    """The first table in the wanted container (by id; any with the prefix
    if ``wanted`` is None): container id, why there are no rows, the rows."""
    if not (html or "").strip():
        return {"container": None, "reason": "no_content", "rows": []}
    container, depth, table = None, 0, None
    for m in _TOKEN.finditer(html):
        if m.group(5) is not None:
            if table:
                table.text(m.group(5))
            continue
        if m.group(3) is None:          # comment or script/style body
            continue
        tag, closing = m.group(3).lower(), m.group(2) == "/"
        if container is None:
            if tag == "div" and not closing:
                ident = _attrs(m.group(4)).get("id", "")
                if ident == wanted if wanted is not None else ident.startswith(prefix):
                    container, depth = ident, 1
        elif table is not None:
            if table.tag(tag, closing, m.group(4)):
                break
        elif tag == "table" and not closing:
            table = _Table()
        elif tag == "div":
            depth += -1 if closing else 1
            if depth == 0:
                break
    if table:
        table.end_row()
    rows = [r for r in table.rows if r["cells"]] if table else []
    reason = ("container_missing" if container is None else "table_missing" if table is None else "ok" if rows else "no_rows")
    return {"container": container, "reason": reason, "rows": table.rows if table else []}


def parse_pages(pages: DataFrame, keys, html: str = "html", container_prefix: str = CONTAINER_PREFIX,
                period: str | None = None, status: str | None = None) -> DataFrame:
    """(keys, container, reason, rows), one row per page.

    With ``period`` the container is the one of the row's period (id prefix
    + period); without it, the first with the prefix.  With ``status`` a page
    whose status isn't 200 (or is null) isn't read.  Reasons: no_content,
    bad_status, container_missing, table_missing, no_rows, ok.
    """
    keys = list(keys)
    ship(pages.sparkSession)
    kinds = ", ".join(f"{q(k)} {pages.schema[k].dataType.simpleString()}" for k in keys)
    wanted = F.concat(F.lit(container_prefix), F.col(q(period)).cast("string")) if period else F.lit(None).cast("string")
    read = F.coalesce(F.col(q(status)) == STATUS_OK, F.lit(False)) if status else F.lit(True)

    def run(batches):
        import pyarrow as pa

        for b in batches:
            found = [parse_page(page, want, container_prefix) if ok else {"container": None, "reason": "bad_status", "rows": []}
                     for page, want, ok in zip(*(b.column(i).to_pylist() for i in range(3)))]
            row = pa.struct([("pos", pa.int32()), ("row_class", pa.string()),
                             ("cells", pa.list_(pa.struct([("text", pa.string()), ("amount", pa.string())])))])
            cols = [pa.array([f[c] for f in found], t) for c, t in (("container", pa.string()), ("reason", pa.string()), ("rows", pa.list_(row)))]
            yield pa.RecordBatch.from_arrays([*b.columns[3:], *cols], [*keys, "container", "reason", "rows"])

    return (pages.select(F.col(q(html)).alias("_html"), wanted.alias("_wanted"), read.alias("_read"), *[F.col(q(k)) for k in keys])
            .mapInArrow(run, f"{kinds}, {PARSED}"))


def table_rows(pages: DataFrame, keys, html: str = "html", container_prefix: str = CONTAINER_PREFIX,
               classes=None, min_cells: int = 3, period: str | None = None, status: str | None = None) -> DataFrame:
    """Rows of the table in the page's container (``parse_pages``).

    Without ``classes`` the header row is skipped and every row with at
    least ``min_cells`` cells is kept (S12); with ``classes`` only rows
    carrying one of the classes are kept (S13).  Output: keys,
    ``container`` (the id suffix), ``pos``, ``row_class``, ``section`` (text
    of cell 2) and ``amount`` (text of ``span.value-value`` in cell 3).
    """
    rows = (parse_pages(pages, keys, html, container_prefix, period, status)
            .select(*[F.col(q(k)) for k in keys], F.substr("container", F.lit(len(container_prefix) + 1)).alias("container"), F.inline("rows")))
    own = F.split("row_class", r"\s+")
    keep = F.arrays_overlap(own, F.array(*map(F.lit, classes))) if classes else F.col("pos") >= 1
    return rows.where(keep & (F.size("cells") >= min_cells)).select(
        *[F.col(q(k)) for k in keys], "container", "pos", "row_class",
        F.coalesce(F.try_element_at("cells", F.lit(2))["text"], F.lit("")).alias("section"),
        F.coalesce(F.try_element_at("cells", F.lit(3))["amount"], F.lit("")).alias("amount"))


def audit(pages: DataFrame, keys, html: str = "html", container_prefix: str = CONTAINER_PREFIX,
          period: str | None = None, status: str | None = None) -> DataFrame:
    """Per page, why it yields no rows (taken from the extraction) and how many it yields."""
    return parse_pages(pages, keys, html, container_prefix, period, status).select(
        *[F.col(q(k)) for k in keys], "reason", F.size("rows").alias("n_rows"))
