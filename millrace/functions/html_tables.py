"""HTML tables and paragraphs as rows, by Python table functions on the standard parser."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_COLOUR_RULE = re.compile(r"([.#]?[\w-]+)\s*\{[^}]*?(?<![\w-])color\s*:\s*([^;}\s]+)", re.I)


class _Tables(HTMLParser):
    """Collects the cells of each table, nested ones on their own, and the text around them."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[list[list[list]]] = []  # table > row > cell [text pieces, rowspan, colspan]
        self.open: list[int] = []
        self.cell: list[list | None] = []
        self.paragraphs: list[tuple[int | None, str]] = []
        self.pieces: list[str] = []
        self.skip = 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.skip += 1
        elif tag == "table":
            self._flush()
            self.paragraphs.append((len(self.tables), ""))
            self.open.append(len(self.tables))
            self.tables.append([])
            self.cell.append(None)
        elif self.open and tag == "tr":
            self.cell[-1] = None
            self.tables[self.open[-1]].append([])
        elif self.open and tag in ("td", "th"):
            rows = self.tables[self.open[-1]]
            if not rows:
                rows.append([])
            spans = {k: int(v) if (v or "").strip().isdigit() else 1 for k, v in attrs if k in ("rowspan", "colspan")}
            self.cell[-1] = [[], max(spans.get("rowspan", 1), 1), max(spans.get("colspan", 1), 1)]
            rows[-1].append(self.cell[-1])
        elif tag in ("p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li") and not self.open:
            self._flush()

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.skip = max(0, self.skip - 1)
        elif tag == "table" and self.open:
            self.open.pop()
            self.cell.pop()
        elif self.open and tag in ("td", "th", "tr"):
            self.cell[-1] = None
        elif tag in ("p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li") and not self.open:
            self._flush()

    def handle_data(self, data):
        if self.skip:
            return
        if self.open:
            if self.cell[-1] is not None:
                self.cell[-1][0].append(data)
        else:
            self.pieces.append(data)

    def _flush(self):
        text = " ".join("".join(self.pieces).split())
        self.pieces = []
        if text:
            self.paragraphs.append((None, text))

    def close(self):
        super().close()
        self._flush()


def _read(html: str | None) -> _Tables:
    parser = _Tables()
    parser.feed(html or "")
    parser.close()
    return parser


def grid(rows: list[list[list]]) -> list[tuple[int, int, str]]:
    """(row, column, text) of a rectangular grid; spans repeat the text right and down, to the last row at most."""
    filled: dict[tuple[int, int], str] = {}
    width = 0
    for r, cells in enumerate(rows):
        c = 0
        for pieces, down, right in cells:
            while (r, c) in filled:
                c += 1
            text = " ".join("".join(pieces).split())
            for y in range(r, min(r + down, len(rows))):
                for x in range(c, c + right):
                    filled.setdefault((y, x), text)
            c += right
        width = max([width, *(x + 1 for y, x in filled if y == r)])
    return [(y, x, filled.get((y, x), "")) for y in range(len(rows)) for x in range(width)]


class TableGrid:
    """parse_tables(html): (table_no, row, col, text) of every cell of every table."""

    def eval(self, html: str) -> Iterator[tuple[int, int, int, str]]:
        for number, rows in enumerate(_read(html).tables):
            for r, c, text in grid(rows):
                yield number, r, c, text


class Paragraphs:
    """parse_paragraphs(html): (ord, table_no, text); a table's row has its number and no text."""

    def eval(self, html: str) -> Iterator[tuple[int, int | None, str]]:
        for place, (number, text) in enumerate(_read(html).paragraphs):
            yield place, number, text


def register(spark: SparkSession) -> None:
    """Make both functions known to SQL."""
    spark.udtf.register("parse_tables", F.udtf(TableGrid, returnType="table_no int, row int, col int, text string"))
    spark.udtf.register("parse_paragraphs", F.udtf(Paragraphs, returnType="ord int, table_no int, text string"))


def tables_of(spark: SparkSession, docs: DataFrame, key: str, html: str) -> DataFrame:
    """(key, table_no, row, col, text) of all tables of all documents."""
    register(spark)
    docs.select(key, html).createOrReplaceTempView("__millrace_html")
    return spark.sql(f"select {key}, g.table_no, g.row, g.col, g.text from __millrace_html, lateral parse_tables({html}) g")


def paragraphs_of(spark: SparkSession, docs: DataFrame, key: str, html: str) -> DataFrame:
    """(key, ord, table_no, text, before_table): the text with the number of the table that follows it."""
    from pyspark.sql import Window

    register(spark)
    docs.select(key, html).createOrReplaceTempView("__millrace_html")
    rows = spark.sql(f"select {key}, g.ord, g.table_no, g.text from __millrace_html, lateral parse_paragraphs({html}) g")
    after = Window.partitionBy(key).orderBy("ord").rowsBetween(0, Window.unboundedFollowing)
    return rows.withColumn("before_table", F.first("table_no", ignorenulls=True).over(after))


def _html_text(html: str | None) -> str:
    parser = _read(html)
    cells = ["".join(cell[0]) for rows in parser.tables for row in rows for cell in row]
    return ",".join([t for _, t in parser.paragraphs if t] + [t for c in cells if (t := " ".join(c.split()))])


def html_text(html: Column) -> Column:
    """The text of a page: paragraphs and headings, then cells, joined by commas."""
    @F.pandas_udf("string")
    def text_of(pages: pd.Series) -> pd.Series:
        return pages.map(_html_text)

    return text_of(html)


def _coloured(html: str | None, colour: str) -> list[str]:
    page = html or ""
    styles = " ".join(re.findall(r"<style[^>]*>(.*?)</style>", page, re.S | re.I))
    wanted = {name.lower() for name, value in _COLOUR_RULE.findall(styles) if value.lower() == colour.lower()}
    found: list[str] = []

    class Reader(HTMLParser):
        depth: list[list[str] | None] = []

        def handle_starttag(self, tag, attrs):
            names = {tag, *("." + c.lower() for k, v in attrs if k == "class" for c in (v or "").split()), *("#" + (v or "").lower() for k, v in attrs if k == "id")}
            if tag not in ("br", "img", "hr", "meta", "link", "input"):
                self.depth.append([] if names & wanted else None)

        def handle_endtag(self, tag):
            if self.depth and (pieces := self.depth.pop()) is not None:
                if text := " ".join("".join(pieces).split()):
                    found.append(text)

        def handle_data(self, data):
            for pieces in self.depth:
                if pieces is not None:
                    pieces.append(data)

    reader = Reader()
    reader.depth = []
    reader.feed(page)
    return found


def coloured_text(html: Column, colour: str = "#F00") -> Column:
    """The texts of elements whose tag, class or id a style rule gives the colour."""
    @F.pandas_udf("array<string>")
    def of(pages: pd.Series) -> pd.Series:
        return pages.map(lambda h: _coloured(h, colour))

    return of(html)
