"""Readers of small binary files - archives, spreadsheets, images, pages - as rows; parsing beyond rows is left to DataFrames.

All take a DataFrame of the ``binaryFile`` source (path, content). A file is one
row there and bounds what a task holds.
"""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from xml.etree import ElementTree

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK = 12
LIGHT = 230
_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_SPACE = re.compile(r"\s+")


def _rows_of(files: DataFrame, parse: Callable[[bytes], Iterator[tuple]], schema: str, types: list[pa.DataType]) -> DataFrame:
    """(path, parsed columns...) of every file; a file that can't be parsed gives one row of nulls."""
    names = ["path", *[x.split()[0] for x in schema.split(", ")]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                try:
                    rows = [(path, *r) for r in parse(content or b"")]
                except (zipfile.BadZipFile, ElementTree.ParseError, ValueError, KeyError):
                    rows = [(path, *[None] * len(types))]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), [pa.string(), *types], strict=True)], names)

    return files.select("path", "content").mapInArrow(run, f"path string, {schema}")


def zipped_lines(files: DataFrame, parting: str = "|", encoding: str = "latin-1") -> DataFrame:
    """(path, member, line_no, cells): the lines of every member of zip archives, split."""

    def parse(content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            for name in z.namelist():
                with z.open(name) as f:
                    for k, line in enumerate(io.TextIOWrapper(f, encoding)):
                        yield name, k, line.rstrip("\r\n").split(parting)

    return _rows_of(files, parse, "member string, line_no long, cells array<string>", [pa.string(), pa.int64(), pa.list_(pa.string())])


def _column(reference: str) -> int:
    at = 0
    for c in reference:
        if not c.isalpha():
            break
        at = at * 26 + ord(c.upper()) - 64
    return at - 1


def sheet_rows(files: DataFrame) -> DataFrame:
    """(path, sheet, row_no, cells): rows of spreadsheets' sheets as text, gaps null; sheets are named by their parts."""

    def parse(content: bytes) -> Iterator[tuple]:
        with zipfile.ZipFile(io.BytesIO(content)) as z:
            names = z.namelist()
            shared = []
            if "xl/sharedStrings.xml" in names:
                shared = ["".join(t.text or "" for t in si.iter(f"{_SHEET}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_SHEET}si")]
            for name in sorted(n for n in names if n.startswith("xl/worksheets/") and n.endswith(".xml")):
                for row in ElementTree.fromstring(z.read(name)).iter(f"{_SHEET}row"):
                    cells: list[str | None] = []
                    for c in row.iter(f"{_SHEET}c"):
                        at = _column(c.get("r", "")) if c.get("r") else len(cells)
                        value = c.findtext(f"{_SHEET}v")
                        if c.get("t") == "s" and value is not None:
                            value = shared[int(value)]
                        elif c.get("t") == "inlineStr":
                            value = "".join(t.text or "" for t in c.iter(f"{_SHEET}t"))
                        cells += [None] * (at - len(cells)) + [value]
                    yield name.split("/")[-1].removesuffix(".xml"), int(row.get("r", 0)), cells

    return _rows_of(files, parse, "sheet string, row_no long, cells array<string>", [pa.string(), pa.int64(), pa.list_(pa.string())])


def after_header(rows: DataFrame, keys: list[str], wanted: str) -> DataFrame:
    """Rows of each sheet below its first row with a cell that has ``wanted``, with that row's cells as ``header``.

    The header is found by content, not by place; sheets without one give no rows.
    """
    hit = rows.filter(F.exists("cells", lambda c: F.coalesce(c.rlike(f"(?i){wanted}"), F.lit(False))))
    head = hit.groupBy(*keys).agg(F.min_by("cells", "row_no").alias("header"), F.min("row_no").alias("__head"))
    return rows.join(head, keys).filter(F.col("row_no") > F.col("__head")).drop("__head")


def _pgm(content: bytes) -> np.ndarray:
    fields, at = [], 0
    while len(fields) < 4:
        m = re.compile(rb"\s*(?:#[^\n]*\n\s*)*([^\s#]+)").match(content, at)
        if not m:
            raise ValueError("no header")
        fields.append(m.group(1))
        at = m.end()
    if fields[0] != b"P5" or not 0 < int(fields[3]) < 256:
        raise ValueError("not an 8-bit binary map")
    width, height = int(fields[1]), int(fields[2])
    raster = np.frombuffer(content, np.uint8, offset=at + 1)
    if len(raster) < width * height:
        raise ValueError("short raster")
    return raster[: width * height].reshape(height, width)


def image_blocks(files: DataFrame, block: int = BLOCK, light: int = LIGHT) -> DataFrame:
    """(path, row, col, mean, sd, light): statistics of the whole blocks of grey images; light is the share of pixels from ``light`` on."""

    def parse(content: bytes) -> Iterator[tuple]:
        image = _pgm(content)
        h, w = image.shape[0] // block, image.shape[1] // block
        cells = image[: h * block, : w * block].reshape(h, block, w, block).astype(float)
        mean, sd, share = cells.mean((1, 3)), cells.std((1, 3)), (cells >= light).mean((1, 3))
        for r in range(h):
            for c in range(w):
                yield r, c, float(mean[r, c]), float(sd[r, c]), float(share[r, c])

    return _rows_of(files, parse, "row int, col int, mean double, sd double, light double", [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()])


class _Sections(HTMLParser):
    """Texts of headings, paragraphs, list items and whole tables, in order."""

    PARTS = frozenset("h1 h2 h3 h4 h5 h6 p li blockquote table".split())
    HIDDEN = frozenset("script style noscript template".split())

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.tag, self.parts = "body", []
        self.tables = self.hidden = 0

    def _end(self, tag: str = "body") -> None:
        if body := _SPACE.sub(" ", "".join(self.parts)).strip():
            self.found.append((self.tag, body))
        self.tag, self.parts = tag, []

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.hidden += 1
        elif tag == "table":
            if not self.tables:
                self._end("table")
            self.tables += 1
        elif self.tables:
            self.parts.append(" ")
        elif tag in self.PARTS:
            self._end(tag)
        elif tag == "br":
            self.parts.append(" ")

    def handle_endtag(self, tag):
        if tag in self.HIDDEN:
            self.hidden = max(0, self.hidden - 1)
        elif tag == "table" and self.tables:
            self.tables -= 1
            if not self.tables:
                self._end()
        elif tag in self.PARTS and not self.tables:
            self._end()

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)


def sections(pages: DataFrame, key: str, html: str) -> DataFrame:
    """(key, k, tag, body): the sections of pages in order; a table is one. Null pages give none."""
    kind = pages.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, out = [], []
            for row, body in enumerate(b.column(1).to_pylist()):
                parser = _Sections()
                parser.feed(body or "")
                parser.close()
                parser._end()
                at += [row] * len(parser.found)
                out += [(k, *x) for k, x in enumerate(parser.found)]
            columns = list(zip(*out, strict=True)) if out else [(), (), ()]
            types = [pa.int32(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), *[pa.array(c, t) for c, t in zip(columns, types, strict=True)]], [key, "k", "tag", "body"])

    return pages.select(key, F.col(html).cast("string").alias("__html")).mapInArrow(run, f"{key} {kind}, k int, tag string, body string")
