"""HTML pages to rows: chapter pages with marked verses, and ordered lists.

The parsers are plain functions over one page; the operators run them in ``mapInArrow`` over the
columns they need, so pages are never collected and the other columns never leave the JVM twice.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.functions import text as T
from lectern.operators.html import Element, parse

_SPACE = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_BRACKET = re.compile(r"\[[0-9]+\]")
_CODE = re.compile(r"[A-Z0-9]{2,5}")
_NUMBER = re.compile(r"[+-]?[0-9]+")
# Fixed value: what stands for an omitted verse without a note.
OMITTED_TEXT = "[verse not in this translation]"
#: A page of this many bytes or more is taken to be cut off.
MAX_PAGE = 10 << 20


def _fields(s: str) -> list[str]:
    return [x for x in _SPACE.split(s) if x]


def _collapse(s: str) -> str:
    return " ".join(_fields(s))


def _number(s: str) -> int | None:
    return int(s) if _NUMBER.fullmatch(s) else None


def _is_span(e: Element, part: str) -> bool:
    return e.tag == "span" and part in e.attr("class")


@dataclass
class Verse:
    number: int
    sub_title: str = ""
    fragments: list[str] = field(default_factory=list)
    omitted: bool = False
    merged: bool = False
    cross_ref: str = ""

    def row(self, pos: int) -> tuple[int, int, str, str, str, str]:
        note = f"ref:{self.cross_ref}" if self.omitted and self.cross_ref else "omitted" if self.omitted else "merged" if self.merged else ""
        return pos, self.number, self.sub_title, _collapse(" ".join(self.fragments)), note, self.cross_ref if self.omitted else ""


def _numbers(refs: str, usfm: str, chapter: int) -> list[int]:
    found = []
    for ref in _fields(refs.replace("+", " ")):
        parts = ref.split(".", 2)
        if len(parts) == 3 and parts[0] == usfm and _number(parts[1]) == chapter:
            n = _number(parts[2])
            if n is not None and 0 < n <= T.MAX_VERSE:
                found.append(n)
    return found


def _is_bracketed(span: Element) -> bool:
    labels = [e for e in span.elements() if _is_span(e, "__label")]
    return bool(labels) and bool(_BRACKET.fullmatch(_collapse(labels[0].text())))


def _note_parts(span: Element) -> Iterator[Element]:
    for note in span.elements():
        if _is_span(note, "__note"):
            yield from note.descendants()


def _cross_ref(span: Element) -> str:
    """The first reference of the verse's notes, if it is a whole key; a plus sign is not split."""
    for e in _note_parts(span):
        if e.tag == "span" and "data-usfm" in e.attrs and e.attr("class") == "ref":
            named = _fields(e.attr("data-usfm"))[:1]
            parts = named[0].split(".", 2) if named else []
            if len(parts) == 3 and _CODE.fullmatch(parts[0]) and _number(parts[1]) is not None and (_number(parts[2]) or 0) > 0:
                return named[0]
            return ""
    return ""


def _note_text(span: Element) -> str:
    """The first note body: its elements but the place prefix; bare text only where it has none."""
    body = next((e for e in _note_parts(span) if _is_span(e, "__body")), None)
    if body is None:
        return ""
    inner = body.elements()
    if not inner:
        return _collapse(body.text())
    return _collapse("".join(e.text() for e in inner if "__fr" not in e.attr("class")))


def parse_chapter(html: str | None, usfm: str, chapter: int) -> list[tuple[int, int, str, str, str, str]]:
    """(pos, verse_sort, sub_title, content, note, cross_ref) in order of first appearance."""
    if not _CODE.fullmatch(usfm or "") or not 1 <= (chapter or 0) <= T.MAX_CHAPTER:
        raise ValueError("bad chapter key")
    everything = list(parse(html).descendants())
    marked = lambda key: next((e for e in everything if e.tag == "div" and e.attr("data-usfm") == key), None)
    container = marked(f"{usfm}.{chapter}") or marked(usfm)
    if container is None:
        raise ValueError("chapter div not found")
    verses: dict[int, Verse] = {}  # keeps the order of first appearance
    heading = ""
    for block in container.elements():
        inside = list(block.descendants())
        headings = [e for e in inside if _is_span(e, "__heading")]
        if headings:
            heading = "".join(e.text() for e in headings).strip()
            continue
        for span in inside:
            if not (_is_span(span, "__verse") and "data-usfm" in span.attrs):
                continue
            numbers = _numbers(span.attr("data-usfm"), usfm, chapter)
            if not numbers:
                continue
            first = min(numbers)
            content = span.text_without(lambda e: _is_span(e, "__note") or _is_span(e, "__label"))
            omitted, ref = False, ""
            if not _fields(content):
                if not _is_bracketed(span) or (first in verses and verses[first].omitted):
                    continue
                omitted, ref = True, _cross_ref(span)
                content = "" if ref else _note_text(span) or OMITTED_TEXT
            if first in verses:
                verses[first].fragments.append(content)
            else:
                verses[first] = Verse(first, heading, [content], omitted, cross_ref=ref)
                heading = ""
            for n in sorted(set(numbers) - {first}):
                verses.setdefault(n, Verse(n, fragments=[T.MERGED], merged=True))
    return [v.row(pos) for pos, v in enumerate(verses.values())]


def parse_list_items(html: str | None) -> list[tuple[int, str | None, str]]:
    """(pos, value, text) of every item of an ordered list, scripts, styles and links removed."""
    root = parse(html)
    root.remove({"script", "style", "a"})
    items, pos = [], 0
    stack: list[tuple[Element, bool]] = [(e, False) for e in root.elements()[::-1]]
    while stack:
        node, listed = stack.pop()
        if node.tag == "li" and listed:
            items.append((pos, node.attrs.get("value"), node.text()))
            pos += 1
        stack += [(e, listed or node.tag == "ol") for e in node.elements()[::-1]]
    return items


def decode_big5(raw: Column) -> Column:
    """Lenient: bytes that are no Big5 become replacement characters.

    No built-in function knows the encoding; text comes in Arrow batches, one value after the other.
    """

    @F.pandas_udf("string")
    def decoded(raw: pd.Series) -> pd.Series:
        return raw.map(lambda b: None if b is None else bytes(b).decode("big5hkscs", "replace"))

    return decoded(raw)


_PAGE_BYTES, _PAGE_ROWS = 4 << 20, 5_000


VERSE_ROWS = "pos int, verse_sort int, sub_title string, content string, note string, cross_ref string"
ITEM_ROWS = "pos int, value_raw string, text string"


def page_rows(batches: Iterable[pa.RecordBatch], parser, schema: str) -> Iterator[pa.RecordBatch]:
    """Rows of each page and ``error``: one row with it for a page that cannot be parsed, was cut off or
    holds nothing. Pages are parsed one by one, each as a tree of its elements (for a page of ``MAX_PAGE`` bytes
    about 250 MB), and their rows passed on in runs of bounded size."""
    kinds = _arrow(f"page_id long, {schema}, error string")
    width = len(kinds) - 2

    def frame(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kinds, strict=True)], schema=kinds)

    rows: list[tuple] = []
    held = 0
    for batch in batches:
        for page, html, *rest in zip(*batch.columns, strict=True):
            raw = html.as_buffer().size if html.is_valid else 0
            try:
                if raw >= MAX_PAGE:
                    raise ValueError("page too large, possibly cut off")
                found = [(page.as_py(), *row, None) for row in parser(html.as_py(), *(x.as_py() for x in rest))]
                if not found:
                    raise ValueError("no verses found")
            except ValueError as e:
                found = [(page.as_py(), *[None] * width, str(e))]
            rows += found
            held += raw
            if held >= _PAGE_BYTES or len(rows) >= _PAGE_ROWS:
                yield frame(rows)
                rows, held = [], 0
    if rows:
        yield frame(rows)


def _parsed(pages: DataFrame, columns: list[str], parser, schema: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from page_rows(batches, parser, schema)

    return pages.select("page_id", *columns).mapInArrow(run, f"page_id long, {schema}, error string")


def _arrow(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (x.split() for x in schema.split(", "))])


def chapters(pages: DataFrame) -> DataFrame:
    """Of (page_id, html, usfm, chapter_sort): a row per verse, and one with ``error`` per bad page."""
    return _parsed(pages, ["html", "usfm", "chapter_sort"], parse_chapter, VERSE_ROWS)


def list_items(pages: DataFrame) -> DataFrame:
    """Of (page_id, html): a row per item of an ordered list, and one with ``error`` per page without."""
    return _parsed(pages, ["html"], parse_list_items, ITEM_ROWS)


def failed_pages(rows: DataFrame) -> DataFrame:
    return rows.filter("error IS NOT NULL").select("page_id", "error")


def _verse_sort() -> Column:
    """A positive ``value``, else the position."""
    value = T.trim_u(F.col("value_raw"))
    parsed = F.when(value.rlike(r"^[+-]?[0-9]+$"), value.try_cast("int"))
    return F.when(parsed > 0, parsed).otherwise(F.col("pos") + 1).cast("int")


def numbered(items: DataFrame) -> DataFrame:
    """List items with their verse number; blank texts go, but keep their place in the count."""
    rows = items.filter("error IS NULL").select("page_id", "pos", _verse_sort().alias("verse_sort"), T.trim_u(F.col("text")).alias("content"))
    return rows.filter("content <> ''")


def within_spec(items: DataFrame, bounds: DataFrame) -> DataFrame:
    """Numbered items no greater than their page's ``max_verses``."""
    return items.join(bounds, "page_id").filter(F.col("verse_sort") <= F.col("max_verses")).drop("max_verses")


def verse_counts(items: DataFrame) -> DataFrame:
    """Largest number of each page's items, blank ones too; ``error`` where a page has none."""
    return items.select("page_id", F.when(F.col("error").isNull(), _verse_sort()).alias("n"), "error").groupBy("page_id").agg(F.max("n").alias("verses"), F.max("error").alias("error"))
