"""Markup to text: TEI XML and HTML, parsed where the rows are, and parsers with a fallback."""

from __future__ import annotations

import re
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import segment

#: Elements of a TEI document whose text is read, HTML elements that are blocks of text, and those that are none.
TEI_BLOCKS = {"title", "head", "p", "note"}
TEI_NAMESPACE = "http://www.tei-c.org/ns/1.0"
HTML_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "td", "title"}
HTML_HIDDEN = {"script", "style", "template"}


def _paragraph(text: str) -> str:
    text = re.sub(r"[ \t\r\f\v]+", " ", text.replace("­", ""))
    return re.sub(r"\s+([,.;:!?])", r"\1", text).strip()


def tei_text(xml: str, legacy: bool = False) -> str:
    """Titles, heads, paragraphs and notes in document order, of any namespace. Blocks within a block belong to it; with `legacy` they come again."""
    out: list[str] = []

    def walk(e: ET.Element) -> None:
        block = isinstance(e.tag, str) and e.tag.rpartition("}")[2] in TEI_BLOCKS
        if block and (t := _paragraph("".join(e.itertext()))):
            out.append(t)
        if legacy or not block:
            for child in e:
                walk(child)

    walk(ET.fromstring(xml))
    return "\n\n".join(out).strip()


def tei_paragraphs(xml: str) -> list[str]:
    """Texts of the p elements (TEI's or without namespace), blanks collapsed, empty ones left out."""
    found = (re.sub(r"[ \t]+", " ", "".join(e.itertext())).strip() for e in ET.fromstring(xml).iter() if e.tag in ("p", f"{{{TEI_NAMESPACE}}}p"))
    return [t for t in found if t]


#: Characters of a document that a parser is given at once.
FEED_CHARS = 1 << 16


def tei_stream(xml: str) -> Iterator[str]:
    """tei_paragraphs() as the document is read: a paragraph comes when the outermost one that holds it has ended, and its elements are let go.

    Of a document that isn't well-formed, the paragraphs before the fault come, then ParseError.
    """
    names = ("p", f"{{{TEI_NAMESPACE}}}p")
    parser = ET.XMLPullParser(("start", "end"))
    path: list[ET.Element] = []
    inside = 0

    def events() -> Iterator[tuple[str, ET.Element]]:
        for at in range(0, len(xml), FEED_CHARS):
            parser.feed(xml[at : at + FEED_CHARS])
            yield from parser.read_events()
        parser.close()
        yield from parser.read_events()

    for event, e in events():
        if event == "start":
            path.append(e)
            inside += e.tag in names
            continue
        path.pop()
        inside -= e.tag in names
        if inside:
            continue  # it goes with the paragraph that it is part of
        if e.tag in names:
            for p in e.iter():
                if p.tag in names and (t := re.sub(r"[ \t]+", " ", "".join(p.itertext())).strip()):
                    yield t
        if path:
            path[-1].remove(e)


def tei_chunks(docs: DataFrame, most: int, xml_col: str = "xml", sep: str = "\n\n", lenient: bool = False) -> DataFrame:
    """One row for each chunk of whole TEI paragraphs: `docs` with chunk_index, global_offset, kind and body instead of the XML.

    Paragraphs go from the parser straight into packing; offsets are those of the text that joins them. A null document has no chunks;
    one that isn't well-formed fails, or, if `lenient`, gives the chunks of what could be read.
    """

    def paragraphs(xml: str) -> Iterator[str]:
        try:
            yield from tei_stream(xml)
        except ET.ParseError:
            if not lenient:
                raise

    def work(xml: str) -> Iterator[tuple]:
        for n, (at, body, kind) in enumerate(segment.packed_stream(paragraphs(xml), most, sep)):
            yield n, at, kind, body

    given = docs.where(F.col(xml_col).isNotNull())
    return segment.text_rows(given, xml_col, "chunk_index int, global_offset int, kind string, body string", work)


class _Blocks(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []
        self.held: list[str] = []
        self.inside, self.hidden = False, 0

    def end_block(self):
        if t := " ".join("".join(self.held).split()):
            self.out.append(t)
        self.held, self.inside = [], False

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in HTML_HIDDEN
        if tag in HTML_BLOCKS:
            self.end_block()
            self.inside = True
        elif tag == "br":
            self.held.append(" ")

    def handle_endtag(self, tag):
        self.hidden -= tag in HTML_HIDDEN and self.hidden > 0
        if tag in HTML_BLOCKS:
            self.end_block()

    def handle_data(self, data):
        if self.inside and not self.hidden:
            self.held.append(data)


def html_blocks(html: str) -> list[str]:
    """Texts of headings, paragraphs, list items and cells of HTML as it is found, well-formed or not."""
    p = _Blocks()
    p.feed(html)
    p.close()
    p.end_block()
    return p.out


def parse_column(df: DataFrame, source: str, target: str, parser: Callable[[str], str], fallback: Callable[[str], str] | None = None, catch: tuple[type[Exception], ...] = (Exception,)) -> DataFrame:
    """`df` with `target`: what the parser makes of `source`, or the fallback where the parser fails; parser_used says which (primary, fallback), null where both do."""
    keep = [c for c in df.columns if c not in (target, "parser_used")]
    schema = ", ".join([f"`{n}` {t}" for n, t in df.select(*keep).dtypes] + [f"`{target}` string, parser_used string"])

    def one(value):
        if value is None:
            return None, None
        for name, f in (("primary", parser), ("fallback", fallback)):
            if f is not None:
                try:
                    return f(value), name
                except catch:
                    continue
        return None, None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [one(v) for v in b.column(b.schema.get_field_index(source)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.select(keep).columns, pa.array([t for t, _ in got], pa.string()), pa.array([u for _, u in got], pa.string())], names=[*keep, target, "parser_used"])

    return df.mapInArrow(run, schema)


def page_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """`pages` with column text: the HTML's blocks, one to a line."""
    return parse_column(pages, html_col, "text", lambda h: "\n".join(html_blocks(h))).drop("parser_used")


def service_text(pdfs: DataFrame, call: Callable[[bytes], str], fallback: Callable[[bytes], str] | None = None) -> DataFrame:
    """Text of PDF bytes from a parsing service, TEI or plain, with a local parser for what it fails on."""
    out = parse_column(pdfs, "content", "raw", call, fallback)
    tei = parse_column(out.where(F.startswith(F.ltrim("raw"), F.lit("<"))).withColumnRenamed("parser_used", "_used"), "raw", "text", tei_text).drop("parser_used")
    plain = out.where(~F.startswith(F.ltrim("raw"), F.lit("<"))).withColumnRenamed("parser_used", "_used").withColumn("text", F.col("raw"))
    return tei.unionByName(plain).withColumnRenamed("_used", "parser_used")
