"""One event-driven pass over JATS articles.

The parser calls back at each start, end and piece of text; nothing is kept as a tree.
Open elements of interest collect their text, and an article leaves as one row: metadata,
sections, paragraphs, figures, and its tables as cells with positions and spans.  What is
made of these (dense grids, header paths, methods, licences, formulas) are column
expressions of :mod:`article_tables`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# The largest article, the widest span, and what a superscript note consists of.
MOST_BYTES = 20_000_000
MOST_SPAN = 100
NOTE = re.compile(r"[a-zA-Z*†‡, ]+")

CELL = "struct<column:int,down:int,across:int,printed:string,clean:string>"
TABLE = (
    "struct<table_id:string,label:string,caption:string,footnotes:string,everything:string,hrefs:array<string>,has_table:boolean,"
    f"head:array<array<{CELL}>>,body:array<array<{CELL}>>,problem:string,lines:array<array<{CELL}>>,heads:int>"
)
SCANNED = (
    "stated string, problem string, sha256 string, article_type string, ids map<string,string>, title string, year string, license string, permissions string, "
    "sections array<struct<section_id:string,title:string,in_body:boolean,paragraphs:array<string>>>, paragraphs array<string>, "
    f"figures array<struct<figure_id:string,href:string>>, tables array<{TABLE}>"
)


class ArticleError(ValueError):
    """An article that can't be read under the rules."""


class _Text:
    """What an open element prints, and the same without notes."""

    def __init__(self, level: int, done: Callable[[_Text], None]):
        self.level, self.done = level, done
        self.printed: list[str] = []
        self.kept: list[str] = []
        self.marks: list[tuple[int, int]] = []

    def add(self, piece: str) -> None:
        self.printed.append(piece)
        self.kept.append(piece)

    def note_begins(self) -> None:
        self.marks.append((len(self.printed), len(self.kept)))

    def note_ends(self, sure: bool) -> None:
        printed, kept = self.marks.pop()
        if sure or NOTE.fullmatch("".join(self.printed[printed:])):
            del self.kept[kept:]

    def plain(self) -> str:
        return " ".join("".join(self.printed).split())

    def clean(self) -> str:
        return " ".join("".join(self.kept).split())


def place(rows: list[list[dict]]) -> tuple[list[list[dict]], str | None]:
    """Cells with the columns they take, and what is wrong with their spans.

    A cell takes the first column that no cell above still covers.  Where something is
    wrong, every cell takes the next column and no span.
    """
    placed, covered = [], {}
    try:
        for row in rows:
            taken, following, column, out = set(covered), {c: n - 1 for c, n in covered.items() if n > 1}, 0, []
            for cell in row:
                try:
                    down, across = int(cell["rowspan"]), int(cell["colspan"])
                except ValueError:
                    raise ArticleError("a table span is no number") from None
                if not (1 <= down <= MOST_SPAN and 1 <= across <= MOST_SPAN):
                    raise ArticleError("unsupported table span")
                while column in taken:
                    column += 1
                mine = range(column, column + across)
                if not taken.isdisjoint(mine):
                    raise ArticleError("overlapping table spans")
                taken.update(mine)
                if down > 1:
                    following.update(dict.fromkeys(mine, down - 1))
                out.append({"column": column, "down": down, "across": across, "printed": cell["printed"], "clean": cell["clean"]})
                column += across
            placed.append(out)
            covered = following
    except ArticleError as error:
        loose = [[{"column": n, "down": 1, "across": 1, "printed": c["printed"], "clean": c["clean"]} for n, c in enumerate(row)] for row in rows]
        return loose, str(error)
    return placed, None


class _Table:
    """An open table-wrap."""

    def __init__(self, name: str | None):
        self.fields: dict = {"table_id": name, "label": "", "caption": "", "footnotes": "", "everything": ""}
        self.hrefs: list[str] = []
        self.level: int | None = None  # of its table element
        self.seen: set[str] = set()
        self.groups: dict[str, list] = {"thead": [], "tbody": [], "tr": []}
        self.lines: list[list[dict]] = []
        self.heads: int | None = None
        self.in_head = False

    def row(self) -> dict:
        head, body = self.groups["thead"], self.groups["tbody"] or self.groups["tr"]
        if not head:  # leading rows with a heading cell stand for the missing head
            first = next((n for n, row in enumerate(body) if not any(c["th"] for c in row)), len(body))
            head, body = body[:first], body[first:]
        (head, wrong_head), (body, wrong_body), (lines, _) = place(head), place(body), place(self.lines)
        return self.fields | {
            "hrefs": self.hrefs, "has_table": self.level is not None, "head": head, "body": body, "problem": wrong_head or wrong_body, "lines": lines, "heads": max(1, 1 if self.heads is None else self.heads),
        }


#: Children of a table-wrap that are read, and the field that takes their text.
_PARTS = {"label": "label", "caption": "caption", "table-wrap-foot": "footnotes"}
_META = ("article", "front", "article-meta")


class Scan:
    """Collects one article; :meth:`read` gives its row."""

    def __init__(self) -> None:
        self.path: list[str] = []
        self.texts: list[_Text] = []
        self.out: dict = {"article_type": "", "ids": {}, "title": "", "year": "", "license": "", "permissions": "", "sections": [], "paragraphs": [], "figures": [], "tables": []}
        self.sections: list[dict] = []
        self.figures: list[str] = []
        self.wraps: list[_Table] = []
        self.rows: list[list[dict]] = []
        self.hrefs: list[str] = []
        self.met: set[str] = set()

    def read(self, raw: bytes | str) -> dict:
        data = raw.encode() if isinstance(raw, str) else bytes(raw)
        if len(data) > MOST_BYTES:
            raise ArticleError("the article is larger than 20 MB")
        parser = expat.ParserCreate("utf-8" if isinstance(raw, str) else None, namespace_separator="}")
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = self.start, self.end, self.text
        parser.EntityDeclHandler, parser.SkippedEntityHandler = self.entity, self.entity
        try:
            parser.Parse(data, True)
        except expat.ExpatError as error:
            raise ArticleError(f"not well-formed: {error}") from None
        return self.out | {"sha256": hashlib.sha256(data).hexdigest()}

    @staticmethod
    def entity(*_: object) -> None:
        raise ArticleError("entity declarations are not accepted")

    def listen(self, done: Callable[[_Text], None]) -> None:
        self.texts.append(_Text(len(self.path), done))

    def once(self, field: str) -> None:
        """The text of the first such element becomes a field."""
        if field not in self.met:
            self.met.add(field)
            self.listen(lambda t: self.out.__setitem__(field, t.plain()))

    def text(self, piece: str) -> None:
        for text in self.texts:
            text.add(piece)

    def start(self, name: str, attributes: dict[str, str]) -> None:
        tag = name.rpartition("}")[2]
        parent = self.path[-1] if self.path else None
        if parent is None:
            if tag != "article":
                raise ArticleError("not a JATS article")
            self.out["article_type"] = attributes.get("article-type", "")
        if tag in ("xref", "sup"):
            for text in self.texts:
                text.note_begins()
        self.path.append(tag)
        if self.path[1:2] == ["front"]:
            self.front(tuple(self.path), attributes)
        if tag == "sec":
            self.sections.append({"section_id": attributes.get("id", ""), "title": "", "titled": False, "in_body": self.path[1] == "body", "own": []})
            self.out["sections"].append(self.sections[-1])
        elif tag == "title" and parent == "sec" and not self.sections[-1]["titled"]:
            section = self.sections[-1]
            section["titled"] = True
            self.listen(lambda t: section.__setitem__("title", t.plain()))
        elif tag == "p":
            slot = [""]
            self.out["paragraphs"].append(slot)
            if parent == "sec":
                self.sections[-1]["own"].append(slot)
            self.listen(lambda t: slot.__setitem__(0, t.plain()))
        elif tag == "fig":
            self.figures.append(attributes.get("id", ""))
        elif tag == "graphic":
            links = [v for k, v in attributes.items() if k.rpartition("}")[2] == "href"]
            self.out["figures"] += [{"figure_id": figure, "href": link} for figure in self.figures for link in links]
            for wrap in self.wraps:
                wrap.hrefs += links[:1]
        elif tag == "table-wrap":
            wrap = _Table(attributes.get("id"))
            self.wraps.append(wrap)
            self.out["tables"].append(wrap)
            self.listen(lambda t: wrap.fields.__setitem__("everything", "".join(t.printed)))
        if self.wraps and tag != "table-wrap":
            self.in_wrap(self.wraps[-1], tag, parent, attributes)

    def front(self, path: tuple[str, ...], attributes: dict[str, str]) -> None:
        if path[:3] != _META:
            return
        rest = path[3:]
        if rest == ("article-id",):
            self.listen(lambda t: self.out["ids"].__setitem__(attributes.get("pub-id-type", ""), t.plain()))
        elif rest == ("title-group", "article-title"):
            self.once("title")
        elif rest == ("pub-date", "year"):
            self.once("year")
        elif rest == ("permissions", "license"):
            self.once("license")
        elif rest == ("permissions",):
            self.listen(lambda t: self.out.__setitem__("permissions", " ".join(["".join(t.printed), *self.hrefs])))
        if rest[:1] == ("permissions",):
            self.hrefs += [v for k, v in attributes.items() if "href" in k]

    def in_wrap(self, wrap: _Table, tag: str, parent: str | None, attributes: dict[str, str]) -> None:
        level = len(self.path)
        if parent == "table-wrap":
            if tag in _PARTS and tag not in wrap.seen:
                wrap.seen.add(tag)
                self.listen(lambda t: wrap.fields.__setitem__(_PARTS[tag], t.plain()))
            elif tag == "table" and wrap.level is None:
                wrap.level = level
        elif wrap.level is None:
            return
        elif tag == "thead" and level == wrap.level + 1 and wrap.heads is None:
            wrap.heads, wrap.in_head = 0, True
        elif tag == "tr":
            row: list[dict] = []
            self.rows.append(row)
            wrap.lines.append(row)
            wrap.heads = wrap.heads + 1 if wrap.in_head and wrap.heads is not None else wrap.heads
            group = "tr" if level == wrap.level + 1 else parent if level == wrap.level + 2 else None
            if group in wrap.groups:
                wrap.groups[group].append(row)
        elif tag in ("td", "th") and parent == "tr":
            cell = {"th": tag == "th", "rowspan": attributes.get("rowspan", "1"), "colspan": attributes.get("colspan", "1"), "printed": "", "clean": ""}
            self.rows[-1].append(cell)
            self.listen(lambda t: cell.update(printed=t.plain(), clean=t.clean()))

    def end(self, name: str) -> None:
        tag, level = self.path[-1], len(self.path)
        while self.texts and self.texts[-1].level == level:
            text = self.texts.pop()
            text.done(text)
        self.path.pop()
        if tag in ("xref", "sup"):
            for text in self.texts:
                text.note_ends(tag == "xref")
        elif tag == "sec":
            self.sections.pop()
        elif tag == "fig":
            self.figures.pop()
        elif tag == "table-wrap":
            self.wraps.pop()
        elif tag == "tr" and self.rows:
            self.rows.pop()
        elif tag == "thead" and self.wraps and level == (self.wraps[-1].level or 0) + 1:
            self.wraps[-1].in_head = False


def scan_article(raw: bytes | str) -> dict:
    """The row of one article; :class:`ArticleError` where it can't be read."""
    out = Scan().read(raw)
    out["sections"] = [{"section_id": s["section_id"], "title": s["title"], "in_body": s["in_body"], "paragraphs": [p[0] for p in s["own"]]} for s in out["sections"]]
    out["paragraphs"] = [p[0] for p in out["paragraphs"]]
    out["tables"] = [wrap.row() for wrap in out["tables"]]
    return out


#: Articles handed over at once, so that a batch stays small.
TOGETHER = 64


def scan_articles(articles: DataFrame, key: str = "pmcid", xml: str = "xml_text") -> DataFrame:
    """:data:`SCANNED` of every row; ``problem`` says why an article can't be read.  A narrow map."""
    schema = to_arrow_schema(T.StructType.fromDDL(SCANNED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, TOGETHER):
                piece, rows = batch.slice(first, TOGETHER), []
                for stated, raw in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    try:
                        if raw is None:
                            raise ArticleError("no text")
                        found = scan_article(raw)
                        rows.append({"stated": stated, **found, "ids": list(found["ids"].items())})
                    except ArticleError as error:
                        rows.append({"stated": stated, "problem": str(error)})
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return articles.select(key, xml).mapInArrow(run, SCANNED)
