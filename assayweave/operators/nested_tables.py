"""Deeply nested records into flat tables with parent-child links (problem 3).

One depth-first visitor walks an article once and emits tagged rows: the tag names
the flat table, ``node_id`` is the primary key inside the article, ``parent_id``
the parent's, ``payload`` the fields as JSON.  The tagged rows are written once,
partitioned by tag, and each flat table is a read of its own partition with its
own schema.
"""

from __future__ import annotations

import json
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayweave.operators.enrich import newest
from assayweave.session import shared_path, spread

TAGGED = "pmcid string, node_id int, parent_id int, payload string, tag string"
SCHEMAS = {
    "section": "title string, depth int",
    "table_wrap": "table_no int, label string, wrap_id string",
    "caption": "table_no int, text string, blank boolean",
    "cell": "table_no int, row_index int, column_index int, row_count int, column_count int, heading boolean, text string",
    "reject": "reason string",
}
MAX_SPAN = 100
_WHOLE = re.compile(r"\s*([0-9]{1,9})\s*")


def _name(node: ET.Element) -> str:
    tag = node.tag
    return tag.rpartition("}")[2] if isinstance(tag, str) else ""


def _text(node: ET.Element) -> str:
    return " ".join("".join(node.itertext()).split())


def _span(node: ET.Element, name: str) -> int | None:
    """The span, 1 where absent, None where it is no whole number from 1 to 100."""
    value = node.get(name)
    if value is None:
        return 1
    found = _WHOLE.fullmatch(value)
    return int(found[1]) if found and 1 <= int(found[1]) <= MAX_SPAN else None


def table_sections(table: ET.Element) -> list[list[ET.Element]]:
    """Row groups of a table, head first; loose rows outside any group make one group."""
    heads, bodies, loose = [], [], []
    for child in table:
        kind = _name(child)
        if kind == "tr":
            if not loose:
                bodies.append(loose)
            loose.append(child)
        elif kind in ("thead", "tbody", "tfoot"):
            (heads if kind == "thead" else bodies).append([row for row in child if _name(row) == "tr"])
    return heads + bodies


def grid_cells(table: ET.Element) -> list[tuple[int, int, int, int, ET.Element]] | None:
    """``(row, column, rows covered, columns covered, node)`` of each cell.

    A cell takes the first free column of its row; what it covers ends with its row
    group.  None if any span is not a whole number from 1 to 100.
    """
    out, base = [], 0
    for group in table_sections(table):
        taken: dict[int, set[int]] = {}
        for r, row in enumerate(group):
            column = 0
            for node in row:
                if _name(node) not in ("td", "th"):
                    continue
                down, across = _span(node, "rowspan"), _span(node, "colspan")
                if down is None or across is None:
                    return None
                used = taken.setdefault(r, set())
                while column in used:
                    column += 1
                down = min(down, len(group) - r)
                for k in range(r, r + down):
                    taken.setdefault(k, set()).update(range(column, column + across))
                out.append((base + r, column, down, across, node))
                column += across
            taken.pop(r, None)
        base += len(group)
    return out


def _table_of(wrap: ET.Element) -> ET.Element | None:
    """The first table below ``wrap`` that is not inside another table-wrap."""
    stack = list(reversed(wrap))
    while stack:
        node = stack.pop()
        kind = _name(node)
        if kind == "table":
            return node
        if kind != "table-wrap":
            stack.extend(reversed(node))
    return None


def visit(pmcid: str | None, xml: str | None) -> Iterator[tuple[str, int, int | None, dict]]:
    """Tagged rows ``(tag, node_id, parent_id, payload)`` of one article, depth first.

    Null, empty and malformed text give a single ``reject`` row.
    """
    if xml is None or not xml.strip():
        yield "reject", 0, None, {"reason": "empty"}
        return
    try:
        root = ET.fromstring(xml)
    except (ET.ParseError, ValueError, UnicodeError):
        yield "reject", 0, None, {"reason": "malformed"}
        return
    ids = iter(range(1, 1 << 31))
    tables = 0
    stack: list[tuple[ET.Element, int | None, int]] = [(root, None, 0)]
    while stack:
        node, parent, depth = stack.pop()
        kind = _name(node)
        if kind == "sec":
            own = next(ids)
            title = next((_text(c) for c in node if _name(c) == "title"), None)
            yield "section", own, parent, {"title": title, "depth": depth}
            parent, depth = own, depth + 1
        elif kind == "table-wrap":
            tables += 1
            own = next(ids)
            label = next((_text(c) for c in node if _name(c) == "label"), None)
            yield "table_wrap", own, parent, {"table_no": tables, "label": label, "wrap_id": node.get("id")}
            for caption in (c for c in node if _name(c) == "caption"):
                text = _text(caption)
                yield "caption", next(ids), own, {"table_no": tables, "text": text, "blank": not text}
            table = _table_of(node)
            cells = grid_cells(table) if table is not None else []
            if cells is None:
                yield "reject", next(ids), own, {"reason": f"span of table {tables}"}
            for row, column, down, across, cell in cells or ():
                yield "cell", next(ids), own, {
                    "table_no": tables, "row_index": row, "column_index": column, "row_count": down,
                    "column_count": across, "heading": _name(cell) == "th", "text": _text(cell),
                }
            parent = own
        stack.extend((child, parent, depth) for child in reversed(node))


def latest_articles(articles: DataFrame) -> DataFrame:
    """``pmcid, xml_text`` of the row with the latest ``fetched_at`` of each pmcid; ties go to the greater text.

    Only pmcids and times are aggregated; a text moves only if its pmcid repeats, or if too
    many pmcids repeat for them to be sent to every executor.
    """
    return newest(articles, "pmcid", "fetched_at", ["pmcid", "xml_text"])


def shred(articles: DataFrame) -> DataFrame:
    """Tagged rows (:data:`TAGGED`) of ``pmcid, xml_text`` rows; one pass over each text."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [
                (pmcid, node, parent, json.dumps(payload, ensure_ascii=False), tag)
                for pmcid, xml in zip(pdf["pmcid"], pdf["xml_text"])
                for tag, node, parent, payload in visit(pmcid, xml)
            ]
            out = pd.DataFrame(rows, columns=["pmcid", "node_id", "parent_id", "payload", "tag"])
            yield out.astype({"node_id": "int32", "parent_id": "Int32"})

    return articles.select("pmcid", "xml_text").mapInPandas(run, TAGGED)


def write_tagged(tagged: DataFrame, path: str) -> None:
    """All flat tables in one write, a folder for each tag."""
    tagged.write.partitionBy("tag").parquet(path)


def read_tag(spark: SparkSession, path: str, tag: str) -> DataFrame:
    """The flat table ``tag`` with its schema; reads its own folder only."""
    rows = spark.read.schema(TAGGED).parquet(path).where(F.col("tag") == tag)
    return rows.select("pmcid", "node_id", "parent_id", F.from_json("payload", SCHEMAS[tag]).alias("f")).select(
        "pmcid", "node_id", "parent_id", "f.*"
    )


def flat_tables(articles: DataFrame) -> dict[str, DataFrame]:
    """The flat tables of the latest articles, by tag."""
    spark = articles.sparkSession
    path = shared_path(spark, "shred")
    write_tagged(shred(spread(latest_articles(articles), articles)), path)
    return {tag: read_tag(spark, path, tag) for tag in SCHEMAS}


def spans_and_captions(articles: DataFrame) -> DataFrame:
    """Captions with text, and each grid position that a spanning cell covers besides its own."""
    flat = flat_tables(articles)
    minus = F.lit(-1)
    captions = flat["caption"].where(~F.col("blank")).select(
        "pmcid", "table_no", F.lit("caption").alias("item"), minus.alias("row_index"), minus.alias("column_index"),
        minus.alias("origin_row"), minus.alias("origin_column"),
    )
    wide = flat["cell"].where((F.col("row_count") > 1) | (F.col("column_count") > 1))
    spread = (
        wide.withColumn("r", F.explode(F.sequence(F.col("row_index"), F.col("row_index") + F.col("row_count") - 1)))
        .withColumn("c", F.explode(F.sequence(F.col("column_index"), F.col("column_index") + F.col("column_count") - 1)))
        .where((F.col("r") != F.col("row_index")) | (F.col("c") != F.col("column_index")))
    )
    cells = spread.select(
        "pmcid", "table_no", F.lit("cell").alias("item"), F.col("r").alias("row_index"), F.col("c").alias("column_index"),
        F.col("row_index").alias("origin_row"), F.col("column_index").alias("origin_column"),
    )
    return captions.unionByName(cells).distinct()
