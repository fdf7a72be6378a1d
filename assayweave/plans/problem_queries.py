"""Queries of the data problems that belong to the core."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayweave.operators import nested_tables, snapshot_diff, units
from assayweave.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose stored nM value is missing or wrong."""
    return units.misconverted(table(spark, folder, "llm_extract"), table(spark, folder, "chembl_activity"))


def p2_nanomolar(spark: SparkSession, folder: str) -> DataFrame:
    """The quantity in nM of every row that states one number, null where no conversion exists."""
    return units.quantities(table(spark, folder, "llm_extract"), table(spark, folder, "chembl_activity")).select("tab", "row_id", "nm").distinct()


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Captions, and grid positions under spanning cells, of the latest articles."""
    return nested_tables.spans_and_captions(table(spark, folder, "articles"))


def p3_cells(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of cells with its parent links."""
    return nested_tables.flat_tables(table(spark, folder, "articles"))["cell"].distinct()


def p3_captions(spark: SparkSession, folder: str) -> DataFrame:
    """The flat table of captions with its parent links."""
    return nested_tables.flat_tables(table(spark, folder, "articles"))["caption"].distinct()


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """What differs between the two copies of the records."""
    return snapshot_diff.snapshot_diff(table(spark, folder, "records"), table(spark, folder, "records_mirror"))


def _p4_sql() -> str:
    fields = (
        "pmcid doi pub_year table_id row_index target_column compound_label target_key measurement_type raw_value relation unit value_num "
        "normalized_value_nm uncertainty flags review_status chembl_match doc"
    ).split()
    doubles = {"value_num", "normalized_value_nm", "uncertainty"}

    def off(c: str) -> str:
        if c not in doubles:
            return f"a.{c} IS DISTINCT FROM b.{c}"
        return f"(a.{c} IS DISTINCT FROM b.{c} AND NOT coalesce(abs(a.{c} - b.{c}) <= 1e-9 * greatest(abs(a.{c}), abs(b.{c})), false))"

    best = ", ".join(
        f"{n} AS (SELECT * FROM {t} QUALIFY row_number() OVER (PARTITION BY id ORDER BY exported_at DESC NULLS LAST) = 1)"
        for n, t in (("a0", "records"), ("b0", "records_mirror"))
    )
    parts = [
        "SELECT id, 'only_records' AS field FROM a0 WHERE id NOT IN (SELECT id FROM b0)",
        "SELECT id, 'only_records_mirror' AS field FROM b0 WHERE id NOT IN (SELECT id FROM a0)",
        *(f"SELECT a.id, '{c}' AS field FROM a0 a JOIN b0 b ON a.id = b.id WHERE {off(c)}" for c in fields),
    ]
    return f"WITH {best} " + " UNION ALL ".join(parts)


QUERIES: dict[str, Query] = {
    "p2_found": p2_found,
    "p2_nanomolar": p2_nanomolar,
    "p3_found": p3_found,
    "p3_cells": p3_cells,
    "p3_captions": p3_captions,
    "p4_found": p4_found,
}
SQL: dict[str, str] = {"p4_found": _p4_sql()}
