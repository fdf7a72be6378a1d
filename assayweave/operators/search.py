"""The query surface: search, evidence, summaries, profiles over records and activities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayweave.functions import parsing
from assayweave.operators import enrich, metrics

MOST_ROWS = 100


def paper_rows(records: DataFrame, articles: DataFrame | None = None) -> DataFrame:
    """Records in the shape that all searches share; ``citation`` says where a value was read."""
    year = F.col("pub_year")
    title, journal = F.lit(None).cast("string"), F.lit(None).cast("string")
    if articles is not None:
        known = articles.groupBy(F.col("pmcid").alias("__pmcid")).agg(F.max(F.struct("fetched_at", "title", "journal")).alias("__a"))
        records = records.join(known, F.col("pmcid") == F.col("__pmcid"), "left")
        title, journal = F.col("__a.title"), F.col("__a.journal")
    return records.select(
        F.col("id").cast("string").alias("id"), F.lit("paper").alias("source"), F.col("compound_label").alias("compound"), F.lit(None).cast("string").alias("molecule_id"),
        F.col("target_key").alias("target"), F.col("measurement_type").alias("endpoint"), F.col("relation"), F.col("normalized_value_nm").alias("value_nm"),
        F.trim(F.concat_ws(" ", "raw_value", "unit")).alias("reported"), F.array_except(F.coalesce("flags", F.array().cast("array<string>")), F.array(*map(F.lit, enrich.INFO_FLAGS))).alias("flags"),
        F.struct("pmcid", "doi", year.alias("year"), "table_id", F.col("row_index").cast("int").alias("row_index"), title.alias("title"), journal.alias("journal")).alias("citation"),
    )


def database_rows(activities: DataFrame) -> DataFrame:
    """Activities in the same shape; a validity note is a flag."""
    none = lambda kind: F.lit(None).cast(kind)
    return activities.select(
        F.concat(F.lit("db:"), F.col("activity_id").cast("string")).alias("id"), F.lit("database").alias("source"), F.coalesce("pref_name", "molecule_id").alias("compound"),
        "molecule_id", F.col("target_key").alias("target"), "endpoint", parsing.clean_relation(F.col("relation")).alias("relation"), F.col("normalized_value_nm").alias("value_nm"),
        F.trim(F.concat_ws(" ", F.col("value_num").cast("string"), "units")).alias("reported"), F.array_compact(F.array("validity")).alias("flags"),
        F.struct(none("string").alias("pmcid"), "doi", F.col("pub_year").alias("year"), F.col("document_id").alias("table_id"), none("int").alias("row_index"), none("string").alias("title"), none("string").alias("journal")).alias("citation"),
    )


def pool(papers: DataFrame, database: DataFrame, source: str, target: str | None) -> DataFrame:
    """Rows of the chosen source; the database is only searched for a chosen target."""
    if source not in ("paper", "database", "both"):
        raise ValueError("source is paper, database or both")
    parts = []
    if source != "database":
        parts.append(papers)
    if source != "paper" and target is not None:
        parts.append(database)
    out = parts[0] if parts else papers.limit(0)
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.where(F.col("target") == target) if target is not None else out


def usable(exact_only: bool) -> Column:
    """Rows with a value; if asked only exact ones without flags."""
    present = F.col("value_nm").isNotNull()
    return present & (F.col("relation") == "=") & (F.size("flags") == 0) if exact_only else present


def search_measurements(
    rows: DataFrame, compound: str | None = None, endpoint: str | None = None, max_nm: float | None = None, exact_only: bool = False, limit: int = 20
) -> DataFrame:
    """Matching rows by ascending value, ties by id, with ``matches``: their number before the limit.

    The limit is clamped to 1..100.  ``compound`` is a case-insensitive part of the label or the molecule id.
    """
    found = rows.where(usable(exact_only))
    if endpoint is not None:
        found = found.where(F.col("endpoint") == endpoint)
    if max_nm is not None:
        found = found.where(F.col("value_nm") <= max_nm)
    if compound:
        part = F.lit(compound.lower())
        found = found.where(F.contains(F.lower(F.coalesce("compound", F.lit(""))), part) | F.contains(F.lower(F.coalesce("molecule_id", F.lit(""))), part))
    count = found.agg(F.count("*").alias("matches"))
    top = found.orderBy("value_nm", "id").limit(max(1, min(MOST_ROWS, limit)))
    return top.join(F.broadcast(count), F.lit(True)).orderBy("value_nm", "id")


def potency_summary(rows: DataFrame, keys: list[str], most: int = 10) -> DataFrame:
    """``keys, n, p10, p50, p90, top`` of exact values; ``top`` are the ids of the most potent.

    All matching rows enter the percentiles.
    """
    exact = rows.where(usable(True) & (F.col("value_nm") > 0))
    stats = metrics.percentiles(exact, keys, "value_nm", {"p10": 0.1, "p50": 0.5, "p90": 0.9})
    order = Window.partitionBy(*keys).orderBy("value_nm", "id")
    top = exact.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= most)
    top = top.groupBy(*keys).agg(F.transform(F.array_sort(F.collect_list(F.struct("rn", "id"))), lambda x: x["id"]).alias("top"))
    return stats.join(top, keys).select(*keys, "n", "p10", "p50", "p90", "top")


def dataset_info(records: DataFrame, activities: DataFrame) -> DataFrame:
    """One row of global counts."""
    a = records.agg(
        F.count("*").alias("paper_values"), F.countDistinct("pmcid").alias("papers"), F.countDistinct("target_key").alias("targets_with_paper_values"),
        F.count_if(F.col("normalized_value_nm").isNotNull() & (F.col("relation") == "=")).alias("exact_values"),
    )
    b = activities.agg(F.count("*").alias("database_values"), F.countDistinct("molecule_id").alias("database_molecules"))
    return a.join(F.broadcast(b), F.lit(True))


def list_targets(targets: DataFrame, records: DataFrame, activities: DataFrame) -> DataFrame:
    """Registry rows with their counts in both sources, 0 where there are none."""
    a = records.groupBy("target_key").agg(F.count("*").alias("paper_values"), F.countDistinct("pmcid").alias("papers"))
    b = activities.groupBy("target_key").agg(F.count("*").alias("database_values"))
    zero = F.lit(0).cast("long")
    counted = targets.join(a, "target_key", "left").join(b, "target_key", "left")
    return counted.withColumns({c: F.coalesce(c, zero) for c in ("paper_values", "papers", "database_values")})


def visible_targets(targets: DataFrame, records: DataFrame, activities: DataFrame) -> DataFrame:
    """Targets that any source has rows of."""
    used = records.select("target_key").union(activities.select("target_key")).distinct()
    return targets.join(used, "target_key", "left_semi")


def get_evidence(records: DataFrame, tables: DataFrame, wanted: str) -> DataFrame:
    """The record with its table's row as ``cells``: header, text and whether it is the value read.

    ``tables`` has pmcid, table_id, headers, rows.  Cells beyond the headers are named by
    their place.  An unknown id gives no row.
    """
    one = records.where(F.col("id") == wanted)
    joined = one.join(tables.select("pmcid", "table_id", "headers", "rows"), ["pmcid", "table_id"], "left")
    row = F.get("rows", F.col("row_index"))
    cells = F.transform(
        row,
        lambda cell, i: F.struct(
            F.coalesce(F.nullif(F.get("headers", i), F.lit("")), F.concat(F.lit("col"), i.cast("string"))).alias("header"), cell.alias("text"), (i == F.col("target_column")).alias("extracted")
        ),
    )
    return joined.select("id", "pmcid", "table_id", "compound_label", "raw_value", cells.alias("cells"))


def compound_profile(rows: DataFrame, name: str, per_target: int = 5) -> DataFrame:
    """``target, paper_values, database_values, paper_median, database_median, examples`` of one compound.

    Paper rows match by part of their label, database rows by exact name or id.  Medians
    are the upper ones of exact unflagged values.
    """
    text = name.strip().lower()
    label, molecule = F.lower(F.coalesce("compound", F.lit(""))), F.lower(F.coalesce("molecule_id", F.lit("")))
    paper = F.col("source") == "paper"
    hits = rows.where((paper & F.contains(label, F.lit(text))) | (~paper & ((label == text) | (molecule == text))))
    exact = usable(True)
    hits = hits.withColumns({"__paper": F.when(paper & exact, F.col("value_nm")), "__database": F.when(~paper & exact, F.col("value_nm"))})
    stats = hits.groupBy("target").agg(F.count_if(paper).alias("paper_values"), F.count_if(~paper).alias("database_values"))
    for column, median in (("__paper", "paper_median"), ("__database", "database_median")):
        stats = stats.join(metrics.upper_median_rows(hits, ["target"], column, median), "target", "left")
    order = Window.partitionBy("target", "source").orderBy(F.coalesce("value_nm", F.lit(0.0)), "id")
    shown = hits.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= per_target)
    shown = shown.groupBy("target").agg(F.array_sort(F.collect_list(F.struct("source", "rn", "id"))).alias("e"))
    return stats.join(shown, "target").select("target", "paper_values", "database_values", "paper_median", "database_median", F.transform("e", lambda x: x["id"]).alias("examples"))


def filter_records(records: DataFrame, text: str = "", pmcid: str = "", measurement: str = "", target: str = "", flagged: bool = False) -> DataFrame:
    """Records whose label, article, target or type contain a text, and that equal the other filters.

    A missing type reads ``None``, so that text finds it.
    """
    out = records
    if text:
        words = F.lower(F.concat_ws(" ", "compound_label", "pmcid", "target_key", F.coalesce("measurement_type", F.lit("None"))))
        out = out.where(F.contains(words, F.lit(text.lower())))
    for column, wanted in (("pmcid", pmcid), ("measurement_type", measurement), ("target_key", target)):
        if wanted:
            out = out.where(F.col(column) == wanted)
    return out.where(F.size("flags") > 0) if flagged else out


def ordered(records: DataFrame, column: str, descending: bool = False, most: int = 500) -> DataFrame:
    """The first rows by a column, nulls last either way, ties by id."""
    key = F.col(column).desc_nulls_last() if descending else F.col(column).asc_nulls_last()
    return records.orderBy(key, "id").limit(most)
