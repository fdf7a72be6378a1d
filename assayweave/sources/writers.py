"""Writers: CSV for spreadsheets, JSON and Parquet releases, snapshots, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayweave.functions import scalars


def sheet_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as text: lists joined by ';', structs as JSON, formulas neutralised."""

    def text(field: T.StructField) -> Column:
        c = F.col(field.name)
        if isinstance(field.dataType, T.ArrayType) and isinstance(field.dataType.elementType, T.StringType):
            c = F.array_join(c, ";")
        elif isinstance(field.dataType, (T.ArrayType, T.StructType, T.MapType)):
            c = F.to_json(c)
        return scalars.sheet_safe(c.cast("string")).alias(field.name)

    return df.select(*[text(df.schema[name]) for name in columns])


def write_csv(df: DataFrame, path: str, columns: list[str], line_end: str = "\n") -> None:
    """CSV with a header; as many files as partitions."""
    sheet_columns(df, columns).write.option("header", True).option("lineSep", line_end).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def csv_text(df: DataFrame, columns: list[str], order: list[str], most: int = 100_000) -> str:
    """One CSV text with a byte-order mark for a download; refuses more than ``most`` rows."""
    import csv
    import io

    rows = sheet_columns(df.orderBy(*order).limit(most + 1), columns).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} rows; use write_csv")
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\r\n")
    writer.writerow(columns)
    writer.writerows([["" if v is None else v for v in row] for row in rows])
    return "﻿" + out.getvalue()


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines, made visible at once by the commit protocol."""
    df.write.mode("overwrite").json(path)


def write_release(df: DataFrame, path: str, by: str | None = None) -> None:
    """Parquet with zstd, a folder for each value of ``by`` (a licence, a target)."""
    writer = df.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)


def write_training(df: DataFrame, path: str) -> None:
    """Training rows as CSV with header."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_snapshot(records: DataFrame, articles: DataFrame, tables: DataFrame, path: str) -> None:
    """Records, the articles and tables they use, and the skipped rows of nothing, side by side.

    The assay context belongs to the article: it leaves the records and is stored once with
    each article, an empty list where no record has one.
    """
    if "assay_context" in records.columns:
        contexts = records.groupBy("pmcid").agg(F.max("assay_context").alias("assay_context"))
        used = articles.drop("assay_context").join(contexts, "pmcid")
        if isinstance(records.schema["assay_context"].dataType, T.ArrayType):
            kind = records.schema["assay_context"].dataType.simpleString()
            used = used.withColumn("assay_context", F.coalesce("assay_context", F.array().cast(kind)))
    else:
        used = articles.join(records.select("pmcid").distinct(), "pmcid", "left_semi")
    records.drop("assay_context").write.mode("overwrite").json(f"{path}/records")
    used.write.mode("overwrite").json(f"{path}/articles")
    tables.join(records.select("pmcid", "table_id").distinct(), ["pmcid", "table_id"], "left_semi").write.mode("overwrite").json(f"{path}/tables")
    records.sparkSession.createDataFrame([], "pmcid string, table_id string, row_index int, reason string").write.mode("overwrite").json(f"{path}/skipped")


def upsert(df: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Rows of ``df``, and those of ``existing`` whose key it lacks."""
    return df.unionByName(existing.join(df.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def attribution(articles: DataFrame, known: DataFrame, most: int = 8) -> DataFrame:
    """``pmcid, credit`` of articles not yet credited: at most ``most`` authors, then 'et al.'."""
    fresh = articles.join(known.select("pmcid").distinct(), "pmcid", "left_anti")
    short = F.array_join(F.slice("authors", 1, most), ", ")
    return fresh.select("pmcid", F.when(F.size("authors") > most, F.concat(short, F.lit(" et al."))).otherwise(short).alias("credit"))


def data_card(df: DataFrame, title: str, by: list[str], most: int = 200) -> str:
    """Markdown with the size class and the counts of some columns, largest first.

    A column with more than ``most`` values shows the most frequent ones, and one line
    with the number and the rows of all others, so that each table adds up to all rows.
    """
    total = df.count()
    size = df.sparkSession.range(1).select(scalars.size_bucket(F.lit(total))).first()[0]
    lines = [f"# {title}", "", f"Rows: {total} ({size})", ""]
    for column in by:
        lines += [f"| {column} | rows |", "|---|---|"]
        counted = df.groupBy(column).count()
        shown = counted.orderBy(F.col("count").desc(), column).limit(most).collect()
        lines += [f"| {row[column]} | {row['count']} |" for row in shown]
        if len(shown) == most and (others := counted.count() - most):
            lines.append(f"| {others} others | {total - sum(row['count'] for row in shown)} |")
        lines.append("")
    return "\n".join(lines)
