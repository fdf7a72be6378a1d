"""Incremental ingest: new article rows become records as they arrive.

Each micro-batch is parsed and written under its batch id, so a batch that is repeated
after a failure replaces its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from assayweave.operators import article_tables, classify, enrich
from assayweave.operators.registry import RULES, Rule
from assayweave.session import settle

ARTICLES = "pmcid string, xml_text string, fetched_at timestamp"


def stream_articles(spark: SparkSession, folder: str, files_per_batch: int = 100) -> DataFrame:
    """Article rows of the Parquet files that appear in a folder."""
    return spark.readStream.schema(ARTICLES).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def ingest(articles: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes records and skipped rows of each batch; runs until the source has no more files."""

    def write(batch: DataFrame, number: int) -> None:
        latest = batch.groupBy("pmcid").agg(F.max_by("xml_text", "fetched_at").alias("xml_text"))
        records, skipped = article_tables.measurements(article_tables.parse_articles(latest, on_error="skip"))
        records.write.mode("overwrite").parquet(f"{out}/records/batch={number}")
        skipped.write.mode("overwrite").parquet(f"{out}/skipped/batch={number}")

    return articles.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def admit(scanned: DataFrame, known: DataFrame, rules: tuple[Rule, ...] = RULES) -> tuple[DataFrame, DataFrame]:
    """``(admitted, reasons)`` of newly fetched articles, each judged by the first gate that stops it.

    ``scanned``: articles of :func:`article_scan.scan_articles`, one row an article.
    ``known``: pmcid of the corpus.  Gates, in order: ``have`` (in the corpus), ``err``
    (unreadable), ``no_clean`` (no record with a value and without a flag, but for a missing
    assay context), ``license`` (no open attribution licence).  ``admitted`` has pmcid, doi,
    title, year, sha256 and the number of clean records, ``reasons`` how many articles each
    gate stopped.
    """
    parsed = settle(article_tables.parsed_of(scanned, on_error="skip"), "parsed")
    records, _ = article_tables.measurements(parsed, rules)
    clean = records.where(F.col("value").isNotNull() & (F.size(F.array_except("flags", F.array(F.lit("missing_assay_context")))) == 0)).groupBy("pmcid").agg(F.count("*").alias("clean"))
    outcome = parsed.where(F.col("kind").isin("article", "error")).select("pmcid", "kind", "doi", "title", "year", "sha256")
    licence = scanned.select(F.col("stated").alias("pmcid"), classify.licence_class(F.col("permissions"), public_domain=False).alias("licence"))
    there = known.select("pmcid").distinct().withColumn("__have", F.lit(True))
    judged = outcome.join(there, "pmcid", "left").join(clean, "pmcid", "left").join(licence, "pmcid", "left")
    gates = [
        (F.coalesce("__have", F.lit(False)), "have"), (F.col("kind") == "error", "err"), (F.col("clean").isNull(), "no_clean"), (F.coalesce(F.col("licence"), F.lit("unknown")) != "open", "license"),
    ]
    judged = settle(judged.withColumn("reason", enrich.elimination_reason(gates)), "judged")
    admitted = judged.where(F.col("reason").isNull()).select("pmcid", "doi", "title", "year", "sha256", "clean")
    return admitted, judged.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n"))


def latest_values(events: DataFrame, key: str, time: str, delay: str = "7 days") -> DataFrame:
    """Deduplicated late arrivals: one row per key within the watermark."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])
