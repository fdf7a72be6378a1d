"""Readers for the table folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assayweave.session import show_package


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table ``name`` of ``folder``; columns are pruned by what is selected from it."""
    show_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
