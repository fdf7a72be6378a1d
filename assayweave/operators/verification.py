"""Verification of extracted values against the tables they are said to come from."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayweave.operators import classify
from assayweave.operators.article_tables import locate
from assayweave.operators.registry import RULES, Rule
from assayweave.session import settle


def verify(values: DataFrame, grids: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """``value_id, status, reason, column_header`` of extracted values.

    ``values``: value_id, pmcid, table_id, compound_label, target_key, value_text, value,
    unit, value_nm, kind.  ``grids``: pmcid, table_id, caption, grid, heads, one row a table.
    Values are located by joins with the cells, so no grid is copied; rules run on distinct
    headers and captions only, whatever the number of values.
    """
    known = tuple(rules)
    place = ["pmcid", "table_id", "compound_label", "value_text"]
    tables = settle(grids, "grids")
    found = locate(values.select(*place), tables)
    same = F.lit(True)
    for c in place:
        same = same & F.col(f"v.{c}").eqNullSafe(F.col(f"f.{c}"))
    joined = values.alias("v").join(found.alias("f"), same, "left").select("v.*", "f.headers")
    captions = tables.select("pmcid", "table_id", "caption", F.lit(True).alias("has_table"))
    joined = joined.join(captions, ["pmcid", "table_id"], "left").withColumn("has_table", F.coalesce("has_table", F.lit(False)))
    located = settle(joined.withColumn("located", F.coalesce("headers", F.array().cast("array<string>"))).drop("headers"), "located")
    shown = located.select("value_id", "target_key", F.posexplode("located").alias("pos", "header"))
    names = settle(shown.select("header").distinct().withColumn("names", classify.named_targets(F.col("header"), known)), "names")
    # the first header that names the claimed target, else the first
    ranked = shown.join(names, "header").withColumn("miss", (~F.coalesce(F.array_contains("names", F.col("target_key")), F.lit(False))).cast("int"))
    chosen = ranked.groupBy("value_id").agg(F.min_by(F.struct("header", "names"), F.struct("miss", "pos")).alias("c")).select("value_id", "c.header", F.col("c.names").alias("header_names"))
    placed = settle(located.join(chosen, "value_id", "left"), "placed")
    heads = classify.classify_columns(placed.where(F.col("header").isNotNull()).select("header", "caption").distinct(), rules=known)
    heads = settle(heads.select(F.col("header").alias("__h"), F.col("caption").alias("__c"), F.col("target").alias("by_header")), "heads")
    captions = placed.where(F.col("caption").isNotNull()).select(F.col("caption").alias("__cap")).distinct()
    captions = captions.withColumn("caption_names", classify.named_targets(F.col("__cap"), known))
    single = classify.caption_targets(captions, "__cap", known).withColumnRenamed("target", "by_caption")
    captions = settle(captions.join(single, "__cap", "left"), "captions")
    full = placed.join(heads, (F.col("header") == F.col("__h")) & F.col("caption").eqNullSafe(F.col("__c")), "left").join(captions, F.col("caption") == F.col("__cap"), "left")
    ladder = classify.verification(
        F.col("value"), F.col("unit"), F.col("value_nm"), F.col("kind"), F.col("has_table"), F.col("target_key"), F.col("header"), F.col("caption"),
        F.col("by_header"), F.col("header_names"), F.col("caption_names"), F.col("by_caption"),
    )
    return full.select("value_id", ladder.alias("v")).select("value_id", "v.*")
