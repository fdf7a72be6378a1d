"""Queries of the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from assayweave.llm import confusables, encoding_repair, entity_match, packing, splits, tokens
from assayweave.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of records and activities that report the same measurement."""
    return p1_matches(spark, folder).select("id", "activity_id")


def p1_matches(spark: SparkSession, folder: str) -> DataFrame:
    """The same pairs with their confidence."""
    return entity_match.match_entities(table(spark, folder, "records"), table(spark, folder, "chembl_activity"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Rows whose present split parts their group."""
    return splits.parted_rows(table(spark, folder, "release_papers"))


def p5_splits(spark: SparkSession, folder: str) -> DataFrame:
    """An assignment of all rows to 80 / 10 / 10 that parts no group."""
    return splits.assign_splits(table(spark, folder, "release_papers"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Fields that are not in the consistent form."""
    labels = confusables.inconsistent_fields(table(spark, folder, "llm_extract"), "value_id", ["compound_label", "value_text"])
    headers = confusables.inconsistent_fields(table(spark, folder, "verify_scale"), "value_id", ["column_header"])
    return labels.unionByName(headers)


def p6_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Each field with a non-ASCII character, in its stored and its consistent form."""
    labels = confusables.normalized_fields(table(spark, folder, "llm_extract"), "value_id", ["compound_label", "value_text"])
    headers = confusables.normalized_fields(table(spark, folder, "verify_scale"), "value_id", ["column_header"])
    return labels.unionByName(headers).distinct()


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encode_corpus(table(spark, folder, "documents"))


def p8_pack(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces with their place in a container of 1,024 tokens."""
    return packing.pack_documents(table(spark, folder, "documents"))


def p8_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full the containers are."""
    return packing.fill_report(packing.pack_documents(table(spark, folder, "documents")))


def p8_batches(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces in token-budget batches that form inside the optimal length buckets."""
    return packing.pack_documents(table(spark, folder, "documents"), buckets=packing.BUCKETS)


def p8_batch_fill(spark: SparkSession, folder: str) -> DataFrame:
    """How full these batches are."""
    return packing.fill_report(p8_batches(spark, folder))


def p8_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The optimal length buckets and their padding."""
    return packing.bucket_report(tokens.count_tokens(table(spark, folder, "documents")))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents any part of which was decoded wrongly."""
    return encoding_repair.find_garbled(table(spark, folder, "documents"))


def p9_restored(spark: SparkSession, folder: str) -> DataFrame:
    """The restored texts of those documents."""
    return encoding_repair.restore(table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    "p1_found": p1_found,
    "p1_matches": p1_matches,
    "p5_found": p5_found,
    "p5_splits": p5_splits,
    "p6_found": p6_found,
    "p6_forms": p6_forms,
    "p7_ids": p7_ids,
    "p8_pack": p8_pack,
    "p8_fill": p8_fill,
    "p8_batches": p8_batches,
    "p8_batch_fill": p8_batch_fill,
    "p8_buckets": p8_buckets,
    "p9_found": p9_found,
    "p9_restored": p9_restored,
}
_KEY = "CASE WHEN {0} <> '' THEN '{0}=' || {0} END"
SQL: dict[str, str] = {
    # a plain transitive closure over the links of each row to the least row of each of its keys
    "p5_found": (
        "WITH RECURSIVE r AS (SELECT DISTINCT release_id AS id, CASE lower(trim(split)) WHEN 'val' THEN 'valid' WHEN '' THEN NULL ELSE lower(trim(split)) END AS split, "
        f"unnest([{_KEY.format('pmcid')}, {_KEY.format('author_id')}, CASE WHEN scaffold <> 'acyclic' THEN {_KEY.format('scaffold')} END, {_KEY.format('inchikey')}]) AS k FROM release_papers WHERE release_id IS NOT NULL), "
        "m AS (SELECT k, min(id) AS least FROM r WHERE k IS NOT NULL GROUP BY 1), e AS (SELECT DISTINCT id AS a, least AS b FROM r JOIN m USING (k) WHERE id <> least), "
        "l AS (SELECT a, b FROM e UNION SELECT b, a FROM e), c AS (SELECT DISTINCT id, id AS root FROM r UNION SELECT l.b AS id, c.root FROM c JOIN l ON c.id = l.a), "
        "g AS (SELECT id, min(root) AS component FROM c GROUP BY 1), s AS (SELECT DISTINCT id, split, component FROM r JOIN g USING (id) WHERE split IS NOT NULL) "
        "SELECT DISTINCT id AS release_id FROM s WHERE component IN (SELECT component FROM s GROUP BY 1 HAVING count(DISTINCT split) > 1)"
    ),
}
