"""Readers for manifests, article files, database bundles and other nested sources.

Every reader states its schema; optional inputs that are absent give an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_ENTRY = "pmcid string, filename string, sha256 string, title string, doi string, year int, license string"
COMPOUNDS = "name string, molecule_id string, preferred_name string, inchikey string, smiles string"
STRUCTURES = "pmcid string, compound_label string, smiles string, inchikey string, name string, method string, formula_check string, formula string, stated_formula string"
REVIEWS = "id string, status string, reviewer string, date string, method string, note string"
ACTIVITIES = (
    "target string, activity_id long, molecule_id string, pref_name string, endpoint string, relation string, value double, units string, pchembl double, "
    "assay_id string, document_id string, year int, validity string"
)
MODEL_VALUES = "compound_label string, target string, endpoint string, relation string, value double, unit string, value_text string, column_header string, value_nm double, grounded boolean"
FILE_NAME = r"^[A-Za-z0-9_.-]+\.xml$"


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in its file system."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Manifest entries in their order; the file is a list, or an object with ``articles``.

    Repeated article ids are an error.
    """
    text = spark.read.text(path, wholetext=True)
    listed = F.from_json("value", f"array<struct<{_ddl(MANIFEST_ENTRY)}>>")
    wrapped = F.from_json("value", f"struct<articles:array<struct<{_ddl(MANIFEST_ENTRY)}>>>")["articles"]
    opened = text.select(F.when(F.ltrim("value").startswith("["), listed).otherwise(wrapped).alias("a"))
    rows = opened.select(F.posexplode("a").alias("position", "e")).select("position", "e.*")
    again = rows.groupBy("pmcid").count().where("count > 1").limit(1).collect()
    if again:
        raise ValueError(f"article {again[0]['pmcid']} is listed twice")
    return rows


def _ddl(schema: str) -> str:
    return ", ".join(f"{name}:{kind}" for name, kind in (part.split(" ", 1) for part in schema.split(", ")))


def read_article_files(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """``pmcid, filename, content`` of the listed files.

    Names have to be bare ``*.xml`` names; a file whose SHA-256 is not the listed one, or
    that is missing, fails the read.
    """
    bad = manifest.where(~F.coalesce(F.col("filename").rlike(FILE_NAME), F.lit(False))).select("filename").limit(1).collect()
    if bad:
        raise ValueError(f"not a bare XML file name: {bad[0]['filename']}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xml").load(folder).select(F.element_at(F.split("path", "/"), -1).alias("filename"), "content")
    joined = manifest.select("pmcid", "filename", "sha256").join(files, "filename", "left")
    wrong = F.col("content").isNull() | (F.sha2("content", 256) != F.lower("sha256"))
    stop = F.raise_error(F.concat(F.lit("missing or changed source file "), F.col("filename")))
    return joined.select("pmcid", "filename", F.when(wrong, stop.cast("binary")).otherwise(F.col("content")).alias("content"))


def read_optional(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON rows of a file that may be absent."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).json(path, multiLine=True)


def read_compound_ids(spark: SparkSession, path: str) -> DataFrame:
    """:data:`COMPOUNDS` of an object from lower-case name to ``[id, name, inchikey, smiles]``."""
    if not exists(spark, path):
        return spark.createDataFrame([], COMPOUNDS)
    opened = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", "map<string,array<string>>")).alias("name", "v"))
    return opened.select("name", *[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(("molecule_id", "preferred_name", "inchikey", "smiles"))])


_SLOTS = ("activity_id", "molecule_id", "pref_name", "endpoint", "relation", "value", "units", "pchembl", "assay_id", "document_id", "year", "validity")


def read_database_files(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(activities, documents, assays)`` of per-target files with positional rows and dictionaries."""
    opened = spark.read.text(path, wholetext=True).select(
        F.from_json("value", "struct<target:string, rows:array<array<string>>, docs:map<string,array<string>>, assays:map<string,array<string>>>").alias("j")
    )
    kinds = dict(part.split(" ") for part in ACTIVITIES.split(", "))
    rows = opened.select("j.target", F.explode("j.rows").alias("r"))
    activities = rows.select("target", *[F.get("r", F.lit(i)).try_cast(kinds[c]).alias(c) for i, c in enumerate(_SLOTS)])
    pick = lambda names: [F.get("v", F.lit(i)).alias(c) for i, c in enumerate(names)]
    documents = opened.select(F.explode("j.docs").alias("document_id", "v")).select("document_id", *pick(("doi", "journal", "year", "title"))).distinct()
    assays = opened.select(F.explode("j.assays").alias("assay_id", "v")).select("assay_id", *pick(("description", "type"))).distinct()
    return activities, documents, assays


def read_target(spark: SparkSession, path: str, target: str) -> DataFrame:
    """Activities of one target of a release written by target; only its folder is read, an unknown target has no rows."""
    return spark.read.parquet(path).where(F.col("target") == target)


def documents_by_pmid(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """``pmid, document_id`` of the wanted pmids; a pmid may have several documents, null ones have none."""
    return documents.where(F.col("pmid").isNotNull()).select("pmid", "document_id").distinct().join(wanted.select("pmid").distinct(), "pmid")


def import_bundle(activities: DataFrame, key: str = "activity_id", group: str = "target", order: list[Column] | None = None) -> DataFrame:
    """Rows in nM with a value, the first of each activity and target.

    Without a stated order the content decides, so the choice does not hang on partitioning.
    """
    kept = activities.where((F.col("units") == "nM") & F.col("value").isNotNull())
    window = Window.partitionBy(group, key).orderBy(*(order or [F.col(c) for c in activities.columns]))
    return kept.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") == 1).drop("__rn")


def prune_dictionary(dictionary: DataFrame, used: DataFrame, key: str) -> DataFrame:
    """Dictionary rows that are referred to."""
    return dictionary.join(used.select(key).distinct(), key, "left_semi")


def read_gzip_dictionary(spark: SparkSession, path: str, wanted: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows of a tab-separated file, gzipped or not, whose key is wanted; columns are found by header."""
    whole = spark.read.csv(path, sep="\t", header=True)
    return whole.select(key, *columns).join(wanted.select(key).distinct(), key, "left_semi")


def read_model_output(spark: SparkSession, path: str) -> DataFrame:
    """``pmcid, table_id, kind`` and :data:`MODEL_VALUES` of an object keyed by ``article|table``."""
    kind = f"map<string,struct<kind:string, values:array<struct<{_ddl(MODEL_VALUES)}>>>>"
    opened = spark.read.text(path, wholetext=True).select(F.from_json("value", f"struct<tables:{kind}>")["tables"].alias("t"))
    tables = opened.select(F.explode("t").alias("k", "v"))
    place = F.split("k", r"\|", 2)
    return tables.select(F.get(place, F.lit(0)).alias("pmcid"), F.get(place, F.lit(1)).alias("table_id"), "v.kind", F.explode("v.values").alias("x")).select("pmcid", "table_id", "kind", "x.*")


def not_done(wanted: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """What an interrupted run has still to do."""
    return wanted.join(done.select(*keys).distinct(), keys, "left_anti")


def schema_of(ddl: str) -> T.StructType:
    """A schema from its text."""
    return T.StructType.fromDDL(ddl)
