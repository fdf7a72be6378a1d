"""Tables for machine learning: selection, projection, splits, statistics."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assayweave.functions import scalars
from assayweave.operators import enrich

# Fixed names and order: the columns of the paper release.
PAPER_COLUMNS = (
    "smiles inchikey scaffold split target uniprot target_name endpoint relation value_nm p_value reported_value reported_unit compound_label structure_method "
    "pmcid doi year table_id row_index source_url source_sha256 review record_id"
).split()
PAPER_SOURCE = "pmcid doi pub_year table_id row_index compound_label target_key measurement_type relation raw_value unit normalized_value_nm review_status".split()
DATABASE_SOURCE = "molecule_id pref_name endpoint relation value_num units normalized_value_nm target_key document_id doi pub_year validity".split()
DATABASE_COLUMNS = "activity_id molecule_id pref_name endpoint relation value_num units value_nm p_value target_key document_id doi pub_year split".split()


def structures_by_source(records: DataFrame, structures: DataFrame, fallback: DataFrame, keys: list[str], field: str) -> DataFrame:
    """``records`` with ``field`` and ``method``: of the verified structures, else of the fallback."""
    first = structures.select(*keys, F.col(field).alias("__first"))
    second = fallback.select(*keys, F.col(field).alias("__second"))
    joined = records.join(first, keys, "left").join(second, keys, "left")
    return joined.select(
        *records.columns, F.coalesce("__first", "__second").alias(field), F.when(F.col("__first").isNotNull(), "verified").when(F.col("__second").isNotNull(), "named").alias("method")
    )


def paper_release(records: DataFrame, targets: DataFrame, structures: DataFrame, sources: DataFrame, family: list[str] | None = None, by: tuple[str, ...] = ("pmcid", "compound_label"), review: str = "ai_checked_transcription") -> DataFrame:
    """Reviewed records with a structure and a value, as the flat table :data:`PAPER_COLUMNS`.

    ``targets``: target_key, target_name, uniprot.  ``structures``: the columns ``by`` and
    smiles, inchikey, scaffold, structure_method, one row a compound.  ``sources``: pmcid,
    source_sha256, one row an article.  A record without structure or value has no row, one
    without target or source row has nulls there.  The split is that of the scaffold.
    """
    rows = records.where((F.col("review_status") == "reviewed") & F.col("normalized_value_nm").isNotNull())
    if family is not None:
        rows = rows.where(F.col("target_key").isin(*family))
    full = rows.join(structures, list(by)).join(targets, "target_key", "left").join(sources, "pmcid", "left")
    value = F.col("normalized_value_nm")
    return full.select(
        "smiles", "inchikey", "scaffold", scalars.scaffold_split(F.col("scaffold")).alias("split"), F.col("target_key").alias("target"), "uniprot", "target_name",
        F.col("measurement_type").alias("endpoint"), "relation", value.alias("value_nm"), scalars.p_value(value, F.col("relation")).alias("p_value"),
        F.col("raw_value").alias("reported_value"), F.col("unit").alias("reported_unit"), "compound_label", "structure_method", "pmcid", "doi",
        F.coalesce(F.col("pub_year").cast("string"), F.lit("")).alias("year"), "table_id", "row_index",
        F.concat(F.lit("https://pmc.ncbi.nlm.nih.gov/articles/"), "pmcid", F.lit("/")).alias("source_url"), "source_sha256", F.lit(review).alias("review"), F.col("id").alias("record_id"),
    ).select(*PAPER_COLUMNS)


def external_test(values: DataFrame, checked: DataFrame, tasks: DataFrame, structures: list[tuple[str, DataFrame]], keys: tuple[str, str] = ("pmcid", "compound_label")) -> tuple[DataFrame, DataFrame]:
    """``(rows, reasons)``: verified exact values with a structure, and how many were left out why.

    ``values``: value_id, target, endpoint, relation, value_nm, pmcid, compound_label.
    ``checked``: value_id, status, secondary_source.  ``tasks``: target, endpoint of the
    model.  ``structures``: (method, table of ``keys`` and smiles), best source first.  A
    value is counted under the first gate that stops it.
    """
    known = tasks.select("target", "endpoint").distinct().withColumn("__task", F.lit(True))
    joined = values.join(checked.select("value_id", "status", "secondary_source"), "value_id", "left").join(known, ["target", "endpoint"], "left")
    smiles, method = [], []
    for n, (name, side) in enumerate(structures):
        joined = joined.join(side.select(*keys, F.col("smiles").alias(f"__s{n}")), list(keys), "left")
        smiles.append(F.col(f"__s{n}"))
        method.append(F.when(F.col(f"__s{n}").isNotNull(), name))
    joined = joined.withColumn("smiles", F.coalesce(*smiles)).withColumn("structure_method", F.coalesce(*method))
    gates = [
        (~F.coalesce(F.col("status") == "verified", F.lit(False)), "not verified"), (F.coalesce("secondary_source", F.lit(False)), "review article"),
        (~F.coalesce(F.col("relation") == "=", F.lit(False)), "bound"), (F.col("__task").isNull(), "enzyme/endpoint not in model"), (F.col("smiles").isNull(), "no structure"),
    ]
    gated = joined.withColumn("reason", enrich.elimination_reason(gates))
    rows = gated.where(F.col("reason").isNull()).select("value_id", "target", "endpoint", "compound_label", "smiles", "structure_method", "value_nm", scalars.p_value(F.col("value_nm"), F.col("relation")).alias("p"), "pmcid")
    return rows, gated.where(F.col("reason").isNotNull()).groupBy("reason").agg(F.count("*").alias("n"))


def database_release(activities: DataFrame) -> DataFrame:
    """Comparable activities as a flat table with p-value and split by molecule."""
    rows = enrich.reference_filter(activities)
    out = rows.withColumn("value_nm", F.col("normalized_value_nm")).withColumn("relation", F.lit("=")).withColumn("p_value", scalars.p_value(F.col("value_nm"), F.lit("=")))
    return out.withColumn("split", scalars.molecule_split(F.col("molecule_id"))).select(*DATABASE_COLUMNS)


def standardized(df: DataFrame, column: str, function: Callable[[str], str | None], name: str) -> DataFrame:
    """``df`` with ``name``: a costly function of a column, run once for each distinct value."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(function)

    known = df.select(F.col(column).alias("__value")).where(F.col("__value").isNotNull()).distinct().withColumn(name, run("__value"))
    return df.join(known, F.col(column) == F.col("__value"), "left").drop("__value")


def release_stats(rows: DataFrame, split: str = "split") -> DataFrame:
    """``split, rows, molecules, targets, papers``, null split included."""
    return rows.groupBy(split).agg(
        F.count("*").alias("rows"), F.countDistinct("inchikey").alias("molecules"), F.countDistinct("target_key").alias("targets"), F.countDistinct("pmcid").alias("papers")
    )


def shared_molecules(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """``shared``: how many keys both tables have."""
    return a.select(key).where(F.col(key).isNotNull()).intersect(b.select(key)).agg(F.count("*").alias("shared"))


def standard_molecule(smiles: str) -> str | None:
    """Canonical SMILES of the neutral parent, where the chemistry toolkit is installed."""
    try:
        from rdkit import Chem
        from rdkit.Chem.MolStandardize import rdMolStandardize
    except ImportError as error:
        raise RuntimeError("rdkit is not installed") from error
    molecule = Chem.MolFromSmiles(smiles)
    if molecule is None:
        return None
    parent = rdMolStandardize.Uncharger().uncharge(rdMolStandardize.LargestFragmentChooser().choose(molecule))
    return Chem.MolToSmiles(parent)
