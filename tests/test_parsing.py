"""Parsing functions against the cases they were specified by, and a plain Python reading."""

from __future__ import annotations

import hashlib
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assayweave.functions import parsing, scalars
from assayweave.functions.textfold import fold, fold_text

CASES = [
    ("0.025 ± 0.002", "µM", 0.025, "=", 25.0, 0.002, []),
    (">100 000", "nM", 100000.0, ">", 100000.0, None, ["qualified_value"]),
    (">100 000", "nM", 100000.0, ">", 100000.0, None, ["qualified_value"]),
    ("NA", "µM", None, None, None, None, ["missing_value"]),
    (" n.d. ", "µM", None, None, None, None, ["missing_value"]),
    (None, "µM", None, None, None, None, ["missing_value"]),
    ("23", None, 23.0, "=", None, None, ["missing_unit"]),
    ("41.2 [85.8]", "µM", None, None, None, None, ["unparsed_value"]),
    ("2 µM", "nM", 2.0, "=", 2000.0, None, ["cell_unit_overrides_header"]),
    ("2–4", "nM", None, None, None, None, ["unparsed_value"]),
    ("-3", "nM", None, None, None, None, ["unparsed_value"]),
    ("4 or 9", "nM", None, None, None, None, ["unparsed_value"]),
    ("1e999", "nM", None, None, None, None, ["unparsed_value"]),
    ("≤12,300", "pM", 12300.0, "<=", 12.3, None, ["qualified_value"]),
    (".5", "nM", None, None, None, None, ["unparsed_value"]),
]


@pytest.fixture(scope="module")
def parsed(spark):
    df = spark.createDataFrame([(n, c[0], c[1]) for n, c in enumerate(CASES)], "n int, raw string, unit string")
    rows = df.select("n", parsing.parse_value(F.col("raw"), F.col("unit")).alias("p")).select("n", "p.*").collect()
    return {r["n"]: r for r in rows}


@pytest.mark.parametrize("n", range(len(CASES)))
def test_parse_value(parsed, n):
    _, _, value, relation, nm, uncertainty, flags = CASES[n]
    row = parsed[n]
    assert (row["value"], row["relation"], row["normalized_value_nm"], row["uncertainty"], row["flags"]) == (value, relation, nm, uncertainty, flags)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.decimals("0.0001", "99999", allow_nan=False, places=4), st.sampled_from(["pM", "nM", "µM", "mM", "M"])), min_size=1, max_size=20))
def test_conversion_is_exact(spark, items):
    df = spark.createDataFrame([(f"{v:f}", u) for v, u in items], "raw string, unit string")
    rows = df.select("raw", "unit", parsing.parse_value(F.col("raw"), F.col("unit"))["normalized_value_nm"].alias("nm")).collect()
    for row in rows:
        assert row["nm"] == float(Decimal(row["raw"]).scaleb(parsing.UNIT_POWERS[row["unit"]]))


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_units_and_kinds(spark):
    lit = F.lit
    assert one(spark, parsing.unit_in(lit("IC50 (μM) ± SEM"))) == "µM"
    assert one(spark, parsing.unit_in(lit("nM and µM"))) is None
    assert one(spark, parsing.measurement_kind(lit("K_{i} (nM)"))) == "Ki"
    assert one(spark, parsing.measurement_kind(lit("Ki and IC50"))) is None
    assert one(spark, parsing.measurement_kind(lit("IC500"))) is None
    assert [one(spark, parsing.repair_unit(lit(u))) for u in ("uM", "nm", " μM", "M", "ng/mL")] == ["µM", "nM", "µM", "M", None]


def test_names_and_labels(spark):
    lit = F.lit
    assert one(spark, parsing.name_candidates(lit("1 (Olaparib)"))) == ["olaparib"]
    assert one(spark, parsing.name_candidates(lit("Donepezil [4]"))) == ["donepezil"]
    assert one(spark, parsing.name_candidates(lit("5a"))) == []
    assert one(spark, parsing.name_candidates(lit(None).cast("string"))) == []
    assert one(spark, parsing.clean_label(lit("1a 2"))) == "1a"
    assert one(spark, parsing.figure_label(lit("compound 5a′ (x)"))) == "5a'"


def test_formulas(spark):
    match = lambda a, b: one(spark, parsing.formula_matches(F.lit(a), F.lit(b)))
    assert match("C21H24N4O2", "C21H25N4O2") and match("C10H8", "C10H8Na") and match("CH4", "CH3Na") and match("C2H6O", "C2H6O")
    assert not match("C10H8", "C9H8") and not match("C10H8", "H8")
    assert one(spark, parsing.formula_counts(F.lit("CH3CH2OH"))) == {"C": 2, "H": 6, "O": 1}
    assert one(spark, parsing.formula_mentions(F.lit("HRMS calcd for C21H25N4O2 365.2"))) == ["C21H25N4O2"]


def test_header_family_conflict(spark):
    check = lambda t, h: one(spark, parsing.header_family_conflict(F.lit(t), F.lit(h)))
    assert check("PARP1", "PARP2 IC50") and not check("PARP1", "PARP1/2") and not check("EGX", "anything") and not check("PARP1", "IC50")


def test_two_figures(spark):
    rows = spark.createDataFrame([(x,) for x in (125.0, 0.125, 2.35, 0.0, 1234.0)], "x double").select(scalars.two_figures(F.col("x")).alias("y")).collect()
    assert [round(r["y"], 10) for r in rows] == [float(f"{x:.2g}") for x in (125.0, 0.125, 2.35, 0.0, 1234.0)]


def test_hash_splits(spark):
    texts = [f"c1cc{n}" for n in range(60)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", scalars.hash_modulus(F.col("t"), 100).alias("m"), scalars.molecule_split(F.col("t")).alias("s")).collect()
    for row in rows:
        digest = int(hashlib.sha1(row["t"].encode()).hexdigest(), 16)
        assert row["m"] == digest % 100
        assert row["s"] == {0: "test", 1: "val"}.get(digest % 10, "train")


def test_guards(spark):
    lit = F.lit
    assert one(spark, scalars.sheet_safe(lit("=1+1"))) == "'=1+1"
    assert one(spark, scalars.sheet_safe(lit("="))) == "="
    assert one(spark, scalars.safe_url(lit("javascript:x"))) is None
    assert one(spark, scalars.safe_url(lit("https://a"))) == "https://a"
    assert one(spark, scalars.media_type(F.unhex(lit("89504E470D0A")))) == "image/png"
    assert one(spark, scalars.media_type(F.unhex(lit("00")))) is None


def test_fold_agrees_with_python(spark):
    texts = ["ＩＣ５０ （ｎＭ）", "nΜ", "1.7×10⁻⁹ M", "14­300", "a b", "", "plain", "10⁻¹⁰", "μM µM", "сoмpound"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", fold(F.col("t")).alias("f")).collect()
    assert all(row["f"] == fold_text(row["t"]) for row in rows)
    assert re.fullmatch(r"1\.7x10\^-9 m", fold_text("1.7×10⁻⁹ M"))
