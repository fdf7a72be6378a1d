"""Header, caption and verification rules."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from assayweave.operators import classify, verification
from assayweave.operators.article_tables import locate

HEADERS = [
    ("hCA II Ki (nM)", "", "CA2"), ("CA II", "human isoforms", "CA2"), ("CA II", "bovine", None), ("bCA II", "human", None), ("hCA II/hCA IX", "", None),
    ("mTOR IC50", "", "MTOR"), ("GSK-3β (µM)", "", "GSK3B"), ("MAO-B", "human enzymes", "MAOB"), ("MAO-B", "rat", None), ("EGFR WT", "", "EGFR"), ("EGFR T790M", "", None),
    ("p-mTOR", "", None), ("HDAC1 (%)", "", None), ("MCF-7 mTOR", "", None), ("PI3Kα", "", "PI3KA"), ("PI3Kα H1047R", "", None), ("mTOR and JAK2", "", None), ("IC50", None, None),
]


def test_header_target(spark):
    df = spark.createDataFrame([(n, h, c) for n, (h, c, _) in enumerate(HEADERS)], "n int, header string, caption string")
    got = {r["n"]: r["target"] for r in classify.classify_columns(df).collect()}
    assert got == {n: t for n, (_, _, t) in enumerate(HEADERS)}


CAPTIONS = [
    ("Inhibition of mTOR by compounds", "MTOR"), ("mTOR inhibition and cell growth", None), ("mTOR and JAK2", None), ("Inhibition of BACE1", "BACE1"), ("", None), (None, None), ("rat mTOR", None),
    ("PARP1 trapping", None), ("PARP1" + " and so on" * 6 + " trapping", "PARP1"), ("PARP1/2", None), ("COX-2/LOX", "COX2"), ("MAO-B", None), ("human MAO-B", "MAOB"), ("EGFR T790M", None), ("EGFR", "EGFR"), ("hCA II human", None),
]


def test_caption_targets(spark):
    rows = spark.createDataFrame([(c, 1) for c, _ in CAPTIONS] * 2, "caption string, other int")
    got = {r["caption"]: r["target"] for r in classify.caption_targets(rows).collect()}
    assert got == {c: t for c, t in CAPTIONS if t}


LICENCES = [
    ("Distributed under the terms of the Creative Commons Attribution License (CC BY 4.0)", "open"), ("http://creativecommons.org/licenses/by/4.0/", "open"), ("This is an open CC BY licence.", "open"),
    ("CC BY-NC 4.0", "restricted"), ("cc by-nd", "restricted"), ("Creative Commons Attribution, noncommercial use", "restricted"), ("All rights reserved, understood?", "unknown"), ("CC0 1.0", "open"), ("", "unknown"), (None, "unknown"),
    ("https://creativecommons.org/publicdomain/zero/1.0/", "open"), ("CC BY-NC-ND", "restricted"),
]


def test_licence_class(spark):
    rows = spark.createDataFrame([(t,) for t, _ in LICENCES], "t string").select("t", classify.licence_class(F.col("t")).alias("c"), classify.licence_class(F.col("t"), False).alias("strict")).collect()
    assert {r["t"]: r["c"] for r in rows} == dict(LICENCES)
    assert {r["t"]: r["strict"] for r in rows}["CC0 1.0"] == "unknown"


def test_bare_endpoint(spark):
    rows = spark.createDataFrame([("IC50 (nM)",), ("X | IC50 (µM)a,b",), ("IC50 mTOR",), ("yield",)], "h string").select("h", classify.is_bare_endpoint(F.col("h")).alias("b")).collect()
    assert {r["h"]: r["b"] for r in rows} == {"IC50 (nM)": True, "X | IC50 (µM)a,b": True, "IC50 mTOR": False, "yield": False}


def test_resolve_targets(spark):
    asked = ["mtor", "P42345", " MTOR kinase", "sirtuin 1", "sirtuin", "no such thing", "butyryl-cholin", None]
    got = {r["q"]: (r["target"], r["fits"]) for r in classify.resolve_targets(spark.createDataFrame([(q, 1) for q in asked] * 2, "q string, o int"), "q").collect()}
    assert got == {"mtor": ("MTOR", 1), "P42345": ("MTOR", 1), " MTOR kinase": ("MTOR", 1), "sirtuin 1": ("SIRT1", 1), "sirtuin": (None, 3), "no such thing": (None, 0), "butyryl-cholin": ("BCHE", 1)}


def test_match_dimension_takes_single_hits(spark):
    rows = spark.createDataFrame([("ab",), ("a",), ("c",), (None,)], "t string")
    rules = spark.createDataFrame([("A", "a"), ("B", "b")], "k string, p string")
    assert {(r["t"], r["k"]) for r in classify.match_dimension(rows, "t", rules, "k", "p").collect()} == {("ab", None), ("a", "A"), ("c", None), (None, None)}
    with pytest.raises(ValueError):
        classify.match_dimension(rows, "t", rules, "k", "p", most=1)


GRID = [["Compound", "mTOR IC50 (nM)", "JAK2 IC50 (nM)"], ["1a", "12.1", ">100"], ["2b", ">100", ">100"]]


def located(spark, grid, heads, *asked):
    grids = spark.createDataFrame([("P", "T", grid, heads), ("P", "U", [["x"]], 1)], "pmcid string, table_id string, grid array<array<string>>, heads int")
    rows = spark.createDataFrame([("P", "T", *a) for a in asked] + [(None, "T", "1a", "1"), ("P", None, None, None)], "pmcid string, table_id string, compound_label string, value_text string")
    return {(r["compound_label"], r["value_text"]): r["headers"] for r in locate(rows, grids).collect()}


def test_locate(spark):
    asked = [("1a", "12.1"), ("2b", ">100"), ("3c", "1"), ("1 a", "12.1 *"), (None, "12.1"), ("", "")]
    assert located(spark, GRID, 1, *asked) == {("1a", "12.1"): ["mTOR IC50 (nM)"], ("2b", ">100"): ["mTOR IC50 (nM)", "JAK2 IC50 (nM)"], ("1 a", "12.1 *"): ["mTOR IC50 (nM)"]}
    assert located(spark, [["x", "1a"], ["mTOR", "12.1"]], 1, ("1a", "12.1")) == {("1a", "12.1"): ["mTOR x"]}
    assert located(spark, [], 1, ("1a", "12.1")) == {} and located(spark, [["a"], []], 3, ("a", "a")) == {}


def locate_by_hand(rows, heads, label, value):
    """The rule read cell by cell."""
    plain = lambda t: re.sub(r"[\s,*†‡§#]", "", t or "").replace("μ", "µ").replace("−", "-").replace("–", "-").lower()
    mark, wanted = plain(label), plain(value)
    number = re.match(r"[<>≤≥~]?-?\d+(?:\.\d+)?", wanted)
    shows = lambda c: plain(c) == wanted or bool(number and len(number[0]) > 1 and plain(c).startswith(number[0]))
    is_label = lambda c: plain(c) == mark or bool(mark and plain(c).startswith(mark + "(")) or (len(mark) > 3 and mark in plain(c))

    def over(j):
        seen = []
        for row in rows[:heads]:
            if j < len(row) and row[j] and row[j] not in seen:
                seen.append(row[j])
        return " ".join(seen)

    for row in rows[heads:]:
        at = [j for j, c in enumerate(row) if is_label(c)][:1]
        out = [over(j) for j, c in enumerate(row) if at and j != at[0] and shows(c)]
        if out:
            return out
    for head in rows[:heads]:
        out = [" ".join(x for x in (row[0], over(0)) if x) for j, c in enumerate(head) if is_label(c) for row in rows[heads:] if j < len(row) and shows(row[j])]
        if out:
            return out
    return []


def test_locate_against_the_plain_reading(spark):
    rng = random.Random(5)
    words, grids, asked, want = ["1a", "1a(S)", "cmpd 1a", "longname", "xlongnamey", "12", "12.1", "12.1 ± 3", ">12", "", "7", "IC50"], [], [], {}
    for n in range(40):
        grid, heads = [[rng.choice(words) for _ in range(rng.randint(1, 4))] for _ in range(rng.randint(1, 5))], rng.randint(1, 2)
        grids.append((f"P{n}", "T", grid, heads))
        for label in ("1a", "longname", "", None, "7"):
            for value in ("12.1", "12", "7", "", None):
                asked.append((f"P{n}", "T", label, value))
                want[f"P{n}", label, value] = locate_by_hand(grid, heads, label, value)
    found = locate(
        spark.createDataFrame(asked, "pmcid string, table_id string, compound_label string, value_text string"),
        spark.createDataFrame(grids, "pmcid string, table_id string, grid array<array<string>>, heads int"),
    )
    got = {(r["pmcid"], r["compound_label"], r["value_text"]): r["headers"] for r in found.collect()}
    assert got == {k: v for k, v in want.items() if v}


def test_verify_ladder(spark):
    values = [
        (1, "1a", "MTOR", "12.1", 12.1, "nM", 12.1, "text"), (2, "2b", "JAK2", ">100", 100.0, "nM", 100.0, "text"), (3, "1a", "JAK2", "12.1", 12.1, "nM", 12.1, "text"),
        (4, "9z", "MTOR", "1", 1.0, "nM", 1.0, "text"), (5, "1a", "MTOR", "12.1", 12.1, "M", 1e10, "text"), (6, "1a", "MTOR", "12.1", 12.1, "nM", 12.1, "image"), (7, "1a", "MTOR", "12.1", None, None, None, "text"),
    ]
    df = spark.createDataFrame([(v[0], "PMC1", "T1", *v[1:]) for v in values], "value_id int, pmcid string, table_id string, compound_label string, target_key string, value_text string, value double, unit string, value_nm double, kind string")
    grids = spark.createDataFrame([("PMC1", "T1", "Inhibition", GRID, 1)], "pmcid string, table_id string, caption string, grid array<array<string>>, heads int")
    got = {r["value_id"]: (r["status"], r["column_header"]) for r in verification.verify(df, grids).collect()}
    assert got == {
        1: ("verified", "mTOR IC50 (nM)"), 2: ("verified", "JAK2 IC50 (nM)"), 3: ("rejected", "mTOR IC50 (nM)"), 4: ("unlocated", None), 5: ("rejected", None), 6: ("image", None), 7: ("rejected", None),
    }
