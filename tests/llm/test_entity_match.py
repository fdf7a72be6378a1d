"""Matching of records with activities."""

from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayweave.llm import entity_match as em

RECORDS = "id string, pmcid string, doi string, pub_year int, compound_label string, target_key string, measurement_type string, raw_value string, unit string, value_num double, normalized_value_nm double, exported_at timestamp, note string"
ACTIVITIES = "activity_id long, molecule_id string, pref_name string, endpoint string, value_num double, units string, normalized_value_nm double, target_key string, assay_description string, document_id string, doi string, pub_year int, loaded_at timestamp"
T0 = dt.datetime(2024, 1, 1)


def rec(i, label, value, unit="nM", kind="Ki", target="X", doi="10.1234/a.1", pmcid="P1", when=T0):
    number = float(value) if value and value.replace(".", "").isdigit() else None
    return (i, pmcid, doi, 2020, label, target, kind, value, unit, number, None, when, "x")


def act(i, name, value, units="nM", kind="K_i", target="X", doi="doi:10.1234/A.1.", document="D1", molecule=None, year=2020):
    return (i, molecule or f"M{i}", name, kind, value, units, None, target, None, document, doi, year, T0)


def match(spark, records, activities, **kw):
    out = em.match_entities(spark.createDataFrame(records, RECORDS), spark.createDataFrame(activities, ACTIVITIES), **kw)
    return {(r["id"], r["activity_id"]): r["confidence"] for r in out.collect()}


def test_evidence(spark):
    records = [
        rec("exact", "Lokimaresertib (27)", "14.4"), rec("typo", "Kinininaccilib", "4.96", kind="IC50"), rec("code", "HGT-10001", "1.44"), rec("local", "compound 8f", "520"), rec("noname", "4d", "6860", kind="Kd"),
        rec("salt", "Keradaloparin", "23.1", target="Y"), rec("isomer", "(S)-Lemafanozolide", "138", target="Y"), rec("heavy", "Fomimafofenib", "5", target="Z"), rec("notype", "Bolinekexaban", "4830", kind=None, target="Z"),
        rec("disagree", "Karekinovaptine", "124", target="W"), rec("iso", "Nikemobozolide", "7", target="V"), rec("norow", None, None, target="V"),
    ]
    activities = [
        act(1, "LOKIMARESERTIB", 144.0), act(2, "KININACCICLIB".replace("KININ", "KINININ"), 4.96, kind="IC 50"), act(3, "HGT 10001", 0.0014, "uM"), act(4, "COMPOUND 8F", 0.52, "uM"), act(5, None, 6.86, "uM", kind="KD"),
        act(6, "KERADALOPARIN tartrate", 23.0, target="Y"), act(7, "LEMAFANOZOLIDE", 138.0, target="Y"), act(8, "Fomimafofenib-d3", 5.0, target="Z"), act(9, "BOLINEKEXABAN", 4.8, "10^-6 M", kind="ic50", target="Z"),
        act(10, "Karekinovaptine", 409.0, "nmol.L-1", target="W"), act(11, "ISONIKEMOBOZOLIDE", 7.0, target="V"),
        act(12, "Lokimaresertib", 14.4, doi="10.9999/other", document="D2"), act(13, "Lokimaresertib", 14.4, doi=None), act(14, "lokimaresertib", 14.4, kind="IC50"),
    ]
    got = match(spark, records, activities)
    assert set(got) == {("exact", 1), ("typo", 2), ("code", 3), ("local", 4), ("noname", 5), ("salt", 6), ("notype", 9), ("disagree", 10), ("exact", 13)}
    assert got["exact", 13] > got["exact", 1] and all(0 < c <= 1 for c in got.values())


def test_nameless_molecule_is_learned_from_one_value(spark):
    records = [rec("a", "1f", "3920"), rec("b", "1f", "3.81", kind="IC50"), rec("c", "2g", "77", kind="IC50")]
    activities = [act(1, None, 3920.0, molecule="M"), act(2, None, 11600.0, kind="IC50", molecule="M")]
    assert set(match(spark, records, activities)) == {("a", 1), ("b", 2)}


def test_superseded_rows_repeats_and_clashing_columns(spark):
    records = [rec("a", "Lokimaresertib", "1", when=T0), rec("a", "Othermabinib", "99", when=T0 + dt.timedelta(1)), rec("a", "Othermabinib", "99", when=T0 + dt.timedelta(1))]
    activities = [act(1, "OTHERMABINIB", 99.0)] * 2 + [act(2, "LOKIMARESERTIB", 1.0)]
    assert set(match(spark, records, activities)) == {("a", 1)}
    wide = spark.createDataFrame(records, RECORDS).withColumns({"pub": F.lit(1), "kind": F.lit("z"), "number": F.lit(2)})
    out = em.match_entities(wide, spark.createDataFrame(activities, ACTIVITIES))
    assert {(r["id"], r["activity_id"]) for r in out.collect()} == {("a", 1)}


def test_empty_tables_and_nulls(spark):
    assert match(spark, [], []) == {} and match(spark, [rec("a", "x", "1")], []) == {}
    nothing = (None,) * 13
    assert match(spark, [nothing, rec("b", "Lokimaresertib", "1", doi=None, pmcid=None)], [nothing, act(1, "Lokimaresertib", 1.0, doi=None, document=None)]) == {("b", 1): pytest.approx(0.9)}


def test_windows_find_what_all_pairs_find(spark):
    rng = random.Random(11)
    names = ["".join(rng.choice(["lo", "ki", "ma", "re", "fa", "ne", "bo"]) for _ in range(5)) + end for end in ("tinib", "mab", "statin") for _ in range(12)]
    records, activities = [], []
    for p in range(12):
        for n, name in enumerate(rng.sample(names, 10)):
            value = round(10 ** rng.uniform(0, 4), 2)
            records.append(rec(f"{p}-{n}", name, str(value), target=f"T{n % 3}", doi=f"10.1234/p.{p}", pmcid=f"P{p}", kind=rng.choice(["Ki", "IC50", None])))
            if rng.random() < 0.7:
                activities.append(act(len(activities) + 1, rng.choice([name.upper(), None]), value, target=f"T{n % 3}", doi=f"10.1234/p.{p}", document=f"D{p}", kind=records[-1][6] or "Ki"))
    found = match(spark, records, activities, window=40, block=45)
    own, theirs = em.entities(spark.createDataFrame(records, RECORDS), spark.createDataFrame(activities, ACTIVITIES))
    whole = em._stacked(own, theirs).toPandas()
    whole["__place"] = range(len(whole))
    every = em.compare_block(whole, window=len(whole))
    blocks = em.candidate_pairs(own, theirs, window=40, block=45).toPandas()
    assert set(zip(blocks.id, blocks.activity_id)) == set(zip(every.id, every.activity_id))
    assert len({a for _, a in found}) == len(found) and len(found) >= 0.9 * len(activities)


def greatest_total(edges):
    """The greatest total of a one-to-one choice of edges, by trying all."""
    if not edges:
        return 0
    (r, e, w), rest = edges[0], edges[1:]
    return max(greatest_total(rest), w + greatest_total([x for x in rest if x[0] != r and x[1] != e]))


def random_edges(rng, group, most):
    return [(f"{group}-{r}", group * 100 + e, round(rng.choice((0.5, 0.75, 0.9, rng.random())), 2)) for e in range(rng.randint(1, 5)) for r in rng.sample(range(5), rng.randint(1, most))]


@pytest.mark.parametrize("large", [em.LARGE, 0])
def test_one_to_one_assignment_is_optimal(spark, large):
    rng = random.Random(3)
    groups = [random_edges(rng, g, 3) for g in range(30 if large else 4)]
    df = spark.createDataFrame([x for g in groups for x in g], "id string, entity long, confidence double")
    got = [tuple(r) for r in em.one_to_one(df, large).select("id", "entity").collect()]
    assert len({i for i, _ in got}) == len({e for _, e in got}) == len(got)
    weight = {(i, e): w for g in groups for i, e, w in g}
    for g in groups:
        mine = sum(weight[x] for x in got if x[0].split("-")[0] == g[0][0].split("-")[0])
        slack = 0 if large else em.BID / em.STEPS * len({e for _, e, _ in g})
        assert greatest_total(g) - slack - 1e-9 <= mine <= greatest_total(g) + 1e-9


def test_assignment_of_many_random_components(spark):
    rng = random.Random(4)
    for g in range(300):
        edges = random_edges(rng, g, 4)
        pdf = pd.DataFrame(edges, columns=["id", "entity", "c"]).assign(w=lambda d: (d.c * 1000).round().astype(int))
        got = {tuple(x) for x in em.best_assignment(pdf).itertuples(index=False)}
        assert len({i for i, _ in got}) == len({e for _, e in got}) == len(got)
        assert sum(w for i, e, _, w in pdf.itertuples(index=False) if (i, e) in got) == greatest_total([(i, e, w) for i, e, _, w in pdf.itertuples(index=False)])


def test_members_and_entities_left_over_follow_their_record(spark):
    pairs = spark.createDataFrame([("a", 1, 0.9), ("a", 3, 0.8), ("a", 4, 0.7), ("b", 4, 0.6), ("b", 5, 0.95)], "id string, activity_id long, confidence double")
    members = spark.createDataFrame([(1, 1), (2, 1), (3, 3), (4, 4), (5, 5)], "activity_id long, entity long")
    got = {(r["id"], r["activity_id"]): r["confidence"] for r in em.assign(pairs, members).collect()}
    assert got == {("a", 1): 0.9, ("a", 2): 0.9, ("a", 3): 0.8, ("a", 4): 0.7, ("b", 5): 0.95}


def test_activities_of_one_measurement(spark):
    rows = [(1, "M", "p", "T", "ki", 10.0), (2, "M", "p", "T", "ki", 1000.0), (3, "M", "p", "T", "ki", 11.0), (4, None, "p", "T", "ki", 10.0), (5, "M", None, "T", "ki", 10.0), (6, "M", "p", "T", "ki", None)]
    df = spark.createDataFrame([(*r, None) for r in rows], "activity_id long, molecule string, pub string, target string, kind string, nm double, number double")
    assert {r["activity_id"]: r["entity"] for r in em.same_measurements(df).collect()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6}


def assigned(spark, edges):
    df = spark.createDataFrame(edges, "id string, activity_id long, confidence double")
    return em.assign(df, df.select("activity_id", F.col("activity_id").alias("entity")).distinct())


def test_ties_prefer_the_unclaimed_record(spark):
    assert {(r["id"], r["activity_id"]) for r in assigned(spark, [("a", 1, 0.9), ("a", 2, 0.8), ("b", 2, 0.8)]).collect()} == {("a", 1), ("b", 2)}
    assert assigned(spark, []).count() == 0


VALUES = [
    (10.0, 10.0, 10.0, 10.0, False, em.VALUE_EQUAL), (14.4, 1, 14.0, 1, False, em.VALUE_ROUNDED), (14.4, 1, 1440.0, 1, False, em.VALUE_SHIFTED), (14.4, 1, 14000.0, 1, False, em.VALUE_SHIFTED), (14.4, 1, 17.0, 1, False, em.VALUE_OTHER),
    (104.0, 1, 105.2, 1, True, em.VALUE_ROUNDED), (104.0, 1, 105.2, 1, False, em.VALUE_OTHER), (float("nan"), 14.4, 5.0, 14.4, False, em.VALUE_DIGITS), (float("nan"), 14.4, 5.0, 14000.0, False, em.VALUE_DIGITS),
    (float("nan"), 14.4, 5.0, 1400.0, False, em.VALUE_UNKNOWN), (float("nan"), float("nan"), 5.0, 5.0, False, em.VALUE_UNKNOWN), (5.0, 5.0, float("nan"), 7.0, False, em.VALUE_UNKNOWN),
]


def test_value_grades():
    for *values, expected in VALUES:
        assert em.value_grade(*values) == expected, values


def test_iso_prefixes():
    assert [em.iso_prefix(x) for x in ("isofenib", "siofenib", "iisofenib", "issofenib", "isoofenib", "sofenib", "osofenib", "nisofenib", "")] == [3, 3, 4, 4, 4, 0, 0, 0, 0]


def test_blocks_cover_the_order_evenly(spark):
    rows = spark.createDataFrame([(0, str(n), "same") for n in range(100)], "side int, key string, k string")
    out = em.neighbourhoods(rows, [F.col("k")], window=5, block=20).toPandas()
    assert out.groupby("__block").size().max() == 25 and set(out["__place"]) == set(range(100))


def test_name_keys_and_distance():
    assert em.name_keys("26b (Nibalibisertib)") == ("26b", ["nibalibisertib"]) and em.name_keys("(2i)") == ("2i", []) and em.name_keys("VAX-31689 (Fidafonazolide)") == (None, ["vax31689", "fidafonazolide"])
    assert em.name_keys(None) == (None, []) and em.name_keys("  ") == (None, [])
    assert em.name_key("x-d3") == "xd3" and em.name_key("fomimafofenib-d3") != em.name_key("fomimafofenib")
    assert em.spelling_distance("abcd", "abdc") == 1 and em.spelling_distance("abc", "abc") == 0 and em.spelling_distance("a" * 9, "b" * 9) == 4
