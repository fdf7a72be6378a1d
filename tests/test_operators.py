"""Evaluation, enrichment, metrics, search and releases."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from assayweave.operators import enrich, evaluate, metrics, release, search

GOLD = "pmcid string, table_id string, compound_label string, measurement_type string, target string, value double, unit string, relation string"
BASE = ("PMC123", "T1", "1a", "Ki", "CA2", 1000.0, "nM", "=")
MISSING = "pmcid string, table_id string, compound_label string, measurement_type string, target string"


def score(spark, predictions, gold, missing=()):
    make = lambda rows, schema: spark.createDataFrame(list(rows), schema)
    scope = spark.createDataFrame([("PMC123", "T1")], "pmcid string, table_id string")
    return evaluate.evaluate(make(predictions, GOLD), make(gold, GOLD), scope, make(missing, MISSING)).first().asDict()


def change(**parts):
    names = ["pmcid", "table_id", "compound_label", "measurement_type", "target", "value", "unit", "relation"]
    return tuple(parts.get(n, v) for n, v in zip(names, BASE))


@pytest.mark.parametrize(
    ("predictions", "gold", "tp", "fp", "fn"),
    [
        ([BASE], [BASE], 1, 0, 0),
        ([change(value=1.0, unit="µM")], [BASE], 1, 0, 0),
        ([change(value=0.001, unit="mM")], [BASE], 1, 0, 0),
        ([change(value=1e-6, unit="M")], [BASE], 1, 0, 0),
        ([change(value=999.999999)], [BASE], 0, 1, 1),
        ([change(relation=">")], [BASE], 0, 1, 1),
        ([change(measurement_type="IC50")], [BASE], 0, 1, 1),
        ([BASE, BASE, BASE], [BASE], 1, 2, 0),
        ([BASE], [BASE, BASE], 1, 0, 1),
        ([], [BASE], 0, 0, 1),
        ([BASE, change(pmcid="PMC9", measurement_type="bad")], [BASE], 1, 0, 0),
    ],
)
def test_bag_evaluation(spark, predictions, gold, tp, fp, fn):
    got = score(spark, predictions, gold)
    assert (got["tp"], got["fp"], got["fn"]) == (tp, fp, fn)
    assert got["precision"] == (tp / (tp + fp) if tp + fp else 0.0) and got["recall"] == tp / (tp + fn)


def test_abstentions(spark):
    absent = ("PMC123", "T1", "2b", "Ki", "CA2")
    null = change(compound_label="2b", value=None, unit=None, relation=None)
    got = score(spark, [BASE, null, null, change(compound_label="9", value=None)], [BASE], [absent])
    assert (got["correct_abstentions"], got["duplicate_abstentions"], got["wrong_abstentions"], got["missed_abstentions"], got["fabricated"]) == (1, 1, 1, 0, 0)
    got = score(spark, [BASE, change(compound_label="2b", value=0.0)], [BASE], [absent])
    assert (got["fabricated"], got["missed_abstentions"]) == (1, 1) and evaluate.error_count(got) == 2


@pytest.mark.parametrize("bad", [{"value": float("nan")}, {"value": float("inf")}, {"unit": "pM"}, {"relation": "~"}, {"measurement_type": "Kd"}, {"compound_label": " "}, {"target": None}])
def test_malformed_rows_raise(spark, bad):
    with pytest.raises(ValueError):
        score(spark, [change(**bad)], [BASE])


def test_contradictory_or_empty_truth_raises(spark):
    with pytest.raises(ValueError):
        score(spark, [BASE], [BASE], [BASE[:5]])
    with pytest.raises(ValueError):
        score(spark, [BASE], [change(value=None)])


def test_bag_counts_invariant(spark):
    rng = random.Random(1)
    a = [(rng.choice("abc"), rng.choice([1, 2, None])) for _ in range(60)]
    b = [(rng.choice("abd"), rng.choice([1, 2, None])) for _ in range(50)]
    counts = evaluate.bag_counts(spark.createDataFrame(a, "k string, n int"), spark.createDataFrame(b, "k string, n int"), ["k", "n"])
    total = counts.agg(F.sum("tp"), F.sum("fp"), F.sum("fn")).first()
    both = sum((Counter(a) & Counter(b)).values())
    assert tuple(total) == (both, len(a) - both, len(b) - both)
    rest = evaluate.bag_residue(spark.createDataFrame(a, "k string, n int"), spark.createDataFrame(b, "k string, n int"), ["k", "n"])
    assert Counter(tuple(r) for r in rest.collect()) == Counter(a) - Counter(b)


def test_greedy_matching_follows_the_order(spark):
    own = spark.createDataFrame([("g", 1, 100.0), ("g", 2, 101.0), ("h", 1, 5.0), ("g", 3, None)], "g string, o int, value_nm double")
    gold = spark.createDataFrame([("g", 1, 101.5), ("g", 2, 100.0)], "g string, o int, value_nm double")
    got = {(r["g"], r["own"], r["other"]) for r in evaluate.greedy_matches(own, gold, ["g"], ["o"], ["o"]).collect()}
    assert got == {("g", 1, 1), ("g", 2, 2)}


def test_crosscheck(spark):
    records = spark.createDataFrame([(1, "a", 10.0), (2, "a", 50.0), (3, "b", 1.0), (4, "c", 10.1)], "id int, k string, normalized_value_nm double")
    theirs = spark.createDataFrame([("a", 10.0), ("a", 999.0), ("c", 10.0)], "k string, value_num double")
    got = {r["id"]: (r["candidates"], r["agrees"]) for r in enrich.crosscheck(records, theirs, ["k"]).collect()}
    assert got == {1: (2, True), 2: (2, False), 4: (1, True)}


def test_identities_take_the_first_known_name(spark):
    records = spark.createDataFrame([(1, "Foolaparib (Donepezil)"), (2, "5a"), (3, None)], "id int, compound_label string")
    known = spark.createDataFrame([("donepezil", "M1"), ("other", "M2")], "name string, molecule_id string")
    got = {r["id"]: r["molecule"] and r["molecule"]["molecule_id"] for r in enrich.attach_identities(records, known).collect()}
    assert got == {1: "M1", 2: None, 3: None}


def test_nearest_labels(spark):
    boxes = spark.createDataFrame([(1, 0, 0.0, 0.0, 10.0, 10.0), (1, 1, 0.0, 20.0, 10.0, 30.0)], "page int, box int, y0 double, x0 double, y1 double, x1 double")
    tokens = spark.createDataFrame([(1, "1a", 5.0, 12.0), (1, "1b", 25.0, 11.0), (1, "far", 5.0, 40.0)], "page int, label string, x double, y double")
    assert {(r["box"], r["label"]) for r in enrich.nearest_labels(boxes, tokens).collect()} == {(0, "1a"), (1, "1b")}


def test_name_segments_and_suffixes(spark):
    text = "The acid was refluxed. 4-(Amino)benzoic acid amide (5a) was obtained"
    row = spark.createDataFrame([(text, "5a")], "t string, l string").select(enrich.name_segments(F.col("t"), F.col("l")).alias("s")).first()
    assert row["s"] == "4-(Amino)benzoic acid amide"
    got = spark.range(1).select(enrich.suffixes(F.lit("one two threes")).alias("x")).first()["x"]
    assert got == ["one two threes", "two threes", "threes"]


def test_medians_and_histogram(spark):
    df = spark.createDataFrame([("a", v) for v in (8.0, 2.0, 4.0, 6.0)] + [("b", v) for v in (9.0, 1.0, 3.0)], "k string, v double")
    assert {r["k"]: r["m"] for r in metrics.upper_median_rows(df, ["k"], "v", "m").collect()} == {"a": 6.0, "b": 3.0}
    bins = spark.createDataFrame([(1e-9,), (1.0,), (1e9,)], "v double").select(metrics.log_bin(F.col("v")).alias("b")).collect()
    assert [r["b"] for r in bins] == [1, 7, 18]
    assert metrics.histogram(df, ["k"], "v").count() == 0


def test_commonest_breaks_ties_alphabetically(spark):
    df = spark.createDataFrame([("t", "b"), ("t", "a"), ("u", None)], "k string, v string")
    assert [(r["k"], r["v"], r["n"]) for r in metrics.commonest(df, ["k"], "v").collect()] == [("t", "a", 1)]


def rank(values):
    return [sum(w < v for w in values) + (sum(w == v for w in values) + 1) / 2 for v in values]


def test_group_spearman(spark):
    rng = random.Random(2)
    rows = [(g, rng.randint(0, 5) * 1.0, rng.randint(0, 5) * 1.0) for g, n in (("a", 9), ("b", 12), ("c", 3)) for _ in range(n)] + [("d", 1.0, float(i)) for i in range(6)]
    got = metrics.group_spearman(spark.createDataFrame(rows, "g string, y double, p double"), [], "g", "y", "p").first()
    total = weight = 0.0
    for g in "ab":
        a, b = (rank([r[i] for r in rows if r[0] == g]) for i in (1, 2))
        n, ma, mb = len(a), sum(a) / len(a), sum(b) / len(b)
        r = sum((x - ma) * (y - mb) for x, y in zip(a, b)) / math.sqrt(sum((x - ma) ** 2 for x in a) * sum((y - mb) ** 2 for y in b))
        total, weight = total + r * n, weight + n
    assert got["groups"] == 2 and got["rho"] == pytest.approx(total / weight)


def test_bootstrap_interval_holds_the_point(spark):
    rng = random.Random(4)
    df = spark.createDataFrame([(n, 0.0, rng.gauss(0, 1)) for n in range(300)], "id int, y double, p double")
    row = metrics.poisson_bootstrap(df, "id", "y", "p", replicates=80).first()
    assert row["low"] < row["rmse"] < row["high"] and row["high"] - row["low"] < 0.4
    assert tuple(metrics.poisson_bootstrap(df.repartition(5), "id", "y", "p", replicates=80).first()) == pytest.approx(tuple(row))


def test_running_average_depends_on_order(spark):
    df = spark.createDataFrame([("k", 1, 2.0), ("k", 2, 4.0), ("k", 3, 10.0), ("n", 1, None)], "k string, o int, v double")
    assert [tuple(r) for r in metrics.running_average(df, ["k"], "v", ["o"]).collect()] == [("k", 6.5)]


def test_nearest_neighbours_exact(spark):
    rng = random.Random(7)
    rows = [(n, n % 2, [rng.gauss(0, 1) for _ in range(6)]) for n in range(60)] + [(99, 0, [0.0] * 6)]
    df = spark.createDataFrame(rows, "id long, g int, v array<double>")
    got = {r["id"]: (r["neighbour"], r["similarity"]) for r in metrics.nearest_neighbours(df, df, "id", "v", "g", block=7).collect()}
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    for i, g, v in rows[:-1]:
        best = max(((cosine(v, w), -j) for j, h, w in rows[:-1] if h == g and j != i))
        assert got[i][0] == -best[1] and got[i][1] == pytest.approx(best[0])
    assert 99 not in got


def test_jaccard(spark):
    row = spark.range(1).select(metrics.jaccard_words(F.array(F.lit(0b1110), F.lit(1)), F.array(F.lit(0b0110), F.lit(0))).alias("j")).first()
    assert row["j"] == 0.5


RECORD = "id string, pmcid string, doi string, pub_year int, table_id string, row_index int, target_column int, compound_label string, target_key string, measurement_type string, raw_value string, relation string, unit string, value_num double, normalized_value_nm double, flags array<string>"


@pytest.fixture(scope="module")
def records(spark):
    row = lambda n, label, value, relation="=", flags=(): (f"r{n}", "PMC1", "10.1/x", 2020, "T1", 0, 1, label, "X", "Ki", str(value), relation, "nM", value, value, list(flags))
    return spark.createDataFrame([row(1, "Drug A", 10.0), row(2, "Drug A", 5.0, flags=["missing_assay_context"]), row(3, "b", 1.0, ">"), row(4, "c", 2.0, flags=["unparsed_value"]), row(5, "d", None)], RECORD)


def test_search(records):
    rows = search.paper_rows(records)
    got = search.search_measurements(rows, exact_only=True, limit=0).collect()
    assert [(r["id"], r["matches"]) for r in got] == [("r2", 2)]
    assert [r["id"] for r in search.search_measurements(rows, compound="DRUG", limit=500).collect()] == ["r2", "r1"]
    assert [r["id"] for r in search.search_measurements(rows, max_nm=2.0).collect()] == ["r3", "r4"]
    assert search.potency_summary(rows, ["target"]).first()["n"] == 2
    with pytest.raises(ValueError):
        search.pool(rows, rows, "web", None)


def test_evidence_marks_the_cell(spark, records):
    tables = spark.createDataFrame([("PMC1", "T1", ["h", "Ki"], [["1a", "10", "x"]])], "pmcid string, table_id string, headers array<string>, rows array<array<string>>")
    cells = search.get_evidence(records, tables, "r1").first()["cells"]
    assert [(c["header"], c["text"], c["extracted"]) for c in cells] == [("h", "1a", False), ("Ki", "10", True), ("col2", "x", False)]
    assert search.get_evidence(records, tables, "nope").count() == 0


def test_filters_and_order(records):
    assert [r["id"] for r in search.ordered(records, "normalized_value_nm", descending=True).collect()] == ["r1", "r2", "r4", "r3", "r5"]
    assert {r["id"] for r in search.filter_records(records, "drug").collect()} == {"r1", "r2"}
    assert {r["id"] for r in search.filter_records(records, flagged=True).collect()} == {"r2", "r4"}


def test_releases(spark):
    kinds = "id string, pmcid string, compound_label string, target_key string, review_status string, normalized_value_nm double, relation string, doi string, pub_year int, table_id string, row_index int, measurement_type string, raw_value string, unit string"
    row = lambda i, label, status, nm, relation: (i, "P1", label, "A", status, nm, relation, "d", None, "T", 3, "Ki", "10", "nM")
    rows = [row("r1", "x", "reviewed", 10.0, "="), row("r2", "x", "unreviewed", 10.0, "="), row("r3", "y", "reviewed", 10.0, "="), row("r4", "x", "reviewed", None, "="), row("r5", "x", "reviewed", 10.0, ">")]
    structures = spark.createDataFrame([("P1", "x", "CC", "K", "S", "named")], "pmcid string, compound_label string, smiles string, inchikey string, scaffold string, structure_method string")
    targets = spark.createDataFrame([("A", "An enzyme", "U1")], "target_key string, target_name string, uniprot string")
    sources = spark.createDataFrame([("P1", "hash")], "pmcid string, source_sha256 string")
    out = release.paper_release(spark.createDataFrame(rows, kinds), targets, structures, sources)
    assert out.columns == list(release.PAPER_COLUMNS) and len(out.columns) == 24
    got = {r["record_id"]: r for r in out.collect()}
    assert set(got) == {"r1", "r5"} and got["r1"]["p_value"] == 8.0 and got["r5"]["p_value"] is None
    assert (got["r1"]["year"], got["r1"]["source_sha256"], got["r1"]["target_name"], got["r1"]["smiles"]) == ("", "hash", "An enzyme", "CC")
    assert release.paper_release(spark.createDataFrame(rows, kinds), targets, structures, sources, ["B"]).count() == 0


def test_costly_functions_run_on_distinct_values(spark):
    calls = release.standardized(spark.createDataFrame([("a",), ("a",), (None,)], "s string"), "s", str.upper, "u")
    assert sorted(str(r["u"]) for r in calls.collect()) == ["A", "A", "None"]


def test_external_test_counts_the_first_gate(spark):
    values = [(1, "A", "Ki", "=", 10.0, "P", "x"), (2, "A", "Ki", "=", 10.0, "P", "x"), (3, "A", "Ki", ">", 10.0, "P", "x"), (4, "B", "Ki", "=", 10.0, "P", "x"), (5, "A", "Ki", "=", 10.0, "P", "y"), (6, "A", "Ki", "=", 10.0, None, None), (7, "A", "Ki", "=", 10.0, "P", "x"), (8, "A", "Ki", "=", 100.0, "P", "z")]
    checked = [(1, "verified", False), (2, "image", False), (3, "verified", False), (4, "verified", False), (5, "verified", None), (6, "verified", False), (7, "verified", True), (8, "verified", False)]
    v = spark.createDataFrame(values, "value_id int, target string, endpoint string, relation string, value_nm double, pmcid string, compound_label string")
    c = spark.createDataFrame(checked, "value_id int, status string, secondary_source boolean")
    side = lambda *rows: spark.createDataFrame(list(rows), "pmcid string, compound_label string, smiles string")
    rows, reasons = release.external_test(v, c, spark.createDataFrame([("A", "Ki")], "target string, endpoint string"), [("first", side(("P", "x", "C"))), ("second", side(("P", "x", "N"), ("P", "z", "O")))])
    assert {(r["value_id"], r["smiles"], r["structure_method"], r["p"]) for r in rows.collect()} == {(1, "C", "first", 8.0), (8, "O", "second", 7.0)}
    assert {r["reason"]: r["n"] for r in reasons.collect()} == {"not verified": 1, "review article": 1, "bound": 1, "enzyme/endpoint not in model": 1, "no structure": 2}


def test_newest_takes_the_latest_row_of_each_key(spark):
    rows = [("a", 1, "x"), ("a", 2, "y"), ("a", 2, "y"), ("b", None, "z"), ("b", 1, "w"), (None, 1, "p"), (None, 2, "q"), ("c", None, "r"), ("c", None, "s"), ("d", 5, None), ("e", 1, "u"), ("e", 1, "t")]
    df = spark.createDataFrame(rows, "k string, v int, x string")
    assert sorted(map(str, enrich.newest(df, "k", "v").collect())) == sorted(map(str, spark.createDataFrame([("a", 2, "y"), ("b", 1, "w"), (None, 2, "q"), ("c", None, "s"), ("d", 5, None), ("e", 1, "u")], df.schema).collect()))
    assert {tuple(r) for r in enrich.newest(df, "k", "v", ["x", "k"]).collect()} == {("a", "y"), ("b", "w"), (None, "q"), ("c", "s"), ("d", None), ("e", "u")}
    assert {tuple(r) for r in enrich.newest(df, "k", "v", ["v"]).collect()} == {("a", 2), ("b", 1), (None, 2), ("c", None), ("d", 5), ("e", 1)}
    assert enrich.newest(df.limit(0), "k", "v").count() == 0


def test_newest_of_two_columns_reads_and_sorts_no_more(spark, tmp_path):
    spark.range(50).selectExpr("cast(id % 9 as string) k", "timestamp_seconds(id) v", "'x' a", "'y' b").write.parquet(str(tmp_path / "t"))
    plan = enrich.newest(spark.read.parquet(str(tmp_path / "t")), "k", "v", ["k", "v"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "ReadSchema: struct<k:string,v:timestamp>" in plan


def test_reviews(spark):
    records = spark.createDataFrame([("1", "P", ["missing_assay_context"], "unreviewed"), ("2", "P", ["qualified_value"], "unreviewed"), ("3", "Q", None, "reviewed"), ("4", "R", [], "unreviewed")], "id string, pmcid string, flags array<string>, review_status string")
    log = spark.createDataFrame([("1", "reviewed", "me", None, "read"), ("2", "reviewed", "me", "d", "read"), ("9", "reviewed", "me", "d", "read")], "id string, status string, reviewer string, date string, method string")
    done = enrich.apply_reviews(records, log)
    got = {r["id"]: (r["review_status"], r["review_provenance"] and r["review_provenance"]["date"]) for r in done.collect()}
    assert got == {"1": ("reviewed", "Not recorded"), "2": ("unreviewed", None), "3": ("reviewed", None), "4": ("unreviewed", None)}
    assert {r["id"] for r in enrich.reviewed_view(done).collect()} == {"1", "3"}
    articles = spark.createDataFrame([("P",), ("Q",), ("R",)], "pmcid string")
    assert {r["pmcid"] for r in enrich.of_reviewed(articles, done).collect()} == {"P", "Q"}


def test_a_doi_may_have_many_documents(spark):
    documents = spark.createDataFrame([("10.1/A", "D1"), ("10.1/a", "D2"), ("10.2/b", "D3"), (None, "D4")], "doi string, document_id string")
    rows = spark.createDataFrame([(1, "10.1/a"), (2, "10.9/z"), (3, None)], "n int, doi string")
    assert {(r["n"], r["document_id"]) for r in enrich.documents_of(rows, documents).collect()} == {(1, "D1"), (1, "D2")}


def greedy_by_hand(own, gold):
    free, out = list(enumerate(gold, 1)), set()
    for n, v in enumerate(own, 1):
        at = next((i for i, (_, w) in enumerate(free) if abs(v - w) <= 0.02 * max(abs(w), 1e-12) or float(f"{v:.2g}") == float(f"{w:.2g}")), None)
        if at is not None:
            out.add((n, free.pop(at)[0]))
    return out


def test_greedy_matching_against_brute_force(spark):
    rng = random.Random(8)
    draw = lambda: rng.choice([1.0, 1.05, 1.04, 1.1, 2.0, 2.03, 2.5, 2.45, 10.0, 10.2, 9.96, 100.0, 1e-7, 3e9]) * rng.choice((1.0, 1.0, 1.019, 0.981))
    groups = {f"g{n}": ([draw() for _ in range(rng.randint(0, 25))], [draw() for _ in range(rng.randint(0, 25))]) for n in range(20)}
    frame = lambda side: spark.createDataFrame([(g, n, v) for g, both in groups.items() for n, v in enumerate(both[side])], "g string, o int, value_nm double")
    got = {(r["g"], r["own"], r["other"]) for r in evaluate.greedy_matches(frame(0), frame(1), ["g"], ["o"], ["o"]).collect()}
    assert got == {(g, *pair) for g, (a, b) in groups.items() for pair in greedy_by_hand(a, b)}


def test_reachable(spark):
    gold = spark.createDataFrame([(1, "P", 100.0), (2, "P", 103.0), (3, "P", 7.04), (4, "Q", 100.0), (5, None, 1.0), (6, "P", None), (7, "P", 0.0), (8, "P", 99.0)], "id int, pmcid string, value_nm double")
    numbers = spark.createDataFrame([("P", 101.0), ("P", 7.0), ("P", 0.0), ("Z", 100.0)], "pmcid string, n double")
    got = {r["id"]: r["reachable"] for r in evaluate.reachable_share(gold, numbers).collect()}
    assert got == {1: True, 2: True, 3: True, 4: False, 5: False, 6: False, 7: True, 8: True}


def test_windows_of_every_mention(spark):
    text = "IC50 é " + "x" * 50 + "IC50IC50 end"
    df = spark.createDataFrame([(1, text), (2, "none"), (3, None), (4, "IC50")], "k int, t string")
    got = df.select("k", F.explode(enrich.mention_windows(F.col("t"), "IC50")).alias("m")).select("k", "m.at", "m.around").collect()
    assert sorted((r["k"], r["at"]) for r in got) == [(1, 1), (1, 58), (1, 62), (4, 1)]
    # as many characters as asked on both sides of the mention, fewer at the ends of the text
    assert all(r["around"] == text[max(0, r["at"] - 41) : r["at"] + 43] for r in got if r["k"] == 1)


def test_bootstrap_query_takes_as_many_replicates_as_the_reference(monkeypatch):
    from assayweave.plans import queries_measure

    taken = {}
    monkeypatch.setattr(queries_measure, "_predictions", lambda spark, folder: None)
    monkeypatch.setattr(metrics, "poisson_bootstrap", lambda *args, **options: taken.update(options))
    queries_measure.q_bootstrap(None, "")
    assert taken["replicates"] == 1000


def test_content_id_of_all_records_and_columns(spark, tmp_path):
    from assayweave.plans import queries_measure

    def of(rows, name):
        spark.createDataFrame(rows, "id long, a string, b double").write.parquet(str(tmp_path / name / "records.parquet"))
        return queries_measure.q_content_id(spark, str(tmp_path / name)).first()["dataset_id"]

    rows = [(n, None if n % 3 else str(n), n / 7) for n in range(50)]
    first = of(rows, "first")
    assert len(first) == 16 and of(rows[::-1], "turned") == first
    assert len({first, of([(*rows[0][:2], 1.0), *rows[1:]], "changed"), of(rows + rows[:1], "copied"), of(rows[1:], "fewer")}) == 4


def test_name_segments_of_every_mention(spark):
    text = "First line.\nThe reaction gave 4-aminobenzoic acid (5a) in part; then 2-chloro\nphenol ester (compound 5a) was used; x (5a)"
    df = spark.createDataFrame([(text, "5a"), ("none here", "5a"), (None, "5a")], "t string, l string")
    got = [r["s"] for r in df.select(enrich.all_name_segments(F.col("t"), F.col("l")).alias("s")).collect()]
    assert got == [["4-aminobenzoic acid", "then 2-chloro\nphenol ester"], [], None]


def test_percentiles_against_brute_force(spark):
    rng = random.Random(6)
    groups = {g: [rng.choice([0.0, -1.5, 7.0, 1e-300, -1e300, rng.gauss(0, 1) * 10 ** rng.randint(-6, 6)]) for _ in range(n)] for g, n in (("a", 1), ("b", 2), ("c", 57), (None, 10), ("hot", 500))}
    groups["inf"] = [float("inf"), 1.0, float("-inf"), 2.0, 3.0]
    rows = [(g, v) for g, values in groups.items() for v in values] + [("a", None), ("c", float("nan")), ("none", None)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r["k"]: (r["n"], r["p10"], r["p50"]) for r in metrics.percentiles(df, ["k"], "v", {"p10": 0.1, "p50": 0.5}).collect()}
    assert set(got) == set(groups)
    for g, values in groups.items():
        if g == "inf":
            assert got[g][2] == 2.0
            continue
        ordered = sorted(values)
        for share, mine in ((0.1, got[g][1]), (0.5, got[g][2])):
            at = (len(ordered) - 1) * share
            low, high = ordered[int(at)], ordered[min(len(ordered) - 1, int(at) + (at != int(at)))]
            assert mine == pytest.approx(low + (high - low) * (at - int(at)), rel=1e-12, abs=1e-300)
        assert got[g][0] == len(values)
    medians = {r["k"]: r["m"] for r in metrics.upper_median_rows(df, ["k"], "v", "m").collect()}
    assert medians == {g: sorted(v)[len(v) // 2] for g, v in groups.items()}


def test_neighbours_with_text_keys_and_blocks(spark):
    rng = random.Random(9)
    rows = [(f"k{n}", [rng.random() for _ in range(3)], "g" if n < 50 else "h") for n in range(60)] + [("zero", [0.0, 0.0, 0.0], "g"), ("null", None, "g"), ("alone", [1.0, 0.0, 0.0], "i"), ("nogroup", [1.0, 0.0, 0.0], None)]
    df = spark.createDataFrame(rows, "id string, v array<double>, g string")
    got = {r["id"]: r["neighbour"] for r in metrics.nearest_neighbours(df, df, "id", "v", "g", block=9).collect()}
    cosine = lambda a, b: round(sum(x * y for x, y in zip(a, b)) / (sum(x * x for x in a) * sum(x * x for x in b)) ** 0.5, 12)
    real = [r for r in rows[:60]]
    want = {i: min((-cosine(v, w), j) for j, w, h in real if h == g and j != i)[1] for i, v, g in real}
    assert got == want


def test_bootstrap_of_rank_correlations_against_brute_force(spark):
    rng = random.Random(12)
    rows = [(n, f"g{n % 4}", float(rng.randint(0, 6)), float(rng.randint(0, 6))) for n in range(40)] + [(99, None, 1.0, 2.0), (98, "g1", None, 1.0)]
    df = spark.createDataFrame(rows, "k int, g string, y double, p double")
    weights = {}
    for r in metrics.resampled(df.select("k"), "k", 30).collect():
        weights.setdefault(r["rep"], {})[r["k"]] = r["w"]

    def ranks(values):
        ordered = sorted(values)
        return [ordered.index(v) + (ordered.count(v) + 1) / 2 for v in values]

    found = []
    for drawn in weights.values():
        total = size = 0
        for g in ("g0", "g1", "g2", "g3"):
            pairs = [(y, p) for k, h, y, p in rows if h == g and y is not None for _ in range(drawn.get(k, 0))]
            if len(pairs) < 5 or len({y for y, _ in pairs}) < 2 or len({p for _, p in pairs}) < 2:
                continue
            a, b = ranks([y for y, _ in pairs]), ranks([p for _, p in pairs])
            m, n = sum(a) / len(a), sum(b) / len(b)
            r = sum((x - m) * (z - n) for x, z in zip(a, b)) / (sum((x - m) ** 2 for x in a) * sum((z - n) ** 2 for z in b)) ** 0.5
            total, size = total + r * len(pairs), size + len(pairs)
        found.append(total / size)
    found.sort()
    at = lambda share: found[int((len(found) - 1) * share)] + (found[min(len(found) - 1, int((len(found) - 1) * share) + 1)] - found[int((len(found) - 1) * share)]) * ((len(found) - 1) * share % 1)
    got = metrics.spearman_bootstrap(df, "k", ["g"], "y", "p", replicates=30).first()
    assert (got["low"], got["high"]) == (pytest.approx(at(0.025)), pytest.approx(at(0.975)))
