"""Readers, writers, the paged source, streaming and the entry module."""

from __future__ import annotations

import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from assayweave.sources import paged_api, readers, writers
from assayweave.streaming import ingest


def write(path, value):
    path.write_text(value if isinstance(value, str) else json.dumps(value))
    return str(path)


def test_manifest_and_files(spark, tmp_path):
    (tmp_path / "src").mkdir()
    (tmp_path / "src/a.xml").write_text("<article/>")
    entry = {"pmcid": "PMC1", "filename": "a.xml", "sha256": hashlib.sha256(b"<article/>").hexdigest()}
    for n, shape in enumerate(([entry], {"articles": [entry]})):
        manifest = readers.read_manifest(spark, write(tmp_path / f"m{n}.json", shape))
        assert [r["pmcid"] for r in manifest.collect()] == ["PMC1"]
        assert bytes(readers.read_article_files(spark, str(tmp_path / "src"), manifest).first()["content"]) == b"<article/>"
    with pytest.raises(ValueError):
        readers.read_manifest(spark, write(tmp_path / "d.json", [entry, entry]))
    bad = readers.read_manifest(spark, write(tmp_path / "b.json", [{**entry, "sha256": "0"}]))
    with pytest.raises(Exception, match="changed source file"):
        readers.read_article_files(spark, str(tmp_path / "src"), bad).collect()
    up = readers.read_manifest(spark, write(tmp_path / "u.json", [{**entry, "filename": "../a.xml"}]))
    with pytest.raises(ValueError):
        readers.read_article_files(spark, str(tmp_path / "src"), up)


def test_database_files(spark, tmp_path):
    data = {"target": "X", "rows": [[1, "M", None, "Ki", "=", 5.0, "nM", 8.3, "A1", "D1", 2020, None], [1, "M", None, "Ki", "=", 6.0, "nM", 8.2, "A1", "D1", 2020, None], [2, "M", None, "Ki", "=", 6.0, "µM", None, "A1", "D2", 0, None]],
            "docs": {"D1": ["10.1/x", "J", "2020", "T"], "D9": ["", "", "", ""]}, "assays": {"A1": ["desc", "B"]}}
    activities, documents, assays = readers.read_database_files(spark, write(tmp_path / "x.json", data))
    kept = readers.import_bundle(activities, order=[F.col("value")])
    assert [(r["activity_id"], r["value"], r["year"]) for r in kept.collect()] == [(1, 5.0, 2020)]
    assert [r["document_id"] for r in readers.prune_dictionary(documents, kept, "document_id").collect()] == ["D1"]
    assert assays.first()["description"] == "desc"


def test_optional_and_nested(spark, tmp_path):
    assert readers.read_optional(spark, str(tmp_path / "none.json"), readers.REVIEWS).count() == 0
    assert readers.read_compound_ids(spark, str(tmp_path / "none.json")).count() == 0
    ids = readers.read_compound_ids(spark, write(tmp_path / "ids.json", {"aaz": ["C1", "AAZ", "K", "S"]}))
    assert tuple(ids.first()) == ("aaz", "C1", "AAZ", "K", "S")
    model = {"tables": {"PMC1|T|2": {"kind": "text", "values": [{"compound_label": "1a", "value": 2.0}]}}}
    row = readers.read_model_output(spark, write(tmp_path / "llm.json", model)).first()
    assert (row["pmcid"], row["table_id"], row["compound_label"], row["value"]) == ("PMC1", "T|2", "1a", 2.0)
    with gzip.open(tmp_path / "d.tsv.gz", "wt") as out:
        out.write("id\tsmiles\tx\nA\tCC\t1\nB\tCN\t2\n")
    wanted = spark.createDataFrame([("B",)], "id string")
    assert [tuple(r) for r in readers.read_gzip_dictionary(spark, str(tmp_path / "d.tsv.gz"), wanted, "id", ["smiles"]).collect()] == [("B", "CN")]


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "=cmd", ["a", "b"], 'x "y", z', "<"), (2, None, [], "", "=")], "id int, t string, f array<string>, q string, r string")
    columns = ["id", "t", "f", "q", "r"]
    writers.write_csv(df, str(tmp_path / "out"), columns)
    rows = spark.read.csv(str(tmp_path / "out"), header=True, escape='"').orderBy("id").collect()
    assert (rows[0]["t"], rows[0]["f"], rows[0]["q"], rows[0]["r"], rows[1]["r"]) == ("'=cmd", "a;b", 'x "y", z', "<", "=")
    text = writers.csv_text(df, columns, ["id"])
    assert text.startswith("﻿id,t,f,q,r\r\n1,'=cmd,a;b,")
    with pytest.raises(ValueError):
        writers.csv_text(df, columns, ["id"], most=1)


def test_release_snapshot_and_card(spark, tmp_path):
    df = spark.createDataFrame([("PMC1", "T1", "CC0", 1), ("PMC2", "T1", "CC BY", 2)], "pmcid string, table_id string, licence string, n int")
    writers.write_release(df, str(tmp_path / "rel"), by="licence")
    assert spark.read.parquet(str(tmp_path / "rel")).count() == 2 and (tmp_path / "rel/licence=CC0").exists()
    writers.write_snapshot(df.limit(1), df.select("pmcid"), df.select("pmcid", "table_id"), str(tmp_path / "snap"))
    assert spark.read.json(str(tmp_path / "snap/articles")).count() == 1
    assert "| CC0 | 1 |" in writers.data_card(df, "t", ["licence"])
    assert writers.upsert(df, df.withColumn("n", F.lit(9)), "pmcid").count() == 2
    articles = spark.createDataFrame([("PMC1", [str(n) for n in range(9)]), ("PMC2", ["a"])], "pmcid string, authors array<string>")
    assert [r["credit"] for r in writers.attribution(articles, df.where("n = 2"), most=8).collect()] == ["0, 1, 2, 3, 4, 5, 6, 7 et al."]


def test_paged_source(spark):
    calls = []

    def get(url):
        calls.append(url)
        if len(calls) == 1:
            raise ConnectionError
        return json.dumps({"results": [len(calls)], "next": "c2" if url.endswith("=") else None}).encode()

    assert list(paged_api.pages("u?i={ids}&c={cursor}", "1,2", "results", "next", get=get, wait=0)) == [2, 3]
    with pytest.raises(ConnectionError):
        paged_api.fetch("u", tries=2, wait=0, get=lambda _: (_ for _ in ()).throw(ConnectionError()))
    reader = paged_api._Reader({"url": "u", "ids": "1,2,3", "batch": "2"})
    assert [p.ids for p in reader.partitions()] == ["1,2", "3"]


def test_streaming_ingest(spark, tmp_path):
    text = '<article><front><article-meta><article-id pub-id-type="pmc">1</article-id></article-meta></front><body><table-wrap id="T1"><caption>x</caption><table><thead><tr><th>Compound</th><th>mTOR IC50 (nM)</th></tr></thead><tbody><tr><td>1a</td><td>5</td></tr></tbody></table></table-wrap></body></article>'
    rows = spark.createDataFrame([("PMC1", text)], "pmcid string, xml_text string").withColumn("fetched_at", F.current_timestamp())
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):  # the second run finds nothing new
        ingest.ingest(ingest.stream_articles(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert [r["value"] for r in spark.read.parquet(str(tmp_path / "out/records")).collect()] == [5.0]


def test_entry_lists_queries():
    import __spark_entry__ as entry

    queries, twins = entry.queries(), entry.oracle_sql()
    assert set(twins) <= set(queries) and len(queries) > 70


def test_data_card_adds_up_to_all_rows(spark):
    df = spark.createDataFrame([(str(n % 7),) for n in range(30)], "k string")
    card = writers.data_card(df, "t", ["k"], most=3)
    assert "| 0 | 5 |" in card and "| 4 others | 16 |" in card and "others" not in writers.data_card(df, "t", ["k"], most=7)


def test_release_is_read_by_target(spark, tmp_path):
    df = spark.createDataFrame([("A", 1), ("B", 2), ("A", 3)], "target string, activity_id long")
    writers.write_release(df, str(tmp_path / "r"), by="target")
    one = readers.read_target(spark, str(tmp_path / "r"), "A")
    assert {r["activity_id"] for r in one.collect()} == {1, 3} and "PartitionFilters: [isnotnull(target" in one._jdf.queryExecution().executedPlan().toString()
    assert readers.read_target(spark, str(tmp_path / "r"), "Z").count() == 0


def test_pmid_dictionary(spark):
    documents = spark.createDataFrame([(1, "D1"), (1, "D2"), (2, "D3"), (None, "D4")], "pmid int, document_id string")
    wanted = spark.createDataFrame([(1,), (1,), (9,), (None,)], "pmid int")
    assert {tuple(r) for r in readers.documents_by_pmid(documents, wanted).collect()} == {(1, "D1"), (1, "D2")}


def test_articles_are_admitted_by_gates(spark):
    from assayweave.operators import article_scan
    from assayweave.operators.registry import RULES
    from assayweave.streaming import ingest

    def text(n, licence, value="5"):
        rows = f"<tr><td>a1</td><td>{value}</td></tr>"
        return (
            f'<article><front><article-meta><article-id pub-id-type="pmc">{n}</article-id><permissions><license><p>{licence}</p></license></permissions></article-meta></front>'
            f'<body><table-wrap id="T"><table><thead><tr><th>drug</th><th>JAK2 IC50 (nM)</th></tr></thead><tbody>{rows}</tbody></table></table-wrap></body></article>'
        )

    rows = [("PMC1", text(1, "CC BY 4.0")), ("PMC2", text(2, "CC BY-NC")), ("PMC3", text(3, "CC BY", "n.d.")), ("PMC4", "<a"), ("PMC5", text(5, "CC BY")), ("PMC6", text(6, "CC0"))]
    scanned = article_scan.scan_articles(spark.createDataFrame(rows, "pmcid string, xml_text string"))
    rules = tuple(r for r in RULES if r.key == "JAK2")
    admitted, reasons = ingest.admit(scanned, spark.createDataFrame([("PMC5",)], "pmcid string"), rules)
    assert [(r["pmcid"], r["clean"]) for r in admitted.collect()] == [("PMC1", 1)]
    assert {r["reason"]: r["n"] for r in reasons.collect()} == {"have": 1, "err": 1, "no_clean": 1, "license": 2}


def test_snapshot_stores_contexts_once_an_article(spark, tmp_path):
    records = spark.createDataFrame([("P", "T", ["m"], 1), ("P", "T", ["m"], 2), ("Q", "U", None, 3)], "pmcid string, table_id string, assay_context array<string>, id int")
    articles = spark.createDataFrame([("P", "a"), ("Q", "b"), ("R", "c")], "pmcid string, title string")
    writers.write_snapshot(records, articles, spark.createDataFrame([("P", "T"), ("P", "X")], "pmcid string, table_id string"), str(tmp_path / "s"))
    assert {(r["pmcid"], tuple(r["assay_context"])) for r in spark.read.json(str(tmp_path / "s/articles")).collect()} == {("P", ("m",)), ("Q", ())}
    assert "assay_context" not in spark.read.json(str(tmp_path / "s/records")).columns and spark.read.json(str(tmp_path / "s/tables")).count() == 1


def test_cached_fetch_is_verified(tmp_path):
    body, path = b"one", str(tmp_path / "a.xml")
    mark = hashlib.sha256(body).hexdigest()
    calls = []

    def get(answer):
        return lambda url: calls.append(url) or answer

    assert paged_api.cached_fetch("u", path, mark, get=get(body)) == body and paged_api.cached_fetch("u", path, mark, get=get(b"two")) == body and len(calls) == 1
    with pytest.raises(ValueError):
        paged_api.cached_fetch("u", path, hashlib.sha256(b"else").hexdigest(), get=get(b"two"))
    assert paged_api.cached_fetch("u", path, get=get(b"two")) == body and len(calls) == 2
    assert paged_api.cached_fetch("v", str(tmp_path / "b"), get=get(b"two")) == b"two"


def test_commands(spark, tmp_path, monkeypatch):
    from assayweave import __main__ as commands

    monkeypatch.setattr(commands, "build_session", lambda: spark)
    spark.createDataFrame([("P", "T", "reviewed"), ("Q", "U", "unreviewed")], "pmcid string, table_id string, review_status string").write.parquet(str(tmp_path / "r"))
    spark.createDataFrame([("P",), ("Q",)], "pmcid string").write.parquet(str(tmp_path / "a"))
    spark.createDataFrame([("P", "T"), ("Q", "U")], "pmcid string, table_id string").write.parquet(str(tmp_path / "t"))
    assert commands.main(["site", *(str(tmp_path / x) for x in "rat"), str(tmp_path / "s")]) == 0
    assert [r["pmcid"] for r in spark.read.json(str(tmp_path / "s/articles")).collect()] == ["P"]
    entry = {"pmcid": "PMC1", "filename": "a.xml", "sha256": hashlib.sha256(b"x").hexdigest()}
    monkeypatch.setattr(paged_api, "fetch", lambda url, **how: b"x" if url == "http://h/PMC1" else b"")
    assert commands.main(["fetch", write(tmp_path / "m.json", [entry]), "http://h/{pmcid}", str(tmp_path)]) == 0 and (tmp_path / "a.xml").read_bytes() == b"x"
    assert commands.main([]) == 2
