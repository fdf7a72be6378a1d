"""Queries of the search surface, filters, orders and set operations, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayweave.functions import parsing, scalars
from assayweave.operators import classify, enrich, evaluate, metrics, search
from assayweave.sources import writers
from assayweave.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}

#: CTE of the latest row of each record and of each activity.
LATEST = (
    "r0 AS (SELECT * FROM records QUALIFY row_number() OVER (PARTITION BY id ORDER BY exported_at DESC NULLS LAST) = 1), "
    "a0 AS (SELECT * FROM chembl_activity QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY loaded_at DESC NULLS LAST) = 1)"
)


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


def records_of(spark: SparkSession, folder: str, columns: str = "") -> DataFrame:
    """Latest row of each record: its id and the named columns."""
    return enrich.newest(table(spark, folder, "records"), "id", "exported_at", ["id", *columns.split()])


def activities_of(spark: SparkSession, folder: str, columns: str = "") -> DataFrame:
    """Latest row of each activity: its id and the named columns."""
    return enrich.newest(table(spark, folder, "chembl_activity"), "activity_id", "loaded_at", ["activity_id", *columns.split()])


#: What :func:`search.paper_rows` and :func:`search.database_rows` read.
PAPER = "pmcid doi pub_year table_id row_index compound_label target_key measurement_type relation normalized_value_nm raw_value unit flags"
DATABASE = "molecule_id pref_name endpoint relation value_num units normalized_value_nm target_key document_id doi pub_year validity"


def _rows(spark: SparkSession, folder: str) -> DataFrame:
    return search.paper_rows(records_of(spark, folder, PAPER)).unionByName(search.database_rows(activities_of(spark, folder, DATABASE)))


_POOL = (
    "p AS (SELECT id, 'paper' AS source, compound_label AS compound, NULL AS molecule_id, target_key AS target, measurement_type AS endpoint, relation, normalized_value_nm AS value_nm, "
    "len(list_filter(coalesce(flags, []), lambda f: f NOT IN ('missing_assay_context', 'target_from_caption'))) AS n_flags FROM r0 "
    "UNION ALL SELECT 'db:' || activity_id, 'database', coalesce(pref_name, molecule_id), molecule_id, target_key, endpoint, replace(coalesce(relation, '='), '''', ''), normalized_value_nm, "
    "CASE WHEN validity IS NULL THEN 0 ELSE 1 END FROM a0)"
)


@query(
    f"WITH {LATEST}, {_POOL}, e AS (SELECT * FROM p WHERE source = 'paper' AND endpoint IS NOT NULL AND value_nm > 0 AND relation = '=' AND n_flags = 0), "
    "t AS (SELECT *, row_number() OVER (PARTITION BY target, endpoint ORDER BY value_nm, id) rn FROM e) "
    "SELECT target, endpoint, count(*) AS n, round(quantile_cont(value_nm, 0.1), 6) AS p10, round(quantile_cont(value_nm, 0.5), 6) AS p50, round(quantile_cont(value_nm, 0.9), 6) AS p90, "
    "string_agg(CASE WHEN rn <= 10 THEN id END, ';' ORDER BY rn) AS top FROM t GROUP BY target, endpoint"
)
def q_potency_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Percentiles and the most potent rows by target and endpoint."""
    rows = search.paper_rows(records_of(spark, folder, PAPER)).where(F.col("endpoint").isNotNull())
    out = search.potency_summary(rows, ["target", "endpoint"])
    return out.select("target", "endpoint", "n", *[F.round(c, 6).alias(c) for c in ("p10", "p50", "p90")], F.array_join("top", ";").alias("top"))


@query(
    f"WITH {LATEST}, {_POOL}, f AS (SELECT * FROM p WHERE target = 'CAX2' AND endpoint IN ('Ki') AND value_nm <= 5000 AND relation = '=' AND n_flags = 0) "
    "SELECT id, source, compound, value_nm, (SELECT count(*) FROM f) AS matches FROM f ORDER BY value_nm, id LIMIT 100"
)
def q_search(spark: SparkSession, folder: str) -> DataFrame:
    """A search of both sources, its limit clamped to 100."""
    rows = search.pool(search.paper_rows(records_of(spark, folder, PAPER)), search.database_rows(activities_of(spark, folder, DATABASE)), "both", "CAX2")
    return search.search_measurements(rows, endpoint="Ki", max_nm=5000, exact_only=True, limit=1000).select("id", "source", "compound", "value_nm", "matches")


@query(
    f"WITH {LATEST} SELECT * FROM (SELECT count(*) AS paper_values, count(DISTINCT pmcid) AS papers, count(DISTINCT target_key) AS targets_with_paper_values, "
    "count(*) FILTER (normalized_value_nm IS NOT NULL AND relation = '=') AS exact_values FROM r0), (SELECT count(*) AS database_values, count(DISTINCT molecule_id) AS database_molecules FROM a0)"
)
def q_dataset_info(spark: SparkSession, folder: str) -> DataFrame:
    """Global counts (Q1, A2, A3)."""
    return search.dataset_info(records_of(spark, folder, "pmcid target_key normalized_value_nm relation"), activities_of(spark, folder, "molecule_id"))


@query(
    f"WITH {LATEST}, a AS (SELECT target_key, count(*) n, count(DISTINCT pmcid) p FROM r0 GROUP BY 1), b AS (SELECT target_key, count(*) n FROM a0 GROUP BY 1) "
    "SELECT t.target_key, target_name, coalesce(a.n, 0) AS paper_values, coalesce(a.p, 0) AS papers, coalesce(b.n, 0) AS database_values "
    "FROM targets t LEFT JOIN a USING (target_key) LEFT JOIN b USING (target_key)"
)
def q_list_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Targets with their counts (Q2, Q12, A1)."""
    out = search.list_targets(table(spark, folder, "targets"), records_of(spark, folder, "target_key pmcid"), activities_of(spark, folder, "target_key"))
    return out.select("target_key", "target_name", "paper_values", "papers", "database_values")


@query("SELECT target_key FROM targets WHERE target_key IN (SELECT target_key FROM records UNION SELECT target_key FROM chembl_activity)")
def q_visible_targets(spark: SparkSession, folder: str) -> DataFrame:
    """Targets that have rows."""
    return search.visible_targets(table(spark, folder, "targets"), table(spark, folder, "records"), table(spark, folder, "chembl_activity")).select("target_key")


@query(
    f"WITH {LATEST}, {_POOL}, h AS (SELECT *, row_number() OVER (PARTITION BY target, source ORDER BY coalesce(value_nm, 0), id) rn, relation = '=' AND n_flags = 0 AND value_nm IS NOT NULL AS exact FROM p "
    "WHERE (source = 'paper' AND contains(lower(coalesce(compound, '')), 'compound 1l')) OR (source <> 'paper' AND (lower(compound) = 'compound 1l' OR lower(molecule_id) = 'compound 1l'))) "
    "SELECT target, count(*) FILTER (source = 'paper') AS paper_values, count(*) FILTER (source <> 'paper') AS database_values, "
    "list_sort(list(value_nm) FILTER (source = 'paper' AND exact))[CAST(floor(count(*) FILTER (source = 'paper' AND exact) / 2) AS int) + 1] AS paper_median, "
    "list_sort(list(value_nm) FILTER (source <> 'paper' AND exact))[CAST(floor(count(*) FILTER (source <> 'paper' AND exact) / 2) AS int) + 1] AS database_median, "
    "string_agg(CASE WHEN rn <= 5 THEN id END, ';' ORDER BY source, rn) AS examples FROM h GROUP BY target"
)
def q_compound_profile(spark: SparkSession, folder: str) -> DataFrame:
    """Profile of one compound by target."""
    out = search.compound_profile(_rows(spark, folder), "compound 1l")
    return out.withColumn("examples", F.array_join("examples", ";"))


@query(
    "WITH r0 AS (SELECT *, 1 AS one FROM records QUALIFY row_number() OVER (PARTITION BY id ORDER BY exported_at DESC NULLS LAST) = 1), "
    "b AS (SELECT target_key, measurement_type, greatest(1, least(18, CAST(floor((log10(normalized_value_nm) + 3) / 0.5) AS int) + 1)) AS bin FROM r0 WHERE normalized_value_nm > 0 AND measurement_type IS NOT NULL) "
    "SELECT target_key, measurement_type, bin, n FROM (SELECT *, sum(n) OVER (PARTITION BY target_key, measurement_type) AS total FROM (SELECT target_key, measurement_type, bin, count(*) AS n FROM b GROUP BY 1, 2, 3)) WHERE total >= 5"
)
def q_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Half-decade histogram by target and type."""
    rows = records_of(spark, folder, "target_key measurement_type normalized_value_nm").where(F.col("measurement_type").isNotNull())
    return metrics.histogram(rows, ["target_key", "measurement_type"], "normalized_value_nm")


@query(
    f"WITH {LATEST} SELECT target_key, measurement_type, n FROM (SELECT *, row_number() OVER (PARTITION BY target_key ORDER BY n DESC, measurement_type) rn "
    "FROM (SELECT target_key, measurement_type, count(*) AS n FROM r0 WHERE measurement_type IS NOT NULL GROUP BY 1, 2)) WHERE rn = 1"
)
def q_commonest_endpoint(spark: SparkSession, folder: str) -> DataFrame:
    """Most frequent type of each target, ties alphabetical."""
    return metrics.commonest(records_of(spark, folder, "target_key measurement_type"), ["target_key"], "measurement_type")


@query(
    f"WITH {LATEST} SELECT id FROM r0 WHERE contains(lower(concat_ws(' ', compound_label, pmcid, target_key, coalesce(measurement_type, 'None'))), 'none') OR (len(flags) > 0 AND contains(lower(concat_ws(' ', compound_label, pmcid, target_key, coalesce(measurement_type, 'None'))), 'ki'))"
)
def q_filter_records(spark: SparkSession, folder: str) -> DataFrame:
    """Text filter, in which a missing type reads None, and flagged ones."""
    rows = records_of(spark, folder, "compound_label pmcid target_key measurement_type flags")
    return search.filter_records(rows, "none").select("id").union(search.filter_records(rows, "ki", flagged=True).select("id")).distinct()


@query(f"WITH {LATEST} SELECT id, uncertainty FROM r0 ORDER BY uncertainty DESC NULLS LAST, id LIMIT 500")
def q_ordered(spark: SparkSession, folder: str) -> DataFrame:
    """First 500 rows by a column, nulls last (O2)."""
    return search.ordered(records_of(spark, folder, "uncertainty"), "uncertainty", descending=True).select("id", "uncertainty")


@query(f"WITH {LATEST} SELECT id, exported_at FROM r0")
def q_latest(spark: SparkSession, folder: str) -> DataFrame:
    """Latest row of each id."""
    return records_of(spark, folder, "exported_at").select("id", "exported_at")


@query(f"WITH {LATEST} SELECT id, count(*) OVER (PARTITION BY pmcid, target_key, compound_label, measurement_type, raw_value, unit) > 1 AS repeated, "
       "coalesce(min(table_id) OVER w <> max(table_id) OVER w, false) AS several FROM r0 WINDOW w AS (PARTITION BY pmcid, target_key, compound_label, measurement_type)")
def q_group_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Repeated measurements and multiple reports within an article."""
    rows = records_of(spark, folder, "pmcid target_key compound_label measurement_type raw_value unit table_id")
    keys = ["pmcid", "target_key", "compound_label", "measurement_type"]
    return rows.select("id", enrich.repeated(rows, [*keys, "raw_value", "unit"]).alias("repeated"), enrich.multiple_reports(rows, keys, "table_id").alias("several"))


@query("SELECT status, coalesce(reason, '') AS reason, count(*) AS n, count(DISTINCT pmcid) AS papers FROM verify_scale GROUP BY ALL")
def q_status_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Counts by status and reason (A1, A2)."""
    rows = table(spark, folder, "verify_scale")
    return rows.groupBy("status", F.coalesce("reason", F.lit("")).alias("reason")).agg(F.count("*").alias("n"), F.countDistinct("pmcid").alias("papers"))


@query("SELECT column_header, count(*) AS n FROM verify_scale WHERE column_header IS NOT NULL GROUP BY 1 ORDER BY n DESC, column_header LIMIT 8")
def q_top_headers(spark: SparkSession, folder: str) -> DataFrame:
    """Eight most frequent headers."""
    rows = table(spark, folder, "verify_scale").where(F.col("column_header").isNotNull())
    return rows.groupBy("column_header").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "column_header").limit(8)


@query(
    f"WITH {LATEST}, f AS (SELECT pmcid, unnest(coalesce(flags, [])) AS flag FROM r0), g AS (SELECT pmcid, list_sort(list(DISTINCT flag))[1:5] AS fl FROM f GROUP BY 1), "
    "x AS (SELECT pmcid, string_agg(id, ';' ORDER BY id) ex FROM (SELECT pmcid, id, row_number() OVER (PARTITION BY pmcid ORDER BY id) rn FROM r0) WHERE rn <= 3 GROUP BY 1) "
    "SELECT c.pmcid, c.ok, coalesce(array_to_string(g.fl, ';'), '') AS flags, x.ex AS examples FROM (SELECT pmcid, count(*) FILTER (review_status = 'reviewed') AS ok FROM r0 GROUP BY 1) c LEFT JOIN g USING (pmcid) LEFT JOIN x USING (pmcid)"
)
def q_group_dump(spark: SparkSession, folder: str) -> DataFrame:
    """Per article: reviewed rows, first five flags, three examples."""
    rows = records_of(spark, folder, "pmcid flags review_status")
    flags = F.array_sort(F.flatten(F.collect_set(F.coalesce("flags", F.array().cast("array<string>")))))
    base = rows.groupBy("pmcid").agg(F.count_if(F.col("review_status") == "reviewed").alias("ok"), F.array_join(F.slice(F.array_distinct(flags), 1, 5), ";").alias("flags"))
    shown = enrich.top_per_group(rows.select("pmcid", "id"), ["pmcid"], [F.col("id")], 3).groupBy("pmcid").agg(F.array_join(F.array_sort(F.collect_list("id")), ";").alias("examples"))
    return base.join(shown, "pmcid")


@query("SELECT document_id, count(*) AS n FROM chembl_activity GROUP BY 1 ORDER BY n DESC, document_id LIMIT 20")
def q_top_documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with most values."""
    return table(spark, folder, "chembl_activity").groupBy("document_id").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "document_id").limit(20)


@query(
    "SELECT target_key, pmcid, n FROM (SELECT *, row_number() OVER (PARTITION BY target_key ORDER BY n DESC, pmcid) rn FROM (SELECT target_key, pmcid, count(*) AS n FROM llm_extract WHERE target_key IS NOT NULL AND pmcid IS NOT NULL GROUP BY 1, 2)) WHERE rn <= 3"
)
def q_quota(spark: SparkSession, folder: str) -> DataFrame:
    """Three papers for each target, those with most values."""
    rows = table(spark, folder, "llm_extract").where(F.col("target_key").isNotNull() & F.col("pmcid").isNotNull())
    return enrich.top_per_group(rows.groupBy("target_key", "pmcid").agg(F.count("*").alias("n")), ["target_key"], [F.col("n").desc(), F.col("pmcid")], 3)


@query("SELECT target_key, 'records' AS source, count(*) AS n FROM records GROUP BY 1 UNION ALL SELECT target_key, 'llm_extract', count(*) FROM llm_extract GROUP BY 1")
def q_union_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of two sources side by side."""
    a = table(spark, folder, "records").select("target_key", F.lit("records").alias("source"))
    b = table(spark, folder, "llm_extract").select("target_key", F.lit("llm_extract").alias("source"))
    return evaluate.method_pool(a, b, "hybrid").groupBy("target_key", "source").agg(F.count("*").alias("n"))


@query("SELECT pmcid FROM articles WHERE pmcid IS NOT NULL EXCEPT SELECT pmcid FROM records")
def q_id_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Articles without records."""
    wanted = table(spark, folder, "articles").select("pmcid").where(F.col("pmcid").isNotNull()).distinct()
    return enrich.without_known(wanted, table(spark, folder, "records"), "pmcid")


@query("SELECT id FROM records INTERSECT SELECT id FROM records_mirror")
def q_id_intersection(spark: SparkSession, folder: str) -> DataFrame:
    """Ids in both copies."""
    return table(spark, folder, "records").select("id").intersect(table(spark, folder, "records_mirror").select("id"))


@query("SELECT pmcid, table_id, compound_label, raw_value FROM records EXCEPT ALL SELECT pmcid, table_id, compound_label, raw_value FROM records_mirror")
def q_bag_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Multiset difference of the copies."""
    columns = ["pmcid", "table_id", "compound_label", "raw_value"]
    return table(spark, folder, "records").select(*columns).exceptAll(table(spark, folder, "records_mirror").select(*columns))


@query(f"WITH {LATEST} SELECT id, array_to_string(list_filter(coalesce(flags, []), lambda f: f NOT IN ('missing_assay_context', 'target_from_caption')), ';') AS blocking FROM r0")
def q_flag_algebra(spark: SparkSession, folder: str) -> DataFrame:
    """Flags that block."""
    info = F.array(*map(F.lit, enrich.INFO_FLAGS))
    return records_of(spark, folder, "flags").select("id", F.array_join(F.array_except(F.coalesce("flags", F.array().cast("array<string>")), info), ";").alias("blocking"))


@query(
    "WITH k AS (SELECT DISTINCT lower(doi) d FROM records WHERE doi IS NOT NULL) SELECT activity_id FROM (SELECT DISTINCT activity_id, doi FROM chembl_activity) WHERE doi IS NULL OR lower(doi) NOT IN (SELECT d FROM k)"
)
def q_without_papers(spark: SparkSession, folder: str) -> DataFrame:
    """Activities outside the papers, null doi kept."""
    known = table(spark, folder, "records").select(F.lower("doi").alias("d")).where(F.col("d").isNotNull())
    rows = table(spark, folder, "chembl_activity").select("activity_id", F.lower("doi").alias("d")).distinct()
    return enrich.without_known(rows, known, "d").select("activity_id").distinct()


@query(
    f"WITH {LATEST}, a AS (SELECT pmcid, arg_max(title, (fetched_at, title)) AS title FROM articles GROUP BY 1) SELECT r0.id, t.target_name, coalesce(a.title, '') AS title FROM r0 LEFT JOIN targets t USING (target_key) LEFT JOIN a USING (pmcid)"
)
def q_dictionary_joins(spark: SparkSession, folder: str) -> DataFrame:
    """Records with target and article fields."""
    titles = table(spark, folder, "articles").groupBy("pmcid").agg(F.max(F.struct("fetched_at", "title")).alias("a"))
    rows = records_of(spark, folder, "pmcid target_key").join(table(spark, folder, "targets"), "target_key", "left").join(titles, "pmcid", "left")
    return rows.select("id", "target_name", F.coalesce("a.title", F.lit("")).alias("title"))


_GUARD = r"CASE WHEN regexp_matches({0}, '^\s*[=+\-@\t\r]') AND {0} NOT IN ('=', '<', '>', '<=', '>=', '~') THEN '''' || {0} ELSE {0} END AS {0}"


@query(f"WITH {LATEST} SELECT id, {_GUARD.format('compound_label')}, {_GUARD.format('relation')}, array_to_string(flags, ';') AS flags, CAST(row_index AS varchar) AS row_index, {_GUARD.format('raw_value')} FROM r0")
def q_sheet_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Spreadsheet-safe export rows."""
    return writers.sheet_columns(records_of(spark, folder, "compound_label relation flags row_index raw_value"), ["id", "compound_label", "relation", "flags", "row_index", "raw_value"])


_SAYS = lambda words: " OR ".join(f"contains(lower(license), '{w}')" for w in words)


@query(
    f"SELECT pmcid, CASE WHEN {_SAYS(('by-nc', 'by-nd', 'noncommercial', 'non-commercial', 'no derivatives'))} THEN 'restricted' "
    f"WHEN {_SAYS(('licenses/by/', 'cc by', 'cc-by', 'creative commons attribution', 'publicdomain/zero', 'cc0'))} THEN 'open' ELSE 'unknown' END AS class, count(*) AS n FROM articles GROUP BY ALL"
)
def q_licence_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Licence classes of articles."""
    return table(spark, folder, "articles").groupBy("pmcid", classify.licence_class(F.col("license")).alias("class")).agg(F.count("*").alias("n"))


@query(
    "WITH r AS (SELECT id, max(exported_at) AS t FROM records GROUP BY 1), m AS (SELECT id, arg_max(review_status, (exported_at, review_status)) AS status, max(exported_at) AS date FROM records_mirror GROUP BY 1), "
    "f AS (SELECT DISTINCT records.id, pmcid, len(list_filter(coalesce(flags, []), lambda x: x NOT IN ('missing_assay_context', 'target_from_caption'))) AS blocked, review_status FROM records JOIN r ON records.id = r.id AND exported_at = t) "
    "SELECT pmcid, count(*) AS reviewed FROM f LEFT JOIN m USING (id) WHERE CASE WHEN m.status IS NOT NULL AND blocked = 0 THEN m.status ELSE review_status END = 'reviewed' GROUP BY 1"
)
def q_reviewed(spark: SparkSession, folder: str) -> DataFrame:
    """Records with the review log of the other copy, and what of them is reviewed."""
    log = enrich.newest(table(spark, folder, "records_mirror"), "id", "exported_at", ["id", "review_status", "exported_at"])
    log = log.select("id", F.col("review_status").alias("status"), F.lit("mirror").alias("reviewer"), F.col("exported_at").cast("string").alias("date"), F.lit(None).cast("string").alias("method"))
    records = enrich.apply_reviews(records_of(spark, folder, "pmcid flags review_status"), log)
    return enrich.reviewed_view(records).groupBy("pmcid").agg(F.count("*").alias("reviewed"))


@query("SELECT DISTINCT activity_id, replace(coalesce(relation, '='), '''', '') AS relation, lower(coalesce(doi, '')) AS doi FROM chembl_activity")
def q_cleaned(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned relation and doi."""
    return table(spark, folder, "chembl_activity").select("activity_id", parsing.clean_relation(F.col("relation")).alias("relation"), scalars.plain_doi(F.col("doi")).alias("doi")).distinct()


@query("SELECT lang, CASE WHEN count(*) < 1000 THEN 'n<1K' WHEN count(*) < 10000 THEN '1K<n<10K' WHEN count(*) < 100000 THEN '10K<n<100K' WHEN count(*) < 1000000 THEN '100K<n<1M' ELSE 'n>1M' END AS size, count(*) AS n FROM documents GROUP BY 1")
def q_size_classes(spark: SparkSession, folder: str) -> DataFrame:
    """Size classes."""
    return table(spark, folder, "documents").groupBy("lang").agg(scalars.size_bucket(F.count("*")).alias("size"), F.count("*").alias("n"))


@query("SELECT event_type, year(ts) AS year, count(*) AS n, greatest(1, least(18, CAST(floor((log10(value) + 3) / 0.5) AS int) + 1)) AS bin, sum(CAST(json_extract_string(props, '$.k') AS bigint)) AS k FROM events WHERE value > 0 GROUP BY ALL")
def q_event_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Events by year and log bin with a JSON field."""
    rows = table(spark, folder, "events").where(F.col("value") > 0)
    return rows.groupBy("event_type", F.year("ts").alias("year"), metrics.log_bin(F.col("value")).alias("bin")).agg(
        F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("long")).alias("k")
    )
