"""Queries of parsing, enrichment, evaluation, metrics, releases and extraction, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayweave.functions import parsing, scalars
from assayweave.operators import article_scan, article_tables, classify, enrich, evaluate, metrics, nested_tables, release, verification
from assayweave.plans.queries_search import LATEST, activities_of, records_of
from assayweave.session import settle, spread
from assayweave.sources import readers
from assayweave.sources.tables import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name."""

    def add(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return add


_NUMBER = r"(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?"
_BLANK = r"[\s\x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0085}]"
_VALUE = rf"^{_BLANK}*(<=|>=|<|>|=|≤|≥|~|≈)?{_BLANK}*({_NUMBER})(?:{_BLANK}*±{_BLANK}*({_NUMBER}))?{_BLANK}*([pnmµμu]?M)?{_BLANK}*$"
_JOIN = rf"([0-9]){_BLANK}+([0-9]{{3}})([^0-9]|$)"


@query(
    rf"WITH s AS (SELECT DISTINCT value_id, value_text, unit FROM llm_extract), c AS (SELECT *, regexp_replace(regexp_replace(replace(replace(coalesce(value_text, ''), '−', '-'), 'μ', 'µ'), '{_JOIN}', '\1\2\3', 'g'), '{_JOIN}', '\1\2\3', 'g') AS t FROM s), "
    rf"p AS (SELECT *, regexp_extract(t, '{_VALUE}', 1) AS rel, nullif(regexp_extract(t, '{_VALUE}', 2), '') AS num, nullif(regexp_extract(t, '{_VALUE}', 3), '') AS unc, nullif(replace(replace(regexp_extract(t, '{_VALUE}', 4), 'u', 'µ'), 'μ', 'µ'), '') AS own FROM c), "
    "q AS (SELECT *, coalesce(own, unit) AS u, CASE coalesce(own, unit) WHEN 'pM' THEN 0.001 WHEN 'nM' THEN 1.0 WHEN 'µM' THEN 1000.0 WHEN 'mM' THEN 1000000.0 WHEN 'M' THEN 1000000000.0 END AS f FROM p) "
    "SELECT value_id, CAST(replace(num, ',', '') AS double) AS value, CASE WHEN num IS NULL THEN NULL WHEN rel = '' THEN '=' WHEN rel = '≤' THEN '<=' WHEN rel = '≥' THEN '>=' WHEN rel = '≈' THEN '~' ELSE rel END AS relation, "
    "CASE WHEN num IS NULL THEN unit ELSE u END AS unit, round(CAST(replace(num, ',', '') AS double) * f, 9) AS nm, CAST(replace(unc, ',', '') AS double) AS uncertainty, "
    rf"array_to_string(list_filter([CASE WHEN own IS NOT NULL AND unit IS NOT NULL AND unit <> '' AND own <> unit THEN 'cell_unit_overrides_header' END, "
    rf"CASE WHEN num IS NULL AND lower(regexp_replace(coalesce(value_text, ''), '^{_BLANK}+|{_BLANK}+$', '', 'g')) IN ('', 'nd', 'n.d.', 'na', 'n/a', '-', '–', '—') THEN 'missing_value' WHEN num IS NULL THEN 'unparsed_value' END, "
    "CASE WHEN num IS NOT NULL AND f IS NULL THEN 'missing_unit' END, CASE WHEN num IS NOT NULL AND rel NOT IN ('', '=') THEN 'qualified_value' END], lambda x: x IS NOT NULL), ';') AS flags FROM q"
)
def q_parse_values(spark: SparkSession, folder: str) -> DataFrame:
    """Printed values parsed with their unit field."""
    rows = table(spark, folder, "llm_extract").select("value_id", "value_text", "unit").distinct()
    p = rows.select("value_id", parsing.parse_value(F.col("value_text"), F.col("unit")).alias("p"))
    return p.select("value_id", "p.value", "p.relation", "p.unit", F.round("p.normalized_value_nm", 9).alias("nm"), "p.uncertainty", F.array_join("p.flags", ";").alias("flags"))


@query(
    r"WITH h AS (SELECT DISTINCT column_header FROM llm_extract WHERE column_header IS NOT NULL), t AS (SELECT column_header, list_distinct(list_transform(list_filter(regexp_split_to_array(regexp_replace(column_header, '\bSEM\b|S\.\s?D\.?', '', 'g'), '[^A-Za-zµμ]+'), lambda x: x IN ('pM', 'nM', 'mM', 'µM', 'μM', 'uM', 'M')), lambda x: replace(replace(x, 'μ', 'µ'), 'u', 'µ'))) AS u FROM h), "
    r"k AS (SELECT column_header, regexp_matches(column_header, '(?i)(^|[^A-Za-z])K\s*i(\s*app|,\s*app)?($|[^A-Za-z])') AS ki, regexp_matches(column_header, '(?i)(^|[^A-Za-z])IC\s*50($|[^0-9])') AS ic, regexp_matches(column_header, '(?i)(^|[^A-Za-z])K\s*d($|[^A-Za-z])') AS kd FROM h) "
    "SELECT column_header, CASE WHEN len(u) = 1 THEN u[1] END AS unit, CASE WHEN CAST(ki AS int) + CAST(ic AS int) + CAST(kd AS int) = 1 THEN CASE WHEN ki THEN 'Ki' WHEN ic THEN 'IC50' ELSE 'Kd' END END AS kind FROM t JOIN k USING (column_header)"
)
def q_header_kind_unit(spark: SparkSession, folder: str) -> DataFrame:
    """Unit and measurement kind of distinct headers."""
    rows = table(spark, folder, "llm_extract").select("column_header").where(F.col("column_header").isNotNull()).distinct()
    return rows.select("column_header", parsing.unit_in(F.col("column_header")).alias("unit"), parsing.measurement_kind(F.col("column_header")).alias("kind"))


@query(
    "WITH u AS (SELECT DISTINCT unit, CASE WHEN trim(replace(unit, 'μ', 'µ')) = 'uM' THEN 'µM' ELSE trim(replace(unit, 'μ', 'µ')) END AS p FROM llm_extract WHERE unit IS NOT NULL) "
    "SELECT unit, CASE WHEN p IN ('pM', 'nM', 'µM', 'mM', 'M') THEN p WHEN lower(p) = 'pm' THEN 'pM' WHEN lower(p) = 'nm' THEN 'nM' WHEN lower(p) = 'µm' THEN 'µM' WHEN lower(p) = 'mm' THEN 'mM' WHEN lower(p) = 'um' THEN 'µM' END AS repaired FROM u"
)
def q_unit_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Off-list unit spellings repaired."""
    rows = table(spark, folder, "llm_extract").select("unit").where(F.col("unit").isNotNull()).distinct()
    return rows.select("unit", parsing.repair_unit(F.col("unit")).alias("repaired"))


@query(
    r"WITH l AS (SELECT DISTINCT compound_label FROM records WHERE compound_label IS NOT NULL), p AS (SELECT compound_label, trim(regexp_replace(compound_label, '\s*\[[^\]]*\]', '', 'g')) AS t FROM l), "
    r"c AS (SELECT compound_label, unnest(list_transform(list_filter(list_transform(list_prepend(t, regexp_extract_all(t, '\(([^()]+)\)', 1)), lambda x: trim(regexp_replace(trim(regexp_replace(x, '\s*\([^()]*\)', '', 'g')), '\s+\d+[a-z]?$', ''))), lambda x: regexp_matches(x, '^[A-Za-z][A-Za-z\-'' ]{4,40}$') AND regexp_matches(x, '[a-z]{3}')), lambda x: lower(x))) AS name FROM p) SELECT DISTINCT compound_label, name FROM c"
)
def q_name_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Names inside labels."""
    rows = table(spark, folder, "records").select("compound_label").where(F.col("compound_label").isNotNull()).distinct()
    return rows.select("compound_label", F.explode(parsing.name_candidates(F.col("compound_label"))).alias("name")).distinct()


@query(
    r"SELECT DISTINCT compound_label, trim(regexp_replace(trim(regexp_replace(compound_label, '\s*\[[^\]]*\]', '', 'g')), '\s+\d+$', '')) AS cleaned, lower(trim(regexp_replace(regexp_replace(compound_label, '\([^)]*\)|\[[^\]]*\]|[*†‡]', '', 'g'), '\s+\d+$', ''))) AS alternate FROM records WHERE compound_label IS NOT NULL"
)
def q_label_forms(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned labels."""
    label = F.col("compound_label")
    rows = table(spark, folder, "records").select(label).where(label.isNotNull()).distinct()
    return rows.select(label, parsing.clean_label(label).alias("cleaned"), parsing.alternate_name(label).alias("alternate"))


@query("SELECT DISTINCT id, substr(sha256(concat_ws('/', pmcid, table_id, CAST(row_index AS varchar), CAST(target_column AS varchar))), 1, 20) AS record_id, pmcid || ':' || compound_label AS compound_id FROM records WHERE table_id IS NOT NULL")
def q_record_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Ids from a record's place."""
    rows = table(spark, folder, "records").where(F.col("table_id").isNotNull())
    place = scalars.record_id(F.col("pmcid"), F.col("table_id"), F.col("row_index").cast("string"), F.col("target_column").cast("string"))
    return rows.select("id", place.alias("record_id"), scalars.scoped_id(F.col("pmcid"), F.col("compound_label")).alias("compound_id")).distinct()


@query()
def q_content_id(spark: SparkSession, folder: str) -> DataFrame:
    """One id for the content of all records and columns, whatever their order."""
    rows = table(spark, folder, "records")
    return rows.agg(scalars.content_sum(*map(F.col, sorted(rows.columns))).alias("dataset_id"))


_FOLD = "list_reduce(list_prepend(CAST(0 AS bigint), list_transform(range(1, 41), lambda i: CAST(strpos('0123456789abcdef', substr(sha1({0}), i, 1)) - 1 AS bigint))), lambda a, d: (a * 16 + d) % {1})"


@query(
    f"WITH s AS (SELECT DISTINCT scaffold AS key, 'scaffold' AS kind, {_FOLD.format('scaffold', 100)} AS b FROM release_papers WHERE scaffold IS NOT NULL), m AS (SELECT DISTINCT molecule_id AS key, 'molecule' AS kind, {_FOLD.format('molecule_id', 10)} AS b FROM chembl_activity WHERE molecule_id IS NOT NULL) "
    "SELECT key, kind, CASE WHEN b < 80 THEN 'train' WHEN b < 90 THEN 'valid' ELSE 'test' END AS split FROM s UNION ALL SELECT key, kind, CASE b WHEN 0 THEN 'test' WHEN 1 THEN 'val' ELSE 'train' END FROM m"
)
def q_hash_splits(spark: SparkSession, folder: str) -> DataFrame:
    """Splits by the hash of a scaffold and of a molecule."""
    a = table(spark, folder, "release_papers").select(F.col("scaffold").alias("key")).where(F.col("key").isNotNull()).distinct()
    b = table(spark, folder, "chembl_activity").select(F.col("molecule_id").alias("key")).where(F.col("key").isNotNull()).distinct()
    return a.select("key", F.lit("scaffold").alias("kind"), scalars.scaffold_split(F.col("key")).alias("split")).unionByName(
        b.select("key", F.lit("molecule").alias("kind"), scalars.molecule_split(F.col("key")).alias("split"))
    )


@query("SELECT DISTINCT value_id, CASE WHEN normalized_value_nm > 0 AND relation = '=' THEN round(9 - log10(normalized_value_nm), 3) END AS p FROM llm_extract")
def q_p_values(spark: SparkSession, folder: str) -> DataFrame:
    """p-values of exact positive values."""
    return table(spark, folder, "llm_extract").select("value_id", scalars.p_value(F.col("normalized_value_nm"), F.col("relation")).alias("p")).distinct()


_GROUND = r"replace(replace(regexp_replace({0}, '[\s,\x{{00A0}}\x{{2000}}-\x{{200A}}\x{{202F}}\x{{205F}}\x{{3000}}]', '', 'g'), 'μ', 'µ'), '−', '-')"


@query(f"SELECT DISTINCT value_id, contains({_GROUND.format('column_header')}, {_GROUND.format('endpoint')}) AS grounded FROM llm_extract")
def q_grounded(spark: SparkSession, folder: str) -> DataFrame:
    """Whether the stated endpoint is printed in the header."""
    return table(spark, folder, "llm_extract").select("value_id", parsing.is_grounded(F.col("endpoint"), F.col("column_header")).alias("grounded")).distinct()


@query(
    r"WITH d AS (SELECT DISTINCT target_key, column_header, regexp_extract(target_key, '^([A-Z]+)-?(\d+)$', 1) AS fam, regexp_extract(target_key, '^([A-Z]+)-?(\d+)$', 2) AS num FROM llm_extract WHERE column_header IS NOT NULL AND target_key IS NOT NULL), "
    r"n AS (SELECT *, CASE WHEN fam = '' THEN [] ELSE regexp_extract_all(column_header, '(?i)(?:^|[^A-Za-z])' || fam || '\s?-?(\d+)', 1) END AS ns FROM d) SELECT target_key, column_header, fam <> '' AND len(ns) > 0 AND NOT list_contains(ns, num) AS conflict FROM n"
)
def q_header_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """Headers that name another member of the target's family."""
    rows = table(spark, folder, "llm_extract").select("target_key", "column_header").where(F.col("column_header").isNotNull() & F.col("target_key").isNotNull()).distinct()
    return rows.select("target_key", "column_header", parsing.header_family_conflict(F.col("target_key"), F.col("column_header")).alias("conflict"))


@query(
    r"WITH h AS (SELECT DISTINCT column_header FROM verify_scale WHERE column_header IS NOT NULL), m AS (SELECT column_header, min(target_key) AS target, count(*) AS n FROM h JOIN targets ON regexp_matches(column_header, '(^|[^A-Za-z0-9])(h|rh-|hh|hrh-)?' || target_key || '($|[^A-Za-z0-9])') GROUP BY 1) SELECT h.column_header, CASE WHEN n = 1 THEN target END AS target FROM h LEFT JOIN m USING (column_header)"
)
def q_header_targets(spark: SparkSession, folder: str) -> DataFrame:
    """The one target a header names, by a theta join of distinct headers with the dimension."""
    rules = table(spark, folder, "targets").select(F.col("target_key").alias("target"), F.concat(F.lit("(^|[^A-Za-z0-9])(h|rh-|hh|hrh-)?"), "target_key", F.lit("($|[^A-Za-z0-9])")).alias("pattern"))
    rows = table(spark, folder, "verify_scale").select("column_header").where(F.col("column_header").isNotNull()).distinct()
    return classify.match_dimension(rows, "column_header", rules, "target", "pattern").select("column_header", "target")


@query(
    "WITH l AS (SELECT DISTINCT value_id, relation, value_text, normalized_value_nm, grounded FROM llm_extract QUALIFY row_number() OVER (PARTITION BY value_id ORDER BY loaded_at) = 1), v AS (SELECT value_id, max(status) AS status, bool_or(secondary_source) AS sec FROM verify_scale GROUP BY 1), "
    "j AS (SELECT CASE WHEN v.status IS NULL THEN 'not checked' WHEN v.status <> 'verified' THEN 'not verified' WHEN v.sec THEN 'secondary source' WHEN coalesce(l.relation, '=') <> '=' THEN 'bound' WHEN l.normalized_value_nm IS NULL THEN 'no value' ELSE 'kept' END AS reason FROM l LEFT JOIN v USING (value_id)) SELECT reason, count(*) AS n FROM j GROUP BY 1"
)
def q_elimination(spark: SparkSession, folder: str) -> DataFrame:
    """Values counted under the first reason that excludes them."""
    rows = enrich.first_per_key(table(spark, folder, "llm_extract").select("value_id", "relation", "normalized_value_nm", "loaded_at"), ["value_id"], [F.col("loaded_at")])
    checked = table(spark, folder, "verify_scale").groupBy("value_id").agg(F.max("status").alias("status"), F.bool_or("secondary_source").alias("sec"))
    steps = [
        (F.col("status").isNull(), "not checked"), (F.col("status") != "verified", "not verified"), (F.col("sec"), "secondary source"),
        (F.coalesce("relation", F.lit("=")) != "=", "bound"), (F.col("normalized_value_nm").isNull(), "no value"),
    ]
    reason = F.coalesce(enrich.elimination_reason(steps), F.lit("kept"))
    return rows.join(checked, "value_id", "left").groupBy(reason.alias("reason")).agg(F.count("*").alias("n"))


@query("SELECT target_key, count(*) FILTER (unit = 'M' OR normalized_value_nm IS NULL OR normalized_value_nm <= 0 OR normalized_value_nm < 1e-4 OR normalized_value_nm > 1e8) AS implausible, count(*) AS n FROM llm_extract GROUP BY 1")
def q_plausibility(spark: SparkSession, folder: str) -> DataFrame:
    """Implausible values and all values by target (P15, the counts of A24)."""
    bad = classify.implausible(F.col("normalized_value_nm"), F.col("unit"))
    return table(spark, folder, "llm_extract").groupBy("target_key").agg(F.count_if(bad).alias("implausible"), F.count("*").alias("n"))


@query(f"WITH {LATEST} SELECT target_key, count(*) AS n, round(median(normalized_value_nm), 6) AS median_nm FROM r0 WHERE measurement_type = 'IC50' AND relation = '=' AND normalized_value_nm > 0 AND len(list_filter(coalesce(flags, []), lambda f: f NOT IN ('missing_assay_context', 'target_from_caption'))) = 0 GROUP BY 1")
def q_exact_potency(spark: SparkSession, folder: str) -> DataFrame:
    """Exact unblocked potencies of one endpoint (P10, A4)."""
    rows = records_of(spark, folder, "target_key measurement_type normalized_value_nm relation flags")
    keep = enrich.exact_potency(F.col("measurement_type"), "IC50", F.col("normalized_value_nm"), F.col("relation"), F.coalesce("flags", F.array().cast("array<string>")))
    return rows.where(keep).groupBy("target_key").agg(F.count("*").alias("n"), F.round(F.median("normalized_value_nm"), 6).alias("median_nm"))


_KIND = "upper(regexp_replace({0}, '[\\s_-]|app', '', 'g'))"
_CHECK = (
    f"r AS (SELECT id, target_key, lower(trim(compound_label)) AS name, upper(measurement_type) AS kind, normalized_value_nm AS v FROM r0 WHERE normalized_value_nm > 0 AND relation = '='), "
    f"b AS (SELECT DISTINCT target_key, lower(trim(pref_name)) AS name, {_KIND.format('endpoint')} AS kind, value_num AS w FROM a0 WHERE replace(coalesce(relation, '='), '''', '') = '=' AND units = 'nM' AND validity IS NULL AND value_num > 0), "
    "two AS (SELECT r.id, abs(v - w) <= 0.02 * abs(v) OR abs(round_even(v * pow(10, -(floor(log10(v)) - 1)), 0) / pow(10, -(floor(log10(v)) - 1)) - round_even(w * pow(10, -(floor(log10(w)) - 1)), 0) / pow(10, -(floor(log10(w)) - 1))) <= 1e-9 * round_even(w * pow(10, -(floor(log10(w)) - 1)), 0) / pow(10, -(floor(log10(w)) - 1)) AS agrees "
    "FROM r JOIN b USING (target_key, name, kind)), c AS (SELECT id, count(*) AS candidates, bool_or(agrees) AS agrees FROM two GROUP BY 1)"
)


def _checked(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    name = lambda c: F.lower(F.trim(c))
    records = records_of(spark, folder, "target_key compound_label measurement_type normalized_value_nm relation").where((F.col("normalized_value_nm") > 0) & (F.col("relation") == "="))
    own = records.select("id", "target_key", name(F.col("compound_label")).alias("name"), F.upper("measurement_type").alias("kind"), "normalized_value_nm")
    theirs = enrich.reference_filter(activities_of(spark, folder, "target_key pref_name endpoint relation value_num units validity"))
    theirs = theirs.select("target_key", name(F.col("pref_name")).alias("name"), F.upper(F.regexp_replace("endpoint", r"[\s_-]|app", "")).alias("kind"), "value_num")
    return own, enrich.crosscheck(own, theirs, ["target_key", "name", "kind"])


@query(f"WITH {LATEST}, {_CHECK} SELECT * FROM c")
def q_crosscheck(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a database value of the same compound agrees."""
    return _checked(spark, folder)[1]


@query(f"WITH {LATEST}, {_CHECK} SELECT target_key, count(*) AS \"values\", count(agrees) AS checked, count(*) FILTER (agrees) AS agreed FROM r LEFT JOIN c USING (id) GROUP BY 1")
def q_crosscheck_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Checked and agreed values by target (A3, C.5)."""
    own, checked = _checked(spark, folder)
    return enrich.crosscheck_summary(own, checked)


@query(f"WITH {LATEST} SELECT target_key, lower(pref_name) AS name, count(*) AS n, round(median(value_num), 9) AS median_nm, min(value_num) AS min_nm, max(value_num) AS max_nm FROM a0 WHERE units = 'nM' AND pref_name IS NOT NULL GROUP BY ALL")
def q_compound_statistics(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of the same compound."""
    rows = activities_of(spark, folder, "target_key pref_name value_num units").where((F.col("units") == "nM") & F.col("pref_name").isNotNull()).withColumn("name", F.lower("pref_name"))
    return enrich.same_compound_statistics(rows, ["target_key", "name"]).withColumn("median_nm", F.round("median_nm", 9))


@query(f"WITH {LATEST}, d AS (SELECT lower(pref_name) AS name, min(molecule_id) AS molecule_id FROM a0 WHERE pref_name IS NOT NULL GROUP BY 1) SELECT id, molecule_id FROM (SELECT id, lower(trim(regexp_replace(compound_label, '\\s*\\[[^\\]]*\\]', '', 'g'))) AS name FROM r0 WHERE regexp_matches(compound_label, '^[A-Z][a-z]+( \\[\\d+\\])?$')) JOIN d USING (name)")
def q_identities(spark: SparkSession, folder: str) -> DataFrame:
    """Molecules of plain named labels, by the first candidate the dictionary knows."""
    names = activities_of(spark, folder, "pref_name molecule_id").where(F.col("pref_name").isNotNull()).groupBy(F.lower("pref_name").alias("name")).agg(F.min("molecule_id").alias("molecule_id"))
    rows = records_of(spark, folder, "compound_label").where(F.col("compound_label").rlike(r"^[A-Z][a-z]+( \[\d+\])?$"))
    out = enrich.attach_identities(rows, names)
    return out.where(F.col("molecule").isNotNull()).select("id", "molecule.molecule_id")


_BAG = "SELECT pmcid, table_id, compound_label, measurement_type, target_key AS target, relation, printf('%.13g', value_num * CASE unit WHEN 'nM' THEN 1.0 WHEN 'µM' THEN 1000.0 WHEN 'mM' THEN 1e6 WHEN 'M' THEN 1e9 END) AS molar FROM {0} WHERE value_num IS NOT NULL AND value_num >= 0 AND unit IN ('nM', 'µM', 'mM', 'M')"


@query(
    f"WITH a AS (SELECT *, count(*) AS n FROM ({_BAG.format('records')}) GROUP BY ALL), b AS (SELECT *, count(*) AS n FROM ({_BAG.format('records_mirror')}) GROUP BY ALL), "
    "k AS (SELECT coalesce(a.n, 0) AS p, coalesce(b.n, 0) AS g FROM a FULL JOIN b ON a.pmcid IS NOT DISTINCT FROM b.pmcid AND a.table_id IS NOT DISTINCT FROM b.table_id AND a.compound_label IS NOT DISTINCT FROM b.compound_label AND a.measurement_type IS NOT DISTINCT FROM b.measurement_type AND a.target IS NOT DISTINCT FROM b.target AND a.relation IS NOT DISTINCT FROM b.relation AND a.molar = b.molar), "
    "s AS (SELECT CAST(sum(least(p, g)) AS bigint) AS tp, CAST(sum(p - least(p, g)) AS bigint) AS fp, CAST(sum(g - least(p, g)) AS bigint) AS fn FROM k) SELECT tp, fp, fn, round(tp / (tp + fp), 9) AS precision, round(tp / (tp + fn), 9) AS recall, round(2.0 * tp / (2 * tp + fp + fn), 9) AS f1 FROM s"
)
def q_bag_scores(spark: SparkSession, folder: str) -> DataFrame:
    """One copy scored against the other as bags with exact molar keys."""

    def bag(name: str) -> DataFrame:
        rows = table(spark, folder, name).where((F.col("value_num") >= 0) & F.col("unit").isin("nM", "µM", "mM", "M"))
        return evaluate.keyed(rows.select("pmcid", "table_id", "compound_label", "measurement_type", F.col("target_key").alias("target"), "relation", F.col("value_num").alias("value"), "unit"))

    counts = evaluate.bag_counts(bag("records"), bag("records_mirror"), [*evaluate.IDENTITY, "molar", "relation"])
    return evaluate.scores(counts).select("tp", "fp", "fn", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")])


@query(
    "WITH a AS (SELECT pmcid, raw_value, count(*) n FROM records GROUP BY ALL), b AS (SELECT pmcid, raw_value, count(*) m FROM records_mirror GROUP BY ALL) SELECT pmcid, sum(n) AS extracted, sum(coalesce(m, 0)) AS gold, sum(least(n, coalesce(m, 0))) AS matched, round(100.0 * sum(least(n, coalesce(m, 0))) / sum(n), 1) AS pct FROM a LEFT JOIN b ON a.pmcid = b.pmcid AND a.raw_value = b.raw_value GROUP BY a.pmcid AS pmcid"
    .replace("GROUP BY a.pmcid AS pmcid", "GROUP BY a.pmcid").replace("SELECT pmcid, sum(n)", "SELECT a.pmcid AS pmcid, sum(n)")
)
def q_paper_tallies(spark: SparkSession, folder: str) -> DataFrame:
    """Extracted, gold and matched values by paper."""
    a = table(spark, folder, "records").groupBy("pmcid", "raw_value").agg(F.count("*").alias("n"))
    b = table(spark, folder, "records_mirror").groupBy("pmcid", "raw_value").agg(F.count("*").alias("m"))
    both = a.join(b, ["pmcid", "raw_value"], "left").withColumn("m", F.coalesce("m", F.lit(0).cast("long")))
    total = both.groupBy("pmcid").agg(F.sum("n").alias("extracted"), F.sum("m").alias("gold"), F.sum(F.least("n", "m")).alias("matched"))
    return total.withColumn("pct", evaluate.percent(F.col("matched"), F.col("extracted")))


_IN_ORDER = "list(normalized_value_nm ORDER BY table_id NULLS FIRST, row_index NULLS FIRST, target_column NULLS FIRST, id NULLS FIRST, exported_at NULLS FIRST)"
_GREEDY = "SELECT pmcid, target_key, measurement_type, {1} AS v FROM {0} WHERE normalized_value_nm > 0 AND measurement_type IS NOT NULL GROUP BY ALL"
_CLOSE = "(abs(a[i + 1] - b[k]) <= 0.02 * greatest(abs(b[k]), 1e-12) OR printf('%.1e', a[i + 1]) = printf('%.1e', b[k]))"


@query(
    f"WITH RECURSIVE e AS ({_GREEDY.format('records', _IN_ORDER)}), g AS ({_GREEDY.format('records_mirror', _IN_ORDER)}), s AS (SELECT e.pmcid, e.target_key, e.measurement_type, e.v AS a, g.v AS b FROM e JOIN g USING (pmcid, target_key, measurement_type)), "
    "m AS (SELECT pmcid, target_key, measurement_type, a, b, 0 AS i, CAST([] AS bigint[]) AS used, CAST(NULL AS bigint) AS hit FROM s UNION ALL "
    "SELECT pmcid, target_key, measurement_type, a, b, i + 1, CASE WHEN h IS NULL THEN used ELSE list_append(used, h) END, h FROM (SELECT *, "
    f"list_filter(range(1, len(b) + 1), lambda k: NOT list_contains(used, k) AND {_CLOSE})[1] AS h FROM m WHERE i < len(a))) "
    "SELECT pmcid, target_key, measurement_type, i AS own, CAST(hit AS int) AS other FROM m WHERE hit IS NOT NULL"
)
def q_greedy_matches(spark: SparkSession, folder: str) -> DataFrame:
    """One-to-one tolerance matches in document order."""
    rows = lambda name: table(spark, folder, name).where((F.col("normalized_value_nm") > 0) & F.col("measurement_type").isNotNull()).withColumn("value_nm", F.col("normalized_value_nm"))
    order = ["table_id", "row_index", "target_column", "id", "exported_at"]
    return evaluate.greedy_matches(rows("records"), rows("records_mirror"), ["pmcid", "target_key", "measurement_type"], order, order)


@query()
def q_reachable(spark: SparkSession, folder: str) -> DataFrame:
    """Whether a value is printed in its article's tables."""
    gold = records_of(spark, folder, "pmcid value_num").where(F.col("value_num").isNotNull())
    return evaluate.reachable_share(gold, article_tables.printed_numbers(_scanned(spark, folder)), "pmcid", "value_num").select("id", "reachable")


_PRED = "p AS (SELECT target_key, pmcid, p_value AS y, 9 - log10(value_nm) + (release_id % 7 - 3) / 4.0 AS pred FROM release_papers WHERE value_nm > 0 AND p_value IS NOT NULL)"


def _predictions(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "release_papers").where((F.col("value_nm") > 0) & F.col("p_value").isNotNull())
    shifted = F.lit(9.0) - F.log10("value_nm") + (F.col("release_id") % 7 - 3) / 4.0
    return rows.select("release_id", "target_key", "pmcid", "inchikey", F.col("p_value").alias("y"), shifted.alias("pred"))


_ERR = "count(*) AS n, round(sqrt(avg(pow(pred - y, 2))), 6) AS rmse, round(avg(abs(pred - y)), 6) AS mae, round(avg(CAST(abs(pred - y) <= 1 AS int)), 6) AS within_1"


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


@query(f"WITH {_PRED} SELECT target_key, {_ERR} FROM p GROUP BY 1 HAVING count(*) >= 5")
def q_error_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """RMSE, MAE and share within one unit by target."""
    return _rounded(metrics.grouped_metrics(_predictions(spark, folder), ["target_key"], "y", "pred"), "rmse", "mae", "within_1")


@query(f"WITH {_PRED}, b AS (SELECT *, CASE WHEN (y / 12) < 0.4 THEN '<0.4' WHEN (y / 12) < 0.6 THEN '0.4-0.6' ELSE '>0.6' END AS bin FROM p) SELECT bin, {_ERR} FROM b WHERE y / 12 < 1.01 GROUP BY 1 HAVING count(*) >= 10")
def q_binned_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics by similarity bin."""
    rows = _predictions(spark, folder).withColumn("bin", metrics.similarity_bin(F.col("y") / 12)).where(F.col("bin").isNotNull())
    return _rounded(metrics.grouped_metrics(rows, ["bin"], "y", "pred", least=10), "rmse", "mae", "within_1")


@query(
    f"WITH {_PRED}, k AS (SELECT target_key, pmcid, rank() OVER (PARTITION BY target_key, pmcid ORDER BY y) + (count(*) OVER (PARTITION BY target_key, pmcid, y) - 1) / 2.0 AS a, rank() OVER (PARTITION BY target_key, pmcid ORDER BY pred) + (count(*) OVER (PARTITION BY target_key, pmcid, pred) - 1) / 2.0 AS b FROM p WHERE pmcid IS NOT NULL), "
    "g AS (SELECT target_key, pmcid, count(*) AS n, corr(a, b) AS r FROM k GROUP BY ALL HAVING count(*) >= 5 AND min(a) <> max(a) AND min(b) <> max(b)) SELECT target_key, round(sum(r * n) / sum(n), 6) AS rho, count(*) AS groups FROM g GROUP BY 1"
)
def q_group_spearman(spark: SparkSession, folder: str) -> DataFrame:
    """Rank correlation within papers, weighted by size."""
    return _rounded(metrics.group_spearman(_predictions(spark, folder), ["target_key"], "pmcid", "y", "pred"), "rho")


@query(
    "WITH t AS (SELECT * FROM release_papers WHERE p_value IS NOT NULL), m AS (SELECT target_key, avg(p_value) AS pred FROM t WHERE lower(split) = 'train' GROUP BY 1), s AS (SELECT DISTINCT inchikey FROM t WHERE lower(split) = 'train' AND inchikey IS NOT NULL), "
    "e AS (SELECT t.target_key, p_value AS y, pred, t.inchikey IN (SELECT inchikey FROM s) AND t.inchikey IS NOT NULL AS seen FROM t LEFT JOIN m USING (target_key) WHERE lower(split) = 'test') "
    "SELECT seen, count(pred) AS n, round(sqrt(avg(pow(pred - y, 2))), 6) AS rmse, round(avg(abs(pred - y)), 6) AS mae, round(avg(CAST(abs(pred - y) <= 1 AS int)), 6) AS within_1 FROM e GROUP BY 1"
)
def q_baseline(spark: SparkSession, folder: str) -> DataFrame:
    """Task-mean baseline on seen and unseen molecules."""
    rows = table(spark, folder, "release_papers").where(F.col("p_value").isNotNull())
    train, test = rows.where(F.lower("split") == "train"), rows.where(F.lower("split") == "test")
    predicted = metrics.task_mean_baseline(train, test, "target_key", "p_value")
    known = train.where(F.col("inchikey").isNotNull())
    marked = metrics.seen_in_training(predicted, known, ["inchikey"])
    return _rounded(marked.groupBy("seen").agg(*metrics.error_metrics(F.col("p_value"), F.col("pred"))), "rmse", "mae", "within_1")


@query(
    f"WITH {LATEST}, a AS (SELECT target_key, lower(compound_label) AS name, median(log10(normalized_value_nm)) AS x FROM r0 WHERE normalized_value_nm > 0 AND compound_label IS NOT NULL GROUP BY ALL), b AS (SELECT target_key, lower(pref_name) AS name, median(log10(normalized_value_nm)) AS y FROM a0 WHERE normalized_value_nm > 0 AND pref_name IS NOT NULL GROUP BY ALL) "
    "SELECT count(*) AS n, round(sqrt(avg(pow(x - y, 2))), 6) AS rmse FROM a JOIN b USING (target_key, name)"
)
def q_noise_floor(spark: SparkSession, folder: str) -> DataFrame:
    """Disagreement of the same compounds between both sources."""
    log = F.log10("normalized_value_nm").alias("v")
    a = records_of(spark, folder, "target_key compound_label normalized_value_nm").where(F.col("normalized_value_nm") > 0).select("target_key", F.lower("compound_label").alias("name"), log)
    b = activities_of(spark, folder, "target_key pref_name normalized_value_nm").where(F.col("normalized_value_nm") > 0).select("target_key", F.lower("pref_name").alias("name"), log)
    return _rounded(metrics.noise_floor(a, b, ["target_key", "name"], "v", "v"), "rmse")


@query()
def q_bootstrap(spark: SparkSession, folder: str) -> DataFrame:
    """Bootstrap interval of the RMSE."""
    return metrics.poisson_bootstrap(_predictions(spark, folder), "release_id", "y", "pred", replicates=1000)


@query()
def q_bootstrap_ranks(spark: SparkSession, folder: str) -> DataFrame:
    """Bootstrap interval of the rank correlation within papers and targets."""
    return metrics.spearman_bootstrap(_predictions(spark, folder), "release_id", ["pmcid", "target_key"], "y", "pred", replicates=300)


@query(f"WITH {LATEST} SELECT target_key, molecule_id, CAST(round(CAST(median(p) AS DECIMAL(18, 6)), 3) AS double) AS p, count(*) AS n, min(nullif(pub_year, 0)) AS year FROM (SELECT *, round(9 - log10(normalized_value_nm), 3) AS p FROM a0 WHERE normalized_value_nm > 0 AND validity IS NULL AND replace(coalesce(relation, '='), '''', '') = '=') GROUP BY ALL")
def q_training_table(spark: SparkSession, folder: str) -> DataFrame:
    """Training rows: median, count and earliest year of each molecule and task."""
    relation = parsing.clean_relation(F.col("relation"))
    rows = activities_of(spark, folder, "target_key molecule_id relation normalized_value_nm validity pub_year").where((F.col("normalized_value_nm") > 0) & F.col("validity").isNull() & (relation == "="))
    rows = rows.withColumn("p", scalars.p_value(F.col("normalized_value_nm"), relation))
    return metrics.training_table(rows, ["target_key", "molecule_id"], "p", "pub_year")


@query(f"WITH {LATEST} SELECT molecule_id, round(list_reduce(list(value_num ORDER BY activity_id), lambda a, x: (a + x) / 2), 9) AS value_num FROM a0 WHERE value_num IS NOT NULL GROUP BY 1")
def q_running_average(spark: SparkSession, folder: str) -> DataFrame:
    """Running pairwise average in stated order."""
    return metrics.running_average(activities_of(spark, folder, "molecule_id value_num"), ["molecule_id"], "value_num", ["activity_id"]).withColumn("value_num", F.round("value_num", 9))


@query(f"WITH {LATEST} SELECT target_key, list_sort(list(normalized_value_nm))[CAST(floor(count(normalized_value_nm) / 2) AS int) + 1] AS upper_median FROM r0 WHERE normalized_value_nm IS NOT NULL GROUP BY 1")
def q_upper_median(spark: SparkSession, folder: str) -> DataFrame:
    """Upper median by target (A5)."""
    return metrics.upper_median_rows(records_of(spark, folder, "target_key normalized_value_nm"), ["target_key"], "normalized_value_nm", "upper_median")


@query(
    "WITH s AS (SELECT a.vec_id, b.vec_id AS other, round(list_cosine_similarity(CAST(a.embedding AS double[]), CAST(b.embedding AS double[])), 6) AS c FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0), t AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY c DESC, other) AS rn FROM s) SELECT vec_id, c AS similarity FROM t WHERE rn = 1"
)
def q_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    """Similarity of every fiftieth vector to the nearest other one with the same label, among all."""
    rows = table(spark, folder, "embeddings")
    return _rounded(metrics.nearest_neighbours(rows.where(F.col("vec_id") % 50 == 0), rows, "vec_id", "embedding", "label"), "similarity").select("vec_id", "similarity")


def _structures(spark: SparkSession, folder: str) -> DataFrame:
    """One structure of each compound name."""
    rows = table(spark, folder, "release_papers").where(F.col("compound_label").isNotNull() & F.col("smiles").isNotNull())
    best = rows.groupBy("compound_label").agg(F.min(F.struct("smiles", "inchikey", "scaffold", "structure_method")).alias("s"))
    return best.select("compound_label", "s.*")


@query(
    f"WITH {LATEST}, s AS (SELECT compound_label, smiles, inchikey, scaffold, structure_method FROM release_papers WHERE compound_label IS NOT NULL AND smiles IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY compound_label ORDER BY smiles, inchikey NULLS FIRST, scaffold NULLS FIRST, structure_method NULLS FIRST) = 1), "
    "x AS (SELECT pmcid, sha256(xml_text) AS h FROM articles QUALIFY row_number() OVER (PARTITION BY pmcid ORDER BY fetched_at DESC NULLS LAST, xml_text DESC NULLS LAST) = 1) "
    f"SELECT smiles, inchikey, scaffold, CASE WHEN scaffold IS NULL THEN NULL WHEN {_FOLD.format('scaffold', 100)} < 80 THEN 'train' WHEN {_FOLD.format('scaffold', 100)} < 90 THEN 'valid' ELSE 'test' END AS split, "
    "target_key AS target, CAST(NULL AS varchar) AS uniprot, target_name, measurement_type AS endpoint, relation, normalized_value_nm AS value_nm, CASE WHEN relation = '=' AND normalized_value_nm > 0 THEN round(9 - log10(normalized_value_nm), 3) END AS p_value, "
    "raw_value AS reported_value, unit AS reported_unit, compound_label, structure_method, pmcid, doi, coalesce(CAST(pub_year AS varchar), '') AS year, table_id, row_index, 'https://pmc.ncbi.nlm.nih.gov/articles/' || pmcid || '/' AS source_url, "
    "h AS source_sha256, 'ai_checked_transcription' AS review, id AS record_id FROM r0 JOIN s USING (compound_label) LEFT JOIN targets USING (target_key) LEFT JOIN x USING (pmcid) WHERE review_status = 'reviewed' AND normalized_value_nm IS NOT NULL"
)
def q_paper_release(spark: SparkSession, folder: str) -> DataFrame:
    """The paper release with its 24 columns, of all targets."""
    targets = table(spark, folder, "targets").select("target_key", "target_name", F.lit(None).cast("string").alias("uniprot"))
    sources = nested_tables.latest_articles(table(spark, folder, "articles")).select("pmcid", F.sha2("xml_text", 256).alias("source_sha256"))
    return release.paper_release(records_of(spark, folder, " ".join(release.PAPER_SOURCE)), targets, _structures(spark, folder), sources, by=("compound_label",))


_NAMED = "SELECT pmcid, compound_label, min(smiles) AS smiles FROM release_papers WHERE pmcid IS NOT NULL AND compound_label IS NOT NULL AND contains(structure_method, 'verified') = {0} GROUP BY ALL"


@query(
    "WITH l AS (SELECT value_id, target_key AS target, endpoint, relation, normalized_value_nm AS value_nm, pmcid, compound_label FROM llm_extract QUALIFY row_number() OVER (PARTITION BY value_id ORDER BY loaded_at DESC NULLS LAST, target_key DESC NULLS LAST, endpoint DESC NULLS LAST, relation DESC NULLS LAST, normalized_value_nm DESC NULLS LAST, pmcid DESC NULLS LAST, compound_label DESC NULLS LAST) = 1), "
    "v AS (SELECT value_id, max(status) AS status, bool_or(secondary_source) AS sec FROM verify_scale GROUP BY 1), t AS (SELECT DISTINCT target_key AS target, endpoint, true AS task FROM release_papers), "
    f"a AS ({_NAMED.format('true')}), b AS ({_NAMED.format('false')}), "
    "g AS (SELECT CASE WHEN status IS DISTINCT FROM 'verified' THEN 'not verified' WHEN sec THEN 'review article' WHEN relation IS DISTINCT FROM '=' THEN 'bound' WHEN task IS NULL THEN 'enzyme/endpoint not in model' WHEN coalesce(a.smiles, b.smiles) IS NULL THEN 'no structure' "
    "WHEN a.smiles IS NOT NULL THEN 'row: opsin_formula_verified' ELSE 'row: name_matched' END AS outcome, CASE WHEN status = 'verified' AND NOT coalesce(sec, false) AND relation = '=' AND task AND coalesce(a.smiles, b.smiles) IS NOT NULL AND value_nm > 0 THEN round(9 - log10(value_nm), 3) END AS p "
    "FROM l LEFT JOIN v USING (value_id) LEFT JOIN t USING (target, endpoint) LEFT JOIN a USING (pmcid, compound_label) LEFT JOIN b USING (pmcid, compound_label)) SELECT outcome, count(*) AS n, round(sum(p), 3) AS total_p FROM g GROUP BY 1"
)
def q_external_test(spark: SparkSession, folder: str) -> DataFrame:
    """External test set: rows by structure source, and what was left out why."""
    names = ["value_id", "target_key", "endpoint", "relation", "normalized_value_nm", "pmcid", "compound_label"]
    latest = enrich.newest(table(spark, folder, "llm_extract"), "value_id", "loaded_at", names)
    values = latest.withColumnsRenamed({"target_key": "target", "normalized_value_nm": "value_nm"})
    checked = table(spark, folder, "verify_scale").groupBy("value_id").agg(F.max("status").alias("status"), F.bool_or("secondary_source").alias("secondary_source"))
    papers = table(spark, folder, "release_papers")
    verified = F.contains("structure_method", F.lit("verified"))
    side = lambda keep: papers.where(keep & F.col("pmcid").isNotNull() & F.col("compound_label").isNotNull()).groupBy("pmcid", "compound_label").agg(F.min("smiles").alias("smiles"))
    sources = [("opsin_formula_verified", side(verified)), ("name_matched", side(~verified))]
    rows, reasons = release.external_test(values, checked, papers.select(F.col("target_key").alias("target"), "endpoint"), sources)
    kept = rows.groupBy(F.concat(F.lit("row: "), "structure_method").alias("outcome")).agg(F.count("*").alias("n"), F.round(F.sum("p"), 3).alias("total_p"))
    return kept.unionByName(reasons.select(F.col("reason").alias("outcome"), "n", F.lit(None).cast("double").alias("total_p")))


@query(f"WITH {LATEST} SELECT activity_id, CASE WHEN normalized_value_nm > 0 THEN round(9 - log10(normalized_value_nm), 3) END AS p_value, units FROM a0 WHERE replace(coalesce(relation, '='), '''', '') = '=' AND units = 'nM' AND validity IS NULL AND value_num > 0")
def q_database_release(spark: SparkSession, folder: str) -> DataFrame:
    """Release table of the database."""
    return release.database_release(activities_of(spark, folder, " ".join(release.DATABASE_SOURCE))).select("activity_id", "p_value", "units")


@query("SELECT lower(split) AS split, count(*) AS rows, count(DISTINCT inchikey) AS molecules, count(DISTINCT target_key) AS targets, count(DISTINCT pmcid) AS papers FROM release_papers GROUP BY 1")
def q_release_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Release statistics by split."""
    return release.release_stats(table(spark, folder, "release_papers").withColumn("split", F.lower("split")))


@query("SELECT count(*) AS shared FROM (SELECT inchikey FROM release_papers WHERE lower(split) = 'train' AND inchikey IS NOT NULL INTERSECT SELECT inchikey FROM release_papers WHERE lower(split) = 'test')")
def q_shared_molecules(spark: SparkSession, folder: str) -> DataFrame:
    """Molecules on both sides of a split."""
    rows = table(spark, folder, "release_papers")
    return release.shared_molecules(rows.where(F.lower("split") == "train"), rows.where(F.lower("split") == "test"), "inchikey")


@query(
    f"WITH {LATEST}, s AS (SELECT pmcid, compound_label, min(smiles) AS a FROM release_papers WHERE pmcid IS NOT NULL AND compound_label IS NOT NULL AND structure_method LIKE '%verified%' GROUP BY ALL), f AS (SELECT pmcid, compound_label, min(smiles) AS b FROM release_papers WHERE pmcid IS NOT NULL AND compound_label IS NOT NULL AND structure_method NOT LIKE '%verified%' GROUP BY ALL) "
    "SELECT id, coalesce(a, b) AS smiles, CASE WHEN a IS NOT NULL THEN 'verified' WHEN b IS NOT NULL THEN 'named' END AS method FROM r0 LEFT JOIN s USING (pmcid, compound_label) LEFT JOIN f USING (pmcid, compound_label)"
)
def q_structure_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Structures of the first source that has one."""
    rows = table(spark, folder, "release_papers").where(F.col("pmcid").isNotNull() & F.col("compound_label").isNotNull())
    keys, verified = ["pmcid", "compound_label"], F.contains("structure_method", F.lit("verified"))
    pick = lambda keep: rows.where(keep).groupBy(*keys).agg(F.min("smiles").alias("smiles"))
    return release.structures_by_source(records_of(spark, folder, "pmcid compound_label").select("id", *keys), pick(verified), pick(~verified), keys, "smiles").select("id", "smiles", "method")


@query("WITH d AS (SELECT pmcid, inchikey, min(compound_label) AS a, max(compound_label) AS b FROM release_papers WHERE inchikey IS NOT NULL GROUP BY ALL) SELECT DISTINCT release_id, coalesce(a <> b, false) AS ambiguous FROM release_papers r JOIN d ON r.pmcid IS NOT DISTINCT FROM d.pmcid AND r.inchikey = d.inchikey")
def q_ambiguous(spark: SparkSession, folder: str) -> DataFrame:
    """Compounds that several labels of a paper share."""
    rows = table(spark, folder, "release_papers").where(F.col("inchikey").isNotNull())
    return rows.select("release_id", F.coalesce(enrich.ambiguous_values(rows, "pmcid", "inchikey", "compound_label"), F.lit(False)).alias("ambiguous")).distinct()


@query("SELECT target_key, compound_label, structure_method FROM (SELECT *, row_number() OVER (PARTITION BY target_key ORDER BY CAST(structure_method LIKE '%verified%' AS int) DESC, length(compound_label) DESC, release_id) rn FROM release_papers WHERE compound_label IS NOT NULL AND structure_method IS NOT NULL) WHERE rn = 1")
def q_best_candidates(spark: SparkSession, folder: str) -> DataFrame:
    """Best candidate of each key: match, then length, then position."""
    rows = table(spark, folder, "release_papers").where(F.col("compound_label").isNotNull() & F.col("structure_method").isNotNull())
    return enrich.best_candidate(rows, "target_key", F.contains("structure_method", F.lit("verified")), F.col("compound_label"), F.col("release_id")).select("target_key", "compound_label", "structure_method")


@query("SELECT target_key, activity_id, min(value_num) AS value FROM chembl_activity WHERE units = 'nM' AND value_num IS NOT NULL GROUP BY ALL")
def q_import_bundle(spark: SparkSession, folder: str) -> DataFrame:
    """First row in nM of each activity and target."""
    rows = table(spark, folder, "chembl_activity").select(F.col("target_key"), "activity_id", F.col("value_num").alias("value"), "units")
    return readers.import_bundle(rows, group="target_key", order=[F.col("value")]).select("target_key", "activity_id", "value")


@query(
    "WITH t AS (SELECT DISTINCT title FROM articles WHERE title IS NOT NULL), w AS (SELECT title, string_split(title, ' ') AS w FROM t), s AS (SELECT title, unnest(list_transform(range(1, least(len(w), 12) + 1), lambda i: array_to_string(w[i:], ' '))) AS suffix FROM w) SELECT title, suffix FROM s WHERE length(suffix) >= 6"
)
def q_suffixes(spark: SparkSession, folder: str) -> DataFrame:
    """Word suffixes of titles."""
    rows = table(spark, folder, "articles").select("title").where(F.col("title").isNotNull()).distinct()
    return rows.select("title", F.explode(enrich.suffixes(F.col("title"))).alias("suffix"))


@query("SELECT value_id, CAST(list_sum(list_distinct(list_transform(regexp_extract_all(replace(value_text, ',', '.'), '[0-9]+(?:\\.[0-9]+)?', 0), lambda x: CAST(x AS double)))) AS double) AS total FROM (SELECT DISTINCT value_id, value_text FROM llm_extract WHERE regexp_matches(value_text, '[0-9]'))")
def q_number_sets(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct numbers of a text, here added up."""
    rows = table(spark, folder, "llm_extract").select("value_id", "value_text").where(F.col("value_text").rlike("[0-9]")).distinct()
    return rows.select("value_id", F.aggregate(parsing.number_set(F.col("value_text")), F.lit(0.0), lambda s, x: s + x).alias("total"))


@query(
    "WITH p AS (SELECT doc_id, text, string_split(text, 'IC50') AS p FROM documents WHERE contains(text, 'IC50')), n AS (SELECT doc_id, text, p, unnest(range(1, len(p))) AS k FROM p), "
    "a AS (SELECT doc_id, text, CAST(length(array_to_string(p[1:k], 'IC50')) + 1 AS int) AS \"at\" FROM n) SELECT doc_id, \"at\", substr(text, greatest(1, \"at\" - 40), \"at\" + 44 - greatest(1, \"at\" - 40)) AS around FROM a"
)
def q_context_windows(spark: SparkSession, folder: str) -> DataFrame:
    """Forty characters around each mention."""
    rows = table(spark, folder, "documents").where(F.contains("text", F.lit("IC50")))
    return rows.select("doc_id", F.explode(enrich.mention_windows(F.col("text"), "IC50")).alias("m")).select("doc_id", "m.at", "m.around")


def _scanned(spark: SparkSession, folder: str) -> DataFrame:
    articles = table(spark, folder, "articles")
    return article_scan.scan_articles(spread(nested_tables.latest_articles(articles), articles))


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return article_tables.parsed_of(_scanned(spark, folder), on_error="skip")


@query()
def q_potency_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of each article, and those that state potencies."""
    return article_tables.potency_tables(_scanned(spark, folder))


@query()
def q_article_tables(spark: SparkSession, folder: str) -> DataFrame:
    """Tables of the articles as header paths and dense grids."""
    rows = _parsed(spark, folder).where(F.col("kind") == "table")
    return rows.select("pmcid", "table_id", "caption", F.array_join("headers", " || ").alias("headers"), F.size("rows").alias("n_rows"))


@query()
def q_printed_tables(spark: SparkSession, folder: str) -> DataFrame:
    """All tables as printed, here their rows and heading rows."""
    rows = article_tables.printed_tables(_scanned(spark, folder)).where(F.col("kind") == "xml")
    return rows.select("pmcid", "table_id", F.size("grid").cast("long").alias("n_rows"), "heads")


@query()
def q_article_records(spark: SparkSession, folder: str) -> DataFrame:
    """Measurement records of the articles' tables."""
    rules = classify.rules_of(table(spark, folder, "targets"))
    return article_tables.measurements(_parsed(spark, folder), rules)[0].drop("evidence")


@query()
def q_article_skips(spark: SparkSession, folder: str) -> DataFrame:
    """What extraction left out, by reason."""
    parsed = settle(_parsed(spark, folder), "parsed")
    skipped = article_tables.measurements(parsed, classify.rules_of(table(spark, folder, "targets")))[1]
    errors = parsed.where(F.col("kind") == "error").select(F.lit("unreadable article").alias("reason"))
    return skipped.select("reason").unionByName(errors).groupBy("reason").agg(F.count("*").alias("n"))


@query()
def q_methods(spark: SparkSession, folder: str) -> DataFrame:
    """Assay sections of the articles, with how many paragraphs they have."""
    rows = _parsed(spark, folder).where(F.col("kind") == "article").select("pmcid", F.explode("methods").alias("m"))
    return rows.select("pmcid", "m.section_id", "m.title", F.size(F.split("m.text", "\n\n", -1)).cast("long").alias("paragraphs"))


@query()
def q_verification(spark: SparkSession, folder: str) -> DataFrame:
    """Extracted values verified against their tables."""
    tables = article_tables.printed_tables(_scanned(spark, folder)).where((F.col("kind") == "xml") & (F.col("table_id") != ""))
    grids = tables.groupBy("pmcid", "table_id").agg(F.min_by(F.struct("caption", "grid", "heads"), F.xxhash64("payload", "caption")).alias("t")).select("pmcid", "table_id", "t.*")
    names = ["value_id", "pmcid", "table_id", "compound_label", "target_key", "value_text", "value_num", "unit", "normalized_value_nm"]
    rows = enrich.newest(table(spark, folder, "llm_extract"), "value_id", "loaded_at", names)
    values = rows.select(
        "value_id", "pmcid", "table_id", "compound_label", "target_key", "value_text", F.col("value_num").alias("value"), parsing.repair_unit(F.col("unit")).alias("unit"),
        F.col("normalized_value_nm").alias("value_nm"), F.lit("text").alias("kind"),
    )
    found = verification.verify(values, grids, classify.rules_of(table(spark, folder, "targets")))
    return found.groupBy("status", "reason").agg(F.count("*").alias("n"))


@query()
def q_formula_mentions(spark: SparkSession, folder: str) -> DataFrame:
    """Formulas stated in texts."""
    rows = table(spark, folder, "documents").select("doc_id", F.explode(parsing.formula_mentions(F.col("text"), 1 << 30)).alias("formula"))
    return rows.select("doc_id", "formula", F.to_json(parsing.formula_counts(F.col("formula"))).alias("counts"))


@query()
def q_stated_formulas(spark: SparkSession, folder: str) -> DataFrame:
    """Formulas that articles state for the labels of their records."""
    labels = table(spark, folder, "records").select("pmcid", "compound_label").where(F.col("compound_label").isNotNull())
    return article_tables.stated_formulas(_scanned(spark, folder), labels)


@query()
def q_figures(spark: SparkSession, folder: str) -> DataFrame:
    """Graphics of the articles' figures."""
    return article_tables.figures(_scanned(spark, folder))
