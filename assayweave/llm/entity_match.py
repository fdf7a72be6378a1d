"""Matching records with database activities that share no key (problem 1).

Both tables are brought to one shape: publication (a canonical doi, filled from the rows
of the same paper or document), target, measurement type, the compound's names, and the
value in nM.  Sorted neighbourhoods propose pairs: under several composite sort keys the
rows of both tables are put in one global order and each is compared with those up to
``window`` places behind it.  Blocks are cut by position, not by key, with an overlap of
one window, so every task gets equally many rows whatever the skew.

Each compared pair gets field similarities and a weighted confidence.  A database may hold
one measurement several times, so activities of the same molecule, publication, target,
type and digits are one entity.  Records and entities are assigned one to one with the
greatest total confidence, and the members of an entity follow it, as do entities that are
left over: that is how a record has several activities.
"""

from __future__ import annotations

import re
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assayweave.functions.textfold import fold_text
from assayweave.llm.splits import components
from assayweave.operators import units
from assayweave.operators.enrich import newest
from assayweave.session import discard, settle

WINDOW = 24
BLOCK = 20_000

# The usual counter-ions and solvates of drugs, which don't change the compound meant.
SALTS = (
    "acetate ammonium anhydrous benzoate besilate besylate bromide calcium chloride citrate dihydrate dihydrochloride edisylate esylate fumarate gluconate glutamate hbr hcl hemihydrate "
    "hydrate hydrobromide hydrochloride iodide lactate lithium magnesium malate maleate meglumine mesilate mesylate monohydrate napsylate nitrate oxalate palmitate pamoate phosphate potassium "
    "sesquihydrate sodium stearate succinate sulfate sulphate tartrate tfa tosylate trifluoroacetate trihydrate tromethamine zinc"
).split()
_SALT = re.compile(rf"[\s,-]+(?:{'|'.join(SALTS)})(?:\s+salt)?$")
_LOCAL = re.compile(r"(?:(?:compound|cpd|cmpd|ligand)\.?\s*)?\(?(\d+[a-z]\d*)\)?(?:\s+\((.+)\))?")
_NUMBERED = re.compile(r"\s*[\[(]\d+[a-z]?[\])]$")
_CODED = re.compile(r"([a-z]{2,5}[\s-]*\d{3,})\s+\((.+)\)")
_CODE = re.compile(r"[a-z]{2,5}\d{3,}")
_ENANTIOMER = re.compile(r"^\(+([rs])\)+[\s-]*|^\(([rs])[\s-]+")
_DEUTERIUM = re.compile(r"[\s-]*d(\d{1,2})$")


def iso_prefix(text: str) -> int:
    """Length of an ``iso`` that begins a name, one letter of it doubled or two of them swapped at most; else 0."""
    for length in (4, 3):
        head = text[:length]
        if set(head) == set("iso") and len(head) == length and spelling_distance(head, "iso", 1) <= 1:
            return length
    return 0


def name_key(name: str) -> str:
    """A compound name without case, salts, numbering and separators.

    Marks of isomers and labelled forms are short in print; they are written out here so
    that no spelling tolerance bridges them.
    """
    text = _NUMBERED.sub("", name.strip())
    before = None
    while before != text:
        before, text = text, _SALT.sub("", text)
    marks = []
    hand = _ENANTIOMER.match(text)
    if hand:
        marks.append((hand[1] or hand[2]) * 5)
        text = text[hand.end() :]
    branched = iso_prefix(text)
    if branched and len(text) > 8:
        marks.append("iso" * 3)
        text = text[branched:]
    heavy = _DEUTERIUM.search(text)
    if heavy and len(text) > 8:
        marks.append(f"ddddd{heavy[1]}")
        text = text[: heavy.start()]
    return re.sub(r"[^a-z0-9]", "", text) + "".join(marks)


def name_keys(label: str | None) -> tuple[str | None, list[str]]:
    """``(number inside the paper, name keys)`` of a label; null and blank labels have neither."""
    text = " ".join(fold_text(label).split()) if label else ""
    if not text:
        return None, []
    local = _LOCAL.fullmatch(text)
    if local:
        return local[1], [name_key(local[2])] if local[2] else []
    coded = _CODED.fullmatch(text)
    parts = [coded[1], coded[2]] if coded else [text]
    return None, [k for k in dict.fromkeys(map(name_key, parts)) if k]


def spelling_distance(a: str, b: str, most: int = 3) -> int:
    """Edits between two keys, a swap of neighbours counting as one; ``most + 1`` if there are more."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    two: list[int] = []
    one = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(one[j] + 1, row[-1] + 1, one[j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, two[j - 2] + 1)
            row.append(d)
        if min(row) > most:
            return most + 1
        two, one = one, row
    return min(one[-1], most + 1)


def canonical_doi(doi: Column) -> Column:
    """The doi itself: no blanks, case, resolver or closing punctuation; null if there is none."""
    return F.nullif(F.regexp_extract(F.regexp_replace(F.lower(doi), r"[\s ]+", ""), r"(10\.\d{4,9}/.*?)[.,;]*$", 1), F.lit(""))


def measurement_kind(text: Column) -> Column:
    """``ic50``, ``ki``, ``kd`` or whatever else is written, without separators and 'app'; null if blank."""
    return F.nullif(F.regexp_replace(F.regexp_replace(F.lower(text), r"[\s_.\-{}]+", ""), "(app|apparent)$", ""), F.lit(""))


def _filled(df: DataFrame, group: str) -> DataFrame:
    """``pub`` filled from rows of the same ``group`` where a row lacks it."""
    known = df.where(F.col("pub").isNotNull() & F.col(group).isNotNull()).groupBy(group).agg(F.min("pub").alias("__p"))
    return df.join(known, group, "left").withColumn("pub", F.coalesce("pub", "__p")).drop("__p")


def _with_names(df: DataFrame, label: str) -> DataFrame:
    """Adds ``local`` and ``names`` of a label column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            known = {text: name_keys(text) for text in pdf[label].dropna().unique()}
            found = [known.get(text, (None, [])) for text in pdf[label]]
            yield pdf.assign(local=[f[0] for f in found], names=[f[1] for f in found])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInPandas(run, f"{fields}, local string, names array<string>")


RECORD = "id pmcid doi pub_year compound_label target_key measurement_type raw_value unit value_num normalized_value_nm".split()
ACTIVITY = "activity_id molecule_id pref_name endpoint value_num units normalized_value_nm target_key assay_description document_id doi pub_year".split()


def entities(records: DataFrame, activities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """:func:`record_entities` and :func:`activity_entities` of the latest rows, with one dictionary of units for both."""
    a = settle(newest(records.where(F.col("id").isNotNull()), "id", "exported_at", RECORD), "records")
    b = settle(newest(activities.where(F.col("activity_id").isNotNull()), "activity_id", "loaded_at", ACTIVITY), "activities")
    printed, folded = units.parsed_printed(a, "id", "raw_value", "unit"), units.parsed_activities(b)
    aliases = units.aliases_of((printed, units.PRINTED), (folded, units.ACTIVITIES))
    return record_entities(a, units.printed_of(printed, "id", aliases)), activity_entities(b, units.activities_of(folded, aliases))


def record_entities(rows: DataFrame, quantities: DataFrame) -> DataFrame:
    """``id, pub, target, kind, year, local, names, number, nm`` of each record."""
    printed = quantities.withColumnRenamed("id", "__id")
    joined = rows.join(printed, F.col("id") == F.col("__id"), "left").withColumn("pub", canonical_doi(F.col("doi")))
    number = F.coalesce("number", "value_num")
    nm = F.coalesce("nm", F.when(F.col("unit").isNotNull(), F.col("normalized_value_nm")))
    shaped = _filled(joined, "pmcid").select(
        "id", "pub", F.col("target_key").alias("target"), measurement_kind(F.col("measurement_type")).alias("kind"), F.col("pub_year").alias("year"), "compound_label",
        F.when(number > 0, number).alias("number"), F.when(nm > 0, nm).alias("nm"),
    )
    named = settle(_with_names(shaped, "compound_label").drop("compound_label"), "named")  # read twice
    # what the paper calls 26b in one place is named beside the number in another
    alias = named.where(F.col("local").isNotNull() & (F.size("names") > 0)).select("pub", "local", F.explode("names").alias("n"))
    alias = alias.groupBy("pub", "local").agg(F.collect_set("n").alias("more")).withColumnRenamed("pub", "__pub").withColumnRenamed("local", "__local")
    both = named.join(alias, (F.col("pub") == F.col("__pub")) & (F.col("local") == F.col("__local")), "left")
    return both.withColumn("names", F.array_union("names", F.coalesce("more", F.array().cast("array<string>")))).drop("more", "__pub", "__local")


def activity_entities(rows: DataFrame, quantities: DataFrame) -> DataFrame:
    """``activity_id, molecule, pub, target, kind, year, local, names, number, nm, logs`` of each activity."""
    quantity = quantities.select(F.col("activity_id").alias("__id"), "nm", "kind")
    joined = rows.join(quantity.withColumnRenamed("kind", "scale"), F.col("activity_id") == F.col("__id"), "left").withColumn("pub", canonical_doi(F.col("doi")))
    shaped = _filled(joined, "document_id").select(
        "activity_id", F.col("molecule_id").alias("molecule"), "pub", F.col("target_key").alias("target"), measurement_kind(F.col("endpoint")).alias("kind"),
        F.col("pub_year").alias("year"), "pref_name", F.when(F.col("value_num") > 0, F.col("value_num")).alias("number"), F.when(F.col("nm") > 0, F.col("nm")).alias("nm"),
        (F.coalesce(F.col("scale"), F.lit("")) == "log").alias("logs"),
    )
    named = settle(_with_names(shaped, "pref_name").drop("pref_name"), "named")  # read three times
    # the same molecule is named in some of its rows and not in others
    known = named.where(F.col("molecule").isNotNull()).select("molecule", F.explode("names").alias("n")).groupBy("molecule").agg(F.collect_set("n").alias("more"))
    paper = named.where(F.col("molecule").isNotNull() & F.col("local").isNotNull()).groupBy("pub", "molecule").agg(F.min("local").alias("__local"))
    joined = named.join(known, "molecule", "left").join(
        paper.withColumnRenamed("pub", "__pub").withColumnRenamed("molecule", "__m"), (F.col("pub") == F.col("__pub")) & (F.col("molecule") == F.col("__m")), "left"
    )
    return joined.withColumn("names", F.array_union("names", F.coalesce("more", F.array().cast("array<string>")))).withColumn(
        "local", F.coalesce("local", "__local")
    ).drop("more", "__pub", "__m", "__local")


def _stacked(records: DataFrame, activities: DataFrame) -> DataFrame:
    """Both tables in one shape; ``side`` 0 are records."""
    shape = ["pub", "target", "kind", "year", "local", "names", "number", "nm"]
    a = records.select(F.lit(0).cast("byte").alias("side"), F.col("id").alias("key"), F.lit(None).cast("string").alias("molecule"), F.lit(False).alias("logs"), *shape)
    b = activities.select(F.lit(1).cast("byte").alias("side"), F.col("activity_id").cast("string").alias("key"), "molecule", "logs", *shape)
    return a.unionByName(b)


def digits(value: Column) -> Column:
    """The leading digits of a positive value, which stay the same whatever the error of its unit; null without one."""
    return F.round(value / F.pow(F.lit(10.0), F.floor(F.log10(value))), 4)


def sort_keys() -> dict[str, tuple[list[Column], bool]]:
    """The composite sort keys, and whether rows enter once for each of their names."""
    pub, target, kind = (F.coalesce(F.col(c), F.lit("")) for c in ("pub", "target", "kind"))
    name = F.coalesce(F.col("__name"), F.concat(F.lit("#"), "local"), F.lit("~"))
    value = F.coalesce(digits(F.coalesce("nm", "number")), F.lit(0.0))
    return {
        "publication, target, digits": ([pub, target, value, kind, name], False), "publication, target, name": ([pub, target, name, kind, value], True),
        "name, target, digits": ([name, target, kind, value, pub], True),
    }


def neighbourhoods(rows: DataFrame, order: list[Column], window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``rows`` in blocks of the global order, each with the first ``window`` rows of the next one.

    A row's place comes from its place in its range partition and the sizes of the
    partitions before, of which there are as many as shuffle partitions.
    """
    keyed = rows.withColumns({f"__k{n}": c for n, c in enumerate(order)})
    names = [f"__k{n}" for n in range(len(order))] + ["side", "key"]
    ordered = keyed.repartitionByRange(*names).sortWithinPartitions(*names).drop(*names[: len(order)])
    placed = settle(ordered.withColumn("__m", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("__m", 33)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    starts, at = [], 0
    for p, n in counts:
        starts.append((p, at))
        at += n
    spark = rows.sparkSession
    first = F.broadcast(spark.createDataFrame(starts or [(0, 0)], "__p long, __first long"))
    place = F.col("__first") + F.col("__m").bitwiseAND((1 << 33) - 1)
    numbered = placed.withColumn("__p", part).join(first, "__p").withColumn("__place", place).drop("__p", "__first", "__m")
    own = F.floor(F.col("__place") / block).cast("long")
    overlap = (F.col("__place") % block < window) & (own > 0)
    return numbered.withColumn("__block", F.explode(F.when(overlap, F.array(own, own - 1)).otherwise(F.array(own))))


NAME_SAME, NAME_CLOSE, NAME_NEAR, NAME_UNKNOWN, NAME_OTHER = 4, 3, 2, 1, 0
VALUE_EQUAL, VALUE_ROUNDED, VALUE_DIGITS, VALUE_SHIFTED, VALUE_UNKNOWN, VALUE_OTHER = 5, 4, 3, 2, 1, 0
#: Similarity of each grade, and the weight of each field in the confidence.
NAME_SCORE = (0.0, 0.4, 0.8, 0.9, 1.0)
VALUE_SCORE = (0.0, 0.4, 0.6, 0.85, 0.95, 1.0)
WEIGHTS = {"name": 0.4, "value": 0.25, "kind": 0.15, "publication": 0.2}


def _grams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 2] for i in range(len(text) - 1))


def name_grade(a: list[str], b: list[str], local_a: str | None, local_b: str | None) -> int:
    """How well two compounds' names agree."""
    if set(a) & set(b):
        return NAME_SAME
    if local_a and local_b:
        if local_a == local_b:
            return NAME_SAME
        if not a or not b:
            return NAME_OTHER
    if not b and not local_b:
        return NAME_UNKNOWN
    if not a and not local_a:
        return NAME_UNKNOWN
    best = 9
    for x in a:
        for y in b:
            if min(len(x), len(y)) < 8 and not (_CODE.fullmatch(x) and _CODE.fullmatch(y)):
                continue
            if _CODE.fullmatch(x) or _CODE.fullmatch(y):
                # digits of a code are never misspelt ones of another
                if re.sub(r"\D", "", x) == re.sub(r"\D", "", y) and spelling_distance(x, y, 1) == 1:
                    best = min(best, 3)
                continue
            if abs(len(x) - len(y)) <= 3:
                gx, gy = _grams(x), _grams(y)
                if 2 * len(gx & gy) >= 0.4 * (len(gx) + len(gy)):
                    best = min(best, spelling_distance(x, y))
    return NAME_CLOSE if best <= 2 else NAME_NEAR if best == 3 else NAME_OTHER


def two_figures(values: np.ndarray) -> np.ndarray:
    """Each value at two significant figures, NaN where it is missing."""
    return np.array([float(f"{x:.1e}") if x == x else np.nan for x in values])


def value_grades(nm_a: np.ndarray, number_a: np.ndarray, nm_b: np.ndarray, number_b: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """How well pairs of values agree; NaN stands for a missing one, ``logs`` says that the second came from a logarithm."""
    near = lambda ratio: np.abs(ratio - 1) < 1e-6
    with np.errstate(invalid="ignore", divide="ignore"):
        two_a, two_b, apart = two_figures(nm_a), two_figures(nm_b), np.log10(nm_a / nm_b)
        off = np.abs(apart - np.rint(apart))
        in_nm = np.select(
            [
                np.abs(nm_a - nm_b) / np.maximum(nm_a, nm_b) <= 0.002, near(two_a / nm_b) | near(two_b / nm_a) | (logs & (np.abs(apart) <= 0.0056)),
                (off <= np.where(logs, 0.0056, 0.001)) | near(two_a / two_b / 10.0 ** np.rint(apart)),
            ],
            [VALUE_EQUAL, VALUE_ROUNDED, VALUE_SHIFTED], VALUE_OTHER,
        )
        apart = np.log10(number_a / number_b)
        places = np.rint(apart)
        rounded = near(two_figures(number_a) / (number_b * 10.0**places)) | near(two_figures(number_b) * 10.0**places / number_a)
        plain = np.where((np.abs(apart - places) <= 0.001) | (rounded & (places % 3 == 0)), VALUE_DIGITS, VALUE_UNKNOWN)
    plain = np.where(np.isnan(number_a) | np.isnan(number_b), VALUE_UNKNOWN, plain)
    return np.where(np.isnan(nm_a) | np.isnan(nm_b), plain, in_nm)


def value_grade(nm_a: float, number_a: float, nm_b: float, number_b: float, logs: bool) -> int:
    """:func:`value_grades` of one pair."""
    return int(value_grades(*(np.array([x], dtype=float) for x in (nm_a, number_a, nm_b, number_b)), np.array([logs]))[0])


PAIR = "id string, activity_id long, molecule string, pub string, name_grade int, value_grade int, same_kind boolean, same_pub boolean, confidence double"


def compare_block(pdf: pd.DataFrame, window: int = WINDOW) -> pd.DataFrame:
    """Pairs of one block: each row with those up to ``window`` places behind it from the other table."""
    pdf = pdf.sort_values("__place", ignore_index=True)
    side, n = pdf["side"].to_numpy(), len(pdf)
    pub, target, kind, year = (pd.factorize(pdf[c])[0] for c in ("pub", "target", "kind", "year"))  # -1 is null
    names, local = [list(x) for x in pdf["names"]], [x if isinstance(x, str) else None for x in pdf["local"]]
    nm, number, logs = pdf["nm"].to_numpy(float), pdf["number"].to_numpy(float), pdf["logs"].to_numpy(bool)
    keys, molecules, pubs = pdf["key"].to_numpy(), pdf["molecule"].to_numpy(), pdf["pub"].to_numpy()
    shown = [(tuple(x), y) for x, y in zip(names, local)]
    code, known = pd.factorize(pd.Series(shown, dtype=object)) if n else (np.array([], dtype=int), [])
    one, two, sure = [], [], []
    for k in range(1, min(window, n - 1) + 1):
        i, j = np.arange(n - k), np.arange(k, n)
        same_pub = (pub[i] == pub[j]) & (pub[i] >= 0)
        open_pub = ((pub[i] < 0) | (pub[j] < 0)) & (year[i] == year[j]) & (year[i] >= 0)
        open_kind = (kind[i] == kind[j]) | (kind[i] < 0) | (kind[j] < 0)
        keep = (side[i] != side[j]) & (same_pub | open_pub) & (target[i] == target[j]) & (target[i] >= 0) & open_kind
        one.append(i[keep]), two.append(j[keep]), sure.append(same_pub[keep])
    columns = [c.split()[0] for c in PAIR.split(", ")]
    i, j, sure = (np.concatenate(x) if x else np.array([], dtype=int) for x in (one, two, sure))
    if not len(i):
        return pd.DataFrame(columns=columns)
    a, b, sure = np.where(side[i] == 0, i, j), np.where(side[i] == 0, j, i), sure.astype(bool)
    # names repeat a lot: each distinct pair of them is graded once
    pairs, back = np.unique(code[a].astype(np.int64) * len(known) + code[b], return_inverse=True)
    graded = np.array([_grade(known[p // len(known)], known[p % len(known)]) for p in pairs], dtype=int)[back]
    told = graded != NAME_OTHER
    a, b, sure, name = a[told], b[told], sure[told], graded[told]
    value = value_grades(nm[a], number[a], nm[b], number[b], logs[b])
    same_kind = (kind[a] == kind[b]) & (kind[a] >= 0)
    score = (
        WEIGHTS["name"] * np.array(NAME_SCORE)[name] + WEIGHTS["value"] * np.array(VALUE_SCORE)[value]
        + WEIGHTS["kind"] * np.where(same_kind, 1.0, 0.5) + WEIGHTS["publication"] * np.where(sure, 1.0, 0.5)
    )
    out = (keys[a], keys[b].astype(np.int64) if len(b) else np.array([], dtype=np.int64), molecules[b], pubs[a], name, value, same_kind, sure, score)
    return pd.DataFrame(dict(zip(columns, out))).drop_duplicates(["id", "activity_id"])


@lru_cache(maxsize=200_000)
def _grade(a: tuple[tuple[str, ...], str | None], b: tuple[tuple[str, ...], str | None]) -> int:
    return name_grade(list(a[0]), list(b[0]), a[1], b[1])


def candidate_pairs(records: DataFrame, activities: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """Distinct compared pairs (:data:`PAIR`) of both entity tables whose names don't contradict."""
    rows = settle(_stacked(records, activities), "entities")
    found = None
    for order, by_name in sort_keys().values():
        once = rows.withColumn("__name", F.explode_outer("names") if by_name else F.get("names", F.lit(0)))
        near = neighbourhoods(once, order, window, block).groupBy("__block").applyInPandas(lambda pdf: compare_block(pdf, window), PAIR)
        found = near if found is None else found.unionByName(near)
    return settle(found.distinct(), "pairs")


def _sure(name: Column, value: Column, same_kind: Column, same_pub: Column) -> Column:
    """Whether the evidence suffices.

    A named compound measured alike in one publication is a match whatever the value.
    Without a name, or a type, the value has to speak; without a publication everything has to.
    """
    named = (name >= NAME_CLOSE) | ((name == NAME_NEAR) & (value >= VALUE_ROUNDED))
    return F.when(
        same_pub,
        (named & same_kind)
        | (named & ~same_kind & value.isin(VALUE_EQUAL, VALUE_ROUNDED, VALUE_DIGITS, VALUE_SHIFTED))
        | ((name == NAME_UNKNOWN) & same_kind & (value >= VALUE_DIGITS))
        | ((name == NAME_UNKNOWN) & ~same_kind & (value == VALUE_EQUAL)),
    ).otherwise((name >= NAME_CLOSE) & same_kind & (value >= VALUE_ROUNDED))


def match_entities(records: DataFrame, activities: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``id, activity_id, confidence``: records with their activities.

    One to one, but for activities that are the same measurement, which follow one another.
    Null ids and rows without a target match nothing; rows without a name match by their
    value inside their publication.  Extra columns are ignored, empty tables give no rows.
    """
    own, theirs = (settle(df, name) for df, name in zip(entities(records, activities), ("own", "theirs")))
    pairs = candidate_pairs(own, theirs, window, block)
    name, value, same_kind, same_pub = (F.col(c) for c in ("name_grade", "value_grade", "same_kind", "same_pub"))
    # a nameless molecule found by one of its values names its other rows in that publication
    label = own.select(F.col("id").alias("__id"), F.coalesce(F.get("names", F.lit(0)), F.concat(F.lit("#"), "local")).alias("compound"))
    labelled = settle(pairs.join(label, F.col("id") == F.col("__id"), "left").drop("__id"), "labelled")
    best = labelled.where((name == NAME_UNKNOWN) & same_pub & same_kind & (value >= VALUE_DIGITS) & F.col("molecule").isNotNull() & F.col("compound").isNotNull())
    taught = best.groupBy(F.col("pub").alias("__pub"), F.col("molecule").alias("__m")).agg(F.max(F.struct("value_grade", "compound")).alias("b"))
    taught = taught.select("__pub", "__m", F.col("b.compound").alias("__c"))
    same = (F.col("pub") == F.col("__pub")) & (F.col("molecule") == F.col("__m")) & (F.col("compound") == F.col("__c")) & (name == NAME_UNKNOWN)
    learned = labelled.join(taught, same, "left")
    gain = WEIGHTS["name"] * (NAME_SCORE[NAME_CLOSE] - NAME_SCORE[NAME_UNKNOWN])
    learned = learned.select(
        "id", "activity_id", "value_grade", "same_kind", "same_pub",
        F.when(F.col("__c").isNotNull(), F.lit(NAME_CLOSE)).otherwise(name).alias("name_grade"),
        F.when(F.col("__c").isNotNull(), F.col("confidence") + gain).otherwise(F.col("confidence")).alias("confidence"),
    )
    accepted = settle(learned.where(_sure(name, value, same_kind, same_pub)).select("id", "activity_id", "confidence"), "accepted")
    return assign(accepted, same_measurements(theirs))


def same_measurements(activities: DataFrame) -> DataFrame:
    """``activity_id, entity``: activities of one molecule, publication, target, type and digits are one entity, named by the least of them.

    An activity that lacks any of these is an entity of its own.
    """
    alike = [F.col("molecule"), F.col("pub"), F.col("target"), F.col("kind"), digits(F.coalesce("nm", "number")).cast("string")]
    whole = F.lit(True)
    for c in alike:
        whole = whole & c.isNotNull()
    keyed = activities.select("activity_id", F.when(whole, F.xxhash64(*alike)).alias("h"), F.when(whole, F.concat_ws("|", *alike)).alias("k"))
    named = keyed.where(F.col("k").isNotNull()).groupBy("h", "k").agg(F.min("activity_id").alias("entity"))
    joined = keyed.alias("a").join(named.alias("n"), (F.col("a.h") == F.col("n.h")) & (F.col("a.k") == F.col("n.k")), "left")
    return joined.select("a.activity_id", F.coalesce("n.entity", "a.activity_id").alias("entity"))


#: Confidences are whole numbers of these steps in the assignment.
STEPS = 10_000
#: Edges up to which one task solves a component exactly; larger ones are solved by bids over all tasks.
LARGE = 20_000


def assign(pairs: DataFrame, members: DataFrame, large: int = LARGE) -> DataFrame:
    """``id, activity_id, confidence``: records and entities one to one with the greatest total confidence, members following.

    ``pairs``: id, activity_id, confidence.  ``members``: activity_id, entity.  An entity
    that the assignment leaves over is one more entry, with another value, of the
    measurement of the record it pairs best with, and follows that record; ties go to the
    smaller id.
    """
    joined = pairs.join(members, "activity_id")
    edges = settle(joined.groupBy("id", "entity").agg(F.max("confidence").alias("confidence")), "edges")
    taken = settle(one_to_one(edges, large), "taken")
    over = edges.join(taken.select("entity"), "entity", "left_anti").groupBy("entity").agg(F.min(F.struct((-F.col("confidence")).alias("c"), "id")).alias("b"))
    chosen = taken.join(edges, ["id", "entity"]).select("id", "entity", "confidence").unionByName(over.select("b.id", "entity", (-F.col("b.c")).alias("confidence")))
    own = joined.select("id", "activity_id", F.col("confidence").alias("__own"))
    out = chosen.join(members, "entity").join(own, ["id", "activity_id"], "left")
    return out.select("id", "activity_id", F.round(F.coalesce("__own", "confidence"), 6).alias("confidence"))


def one_to_one(edges: DataFrame, large: int = LARGE) -> DataFrame:
    """``id, entity`` of the one-to-one assignment with the greatest total ``confidence``.

    A pair that competes with no other is taken as it is.  The others form connected
    components, which are independent of each other: each is solved exactly by augmenting
    paths, or, above ``large`` edges, by an auction, whose total is less than the greatest
    by at most :data:`BID` steps for each entity.
    """
    of_id, of_entity = (edges.groupBy(c).agg(F.count("*").alias(f"__{c}")) for c in ("id", "entity"))
    ranked = edges.join(of_id, "id").join(of_entity, "entity").withColumn("w", F.round(F.col("confidence") * STEPS).cast("long"))
    ranked = settle(ranked, "ranked")
    alone = (F.col("__id") == 1) & (F.col("__entity") == 1)
    contested = ranked.where(~alone).select("id", "entity", "w")
    links = contested.select(F.concat(F.lit("e"), F.col("entity").cast("string")).alias("u"), F.concat(F.lit("r"), "id").alias("v"))
    found = components(links).withColumnRenamed("node", "__node")
    grouped = settle(contested.join(found, F.concat(F.lit("r"), "id") == F.col("__node")).drop("__node"), "contested")
    sizes = grouped.groupBy("component").agg(F.count("*").alias("n"))
    small = grouped.join(sizes.where(F.col("n") <= large).select("component"), "component", "left_semi")
    taken = ranked.where(alone).select("id", "entity").unionByName(small.groupBy("component").applyInPandas(best_assignment, "id string, entity long"))
    big = sizes.where(F.col("n") > large).select("component")
    if big.limit(1).count():
        taken = taken.unionByName(auction(grouped.join(big, "component", "left_semi").select("id", "entity", "w")))
    return taken


def best_assignment(pdf: pd.DataFrame) -> pd.DataFrame:
    """One-to-one pairs ``id, entity`` of the greatest total ``w``, by successive best augmenting paths.

    Ties go to the smaller ids.  Entities enter one by one; a path may leave another entity
    without a record if that is worth more.
    """
    pdf = pdf.sort_values(["entity", "id"])
    entities_, ids = pdf["entity"].unique(), pdf["id"].unique()
    place = {x: n for n, x in enumerate(ids)}
    wanted: list[list[tuple[int, int]]] = [[] for _ in entities_]
    of = {x: n for n, x in enumerate(entities_)}
    for entity, own, w in zip(pdf["entity"], pdf["id"], pdf["w"]):
        wanted[of[entity]].append((place[own], int(w)))
    holder, held = [-1] * len(ids), [-1] * len(entities_)
    weight = [dict(x) for x in wanted]
    for first in range(len(entities_)):
        # gain[e]: what the matching gains if e is the one left free, after moves along a path from the new entity
        gain, come, queue = {first: 0}, {first: (-1, -1)}, deque([first])
        best, end = 0, (first, -1)
        while queue:
            e = queue.popleft()
            for r, w in wanted[e]:
                reached = gain[e] + w
                other = holder[r]
                if other == e:
                    continue
                if other < 0:
                    if reached > best:
                        best, end = reached, (e, r)
                    continue
                left = reached - weight[other][r]
                if left > gain.get(other, -(1 << 60)):
                    gain[other], come[other] = left, (e, r)
                    queue.append(other)
                    if left > best:
                        best, end = left, (other, -1)
        if best <= 0:
            continue
        node, r = end
        if r >= 0:
            moves = [(node, r)]
        else:  # this entity gives its record up
            moves, held[node] = [], -1
        while node != first:
            node, r = come[node]
            moves.append((node, r))
        for e, r in moves:
            holder[r], held[e] = e, r
    rows = [(ids[r], int(entities_[e])) for e, r in enumerate(held) if r >= 0]
    return pd.DataFrame(rows, columns=["id", "entity"])


#: Step by which bids of the auction rise above the second best offer.
BID = 25


def auction(edges: DataFrame, bid: int = BID) -> DataFrame:
    """``id, entity`` of a one-to-one assignment by an auction in rounds; each round is a few aggregations over all tasks.

    Entities without a record bid for their best one, as much as it is worth to them beyond
    the second best; each record goes to the highest bidder.
    """
    edges = settle(edges, "bidders")
    spark = edges.sparkSession
    owned = settle(spark.createDataFrame([], "id string, entity long, price long"), "owned")
    while True:
        free = edges.join(owned.select("entity"), "entity", "left_anti").join(owned.select("id", "price"), "id", "left")
        offers = free.withColumn("net", F.col("w") - F.coalesce("price", F.lit(0)))
        top = offers.groupBy("entity").agg(F.max(F.struct("net", "id", "w")).alias("b"))
        second = offers.join(top, "entity").where(F.col("id") != F.col("b.id")).groupBy("entity").agg(F.max("net").alias("second"))
        raised = F.col("b.w") - F.greatest(F.coalesce("second", F.lit(0)), F.lit(0)) + bid
        bids = top.where(F.col("b.net") > 0).join(second, "entity", "left").select(F.col("b.id").alias("id"), "entity", raised.alias("price"))
        won = settle(bids.groupBy("id").agg(F.max(F.struct("price", "entity")).alias("b")).select("id", "b.entity", "b.price"), "won")
        if not won.limit(1).count():
            return owned.select("id", "entity")
        before, owned = owned, settle(owned.join(won.select("id"), "id", "left_anti").unionByName(won), "owned")
        discard(before)
        discard(won)
