"""Quantities in different units brought to nM (problem 2).

Every phrase that may name a unit (what follows the number in a printed value, the
unit field, the column header, the assay description) is reduced to its *distinct*
spellings first.  A spelling finds the entries of a small lexicon through an inverted
index of character bigrams, a weighted edit distance verifies the candidates, and the
resulting alias dictionary is joined to all rows.  Letters that decide between scales
(n, u, m, p of ``nmol/l``) can't be substituted; short spellings must be exact.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayweave.functions.textfold import fold
from assayweave.session import settle

# Power of ten that takes each prefix to nM.
PREFIXES = {"f": -6, "p": -3, "n": 0, "u": 3, "m": 6, "": 9}
WORDS = {"femto": -6, "pico": -3, "nano": 0, "micro": 3, "milli": 6}
AMOUNTS = ("mol", "mole", "moles")
VOLUMES = ("/l", "l-1", "/liter", "/litre", "/dm3", "dm-3")
LOGS = ("pic50", "pki", "pkd", "pec50", "-log(m)", "-log[m]", "-logm", "-log10(m)", "-log10m", "p[m]", "-logic50(m)", "-logki(m)", "-logkd(m)", "-logec50(m)")
MASSES = tuple(f"{a}g{sep}{b}" for a in ("p", "n", "u", "m", "k", "") for sep, b in (("/", "ml"), ("/", "l"), ("/", "dl"), ("/", "ul"), ("/", "kg"), ("", "ml-1"), ("", "l-1")))
PERCENTS = ("%", "percent", "%inhibition", "%inh", "%control")


def lexicon() -> list[tuple[str, str, int]]:
    """``(spelling, kind, power of ten to nM)``; a constant of some 250 entries."""
    rows = []
    for prefix, power in PREFIXES.items():
        rows += [(f"{prefix}m", "molar", power)]
    for prefix, power in (*PREFIXES.items(), *WORDS.items()):
        rows += [(f"{prefix}{amount}{volume}", "molar", power) for amount in AMOUNTS for volume in VOLUMES]
        rows += [(f"{prefix}mol/ml", "molar", power + 3), (f"{prefix}molar", "molar", power)]
    rows += [(s, "log", 0) for s in LOGS] + [(s, "mass", 0) for s in MASSES] + [(s, "percent", 0) for s in PERCENTS]
    return list(dict.fromkeys(rows))


_POWER = re.compile(r"^\W*?(?:x|\*)?\s*10\s*['^]*\s*([+-]?\d{1,2})\s*(?=[a-z(])")
_TAIL = re.compile(r"\s*(?:±|\+/-)\s*(?:sem|sd|s\.e\.m\.?|s\.d\.?)\s*$")
_LOG_HEAD = re.compile(r"(?:^|[^a-z])(p(?:ic50|ki|kd|ec50))(?![a-z0-9])")
_LOG_PHRASE = re.compile(r"(?:^|[^a-z0-9])(-\s*log(?:10)?)\s*(?:ic-?50|ki|kd|ec50)?\s*[(\[]?m[)\]]?\s*$")


def squash(spelling: str) -> str:
    """A spelling without what never tells units apart: blanks, dots, product signs, carets; ``per`` is a slash."""
    return re.sub(r"[\s.^'*·_]+", "", re.sub(r"(?<=[a-z])\s+per\s+(?=[a-z])", "/", spelling))


def split_power(spelling: str) -> tuple[int, str]:
    """``x10-8 mol/l`` as ``(-8, 'mol/l')``; without a power ``(0, spelling)``."""
    found = _POWER.match(spelling)
    return (int(found[1]), spelling[found.end() :]) if found else (0, spelling)


_BRACKETS = re.compile(r"[(\[]([^()\[\]]+)[)\]]")
_NOTE = re.compile(r"\s*[(\[][^()\[\]]*[)\]]")


def _endings(text: str) -> list[str]:
    """What follows the last of some words and signs, and the last words."""
    out = []
    for mark in (r"\bin\s+", r"\bare\s+", r",\s*", r"\s/\s*", r"\|\s*"):
        parts = re.split(mark, text)
        if len(parts) > 1:
            out.append(parts[-1])
    words = text.split()
    return out + [" ".join(words[-k:]) for k in (3, 2, 1) if len(words) > k]


def candidates(phrase: str) -> list[str]:
    """Spellings that may be the unit of a folded phrase, likeliest first."""
    text = _TAIL.sub("", phrase.strip())
    out = []
    if "%" in text:
        return ["%"]
    if _LOG_PHRASE.search(text):
        return ["-log(m)"]
    head = _LOG_HEAD.search(text)
    if head:
        return [head[1]]
    out.append(text)
    out += reversed(_BRACKETS.findall(text))
    out += _endings(text)
    bare = _NOTE.sub(" ", text).strip()
    if bare != text:  # a unit may be followed by a bracketed note
        out += [bare, *_endings(bare)]
    cleaned = (re.sub(r"\s*(?:scale|units?)\s*$", "", c).strip(" ,;:()") if not c.startswith("-log") else c for c in out)
    return list(dict.fromkeys(c for c in cleaned if c))


def grams(text: str) -> list[str]:
    padded = f"^{text}$"
    return list(dict.fromkeys(padded[i : i + 2] for i in range(len(padded) - 1)))


_SCALE = set("fpnum")


def weighted_distance(a: str, b: str) -> float:
    """Edit distance whose costs follow what confuses readers.

    Separators cost 0.2, a doubled or dropped letter 0.7, another letter 1; touching a
    scale letter in the first place, or a digit, costs 9, because that is another unit.
    """

    def cost(ch: str, place: int) -> float:
        if ch in "/-()[] ":
            return 0.2
        return 9.0 if ch.isdigit() or (place == 0 and ch in _SCALE) else 0.7

    row = [0.0]
    for j, ch in enumerate(b):
        row.append(row[-1] + cost(ch, j))
    for i, x in enumerate(a):
        new = [row[0] + cost(x, i)]
        for j, y in enumerate(b):
            if x == y:
                swap = 0.0
            elif x.isdigit() or y.isdigit() or (min(i, j) == 0 and (x in _SCALE or y in _SCALE)):
                swap = 9.0
            elif x in "/-([])" and y in "/-([])":
                swap = 0.2
            else:
                swap = 1.0
            new.append(min(row[j] + swap, row[j + 1] + cost(x, i), new[-1] + cost(y, j)))
        row = new
    return row[-1]


#: A misspelt spelling has at least so many characters, shares this part of its bigrams
#: with the entry, and is no further from it than this part of the entry's length.
LEAST_FUZZY = 5
LEAST_SHARED = 0.6
MOST_DISTANCE = 0.2


def most_grams() -> int:
    """Bigrams beyond which no spelling can share :data:`LEAST_SHARED` with any entry: a consequence, no cut."""
    longest = max(len(grams(entry)) for entry, _, _ in lexicon())
    return int(longest * (2 - LEAST_SHARED) / LEAST_SHARED)


def alias_dictionary(phrases: DataFrame) -> DataFrame:
    """``(phrase, kind, power)`` of the distinct folded ``phrase`` values that name a unit.

    Spellings are distinct before the index is probed, and the index has as many rows
    as the constant lexicon has bigrams, so the join stays small whatever the rows are.
    """
    spark, most = phrases.sparkSession, most_grams()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for phrase in pdf["phrase"]:
                for place, spelling in enumerate(candidates(phrase)):
                    power, rest = split_power(spelling)
                    key = squash(rest)
                    if key and len(grams(key)) <= most:
                        rows.append((phrase, place, power, key))
            yield pd.DataFrame(rows, columns=["phrase", "place", "shift", "key"])

    # few rows, but each takes time: spread over all tasks, and worked out once for its two readers
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spelled = settle(phrases.repartition(tasks).mapInPandas(cut, "phrase string, place int, shift int, key string"), "spelled")
    aliases = _resolve(spark, spelled.select("key").distinct())
    best = (
        spelled.join(aliases, "key")
        .groupBy("phrase")
        .agg(F.min_by(F.struct("kind", (F.col("power") + F.col("shift")).alias("power")), F.struct("place", "distance")).alias("u"))
    )
    return settle(best.select("phrase", "u.kind", "u.power"), "aliases")


def _resolve(spark: SparkSession, keys: DataFrame) -> DataFrame:
    """``(key, kind, power, distance)`` of the spellings that match a lexicon entry."""
    entries = lexicon()
    index = spark.createDataFrame(
        [(gram, entry, len(grams(entry)), kind, power) for entry, kind, power in entries for gram in grams(entry)],
        "gram string, entry string, entry_grams int, kind string, power int",
    )
    known = spark.createDataFrame(entries, "entry string, kind string, power int")
    exact = keys.join(F.broadcast(known), F.col("key") == F.col("entry")).groupBy("key").agg(F.min(F.struct("kind", "power")).alias("b"))
    exact = exact.select("key", "b.kind", "b.power", F.lit(0.0).alias("distance"))
    # only long spellings that are no entry themselves can be misspelt ones
    rest = keys.join(exact.select("key"), "key", "left_anti").where(F.length("key") >= LEAST_FUZZY)
    padded = F.concat(F.lit("^"), "key", F.lit("$"))
    of_key = F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 1), lambda i: F.substring(padded, i, F.lit(2))))
    probed = rest.withColumn("own", of_key).select("key", F.size("own").alias("key_grams"), F.explode("own").alias("gram"))
    near = (
        probed.join(F.broadcast(index), "gram")
        .groupBy("key", "entry", "kind", "power")
        .agg(F.count("*").alias("shared"), F.first("key_grams").alias("key_grams"), F.first("entry_grams").alias("entry_grams"))
        .where(2 * F.col("shared") >= LEAST_SHARED * (F.col("key_grams") + F.col("entry_grams")))
    )

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            far = np.array([weighted_distance(a, b) for a, b in zip(pdf["key"], pdf["entry"])], dtype=float)
            yield pdf.assign(distance=far)[far <= MOST_DISTANCE * pdf["entry"].str.len().to_numpy(dtype=float)]

    # few pairs, but each takes time: spread over all tasks; a map, which no filter is pushed through
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pairs = near.select("key", "entry", "kind", "power").repartition(tasks)
    close = pairs.mapInPandas(verify, "key string, entry string, kind string, power int, distance double")
    best = close.groupBy("key").agg(F.min(F.struct("distance", "entry", "kind", "power")).alias("b"))
    return exact.unionByName(best.select("key", "b.kind", "b.power", "b.distance"))


# The printed value: relation, log prefix, number, power of ten, deviation, rest.
_GROUPED = r"[1-9]\d{0,2}(?:,\d{3})+(?:\.\d+)?|[1-9]\d{0,2}(?: \d{3})+(?:[.,]\d+)?"
_PLAIN = r"\d+(?:[.,]\d+)?|\.\d+"
VALUE = (
    r"^\s*[<>=~≈≤≥]{0,2}\s*((?:p\s*(?:ic50|ki|kd|ec50)|-\s*log(?:10)?\s*(?:ic50|ki|kd|ec50)?\s*(?:\(m\)|\[m\])?)?)\s*[:=]?\s*[<>=~≈≤≥]{0,2}\s*"
    rf"((?:{_GROUPED}|{_PLAIN})(?![\d]))((?:e[+-]?\d{{1,2}})?)((?:\s*[x*]\s*10\s*\^?\s*[+-]?\d{{1,2}})?)"
    r"((?:\s*(?:±|\+/-)\s*[\d.,]*\d(?:e[+-]?\d+)?)?)\s*(.*?)\s*$"
)

# Digits that belong to a unit's spelling: per litre, per cubic decimetre, -log10.
UNIT_DIGITS = r"(?:l|dm)\s*\^?\s*-\s*[13](?!\d)|dm3|log10"


def parse_printed(folded: Column) -> Column:
    """Struct ``number`` (double, null unless one number is printed), ``log`` and ``rest`` of a folded value.

    The pattern runs once: its groups come as one array, which a lambda binds.
    """
    groups = F.split(F.regexp_replace(folded, VALUE, "\u0001".join(f"${n}" for n in range(1, 7))), "\u0001")

    def read(g: Column) -> Column:
        whole = F.size(g) == 6
        part = lambda n: F.when(whole, F.get(g, F.lit(n - 1))).otherwise("")
        digits = part(2)
        grouped = digits.rlike(r"^[1-9]\d{0,2}([, ]\d{3})+([.,]\d+)?$")
        plain = F.when(grouped, F.regexp_replace(F.regexp_replace(digits, r"[, ](?=\d{3})", ""), ",", ".")).otherwise(F.regexp_replace(digits, ",", "."))
        exponent = F.regexp_extract(part(4), r"10\s*\^?\s*([+-]?\d{1,2})$", 1)
        base = F.concat(plain, part(3)).try_cast("double")
        number = F.when(exponent == "", base).otherwise(F.concat(plain, F.lit("e"), exponent).try_cast("double"))
        return F.struct(F.when(digits != "", number).alias("number"), F.when(part(1) != "", F.lit("log")).alias("log"), F.nullif(part(6), F.lit("")).alias("rest"))

    return F.get(F.transform(F.array(groups), read), F.lit(0))


def _phrases(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct non-null values of the columns."""
    return (
        df.select(F.explode(F.array(*columns)).alias("phrase")).where(F.col("phrase").isNotNull()).distinct()
    )


def _with_unit(df: DataFrame, aliases: DataFrame, column: str, name: str) -> DataFrame:
    """``df`` with struct ``name`` = (kind, power) of its ``column``; null where it names no unit."""
    side = aliases.select(F.col("phrase").alias(f"__{name}"), F.struct("kind", "power").alias(name))
    return df.join(side, F.col(column) == F.col(f"__{name}"), "left").drop(f"__{name}")


def to_nanomolar(number: Column, unit: Column) -> Column:
    """``number`` in nM by ``unit`` (kind, power); null where no conversion exists."""
    molar = number * F.pow(F.lit(10.0), unit["power"].cast("double"))
    log = F.pow(F.lit(10.0), F.lit(9.0) - number)
    return F.when(unit["kind"] == "molar", molar).when(unit["kind"] == "log", log)


def parsed_printed(rows: DataFrame, key: str, value: str, unit: str) -> DataFrame:
    """``key, u, number, log, rest`` of printed values: what :func:`printed_of` needs."""
    folded = rows.select(key, fold(F.col(value)).alias("t"), F.trim(fold(F.col(unit))).alias("u"))
    return settle(folded.select(key, "u", parse_printed(F.col("t")).alias("p")).select(key, "u", "p.*"), "printed")


def printed_of(parsed: DataFrame, key: str, aliases: DataFrame) -> DataFrame:
    """``key, number, nm`` of a printed value with its own or its field's unit; both may be null."""
    joined = _with_unit(_with_unit(parsed, aliases, "rest", "by_text"), aliases, "u", "by_unit")
    return joined.select(key, "number", to_nanomolar(F.col("number"), F.coalesce(F.col("by_text"), F.col("by_unit"))).alias("nm"))


def parsed_literature(rows: DataFrame) -> DataFrame:
    """What :func:`literature_of` needs of the extracted values that print one number."""
    folded = rows.select(
        "value_id", "normalized_value_nm", fold(F.col("value_text")).alias("t"), F.trim(fold(F.col("unit"))).alias("u"), F.trim(fold(F.col("column_header"))).alias("h"),
    )
    parsed = folded.select("value_id", "normalized_value_nm", "u", "h", parse_printed(F.col("t")).alias("p")).select("value_id", "normalized_value_nm", "u", "h", "p.*")
    # a digit after the number, other than in the unit's own spelling, is a range or an alternative
    single = ~F.coalesce(F.regexp_replace("rest", UNIT_DIGITS, ""), F.lit("")).rlike(r"\d")
    # without a single number nothing can be converted, whatever the unit is
    return settle(parsed.where(F.col("number").isNotNull() & single), "numbered")


def literature_of(parsed: DataFrame, aliases: DataFrame) -> DataFrame:
    """``value_id, nm, normalized_value_nm``: a value's own unit prevails over the unit field, that over the header."""
    joined = parsed
    for column, name in (("rest", "by_text"), ("u", "by_unit"), ("h", "by_header")):
        joined = _with_unit(joined, aliases, column, name)
    log = F.when(F.col("log").isNotNull(), F.struct(F.lit("log").alias("kind"), F.lit(0).alias("power")))
    unit = F.coalesce(log, F.col("by_text"), F.col("by_unit"), F.col("by_header"))
    return joined.select("value_id", to_nanomolar(F.col("number"), unit).alias("nm"), "normalized_value_nm")


def parsed_activities(rows: DataFrame) -> DataFrame:
    """What :func:`activities_of` needs of the activities that have a number."""
    return settle(
        rows.select(
            "activity_id", "normalized_value_nm", F.col("value_num").alias("number"), F.trim(fold(F.col("units"))).alias("u"), F.trim(fold(F.col("assay_description"))).alias("a"),
        ).where(F.col("number").isNotNull() & ~F.isnan("number")), "folded"
    )


def activities_of(parsed: DataFrame, aliases: DataFrame) -> DataFrame:
    """``activity_id, nm, kind, normalized_value_nm``; ``units`` prevails over the assay description."""
    joined = _with_unit(_with_unit(parsed, aliases, "u", "by_unit"), aliases, "a", "by_assay")
    unit = F.coalesce(F.col("by_unit"), F.col("by_assay"))
    return joined.select("activity_id", to_nanomolar(F.col("number"), unit).alias("nm"), unit["kind"].alias("kind"), "normalized_value_nm")


#: Columns of the parsed tables that may name a unit.
PRINTED, LITERATURE, ACTIVITIES = ("rest", "u"), ("rest", "u", "h"), ("u", "a")


def aliases_of(*parts: tuple[DataFrame, tuple[str, ...]]) -> DataFrame:
    """One alias dictionary for the phrases of several parsed tables."""
    phrases = None
    for parsed, columns in parts:
        found = _phrases(parsed, *columns)
        phrases = found if phrases is None else phrases.unionByName(found)
    return alias_dictionary(phrases.distinct() if len(parts) > 1 else phrases)


def printed_quantities(rows: DataFrame, key: str, value: str, unit: str) -> DataFrame:
    """``key, number, nm`` of a printed value with its own or its field's unit; both may be null."""
    parsed = parsed_printed(rows, key, value, unit)
    return printed_of(parsed, key, aliases_of((parsed, PRINTED)))


def literature_quantities(rows: DataFrame) -> DataFrame:
    """``value_id, nm, normalized_value_nm`` of extracted values that print one number.

    The number is the one printed in ``value_text``; its own unit prevails over the unit
    field, that over the header.  Ranges, alternatives and missing values have no row; ``nm`` is null
    for percentages, mass per volume and where no unit is named.
    """
    parsed = parsed_literature(rows)
    return literature_of(parsed, aliases_of((parsed, LITERATURE)))


def database_quantities(rows: DataFrame) -> DataFrame:
    """``activity_id, nm, kind, normalized_value_nm`` of activities; ``units`` prevails over the assay description."""
    parsed = parsed_activities(rows)
    return activities_of(parsed, aliases_of((parsed, ACTIVITIES)))


def wrong(nm: Column, stored: Column, tolerance: float = 0.01) -> Column:
    """Whether the stored value is missing or off by more than ``tolerance`` of the converted one."""
    off = F.abs(stored - nm) > tolerance * F.abs(nm) * (1 + 1e-9)
    return nm.isNotNull() & (stored.isNull() | F.isnan(stored) | off)


def quantities(extracted: DataFrame, activities: DataFrame) -> DataFrame:
    """``tab, row_id, nm, stored`` of both tables, with one alias dictionary for all their phrases."""
    a, b = parsed_literature(extracted), parsed_activities(activities)
    aliases = aliases_of((a, LITERATURE), (b, ACTIVITIES))
    parts = [("llm_extract", "value_id", literature_of(a, aliases)), ("chembl_activity", "activity_id", activities_of(b, aliases))]
    shaped = [df.select(F.lit(name).alias("tab"), F.col(key).cast("long").alias("row_id"), "nm", F.col("normalized_value_nm").alias("stored")) for name, key, df in parts]
    return shaped[0].unionByName(shaped[1])


def misconverted(extracted: DataFrame, activities: DataFrame) -> DataFrame:
    """``tab, row_id`` of the rows whose stored nM value is missing or wrong."""
    return quantities(extracted, activities).where(wrong(F.col("nm"), F.col("stored"))).select("tab", "row_id").distinct()
