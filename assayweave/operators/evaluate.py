"""Scoring of predictions against annotated truth."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assayweave.functions import scalars

# What the evaluation accepts.
EVALUATED_UNITS = {"nM": 0, "uM": 3, "µM": 3, "μM": 3, "mM": 6, "M": 9}
EVALUATED_RELATIONS = ("=", "<", ">", "<=", ">=")
EVALUATED_ENDPOINTS = ("Ki", "IC50")
IDENTITY = ["pmcid", "table_id", "compound_label", "measurement_type", "target"]


def molar_key(value: Column, unit: Column) -> Column:
    """An exact key of a molar value: digits without trailing zeros and the exponent in nM.

    Works on the decimal text, so 1 µM, 1000 nM and 0.001 mM have one key and nothing is
    rounded.  Null for missing values and unknown units.
    """
    power = F.lit(None).cast("int")
    for name, n in EVALUATED_UNITS.items():
        power = F.when(unit == name, n).otherwise(power)
    text = value.cast("string")
    mantissa = F.regexp_extract(text, r"^-?([0-9.]+)", 1)
    exponent = F.coalesce(F.nullif(F.regexp_extract(text, r"[eE]([+-]?[0-9]+)$", 1), F.lit("")).cast("int"), F.lit(0))
    whole, fraction = F.split(mantissa, r"\.").getItem(0), F.coalesce(F.get(F.split(mantissa, r"\."), F.lit(1)), F.lit(""))
    digits = F.regexp_replace(F.concat(whole, fraction), "^0+", "")
    bare = F.regexp_replace(digits, "0+$", "")
    scale = exponent - F.length(fraction) + power + F.length(digits) - F.length(bare)
    sign = F.when(value < 0, "-").otherwise("")
    return F.when(power.isNotNull() & value.isNotNull(), F.when(bare == "", "0").otherwise(F.concat(sign, bare, F.lit("e"), scale.cast("string"))))


def invalid_reason(df: DataFrame) -> Column:
    """Why a scoped row can't be evaluated, null if it can."""
    value, unit, relation = F.col("value"), F.col("unit"), F.col("relation")
    return (
        F.when(F.trim(F.coalesce("compound_label", F.lit(""))) == "", "compound_label")
        .when(~F.coalesce(F.col("measurement_type").isin(*EVALUATED_ENDPOINTS), F.lit(False)), "measurement_type")
        .when(F.col("target").isNull(), "target")
        .when(value.isNotNull() & (F.isnan(value) | (F.abs(value) == float("inf"))), "value")
        .when(value.isNotNull() & ~F.coalesce(unit.isin(*EVALUATED_UNITS), F.lit(False)), "unit")
        .when(value.isNotNull() & ~F.coalesce(relation.isin(*EVALUATED_RELATIONS), F.lit(False)), "relation")
    )


def in_scope(predictions: DataFrame, scope: DataFrame) -> DataFrame:
    """Rows of the declared tables; the others are ignored whatever they hold."""
    return predictions.join(scope.select("pmcid", "table_id").distinct(), ["pmcid", "table_id"], "left_semi")


def validate(predictions: DataFrame, gold: DataFrame, scope: DataFrame, missing: DataFrame) -> None:
    """Raises ValueError for malformed scoped rows, empty or contradictory truth."""
    for name, df in (("gold", gold), ("prediction", in_scope(predictions, scope))):
        bad = df.withColumn("why", invalid_reason(df)).where(F.col("why").isNotNull()).groupBy("why").count().orderBy("why").first()
        if bad is not None:
            raise ValueError(f"{bad['count']} {name} rows have a bad {bad['why']}")
    numeric = gold.where(F.col("value").isNotNull())
    if numeric.limit(1).count() == 0:
        raise ValueError("the truth holds no number")
    if numeric.join(missing, IDENTITY, "left_semi").limit(1).count():
        raise ValueError("a measurement is annotated both as a number and as missing")


def keyed(df: DataFrame) -> DataFrame:
    """Adds ``molar``, the exact value of the bag key."""
    return df.withColumn("molar", molar_key(F.col("value"), F.col("unit")))


def bag_counts(predictions: DataFrame, gold: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, predicted, expected, tp, fp, fn`` of two bags; one full join of their counts."""
    a = predictions.groupBy(*keys).agg(F.count("*").alias("predicted"))
    b = gold.groupBy(*keys).agg(F.count("*").alias("expected"))
    renamed = b.select(*[F.col(k).alias(f"__key_{k}") for k in keys], "expected")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    zero = F.lit(0).cast("long")
    both = a.join(renamed, same, "full").select(
        *[F.coalesce(k, f"__key_{k}").alias(k) for k in keys], F.coalesce("predicted", zero).alias("predicted"), F.coalesce("expected", zero).alias("expected")
    )
    least = F.least("predicted", "expected")
    return both.withColumns({"tp": least, "fp": F.col("predicted") - least, "fn": F.col("expected") - least})


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.when(b > 0, a / b).otherwise(0.0)


def percent(a: Column, b: Column) -> Column:
    """100 a / b with one decimal, null where b is 0."""
    return F.when(b > 0, F.round(100.0 * a / b, 1))


def scores(counts: DataFrame) -> DataFrame:
    """One row: ``tp, fp, fn, precision, recall, f1`` of bag counts."""
    total = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(c) for c in ("tp", "fp", "fn")])
    p, r = ratio(F.col("tp"), F.col("tp") + F.col("fp")), ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return total.select("tp", "fp", "fn", p.alias("precision"), r.alias("recall"), ratio(2 * p * r, p + r).alias("f1"))


def evaluate(predictions: DataFrame, gold: DataFrame, scope: DataFrame, missing: DataFrame) -> DataFrame:
    """One row with all counters of the scoped bag evaluation.

    Null predictions are abstentions: right where the truth says missing, wrong elsewhere.
    A number where the truth says missing is fabricated.
    """
    validate(predictions, gold, scope, missing)
    scoped = keyed(in_scope(predictions, scope))
    numeric = scoped.where(F.col("value").isNotNull())
    keys = [*IDENTITY, "molar", "relation"]
    base = scores(bag_counts(numeric, keyed(gold).where(F.col("value").isNotNull()), keys))
    silent = scoped.where(F.col("value").isNull()).groupBy(*IDENTITY).agg(F.count("*").alias("n"))
    expected = missing.select(*IDENTITY).distinct()
    one = lambda df, name, expr: df.agg(F.coalesce(expr, F.lit(0)).cast("long").alias(name))
    parts = [
        one(silent.join(expected, IDENTITY, "left_semi"), "correct_abstentions", F.count("*")),
        one(silent.join(expected, IDENTITY, "left_semi"), "duplicate_abstentions", F.sum(F.col("n") - 1)),
        one(silent.join(expected, IDENTITY, "left_anti"), "wrong_abstentions", F.sum("n")),
        one(expected.join(silent, IDENTITY, "left_anti"), "missed_abstentions", F.count("*")),
        one(numeric.join(expected, IDENTITY, "left_semi"), "fabricated", F.count("*")),
        one(predictions.join(scope.select("pmcid", "table_id").distinct(), ["pmcid", "table_id"], "left_anti"), "ignored", F.count("*")),
    ]
    for part in parts:  # each side is one row
        base = base.join(F.broadcast(part), F.lit(True))
    return base


def error_count(row: dict) -> int:
    """Sum of the counters that make a run fail."""
    return sum(row[c] for c in ("fp", "fn", "wrong_abstentions", "duplicate_abstentions", "fabricated"))


def bag_residue(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``left`` beyond the copies ``right`` has of their key; earlier copies are used up first."""
    numbered = left.withColumn("__copy", F.row_number().over(Window.partitionBy(*keys).orderBy(*left.columns)))
    used = right.groupBy(*keys).agg(F.count("*").alias("__copies"))
    renamed = used.select(*[F.col(k).alias(f"__key_{k}") for k in keys], "__copies")
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__key_{k}"))
    return numbered.join(renamed, same, "left").where(F.col("__copy") > F.coalesce("__copies", F.lit(0))).select(*left.columns)


#: Two values within this share of the second agree; so do those equal at two significant figures.
TOLERANCE = 0.02


def _reach(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of what agrees with each positive value, a little wider than need be.

    Numbers with the same two figures lie within a twentieth of those figures.
    """
    figures = np.array([float(f"{x:.1e}") for x in v])
    return np.minimum(v / (1 + TOLERANCE), 0.95 * figures) * (1 - 1e-9), np.maximum(v / (1 - TOLERANCE), 1.05 * figures) * (1 + 1e-9)


def _agrees(a: float, b: float) -> bool:
    return abs(a - b) <= TOLERANCE * max(abs(b), 1e-12) or f"{a:.1e}" == f"{b:.1e}"


def greedy_matches(extracted: DataFrame, gold: DataFrame, group: list[str], own_order: list[str], gold_order: list[str], value: str = "value_nm") -> DataFrame:
    """``group, own, other``: positions of the pairs that one-to-one tolerance matching makes.

    Extracted values take, in order, the first unused gold value within tolerance, so the
    order columns are part of the result.  Groups are one paper, target and endpoint; within
    one, gold values are kept sorted and only those inside a value's reach are looked at, so
    far-apart values never meet.  Values that aren't positive match nothing.
    """
    present = lambda df: df.where(F.col(value) > 0)
    numbered = lambda df, order: present(df).select(*group, F.col(value).cast("double").alias("v"), F.row_number().over(Window.partitionBy(*group).orderBy(*order)).alias("pos"))  # noqa: E731,E501
    kinds = ", ".join(f"{c} {extracted.schema[c].dataType.simpleString()}" for c in group)

    def match(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        a, b = a.sort_values("pos"), b.sort_values(["v", "pos"])
        sorted_v, pos, rows = b["v"].to_numpy(), b["pos"].to_numpy(), []
        if len(a) and len(b):
            low, high = _reach(a["v"].to_numpy())
            first, last = np.searchsorted(sorted_v, low, "left"), np.searchsorted(sorted_v, high, "right")
            # equal gold values are taken in order: the next free one of each is all that is looked at
            starts = np.flatnonzero(np.r_[True, sorted_v[1:] != sorted_v[:-1]])
            ends, run_of = np.r_[starts[1:], len(sorted_v)], np.zeros(len(sorted_v), dtype=int)
            run_of[starts[1:]] = 1
            run_of, following = run_of.cumsum(), starts.copy()
            for own, v, i, j in zip(a["pos"], a["v"], first, last):
                if i >= j:
                    continue
                runs = [r for r in range(run_of[i], run_of[j - 1] + 1) if following[r] < ends[r] and _agrees(v, sorted_v[starts[r]])]
                if runs:
                    best = min(runs, key=lambda r: pos[following[r]])
                    rows.append((*key, int(own), int(pos[following[best]])))
                    following[best] += 1
        return pd.DataFrame(rows, columns=[*group, "own", "other"])

    a, b = numbered(extracted, own_order), numbered(gold, gold_order)
    return a.groupBy(*group).cogroup(b.groupBy(*group)).applyInPandas(match, f"{kinds}, own int, other int")


def reachable_share(gold: DataFrame, numbers: DataFrame, paper: str = "pmcid", value: str = "value_nm") -> DataFrame:
    """``gold`` with ``reachable``: whether the number is printed in a table of its paper.

    ``numbers``: paper, n, the distinct printed numbers.  Both sides are cut into bands of
    the logarithm wider than the tolerance; a value is joined with its own and the two
    neighbouring bands of its paper, and only distinct values are joined.  Null papers and
    values are not reachable; zero is reached by zero.
    """
    band = lambda c: F.when(c > 0, F.floor(F.log10(c) * 10)).otherwise(F.lit(-10_000)).cast("int")
    printed = numbers.select(F.col(paper).alias("__paper"), F.col("n").cast("double").alias("n")).withColumn("__band", band(F.col("n")))
    wanted = gold.select(F.col(paper).alias("__paper"), F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull()).distinct()
    spread = wanted.withColumn("__band", F.explode(F.transform(F.array(*map(F.lit, (-1, 0, 1))), lambda d: band(F.col("__v")) + d)))
    near = scalars.tolerant_equal(F.col("__v"), F.col("n"), F.greatest(F.abs("n"), F.lit(1e-12)), TOLERANCE)
    hits = spread.join(printed, ["__paper", "__band"]).where(near).select("__paper", "__v").distinct().withColumn("reachable", F.lit(True))
    joined = gold.join(hits, (F.col(paper) == F.col("__paper")) & (F.col(value).cast("double") == F.col("__v")), "left")
    return joined.withColumn("reachable", F.coalesce("reachable", F.lit(False))).drop("__paper", "__v")


def method_pool(rules: DataFrame, model: DataFrame, method: str) -> DataFrame:
    """Rows of the ``rules``, the ``model``, or both for ``hybrid``."""
    if method not in ("rules", "llm", "hybrid"):
        raise ValueError("method is rules, llm or hybrid")
    return {"rules": rules, "llm": model}.get(method) if method != "hybrid" else rules.unionByName(model, allowMissingColumns=True)
