"""Statistics of potencies and of model predictions, over long tables with SQL nulls."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _bin(value: Column) -> Column:
    """Bins that grow with the value: a sixteenth of an octave of its size, in ascending order; few thousands at most."""
    size = F.when(F.abs(value) == float("inf"), 100_000).otherwise(F.floor(F.log2(F.abs(value)) * 16).cast("int") + 20_000)
    return F.when(value > 0, size).when(value < 0, -size).otherwise(0)


def order_statistics(df: DataFrame, keys: list[str], value: str, places: list[tuple[str, Column]]) -> DataFrame:
    """``keys, n`` and for each of ``places`` (name, place from 0 as a column of ``n``) the value at that place of the sorted group.

    Exact, and no group is gathered or sorted whole: counts by bin tell in which bin each
    place lies, and only the values of these bins, combined with their counts, are put in
    order.  Nulls and NaN are left out; groups without a value have no row; null keys are a
    group of their own.
    """
    rows = df.where(F.col(value).isNotNull() & ~F.isnan(value)).select(*keys, F.col(value).cast("double").alias("__v"))
    rows = rows.withColumn("__bin", _bin(F.col("__v")))
    whole, sofar = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("__bin")
    bins = rows.groupBy(*keys, "__bin").agg(F.count("*").alias("__m"))
    bins = bins.withColumn("n", F.sum("__m").over(whole)).withColumn("__before", F.sum("__m").over(sofar) - F.col("__m"))
    wanted = F.array(*[F.struct(F.lit(name).alias("name"), place.cast("long").alias("at")) for name, place in places])
    here = F.filter(wanted, lambda w: (F.col("__before") <= w["at"]) & (w["at"] < F.col("__before") + F.col("__m")))
    bins = bins.withColumn("__wanted", here).where(F.size("__wanted") > 0).select(*keys, F.col("__bin"), "n", "__before", "__wanted")
    bins = bins.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], F.col("__bin").alias("__b"), "n", "__before", "__wanted")
    same = F.col("__bin") == F.col("__b")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    values = rows.groupBy(*keys, "__bin", "__v").agg(F.count("*").alias("__m")).join(bins, same)
    inside = F.sum("__m").over(Window.partitionBy(*keys, "__bin").orderBy("__v"))
    placed = values.withColumn("__to", F.col("__before") + inside).withColumn("__from", F.col("__to") - F.col("__m"))
    hits = placed.select(*keys, "n", F.col("__v"), F.explode("__wanted").alias("w"), "__from", "__to").where((F.col("__from") <= F.col("w.at")) & (F.col("w.at") < F.col("__to")))
    return hits.groupBy(*keys).agg(F.max("n").alias("n"), *[F.max(F.when(F.col("w.name") == name, F.col("__v"))).alias(name) for name, _ in places])


def percentiles(df: DataFrame, keys: list[str], value: str, shares: dict[str, float]) -> DataFrame:
    """``keys, n`` and a linearly interpolated percentile for each name of ``shares``, by :func:`order_statistics`."""
    at = {name: (F.col("n") - 1) * share for name, share in shares.items()}
    places = [(f"__{side}_{name}", use(place)) for name, place in at.items() for side, use in (("low", F.floor), ("high", F.ceil))]
    found = order_statistics(df, keys, value, places)
    mixed = {name: F.col(f"__low_{name}") + (F.col(f"__high_{name}") - F.col(f"__low_{name}")) * (place - F.floor(place)) for name, place in at.items()}
    return found.select(*keys, "n", *[c.alias(name) for name, c in mixed.items()])


def upper_median_rows(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """``keys, name``: the middle value, the upper one of two: element n // 2 of the sorted values, counted from 0."""
    return order_statistics(df, keys, value, [(name, F.floor(F.col("n") / 2))]).select(*keys, name)


#: Bins of half a decade from 1e-3 to 1e6 nM.
HISTOGRAM = (-3.0, 6.0, 18)


def log_bin(value: Column, low: float = HISTOGRAM[0], high: float = HISTOGRAM[1], bins: int = HISTOGRAM[2]) -> Column:
    """Bin from 1 of a positive value's logarithm; what lies outside goes to the outer bins."""
    return F.greatest(F.lit(1), F.least(F.lit(bins), F.floor((F.log10(value) - low) / ((high - low) / bins)).cast("int") + 1))


def histogram(df: DataFrame, keys: list[str], value: str, least: int = 5) -> DataFrame:
    """``keys, bin, n`` of the groups with at least ``least`` positive values."""
    counted = df.where(F.col(value) > 0).groupBy(*keys, log_bin(F.col(value)).alias("bin")).agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*keys))
    return counted.withColumn("__total", total).where(F.col("__total") >= least).drop("__total")


def commonest(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``keys, value, n``: the most frequent value of each group, ties in alphabetical order."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))
    best = counted.groupBy(*keys).agg(F.min(F.struct((-F.col("n")).alias("m"), F.col(value).alias("v"))).alias("b"))
    return best.select(*keys, F.col("b.v").alias(value), (-F.col("b.m")).alias("n"))


def error_metrics(y: Column, pred: Column) -> list[Column]:
    """Aggregates ``n, rmse, mae, within_1`` of predictions; rows without either side are left out."""
    off = pred - y
    return [
        F.count(off).alias("n"), F.sqrt(F.avg(off * off)).alias("rmse"), F.avg(F.abs(off)).alias("mae"), F.avg((F.abs(off) <= 1).cast("double") + off * 0).alias("within_1")
    ]


def average_rank(value: Column, partition: list[str]) -> Column:
    """Rank with ties sharing their mean."""
    ordered = Window.partitionBy(*partition).orderBy(value)
    ties = Window.partitionBy(*partition, value)
    return F.rank().over(ordered) + (F.count("*").over(ties) - 1) / 2


def group_spearman(df: DataFrame, keys: list[str], group: str, y: str, pred: str, least: int = 5) -> DataFrame:
    """``keys, rho, groups``: rank correlation within each group, weighted by its size.

    Groups with fewer than ``least`` rows or a constant side are dropped; without any
    group rho is null.
    """
    rows = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull() & F.col(group).isNotNull())
    by = [*keys, group]
    ranked = rows.select(*by, average_rank(F.col(y), by).alias("__a"), average_rank(F.col(pred), by).alias("__b"))
    per = ranked.groupBy(*by).agg(F.count("*").alias("__n"), (F.covar_pop("__a", "__b") / F.nullif(F.stddev_pop("__a") * F.stddev_pop("__b"), F.lit(0.0))).alias("__r"), (F.min("__a") != F.max("__a")).alias("__va"), (F.min("__b") != F.max("__b")).alias("__vb"))
    kept = per.where((F.col("__n") >= least) & F.col("__va") & F.col("__vb"))
    rho = (F.sum(F.col("__r") * F.col("__n")) / F.sum("__n")).alias("rho")
    return kept.groupBy(*keys).agg(rho, F.count("*").alias("groups")) if keys else kept.agg(rho, F.count("*").alias("groups"))


def similarity_bin(similarity: Column) -> Column:
    """``<0.4``, ``0.4-0.6`` or ``>0.6``."""
    return F.when(similarity < 0.4, "<0.4").when(similarity < 0.6, "0.4-0.6").when(similarity < 1.01, ">0.6")


def grouped_metrics(df: DataFrame, keys: list[str], y: str, pred: str, least: int = 5) -> DataFrame:
    """Error metrics of the groups with at least ``least`` rows."""
    return df.groupBy(*keys).agg(*error_metrics(F.col(y), F.col(pred))).where(F.col("n") >= least)


def resampled(rows: DataFrame, row_key: str, replicates: int, seed: int = 0) -> DataFrame:
    """``rows`` with ``rep`` and ``w``: how often each row is in each replicate of a Poisson bootstrap, 0 left out.

    The Poisson(1) number is drawn from a hash of the row's key, so the result depends
    neither on the partitioning nor on the order.
    """
    spread = rows.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    uniform = F.pmod(F.xxhash64(row_key, "rep", F.lit(seed)), F.lit(1 << 53)) / float(1 << 53)
    # by inversion, cut where the tail is below 1e-9
    cumulative, steps, weight = 0.0, [], F.lit(12)
    for n in range(12):
        cumulative += math.exp(-1) / math.factorial(n)
        steps.append((n, cumulative))
    for n, c in reversed(steps):
        weight = F.when(uniform < c, n).otherwise(weight)
    return spread.withColumn("w", weight).where(F.col("w") > 0)


def _interval(per: DataFrame, value: str, level: float) -> DataFrame:
    """``low, high`` of one value a replicate."""
    tail = (1 - level) / 2
    found = per.agg(F.percentile(value, F.array(F.lit(tail), F.lit(1 - tail))).alias("q"))
    return found.select(F.get("q", F.lit(0)).alias("low"), F.get("q", F.lit(1)).alias("high"))


def poisson_bootstrap(df: DataFrame, row_key: str, y: str, pred: str, replicates: int = 200, level: float = 0.95, seed: int = 0) -> DataFrame:
    """``rmse, low, high``: percentile interval of the RMSE over hashed Poisson resamples, pre-aggregated to one row a replicate and task."""
    square = (F.col(pred) - F.col(y)) ** 2
    rows = df.select(F.col(row_key).alias("k"), square.alias("s")).where(F.col("s").isNotNull())
    per = resampled(rows, "k", replicates, seed).groupBy("rep").agg(F.sqrt(F.sum(F.col("s") * F.col("w")) / F.sum("w")).alias("r"))
    return rows.agg(F.sqrt(F.avg("s")).alias("rmse")).crossJoin(F.broadcast(_interval(per, "r", level)))


def spearman_bootstrap(df: DataFrame, row_key: str, group: list[str], y: str, pred: str, replicates: int = 300, least: int = 5, level: float = 0.95, seed: int = 0) -> DataFrame:
    """``low, high``: percentile interval of the rank correlation within groups, weighted by their size.

    In each replicate a row counts as often as it is drawn: ties share their mean rank, and
    groups with fewer than ``least`` drawn rows or a constant side are left out.
    """
    rows = df.where(F.col(y).isNotNull() & F.col(pred).isNotNull()).select(*group, F.col(row_key).alias("k"), F.col(y).alias("__y"), F.col(pred).alias("__p"))
    for name in group:
        rows = rows.where(F.col(name).isNotNull())
    by = ["rep", *group]

    def rank(value: str) -> Column:
        ties = F.sum("w").over(Window.partitionBy(*by, value))
        return F.sum("w").over(Window.partitionBy(*by).orderBy(value)) - (ties - 1) / 2

    drawn = resampled(rows, "k", replicates, seed).select(*by, "w", rank("__y").alias("a"), rank("__p").alias("b"))
    w, a, b = F.col("w"), F.col("a"), F.col("b")
    sums = {"n": w, "sa": w * a, "sb": w * b, "saa": w * a * a, "sbb": w * b * b, "sab": w * a * b}
    per = drawn.groupBy(*by).agg(*[F.sum(x).cast("double").alias(name) for name, x in sums.items()])
    left, right = (F.col("n") * F.col(f"s{x}{x}") - F.col(f"s{x}") ** 2 for x in "ab")
    kept = per.where((F.col("n") >= least) & (left > 1e-9) & (right > 1e-9)).withColumn("r", (F.col("n") * F.col("sab") - F.col("sa") * F.col("sb")) / F.sqrt(left * right))
    return _interval(kept.groupBy("rep").agg((F.sum(F.col("r") * F.col("n")) / F.sum("n")).alias("rho")), "rho", level)


def task_mean_baseline(train: DataFrame, test: DataFrame, task: str, y: str) -> DataFrame:
    """``test`` with ``pred``: the mean of its task in ``train``."""
    means = train.groupBy(task).agg(F.avg(y).alias("pred"))
    return test.join(means, task, "left")


def seen_in_training(test: DataFrame, train: DataFrame, keys: list[str]) -> DataFrame:
    """``test`` with ``seen``: whether its keys occur in ``train``."""
    known = train.select(*keys).distinct().withColumn("seen", F.lit(True))
    return test.join(known, keys, "left").withColumn("seen", F.coalesce("seen", F.lit(False)))


def noise_floor(a: DataFrame, b: DataFrame, keys: list[str], x: str, y: str) -> DataFrame:
    """``n, rmse`` of the same compounds' values in two sources; each side is reduced to medians first."""
    left = a.groupBy(*keys).agg(F.median(x).alias("__x"))
    right = b.groupBy(*keys).agg(F.median(y).alias("__y"))
    off = F.col("__x") - F.col("__y")
    return left.join(right, keys).agg(F.count("*").alias("n"), F.sqrt(F.avg(off * off)).alias("rmse"))


def training_table(activities: DataFrame, keys: list[str], p: str, year: str) -> DataFrame:
    """``keys, p, n, year``: median with three decimals, count, earliest stated year."""
    return activities.groupBy(*keys).agg(F.round(F.median(p).cast("decimal(18,6)"), 3).cast("double").alias("p"), F.count("*").alias("n"), F.min(F.when(F.col(year) != 0, F.col(year))).alias("year"))


def running_average(df: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """``keys, value``: each further value is averaged with the average so far, in the stated order.

    Not a mean for three or more values; the order is part of the definition.
    """
    window = Window.partitionBy(*keys)
    placed = df.where(F.col(value).isNotNull()).withColumn("__i", F.row_number().over(window.orderBy(*order, value))).withColumn("__n", F.count("*").over(window))
    # unrolled: the last value weighs a half, the one before a quarter, the first as much as the second
    weight = F.pow(F.lit(0.5), F.when(F.col("__i") == 1, F.col("__n") - 1).otherwise(F.col("__n") - F.col("__i") + 1).cast("double"))
    return placed.groupBy(*keys).agg(F.sum(F.col(value) * weight).alias(value))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where one is null or zero."""
    total = lambda x: F.aggregate(x, F.lit(0.0), lambda s, v: s + v)
    product = lambda x, y: total(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")))
    norm = F.sqrt(product(a, a) * product(b, b))
    return F.when(norm > 0, product(a, b) / norm)


def jaccard_words(a: Column, b: Column) -> Column:
    """Tanimoto similarity of two bit vectors given as arrays of 64-bit words."""
    bits = lambda x: F.aggregate(x, F.lit(0), lambda s, w: s + F.bit_count(w))
    both = bits(F.zip_with(a, b, lambda x, y: x.bitwiseAND(y)))
    either = bits(F.zip_with(a, b, lambda x, y: x.bitwiseOR(y)))
    return F.when(either > 0, both / either)


def nearest_neighbours(queries: DataFrame, base: DataFrame, key: str, vector: str, group: str, block: int = 2_000) -> DataFrame:
    """``key, neighbour, similarity``: each query's most similar other row with the same ``group``, exactly; ties go to the smaller key.

    Both sides of a group are cut into blocks of about ``block`` rows by its size, so a task
    compares one block of queries with one of the base, whatever the group holds, and keeps
    the best of each query.  Null and zero vectors have no neighbour and are none; null
    groups match nothing.
    """
    import numpy as np

    kinds = f"{key} {queries.schema[key].dataType.simpleString()}, neighbour {base.schema[key].dataType.simpleString()}, similarity double"

    def cut(df: DataFrame, own: str, other: str, opposite: DataFrame) -> DataFrame:
        """The rows in blocks of their side, each once for every block of the other side."""
        parts = lambda rows, name: rows.groupBy(F.col(group).alias(f"__{name}g")).agg(F.ceil(F.count("*") / block).cast("int").alias(name))
        rows = df.where(F.col(group).isNotNull() & F.col(vector).isNotNull()).select(F.col(group).alias("__group"), F.col(key).alias("__id"), F.col(vector).alias("__vector"))
        sized = rows.join(parts(df, own), F.col("__group") == F.col(f"__{own}g")).join(parts(opposite, other), F.col("__group") == F.col(f"__{other}g"))
        mine = F.pmod(F.xxhash64("__id"), F.col(own).cast("long")).cast("int")
        return sized.withColumn(own, mine).withColumn(other, F.explode(F.sequence(F.lit(0), F.col(other) - 1))).select("__group", "__id", "__vector", "__q", "__p")

    asked, offered = cut(queries, "__q", "__p", base), cut(base, "__p", "__q", queries)

    def unit(pdf: pd.DataFrame) -> np.ndarray:
        m = np.vstack([np.asarray(v, dtype=float) for v in pdf["__vector"]])
        norm = np.linalg.norm(m, axis=1, keepdims=True)
        return np.divide(m, norm, out=np.full_like(m, np.nan), where=norm > 0)

    def best(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if a.empty or b.empty:
            return pd.DataFrame(columns=[key, "neighbour", "similarity"])
        b = b.sort_values("__id", ignore_index=True)
        v, ids, rows = unit(b), b["__id"].to_numpy(), []
        for at in range(0, len(a), 512):
            piece = a.iloc[at : at + 512]
            s = unit(piece) @ v.T
            s[piece["__id"].to_numpy()[:, None] == ids[None, :]] = -np.inf
            s = np.where(np.isnan(s), -np.inf, np.round(s, 12))
            j = s.argmax(axis=1)
            rows += [(own, ids[k], float(x)) for own, k, x in zip(piece["__id"], j, s[np.arange(len(j)), j]) if np.isfinite(x)]
        return pd.DataFrame(rows, columns=[key, "neighbour", "similarity"])

    same = ["__group", "__q", "__p"]
    found = asked.groupBy(*same).cogroup(offered.groupBy(*same)).applyInPandas(best, kinds)
    top = found.groupBy(key).agg(F.min(F.struct((-F.col("similarity")).alias("s"), "neighbour")).alias("b"))
    return top.select(key, F.col("b.neighbour").alias("neighbour"), (-F.col("b.s")).alias("similarity"))
