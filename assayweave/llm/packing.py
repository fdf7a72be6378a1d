"""Texts packed into containers of fixed capacity (problem 8).

Sizes are token counts.  A text longer than the capacity is cut into full pieces and a
rest; nothing else is cut.  Only the histogram of piece sizes, at most as long as the
capacity, goes to the driver.  There

* :func:`optimal_boundaries` chooses length buckets by dynamic programming over the
  histogram so that padding to the bucket's boundary is least; with ``buckets`` given,
  :func:`pack` forms token-budget batches inside each of them, and
* :func:`plan_containers` fills containers across buckets: the largest size that is left
  opens a container, the space left is filled with the largest sizes that fit, and the
  same filling is repeated while the counts last.

Length buckets alone leave the space between a batch's sum and the budget unused; the
filling takes it from smaller buckets, so it is what :func:`pack` uses.  Pieces find
their place by their rank within their size, so no task sees more than its share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayweave.llm.tokens import TOKENIZER_DIR, VOCABULARY, count_tokens
from assayweave.session import settle

CAPACITY = 1024
#: Bounds of the salts that split a frequent size; their number follows the shuffle partitions.
SALTS = (32, 512)


def optimal_boundaries(histogram: dict[int, int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length buckets with the least padding in total."""
    sizes = np.array(sorted(s for s, n in histogram.items() if s > 0 and n > 0), dtype=np.int64)
    if not len(sizes):
        return []
    counts = np.array([histogram[int(s)] for s in sizes], dtype=np.int64)
    n = np.concatenate([[0], np.cumsum(counts)])
    w = np.concatenate([[0], np.cumsum(counts * sizes)])
    best = np.full(len(sizes) + 1, np.iinfo(np.int64).max // 4)
    best[0] = 0
    cuts = []
    for _ in range(min(buckets, len(sizes))):
        new, cut = best.copy(), np.full(len(sizes) + 1, -1)
        for j in range(1, len(sizes) + 1):
            padding = best[:j] + sizes[j - 1] * (n[j] - n[:j]) - (w[j] - w[:j])
            i = int(padding.argmin())
            if padding[i] < new[j]:
                new[j], cut[j] = padding[i], i
        best = new
        cuts.append(cut)
    out, j = [], len(sizes)
    for cut in reversed(cuts):
        if j > 0 and cut[j] >= 0:
            out.append(int(sizes[j - 1]))
            j = int(cut[j])
    return out[::-1]


def plan_containers(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(repeats, [(size, pieces of it)])`` that use up the histogram.

    Each entry either exhausts a size or takes what is left of one, so there are at most
    about twice as many entries as sizes.
    """
    left = {s: n for s, n in histogram.items() if s > 0 and n > 0}
    plan = []
    while left:
        space, filling = capacity, []
        for size in sorted(left, reverse=True):
            if size <= space:
                k = min(space // size, left[size])
                filling.append((size, k))
                space -= k * size
        repeats = min(left[size] // k for size, k in filling)
        for size, k in filling:
            left[size] -= k * repeats
            if not left[size]:
                del left[size]
        plan.append((repeats, filling))
    return plan


def pieces(sizes: DataFrame, key: str = "doc_id", capacity: int = CAPACITY) -> DataFrame:
    """``key, piece, start, size``: texts over the capacity cut into full pieces and a rest; size 0 stays one piece."""
    n = F.col("n_tokens")
    count = F.greatest(F.lit(1), F.ceil(n / capacity)).cast("int")
    cut = sizes.withColumn("piece", F.explode(F.sequence(F.lit(0), count - 1)))
    start = F.col("piece").cast("long") * capacity
    return cut.select(key, "piece", start.alias("start"), F.least(F.lit(capacity), n - start).cast("int").alias("size"))


def by_bucket(histogram: dict[int, int], buckets: int | None) -> list[dict[int, int]]:
    """The histograms of the optimal length buckets, or the whole one if there are none."""
    if buckets is None:
        return [histogram]
    bounds = [0, *optimal_boundaries(histogram, buckets)]
    return [{s: n for s, n in histogram.items() if low < s <= high} for low, high in zip(bounds, bounds[1:])]


def pack(sizes: DataFrame, key: str = "doc_id", capacity: int = CAPACITY, buckets: int | None = None) -> DataFrame:
    """``key, piece, start, size, container, offset`` of ``key, n_tokens`` rows.

    With ``buckets`` a container holds pieces of one of that many optimal length buckets
    only; without, it is filled across all sizes, which leaves less space unused.

    ``start`` is where the piece begins in its text, ``offset`` where it lies in the
    container.  Texts without tokens need no container: both are null.  Repeated and
    tied rows get places of their own.
    """
    salts = min(SALTS[1], max(SALTS[0], int(sizes.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    cut = settle(pieces(sizes, key, capacity).withColumn("salt", F.pmod(F.xxhash64(key, "piece"), F.lit(salts)).cast("int")), "pieces")
    # at most capacity x salts rows, whatever the input
    counts = cut.where(F.col("size") > 0).groupBy("size", "salt").count().collect()
    table = np.zeros((capacity + 1, salts), dtype=np.int64)
    for row in counts:
        table[row["size"], row["salt"]] = row["count"]
    firsts = np.cumsum(table, axis=1) - table
    histogram = {int(s): int(n) for s, n in enumerate(table.sum(axis=1)) if n}
    ranks: dict[int, list[tuple[int, int, int, int]]] = {}
    used, container = dict.fromkeys(histogram, 0), 0
    for repeats, filling in (step for part in by_bucket(histogram, buckets) for step in plan_containers(part, capacity)):
        base = 0
        for size, k in filling:
            ranks.setdefault(size, []).append((used[size], container, k, base))
            used[size] += k * repeats
            base += k * size
        container += repeats
    places = {size: np.array(rows, dtype=np.int64) for size, rows in ranks.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, salt, rn = (np.asarray(batch.column(c).to_numpy(zero_copy_only=False)) for c in ("size", "salt", "rn"))
            where, offset = np.full(len(size), -1, dtype=np.int64), np.full(len(size), -1, dtype=np.int64)
            for s in np.unique(size):
                if s <= 0:
                    continue
                at = np.flatnonzero(size == s)
                rank = firsts[s, salt[at]] + rn[at] - 1
                rows = places[int(s)]
                entry = rows[np.searchsorted(rows[:, 0], rank, side="right") - 1]
                inside = rank - entry[:, 0]
                where[at] = entry[:, 1] + inside // entry[:, 2]
                offset[at] = entry[:, 3] + (inside % entry[:, 2]) * s
            columns = [batch.column(c) for c in (key, "piece", "start", "size")]
            columns += [pa.array(x, mask=x < 0) for x in (where, offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "piece", "start", "size", "container", "offset"])

    ranked = cut.withColumn("rn", F.row_number().over(Window.partitionBy("size", "salt").orderBy(key, "piece")))
    kind = sizes.schema[key].dataType.simpleString()
    return ranked.mapInArrow(place, f"{key} {kind}, piece int, start long, size int, container long, offset long")


def pack_documents(documents: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, folder: str = TOKENIZER_DIR, name: str = VOCABULARY, buckets: int | None = None) -> DataFrame:
    """Documents packed by their token counts."""
    return pack(count_tokens(documents, key, text, folder, name), key, capacity, buckets)


#: Length buckets of the queries.
BUCKETS = 16


def bucket_report(sizes: DataFrame, capacity: int = CAPACITY, buckets: int = BUCKETS) -> DataFrame:
    """``upper, pieces, tokens, padding, batches`` of the optimal length buckets."""
    spark = sizes.sparkSession
    cut = pieces(sizes.select(F.lit(0).alias("doc_id"), "n_tokens"), capacity=capacity)
    histogram = {r["size"]: r["count"] for r in cut.groupBy("size").count().collect()}
    rows, low = [], 0
    for upper in optimal_boundaries(histogram, buckets):
        inside = {s: n for s, n in histogram.items() if low < s <= upper}
        n, tokens = sum(inside.values()), sum(s * n for s, n in inside.items())
        rows.append((upper, n, tokens, upper * n - tokens, -(-n // (capacity // upper))))
        low = upper
    return spark.createDataFrame(rows, "upper int, pieces long, tokens long, padding long, batches long")


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``containers, least, tokens, unused, unused_share`` of a packing; ``least`` containers would hold the tokens if they could be cut."""
    total = packed.agg(F.countDistinct("container").alias("containers"), F.coalesce(F.sum("size"), F.lit(0)).cast("long").alias("tokens"))
    unused = F.col("containers") * capacity - F.col("tokens")
    return total.select(
        "containers", F.ceil(F.col("tokens") / capacity).alias("least"), "tokens", unused.alias("unused"),
        F.when(F.col("containers") > 0, F.round(unused / (F.col("containers") * capacity), 6)).alias("unused_share"),
    )
