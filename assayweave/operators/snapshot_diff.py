"""Differences between two copies of a table (problem 4).

Both copies are brought to one row per key (the one with the latest version),
tagged with their side, and range-partitioned *together*, so that the split
points are shared.  Inside a partition the rows are sorted by key and side, and
one forward pass merges the two sides: a key seen on one side only is missing on
the other, a key seen on both is compared field by field.  The pass works on
Arrow batches and carries at most one row from batch to batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayweave.operators.enrich import newest

_SIDE = "__side__"


def _comparable(df: DataFrame, fields: list[str]) -> DataFrame:
    """Nested fields as JSON text, which compares exactly; plain ones as they are."""
    kinds = dict((f.name, f.dataType) for f in df.schema.fields)
    return df.withColumns({c: F.to_json(c) for c in fields if isinstance(kinds[c], (T.ArrayType, T.StructType, T.MapType))})


def _differs(a: pa.Array, b: pa.Array, tolerance: float) -> np.ndarray:
    """Where two equally long columns differ; two nulls are equal, null differs from any value."""
    na, nb = (np.asarray(pc.is_null(x).to_numpy(zero_copy_only=False)) for x in (a, b))
    if pa.types.is_floating(a.type):
        x, y = (np.asarray(pc.fill_null(v, 0.0).to_numpy(zero_copy_only=False), dtype=float) for v in (a, b))
        with np.errstate(invalid="ignore", over="ignore"):
            same = (x == y) | (np.isnan(x) & np.isnan(y)) | (np.abs(x - y) <= tolerance * np.maximum(np.abs(x), np.abs(y)))
            same &= np.isinf(x) == np.isinf(y)
    else:
        same = np.asarray(pc.fill_null(pc.equal(a, b), True).to_numpy(zero_copy_only=False), dtype=bool)
    return (na != nb) | (~na & ~nb & ~same)


def snapshot_diff(
    left: DataFrame,
    right: DataFrame,
    key: str = "id",
    version: str = "exported_at",
    left_name: str = "records",
    right_name: str = "records_mirror",
    tolerance: float = 1e-9,
) -> DataFrame:
    """Rows ``(key, field)``: what differs between ``left`` and ``right``.

    ``field`` is ``only_<left_name>`` or ``only_<right_name>`` for a key that the
    other copy lacks, else the name of a column that differs.  Columns that only one
    copy has are not compared.  A null key is a key of its own.  An empty copy makes
    every key of the other one missing; two empty copies give no rows.
    """
    fields = [c for c in left.columns if c in right.columns and c not in (key, version)]
    sides = [
        _comparable(newest(df, key, version, [key, version, *fields]), fields).withColumn(_SIDE, F.lit(n).cast("byte"))
        for n, df in enumerate((left, right))
    ]
    both = sides[0].unionByName(sides[1]).drop(version).repartitionByRange(key).sortWithinPartitions(key, _SIDE)
    only = (f"only_{left_name}", f"only_{right_name}")
    key_type = left.schema[key].dataType

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry: pa.Table | None = None

        def flush(rows: pa.Table) -> pa.RecordBatch:
            rows = rows.combine_chunks()
            keys, side = rows.column(key), np.asarray(rows.column(_SIDE).to_numpy())
            n = len(side)
            if n > 1:
                a, b = keys.slice(0, n - 1), keys.slice(1)
                equal = np.asarray(pc.fill_null(pc.equal(a, b), False).to_numpy(), dtype=bool)
                equal |= np.asarray(pc.and_(pc.is_null(a), pc.is_null(b)).to_numpy(), dtype=bool)
                first = np.flatnonzero(equal)
            else:
                first = np.empty(0, dtype=np.int64)
            paired = np.zeros(n, dtype=bool)
            paired[first], paired[first + 1] = True, True
            at, names = [], []
            for s in (0, 1):
                alone = np.flatnonzero(~paired & (side == s))
                at.append(alone)
                names.append(np.full(len(alone), only[s], dtype=object))
            x, y = rows.take(pa.array(first)), rows.take(pa.array(first + 1))
            for c in fields:
                off = _differs(x.column(c).combine_chunks(), y.column(c).combine_chunks(), tolerance)
                at.append(first[off])
                names.append(np.full(int(off.sum()), c, dtype=object))
            out = keys.take(pa.array(np.concatenate(at).astype(np.int64))).combine_chunks()
            if isinstance(out, pa.ChunkedArray):
                out = pa.concat_arrays(out.chunks) if out.num_chunks else pa.array([], keys.type)
            return pa.RecordBatch.from_arrays([out, pa.array(np.concatenate(names), pa.string())], names=[key, "field"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if carry is not None:
                rows = pa.concat_tables([carry, rows])
            if not len(rows):
                continue
            # a left row may have its partner in the next batch
            hold = 1 if rows.column(_SIDE)[len(rows) - 1].as_py() == 0 else 0
            carry = rows.slice(len(rows) - hold) if hold else None
            if len(rows) > hold:
                yield flush(rows.slice(0, len(rows) - hold))
        if carry is not None and len(carry):
            yield flush(carry)

    schema = T.StructType([T.StructField(key, key_type), T.StructField("field", T.StringType())])
    return both.mapInArrow(merge, schema)
