"""Session helpers: where shared files go and how lineage is cut."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "assayweave", master: str = "local[*]", **conf: str) -> SparkSession:
    """A session with the settings that the queries are written for."""
    builder = (
        SparkSession.builder.appName(app)
        .master(master)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


#: Bytes of input for each core below which a table counts as small.
SMALL = 32 << 20


def spread(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df`` on all cores if ``source``, the table it comes from, is small, else as it lies.

    A small table lies in a few splits, so that costly work on it would keep few cores
    busy.  The rows of a larger one are never moved for this.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(source._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(2 * cores) if size < SMALL * cores else df


def show_package(spark: SparkSession) -> None:
    """Lets the Python workers find this package where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    there = spark.sparkContext.environment
    paths = there.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        there["PYTHONPATH"] = os.pathsep.join(p for p in (paths, root) if p)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Only where that setting is absent and Spark runs on one machine, as in tests, a local
    folder is made and set, so that later calls see the same one; on a cluster it is an error.
    """
    found = spark.sparkContext.getCheckpointDir()
    if found:
        return found
    stated = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not stated and not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(stated or tempfile.mkdtemp(prefix="assayweave-"))
    return spark.sparkContext.getCheckpointDir()


_written: dict[str, SparkSession] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below :func:`shared_dir`; see :func:`clear`."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _written[path] = spark
    return path


def settle(df: DataFrame, name: str = "step") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: computed once, lineage cut.

    A lost executor costs nothing that was written, unlike a cached block.  The files
    stay until :func:`discard`, :func:`clear` or the end of the driver's Python.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def discard(df: DataFrame) -> None:
    """Delete what :func:`settle` wrote for ``df``; nothing that is still to run may read it."""
    path = getattr(df, "_settled_at", None)
    if path in _written:
        _delete(_written.pop(path), path)


def clear() -> None:
    """Delete all settled steps; their DataFrames can't be read any more."""
    for path, spark in list(_written.items()):
        try:
            _delete(spark, path)
        except Exception:  # noqa: BLE001  the session is gone, and with it the means to delete
            pass
        _written.pop(path, None)


atexit.register(clear)
