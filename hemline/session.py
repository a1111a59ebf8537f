"""Session settings and the shared folder for checkpoints and written tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid
import warnings

from pyspark import SparkContext
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"
#: Compression of the written tables.
CODEC = "zstd"

_local_folders: dict[str, str] = {}
_written: list[str] = []


def build_session(
    app: str = "hemline", master: str | None = None, settings: dict[str, str] | None = None
) -> SparkSession:
    """A session with the settings the jobs are written for.

    The number of shuffle partitions is left to the caller or the cluster: adaptive execution merges
    small ones, so a cluster should set a generous initial number
    (``spark.sql.adaptive.coalescePartitions.initialPartitionNum``).
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.parquet.filterPushdown", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
        .config("spark.serializer", "org.apache.spark.serializer.KryoSerializer")
    )
    if master:
        builder = builder.master(master)
    for key, value in (settings or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder. On a cluster the setting is
    required, because a folder of one machine is gone when that machine is.
    """
    folder = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_folders:
            _local_folders[app] = tempfile.mkdtemp(prefix="hemline-")
        folder = _local_folders[app]
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """An unused path below the shared folder; deleted by :func:`delete_written` or when Python ends."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if not _written:
        atexit.register(delete_written)
    _written.append(path)
    return path


def delete_written() -> None:
    """Delete every folder that this process has written below the shared folder.

    Frames that read such a folder are gone with it, so call it when a run's results are stored.
    """
    jvm = SparkContext._jvm
    while _written and jvm is not None:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        try:
            path.getFileSystem(jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
        except Exception as error:  # a store that is gone must not keep the others from being cleaned
            warnings.warn(f"could not delete {path}: {error}", stacklevel=2)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs read the same expensive result (training, cross-validation). The lineage
    ends at the files, so a lost executor costs a re-read and not a re-computation. The files are read by this run only
    and take much of its disk, so they are packed more tightly than Spark would.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path, compression=CODEC)
    return df.sparkSession.read.schema(df.schema).parquet(path)
