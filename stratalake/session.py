"""Session set-up and the shared folder used to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
COMPRESSION = "zstd"  # of what a run writes
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    WRITERS: "8",  # writes into a few folders need no sort
    "spark.ui.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",  # call-site capture slows plan building
}


PARTITION_BYTES = 1 << 30
MOST_PARTITIONS = 50_000


def build_session(app: str = "stratalake", master: str | None = None, input_bytes: int | None = None,
                  **settings: str) -> SparkSession:
    """A session with the settings the plans rely on; pass ``master`` for local runs only.

    ``input_bytes`` sizes the shuffles: one partition per GB of the largest input, which sorts and joins
    spill within an executor. Their number has a ceiling, because the driver tracks every pair of map
    task and partition; it changes parallelism, not results. Spark merges partitions that turn out small.
    With tens of thousands of map tasks, also use push-based shuffle (``spark.shuffle.push.enabled``).
    """
    if input_bytes:
        settings = {"spark.sql.shuffle.partitions": str(min(MOST_PARTITIONS, max(200, input_bytes // PARTITION_BYTES))), **settings}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a session whose tasks all run in this process (``local[n]``) and that names no folder, as in
    tests, gets a temporary one of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="stratalake-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def _path(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def exists(spark: SparkSession, path: str) -> bool:
    files, path = _path(spark, path)
    return files.exists(path)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders right below a folder; none where it does not exist."""
    files, at = _path(spark, path)
    return [f"{path}/{f.getPath().getName()}" for f in files.listStatus(at) if f.isDirectory()] if files.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's, if it is there."""
    files, path = _path(spark, path)
    files.delete(path, True)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within the block, Spark removes the shuffle files of a query as soon as it has ended; else they stay on disk until
    the driver happens to collect its garbage, and those of a whole run add up."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def _write_by(df: DataFrame, by: str, path: str, options: dict[str, str]) -> None:
    """Write rows into a few folders with all of them open, which needs no sort, whatever the session is set to."""
    conf = df.sparkSession.conf
    before = conf.get(WRITERS)
    conf.set(WRITERS, SETTINGS[WRITERS] if before == "0" else before)
    try:
        df.write.partitionBy(by).options(**options).parquet(path)
    finally:
        conf.set(WRITERS, before)


def stage(df: DataFrame, by: str | None = None, folder: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written table: later uses neither
    recompute it nor depend on any executor staying alive, read only the columns they need, and
    see its true size when Spark chooses a join. With ``by``, rows of each value of that text column lie in a
    folder of their own, so that a filter on it reads nothing else."""
    path = f"{folder or shared_dir(df.sparkSession)}/staged-{uuid.uuid4().hex}"
    if by is None:
        df.write.options(**options).parquet(path)
    else:
        _write_by(df, by, path, options)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


class Staging:
    """``stage`` for the length of a block: the staged tables are removed at its end, also after a failure."""

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, f"{folder or shared_dir(spark)}/staging-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, by: str | None = None) -> DataFrame:
        return stage(df, by, self.folder, compression=COMPRESSION)

    def inner(self) -> Staging:
        """A block within this one, for tables that are read no more before its end."""
        return Staging(self.spark, self.folder)

    def remove(self, by: str, value: str) -> None:
        """Remove the rows of one value of the column that tables were staged by."""
        for table in folders(self.spark, self.folder):
            delete(self.spark, f"{table}/{by}={value}")

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_) -> None:
        delete(self.spark, self.folder)
