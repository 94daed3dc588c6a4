"""Session defaults, the shared scratch folder and lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "basketspark", master: str | None = None, shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """A session with the settings the library expects: UTC, AQE, skew-join handling."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    if driver_memory:  # local masters only: the driver is the executor there
        builder = builder.config("spark.driver.memory", driver_memory)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may
    fall back to a temporary folder: on a cluster a machine-local path would be
    lost with the machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if current is None:
            spark.sparkContext.setCheckpointDir(configured)
        return configured.rstrip("/")
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    path = tempfile.mkdtemp(prefix="basketspark-")
    spark.sparkContext.setCheckpointDir(path)
    return path


@contextmanager
def shuffles_released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a table written inside are deleted once it is written, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: computed once, short lineage, survives executor loss.

    Parquet rather than an RDD checkpoint: smaller, and later reads prune columns.
    """
    return df.sparkSession.read.schema(df.schema).parquet(written(df))


def written(df: DataFrame) -> str:
    """The folder in the shared folder to which the table has been written."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/basketspark/{spark.sparkContext.applicationId}/cut/{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.parquet(path)
    return path


def written_batches(path: str, columns: list[str], rows: int) -> Iterator:
    """From a task: the record batches, of at most ``rows`` rows, of a table in the shared folder, which must be one that pyarrow can open."""
    from pyarrow import fs, parquet

    system, folder = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    if system.get_file_info(f"{folder}/_SUCCESS").type != fs.FileType.File:
        raise FileNotFoundError(f"{path} is not a finished table")
    for f in sorted(x.path for x in system.get_file_info(fs.FileSelector(folder)) if x.path.endswith(".parquet")):
        with system.open_input_file(f) as source:
            yield from parquet.ParquetFile(source).iter_batches(rows, columns=columns)
