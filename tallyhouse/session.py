"""Session options and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

# Runtime SQL options every job here relies on. Skewed inner, left and anti joins are split by AQE,
# also where that costs one more exchange before an aggregate.
RUNTIME_OPTIONS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # The JVM does not compile methods above 8000 bytes; wide projections run faster outside one fused method.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Files are a fraction of their rows' size: by their own size a table of millions of rows would be sent to the driver for a broadcast.
    "spark.sql.sources.fileCompressionFactor": "8",
    # A scan's filters are written out in plans; by default the second one is cut off.
    "spark.sql.maxMetadataStringLength": "1000",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
ROWS_A_TASK = 25_000  # rows that `dealt` gives a task
ROWS_A_FILE = 1 << 16  # most rows of a file that `cut_lineage` writes


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options on a session made elsewhere; static ones are left alone."""
    for key, value in RUNTIME_OPTIONS.items():
        spark.conf.set(key, value)
    return spark


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, memory: str = "8g", shared: str | None = None,
) -> SparkSession:
    """A single-machine session for tests and the bench; ``shared`` is the folder for staged tables."""
    builder = SparkSession.builder.config("spark.checkpoint.dir", shared) if shared else SparkSession.builder
    spark = (
        builder.master(f"local[{cores}]")
        .appName("tallyhouse")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder that the cluster names in ``spark.checkpoint.dir``; it goes when the session ends.

    A session on one machine without that setting gets a folder there. On a cluster the setting has to be
    there: executors would each write to a disk of their own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.gettempdir()
    home = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/tallyhouse-{spark.sparkContext.applicationId}")
    files = home.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.mkdirs(home):
        files.deleteOnExit(home)
    return f"{home.toString()}/{name}-{uuid.uuid4().hex}"


def shuffle_parts(spark: SparkSession, parts: int) -> None:
    """Shuffles of the session start with this many partitions at least, as long as adaptive execution is on.

    It puts small partitions together, but cuts none of an aggregate or a window: with a fixed number of them, what a task holds
    would grow with the input. The number is only ever raised, so that frames planned earlier keep theirs.
    """
    have = spark.conf.get(INITIAL_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions")
    if parts > int(have):
        spark.conf.set(INITIAL_PARTITIONS, str(parts))


def dealt(df: DataFrame, by: Sequence[str], rows: int = ROWS_A_TASK) -> DataFrame:
    """The frame dealt out by a key to as many tasks as it has times ``rows`` rows; as it is, if that is one.

    The rows are counted as this is called, which for a Parquet table reads the footers only. How many bytes they have says
    little of what is made of them later, so adaptive execution is given the number of partitions. The shuffles of what is made
    of them start with as many at least (see `shuffle_parts`).
    """
    parts = -(-df.count() // rows)
    shuffle_parts(df.sparkSession, parts)
    return df.repartition(parts, *[F.col(f"`{k}`") for k in by]) if parts > 1 else df


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a costly parent that several branches read to the shared folder, and read it back.

    As a table it keeps column pruning for the branches, and a lost executor costs no recomputation. A scan packs files by
    their bytes and a fixed cost of opening one, so the rows of a file are bounded: else a task that reads well compressed
    rows back would hold many millions of them.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("maxRecordsPerFile", ROWS_A_FILE).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._staged_at = path
    return out


def drop_staged(*staged: DataFrame) -> None:
    """Remove tables that ``cut_lineage`` wrote, once nothing that is still to run reads them. Other frames are left alone."""
    for df in staged:
        path = getattr(df, "_staged_at", None)
        if path:
            at = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def unused_name(name: str, taken: Iterable[str]) -> str:
    """The name, or the first form of it with underscores in front that is not taken; case does not tell names apart."""
    low = {t.lower() for t in taken}
    while name.lower() in low:
        name = f"_{name}"
    return name
