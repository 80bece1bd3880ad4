"""Session set-up and materialised intermediate tables."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

_own_scratch: dict[str, str] = {}

ESTIMATE = "spark.sql.sources.fileCompressionFactor"
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
IN_MEMORY = "10"  # rows of a few numbers against their Parquet bytes; keys in order take a fiftieth


def build_session(app: str, cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark; on a cluster the session is given."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def estimate_by_rows(spark: SparkSession) -> None:
    """Let Spark's estimate of a Parquet table be the size of its rows, unless the session has a factor of its own.

    By default the compressed bytes count, so a list of a million keys passes for one
    megabyte, is sent to the driver and from there to every executor. Planned as a
    shuffle, a join is still turned into a broadcast at run time if its rows are few.
    """
    if float(spark.conf.get(ESTIMATE)) == 1.0:
        spark.conf.set(ESTIMATE, IN_MEMORY)


def scratch_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    A local session, as in tests, gets an own folder where none is named. A
    cluster must name one: files in a machine's own folder are lost to the others.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    app = spark.sparkContext.applicationId
    if app not in _own_scratch:
        _own_scratch[app] = tempfile.mkdtemp(prefix="sightline-")
        atexit.register(shutil.rmtree, _own_scratch[app], ignore_errors=True)
    return _own_scratch[app]


def _app_scratch(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/sightline/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's intermediate tables, when nothing reads them any more."""
    _delete(spark, _app_scratch(spark))


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the tables written meanwhile go when their table is written.

    Nothing reads them again, as the written table ends the lineage. By default they
    stay until the driver happens to collect garbage, so the shuffles of all steps add
    up on disk.
    """
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def materialise(df: DataFrame, label: str, compression: str | None = None, counted: bool = False) -> DataFrame:
    """Write ``df`` once and read it back; ``compression`` is Parquet's, by default the session's.

    Used where one result feeds several consumers. Unlike a cache the table
    outlives lost executors, ends the lineage, and has a known size, so later
    joins choose their strategy from it. The shuffle files behind it are dropped.
    With ``counted`` the write also counts its rows, for ``rows_written``.
    """
    spark = df.sparkSession
    path = f"{_app_scratch(spark)}/{label}-{uuid.uuid4().hex}"
    seen = Observation() if counted else None
    with shuffles_dropped(spark):
        (df.observe(seen, F.count(F.lit(1)).alias("rows")) if counted else df).write.parquet(path, compression=compression)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    if counted:
        out._rows_written = seen.get["rows"]
    return out


def discard(df: DataFrame) -> None:
    """Delete a table that ``materialise`` has written and nothing reads any more."""
    _delete(df.sparkSession, df._written_to)


def rows_written(df: DataFrame) -> int:
    """Rows of a table that ``materialise`` has counted; no job."""
    return df._rows_written
