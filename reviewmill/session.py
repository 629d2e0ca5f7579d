"""Session settings and the shared folder that holds intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


# Paths of the tables that this process has materialised and not yet deleted.
_written: set[str] = set()


def local_session(cores: int | str = "*", app: str = "reviewmill") -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, pass your own session instead."""
    partitions = "8" if cores == "*" else str(cores)
    session = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    A local session without that setting gets a temporary folder. On a cluster, a missing setting or a
    folder of one machine is an error, because it would not survive the loss of that machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        local = context.master.startswith("local")
        if not local and (configured is None or configured.startswith("file:")):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        configured = configured or tempfile.mkdtemp(prefix="reviewmill-")
        context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has been written to yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialise(rows: DataFrame, label: str = "table", schema: StructType | None = None) -> DataFrame:
    """Write ``rows`` to the shared folder and read them back.

    Cuts the lineage, so a lost executor costs a re-read and not a re-run, fixes values that a
    re-run could change (range boundaries, partition ids), and gives the optimizer real sizes. Another
    ``schema`` to read with must have the same storage types.
    """
    spark = rows.sparkSession
    path = fresh_path(spark, label)
    _written.add(path)
    with shuffles_dropped_after_use(spark):
        rows.write.parquet(path)
    return spark.read.schema(schema or rows.schema).parquet(path)


@contextmanager
def shuffles_dropped_after_use(spark: SparkSession):
    """Shuffle files of the actions inside go when the action ends, as its result is written."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def intermediates(spark: SparkSession):
    """Deletes at its end all that ``materialise`` writes inside; write results elsewhere before."""
    before = set(_written)
    try:
        yield
    finally:
        for path in set(_written) - before:
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _written.discard(path)


def forget(*tables: DataFrame) -> None:
    """Delete the files of tables made by ``materialise`` that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        home = shared_folder(spark).removeprefix("file:").rstrip("/")
        for name in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            plain = name.removeprefix("file:").replace("///", "/", 1)
            if plain.startswith(home):
                _delete(spark, f"{shared_folder(spark)}{plain.removeprefix(home)}")
