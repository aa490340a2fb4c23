"""Session helpers: shared scratch folder and staged tables."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def build_session(app: str = "articlelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs expect; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # A fixed lower bound on splits keeps the layout of a text scan independent of
        # how many executors are alive when it is planned (see sources.lines).
        "spark.sql.files.minPartitionNum": "256",
        # Pages may hold a megabyte each.
        "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
        # The JVM does not compile methods above 8000 bytes; such plans run faster unfused.
        "spark.sql.codegen.hugeMethodLimit": "8000",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _one_machine(spark: SparkSession) -> bool:
    """True where driver and executors are one process (``local``, ``local[8]``)."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share, as named by ``spark.checkpoint.dir``.

    Where the setting is missing, only a session of one process gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not _one_machine(spark):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="articlelake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def _own_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/articlelake/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_deleted(spark: SparkSession):
    """Writes inside delete their shuffle files when they end: their result is stored, nobody reads the files again.

    Otherwise the files of every earlier step lie on the executors' disks until the driver happens to collect garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to shared storage once and read it back.

    Used where an expensive result feeds several consumers: the copy outlives any
    executor and gives the optimizer exact sizes. :func:`discard` deletes a copy that nothing
    reads any more, :func:`release_scratch` those of the whole application.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    with shuffles_deleted(spark):
        df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    staged._staged_at = path
    return staged


def made_folder(spark: SparkSession, path: str) -> str:
    """Make a folder, if it is not there; its path with the name of its file system."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    system.mkdirs(target)
    return system.makeQualified(target).toString()


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def discard(staged: DataFrame) -> None:
    """Delete the copy behind a DataFrame that :func:`stage` returned."""
    delete_path(staged.sparkSession, staged._staged_at)


def release_scratch(spark: SparkSession) -> None:
    """Delete every staged copy of this application. Results read from them are gone: write them first."""
    delete_path(spark, _own_folder(spark))


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` with its rank from 0 in ``order``, without sending all rows through one task.

    Rows are range partitioned and numbered inside each partition; only one count per
    partition is accumulated.
    """
    placed = stage(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_seq", F.monotonically_increasing_id()), name
    )
    part = F.shiftright("_seq", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.select("_part", F.coalesce(before, F.lit(0)).alias("_before"))
    at = F.col("_seq") - F.shiftleft("_part", 33)
    return placed.withColumn("_part", part).join(starts, "_part").withColumn(name, F.col("_before") + at).drop("_seq", "_part", "_before")
