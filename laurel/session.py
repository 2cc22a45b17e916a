"""Session set-up, the package for the workers, and stage tables."""

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
#: Spark's setting that removes shuffle files once the job that wrote them has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_shipped = set()
_staged = []


def ship(spark: SparkSession) -> None:
    """Send the package (code only) to the Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        base = os.path.join(tempfile.mkdtemp(prefix="laurel-package-"), "laurel")
        context.addPyFile(shutil.make_archive(base, "zip", ROOT, "laurel"))
        _shipped.add(context.applicationId)


def build_session(master=None, app_name="laurel", shuffle_partitions=None, extra=None):
    """A session with the settings the jobs rely on.

    On a cluster pass no master; partition counts then come from the cluster's own
    defaults and AQE coalesces or splits them.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship(spark)
    return spark


def stage_dir(spark: SparkSession) -> str:
    """The shared folder for stage tables, from ``spark.checkpoint.dir``.

    Only a local session may fall back to a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="laurel-stages-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stage(df: DataFrame, name="stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage of iterative jobs and lets several branches read one result;
    the files outlive lost executors, unlike a local checkpoint.  The shuffles behind them
    are removed, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{stage_dir(spark)}/{name}-{uuid.uuid4().hex}"
    old = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, old)
    _staged.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_folder(spark: SparkSession, folder: str) -> bool:
    """Delete a folder on whatever file system it lies; false if there is none."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stages() -> int:
    """How many stage tables of this process there are."""
    return len(_staged)


def drop_stages(spark: SparkSession, first: int = 0, last: int | None = None) -> int:
    """Delete stage tables of this process that nothing reads any more; returns how many.

    All of them, once their results are written, or those from ``first`` to before ``last``
    in the order in which they were written.
    """
    paths = _staged[first:last]
    del _staged[first:last]
    return sum(drop_folder(spark, path) for path in paths)
