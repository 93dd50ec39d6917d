"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "strataq", cores: str = "*", partitions: int = 8) -> SparkSession:
    """A local session with the settings the operators expect (tests, bench)."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def scratch_dir(spark: SparkSession) -> str:
    """The folder all executors share.

    ``spark.checkpoint.dir`` names it on a cluster.  Only where it is unset in a local
    session a temporary folder of this machine is taken; on a cluster each executor
    would write to its own disk, so there the setting is required.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    known = sc._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="strataq-")
    sc.setCheckpointDir(own)
    return "file://" + own


def spread(df: DataFrame) -> DataFrame:
    """Give compute-heavy rows to all cores where the input has fewer splits than cores.

    Large inputs have more splits than cores and pass as they are, unshuffled.
    """
    want = df.sparkSession.sparkContext.defaultParallelism
    if df._jdf.queryExecution().toRdd().getNumPartitions() >= want:
        return df
    return df.repartition(3 * want)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder; what is written there goes with ``release``, or when the driver ends."""
    if not _written:
        atexit.register(release, spark)
    _written.append(f"{scratch_dir(spark)}/strataq-{name}-{uuid.uuid4().hex}")
    return _written[-1]


def durable(df: DataFrame, by: str | None = None) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    A written table survives the loss of executors, is stored compressed and can
    be pruned by column.  ``by`` names a low-cardinality partition column.  The
    files go with ``release``, or when the driver ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: The tables written so far.
_written: list[str] = []


def release(spark: SparkSession) -> None:
    """Remove the tables written so far, once the results that read them are written themselves."""
    while _written:
        _remove(spark, _written.pop())


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session is gone already; the folder is the cluster's to clean
        pass
