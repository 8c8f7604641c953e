"""Session settings, the shared working folder, and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(
    app_name: str = "stayscope",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **conf: str,
) -> SparkSession:
    """Open a session with adaptive execution and UTC timestamps.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the submit
    configuration decides, and adaptive execution coalesces small partitions.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master is not None:
        builder = builder.master(master)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in conf.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    A local session without the setting gets a fresh temporary folder; on a
    cluster the missing setting is an error, since a machine-local folder would
    be lost with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get(
        "spark.checkpoint.dir"
    )
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        folder = getattr(context, "_stayscope_folder", None)
        if folder is None:
            folder = tempfile.mkdtemp(prefix="stayscope-")
            context._stayscope_folder = folder
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Store ``df`` once as a table in the shared folder and return a reader of it.

    Unlike a checkpoint of rows, later reads of the table skip unused columns.
    The folder belongs to the run; its owner decides when to empty it.
    """
    path = fresh_path(df.sparkSession, "stored")
    df.write.parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    stored._stored_at = path
    return stored


def release(stored: DataFrame) -> None:
    """Remove the table behind a result of :func:`cut_lineage` that nothing will read again.

    To be called once all that was made from it is itself stored.
    """
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored._stored_at)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)

