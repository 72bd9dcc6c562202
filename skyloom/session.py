"""Session settings and scratch storage."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "skyloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library relies on.

    Event times are wall-clock texts read as UTC, so the session zone is UTC.
    Adaptive execution splits skewed joins and sizes shuffle partitions; the
    number of shuffle partitions is left to the cluster.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone of a session that somebody else created."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def bound_batches(spark: SparkSession, size: str = "16m") -> SparkSession:
    """Rows reach Python tasks in batches of at most about ``size``, unless the session names another bound.

    Several batches are held at once, in the executor and in its Python workers.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":  # the default
        spark.conf.set(key, size)
    return spark


#: Scratch tables written by this process and not yet deleted.
_written: list[str] = []


def use_scratch(spark: SparkSession, folder: str = "/tmp/checkpoints/skyloom") -> SparkSession:
    """Give a local session that names no shared folder one, for tests and trials."""
    if not _shared_folder(spark) and spark.sparkContext.master.startswith("local"):
        spark.sparkContext.setCheckpointDir(folder)
    return spark


def _shared_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the shared folder named in ``spark.checkpoint.dir``.

    All executors and the driver must reach that folder, so there is no other choice.
    """
    base = _shared_folder(spark)
    if not base:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    path = f"{base.rstrip('/')}/skyloom-{label}-{uuid4().hex}"
    _written.append(path)
    return path


def scratch_tables() -> list[str]:
    """Paths of the scratch tables of this process that are not yet deleted."""
    return list(_written)


def release_scratch(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete scratch tables, all of this process by default; results that read them end."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for name in scratch_tables() if paths is None else paths:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)
        if name in _written:
            _written.remove(name)


def materialise(df: DataFrame, label: str, path: str | None = None) -> DataFrame:
    """Write ``df`` once and read it back.

    Used where several jobs read the same costly result: the files survive the
    loss of executors, cut the lineage and carry their size, so that later joins
    can choose a broadcast from a known number of bytes.
    """
    spark = df.sparkSession
    target = path or scratch_path(spark, label)
    df.write.mode("overwrite").parquet(target)
    return spark.read.schema(df.schema).parquet(target)
