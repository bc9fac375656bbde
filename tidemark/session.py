"""Session construction and the few session facts the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every plan here assumes: UTC, ANSI, AQE with skew handling."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the cluster names; a local one only where none is named and all runs on this machine."""
    context = spark.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if not named and context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidemark-checkpoint-"))
    return context._jsc.sc().getCheckpointDir().get()


def _file_system(spark: SparkSession, path: str):
    """Hadoop's path and file system, so that any store that Spark reaches will do."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


class Scratch:
    """Tables written to the shared checkpoint folder, which cut lineage and outlive lost executors.

    ``keep`` writes a table and reads it again; ``drop`` deletes tables that are done with; the rest goes when the block ends.
    Within it, shuffle files go with the job that wrote them, since what a later job needs has been written.
    """

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folder = f"{ensure_checkpoint_dir(spark)}/scratch-{uuid.uuid4().hex}"
        self.paths: dict[int, str] = {}

    def __enter__(self) -> Scratch:
        self.before = self.spark.conf.get(self.CLEANUP, "false")
        self.spark.conf.set(self.CLEANUP, "true")
        return self

    def __exit__(self, *error) -> None:
        self.spark.conf.set(self.CLEANUP, self.before)
        self._delete(self.folder)

    def keep(self, df: DataFrame) -> DataFrame:
        out, path = _written(df, f"{self.folder}/{uuid.uuid4().hex}")
        self.paths[id(out)] = path
        return out

    def drop(self, *kept: DataFrame) -> None:
        for df in kept:
            self._delete(self.paths.pop(id(df)))

    def _delete(self, path: str) -> None:
        at, files = _file_system(self.spark, path)
        files.delete(at, True)


def _written(df: DataFrame, path: str) -> tuple[DataFrame, str]:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def durable(df: DataFrame) -> DataFrame:
    """The table, written to the shared checkpoint folder and read again; it goes when the application ends.

    Lost executors cost no recomputation of what lies before.
    """
    spark = df.sparkSession
    out, path = _written(df, f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}")
    at, files = _file_system(spark, path)
    files.deleteOnExit(at)
    return out


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver found it."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (root, known) if p)
