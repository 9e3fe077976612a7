"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

LOCAL_MASTER = re.compile(r"local(\[.*\])?")


def build_session(app: str = "roadlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings every job here relies on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that functions run there
    without an installation and from any working directory."""
    context = spark.sparkContext
    if getattr(context, "_roadlens_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="roadlens-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    archive = os.path.join(folder, "roadlens.zip")
    with zipfile.ZipFile(archive, "w") as packed:
        for path, _, files in os.walk(home):
            for name in sorted(files):
                if name.endswith(".py"):
                    full = os.path.join(path, name)
                    packed.write(full, os.path.relpath(full, os.path.dirname(home)))
    context.addPyFile(archive)
    context._roadlens_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not LOCAL_MASTER.fullmatch(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    fallback = tempfile.mkdtemp(prefix="roadlens-")
    atexit.register(shutil.rmtree, fallback, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", fallback)
    return fallback


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def written(df: DataFrame, name: str) -> DataFrame:
    """Like ``durable``, in compressed columns: for rows of which many are alike or that are wide."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def durable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` on reliable storage, so later passes see the very same rows."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()
