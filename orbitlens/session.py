"""Session settings and the shared folder used to cut long lineages."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "orbitlens", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on (UTC, AQE with skew handling)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Where the setting is missing, a temporary folder is taken in local mode only; on a
    cluster a machine-local folder would be wrong, so that is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="orbitlens-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/orbitlens/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "frame") -> DataFrame:
    """Write a frame once to the shared folder and read it back.

    For frames that are read several times and are dear to recompute. The copy survives
    lost executors, and later readers still prune columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application (as ``--py-files`` would)."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        str(Path(tempfile.mkdtemp(prefix="orbitlens-py-")) / root.name), "zip", root.parent, root.name
    )
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)
