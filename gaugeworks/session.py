"""Session defaults, lineage cuts and the shared scratch folder."""

from __future__ import annotations

import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "gaugeworks", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect: UTC, AQE and skew handling."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    for key, val in {**defaults, **conf}.items():
        builder = builder.config(key, val)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to all workers; needed where it is not installed on the machines of the cluster. The functions of
    some operators run in Python workers, which import it."""
    root = Path(__file__).resolve().parent
    made = shutil.make_archive(str(Path(tempfile.mkdtemp(prefix="gaugeworks-")) / "gaugeworks"), "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(made)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Where the setting is absent a temporary folder is used, and only in local mode: on a cluster a
    machine-local folder would lose the data together with its machine.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named
    if sc.getCheckpointDir() is not None:
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="gaugeworks-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/scratch/{name}-{uuid.uuid4().hex}"
    for made in _scopes.__dict__.get("open", [])[-1:]:
        made.append(path)
    return path


_scopes = threading.local()


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Remove what this thread writes to scratch paths within the block. Results must have been stored elsewhere by its end."""
    _scopes.__dict__.setdefault("open", []).append([])
    try:
        yield
    finally:
        for path in _scopes.open.pop():
            remove_path(spark, path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder in whatever store it is."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: its lineage ends there, the result survives
    lost executors, and later joins know its true size."""
    path = scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
