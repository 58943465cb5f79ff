"""Session defaults and the shared scratch location."""

from __future__ import annotations

import contextlib
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import SparkSession

from .sources import fs

CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a table hashed on volume_id serve joins and windows on (volume_id, ...) without a second exchange.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Rows carry gate arrays of a few KiB each; small Arrow batches keep Python workers flat.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str = "polarscan", master: str | None = None, extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    return ship_package(builder.getOrCreate())


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Makes this package importable in Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="polarscan-code-")) / "polarscan"
        archive = shutil.make_archive(str(target), "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir``, or where that is unset one below the warehouse.

    Only a local master, whose executors share its disk, falls back to a temporary folder.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        local = master == "local" or master.startswith("local[")
        path = tempfile.mkdtemp(prefix="polarscan-") if local else f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/polarscan-scratch"
        spark.conf.set("spark.checkpoint.dir", path)
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


_scope = threading.local()


@contextlib.contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Drops the tables that ``materialize`` writes inside the scope when it ends; results must be stored by then."""
    outer = getattr(_scope, "paths", None)
    _scope.paths = []
    try:
        yield
    finally:
        for path in _scope.paths:
            fs.delete(spark, path)
        _scope.paths = outer


def materialize(df, name: str):
    """Write ``df`` to a table in the shared folder and read it back.

    Used where a Python generator feeds several branches: the branches then read only the columns they need, and a lost
    executor re-reads files instead of decoding again. Masks are mostly zeros, of which the default compression keeps a twentieth.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if getattr(_scope, "paths", None) is not None:
        _scope.paths.append(path)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
