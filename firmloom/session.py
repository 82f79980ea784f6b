"""Session helpers: a local test session and the one place that cuts lineage."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and local benches; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("firmloom")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the cluster.

    The cluster names it in ``spark.checkpoint.dir``.  Only a ``local`` master
    may fall back to a temporary folder, because there driver and executors
    share one machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        configured = tempfile.mkdtemp(prefix="firmloom-checkpoint-")
    context.setCheckpointDir(configured)
    return context.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its plan.

    A reliable checkpoint, so the data outlives any executor.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions of the package travel by reference, so the workers must be able
    to import it wherever the driver found it.
    """
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="firmloom-package-")) / package.name
        shutil.make_archive(str(archive), "zip", package.parent, package.name)
        spark.sparkContext.addPyFile(f"{archive}.zip")
        _SHIPPED.add(app)


def map_frames(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInPandas(run, schema)`` on workers that can import this package."""
    ship_package(df.sparkSession)
    return df.mapInPandas(run, schema)


def map_batches(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow(run, schema)`` on workers that can import this package."""
    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)
