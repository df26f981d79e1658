"""Session helpers: a session for tests and benches, and the shared work folder."""

from __future__ import annotations

import functools
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", app: str = "tickfold", **conf: object) -> SparkSession:
    """A local session for tests and benches. On a cluster, submit with its own conf."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
    )
    for key, value in conf.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


@functools.cache
def _local_root() -> str:
    return tempfile.mkdtemp(prefix="tickfold-")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that every executor can reach, for written tables and checkpoints.

    The cluster names its folder in ``spark.checkpoint.dir``. Only a local session may go
    without: driver and executors are then one process and share a temporary folder.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
        root = _local_root()
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, also where it is only on the driver's path.

    The driver serves it as an archive to all executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        to = os.path.join(tempfile.mkdtemp(prefix="tickfold-"), "tickfold")
        root, name = os.path.split(package)
        sc.addPyFile(shutil.make_archive(to, "zip", root, name))
        _shipped.add(sc.applicationId)
