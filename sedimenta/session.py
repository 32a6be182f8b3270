"""Session settings: a local session for tests and bench, scoped settings, shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def local_session(cores: int = 8, name: str = "sedimenta", **conf: str) -> SparkSession:
    """Local session for tests and the bench; on a cluster bring your own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", f"{tempfile.gettempdir()}/sedimenta-warehouse")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@contextmanager
def session_conf(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Session settings for the actions inside the block; the old values come back after.

    The settings belong to the session, so blocks of one session must not run in parallel.
    """
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the folder that every executor can reach.

    That folder is the one the cluster names in ``spark.checkpoint.dir``. Only where it is
    unset, as in a local test, a temporary folder of this machine takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="sedimenta-")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
