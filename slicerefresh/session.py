"""Session helpers: the shared folder for staged data, and a local session for tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_FALLBACK: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir`` from the session.

    A directory set on the context counts too.  Only in local mode, where
    driver and executors are one process, is a folder created and registered
    as the checkpoint directory when none is named; a cluster must name one.
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root and not (sc.master == "local" or sc.master.startswith("local[")):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not root:
        key = id(sc)
        if key not in _LOCAL_FALLBACK:
            _LOCAL_FALLBACK[key] = tempfile.mkdtemp(prefix="slicerefresh-")
        root = _LOCAL_FALLBACK[key]
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused folder under the shared folder."""
    return f"{shared_dir(spark)}/slicerefresh/{tag}-{uuid.uuid4().hex[:12]}"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "slicerefresh") -> SparkSession:
    """A local session configured as the tests and the benchmark use it."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
