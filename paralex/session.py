"""Session defaults and shared scratch locations."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_ROOT: list[str] = []
_SHIPPED: set[str] = set()


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paralex")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever the driver was started:
    once per application it is added as a zip file."""
    if spark.sparkContext.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    folder = tempfile.mkdtemp(prefix="paralex-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    root, name = os.path.split(package)
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, name), "zip", root, name))
    _SHIPPED.add(spark.sparkContext.applicationId)


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the shared folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session.  Only where it is unset,
    a local-mode session gets a folder of its own, which goes when the process
    ends; on a cluster a machine-local path would not be visible to other
    executors, so its absence is an error there.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        if not _LOCAL_ROOT:
            _LOCAL_ROOT.append(tempfile.mkdtemp(prefix="paralex-"))
            atexit.register(shutil.rmtree, _LOCAL_ROOT[0], ignore_errors=True)
        root = _LOCAL_ROOT[0]
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage is cut, and
    row numbers taken from the physical order stay what they are."""
    path = scratch(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
