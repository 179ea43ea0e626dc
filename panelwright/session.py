"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Correctness settings: both are assumed by the date, join and cast logic.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    # month=2026-03 must stay a string, also when it would parse as a date.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}

# Scale settings. AQE coalesces small shuffle partitions, splits skewed join
# partitions and picks broadcast joins from *measured* sizes.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    # Ranks up to here are pruned in each task before their shuffle; the default stops at 1,000.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime-settable settings to an existing session."""
    for key, value in {**REQUIRED_CONF, **SCALE_CONF}.items():
        spark.conf.set(key, value)
    return spark


def local_session(cpus: int = 8, shuffle_partitions: int | None = None, app: str = "panelwright") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", os.environ.get("PANELWRIGHT_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
    )
    for key, value in {**REQUIRED_CONF, **SCALE_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Root folder all executors can reach: the cluster's ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    global _LOCAL_DIR
    if _LOCAL_DIR is None:
        _LOCAL_DIR = tempfile.mkdtemp(prefix="panelwright-")
    return _LOCAL_DIR


_LOCAL_DIR: str | None = None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/panelwright/{name}-{uuid.uuid4().hex[:12]}"


def ship_package(spark: SparkSession) -> None:
    """Add the package to the job's Python files once per application, so that executors need no copy of it."""
    context = spark.sparkContext
    if _SHIPPED.get("application") == context.applicationId:
        return
    root = Path(__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="panelwright-code-")) / "panelwright_code.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))      # Spark serves it to the executors
    _SHIPPED["application"] = context.applicationId


_SHIPPED: dict[str, str] = {}
