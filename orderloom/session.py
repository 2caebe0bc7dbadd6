"""Session settings that the plans rely on at scale."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime SQL settings. The forced skew-join rule matters here: the order fact
# leaves its last join partitioned by order key, the distinct-order counts above
# reuse that partitioning, and without the rule a hot key could not be split
# because splitting costs one more shuffle.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join whose build side turns out below this size in every partition is hashed
    # instead of sorting both sides; the check is made on the shuffled sizes at run time.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.session.timeZone": "UTC",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings above, leaving alone whatever the caller set explicitly."""
    explicit = spark.conf.getAll
    for key, value in RUNTIME_SETTINGS.items():
        if key not in explicit:
            spark.conf.set(key, value)
    return spark


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        code = tempfile.mkdtemp(prefix="orderloom-code-")
        context.addPyFile(shutil.make_archive(f"{code}/orderloom", "zip", package.parent, package.name))
        _SHIPPED.add(context.applicationId)


def local_session(cores: str = "*", name: str = "orderloom") -> SparkSession:
    """A session for tests and the benchmark on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)
