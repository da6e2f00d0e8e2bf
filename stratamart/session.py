"""What the engine needs from the session it is given: settings and a shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"
SKEW_SETTINGS = (
    "spark.sql.adaptive.enabled",
    "spark.sql.adaptive.skewJoin.enabled",
    "spark.sql.adaptive.forceOptimizeSkewedJoin",
    "spark.sql.requireAllClusterKeysForDistribution",
)
#: Spark bounds the size of a Bloom filter (8 MB), so the table it is made from may be large.
FILTER_SOURCE = ("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", "64g")
SETTINGS = dict.fromkeys(SKEW_SETTINGS, "true") | dict([FILTER_SOURCE])


def tune(spark: SparkSession) -> SparkSession:
    """Settings that keep a key with a large share of the rows from becoming one task.

    Adaptive execution splits a hot join key even where that costs one more shuffle. A
    deduplication or rollup on several columns is spread by all of them, after combining on the map
    side, instead of reusing the partitioning of a join on one of them. Large tables, too, may give
    the Bloom filter of a runtime filter. Other sizes, memory and partition counts are left to the
    cluster. For entry points, whose session it is.
    """
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


@contextmanager
def tuned(spark: SparkSession) -> Iterator[SparkSession]:
    """``tune`` for the jobs run inside; the caller's settings come back afterwards."""
    before = {name: spark.conf.get(name, None) for name in SETTINGS}
    try:
        yield tune(spark)
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new path for staged tables under the shared folder of the cluster.

    Paths carry the application id, so that all scratch of a finished application can be dropped
    at once. A session without a shared folder is refused: executors do not see each other's local
    disks.
    """
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if not root:
        raise ValueError(
            f"staged tables need a folder that driver and executors share: set {CHECKPOINT_DIR}"
        )
    app = spark.sparkContext.applicationId
    return f"{root.rstrip('/')}/stratamart/{app}/{purpose}-{uuid.uuid4().hex}"
