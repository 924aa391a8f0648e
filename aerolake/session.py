"""Session settings every aerolake job relies on."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Results depend on the first two: day boundaries and ISO text are computed in
# UTC, bad values must go through try_cast. AQE splits skewed shuffles; small
# shuffle partitions are joined up to the advisory size, so writes leave few
# files. That size is of compressed rows, of which short ones take some twenty
# times as much in a hash aggregate, so it bounds what one task holds. Then comes
# a bound of what one Arrow batch of file contents may weigh.
SESSION_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16777216",
    "spark.sql.execution.arrow.maxBytesPerBatch": "67108864",
    # A repeated key in repaired JSON keeps its last value, like other parsers.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session and return it."""
    for key, value in SESSION_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder on storage that every executor can reach.

    It lies under ``spark.checkpoint.dir`` or, where that is unset, under the
    warehouse folder, which every session has.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{root.rstrip('/')}/aerolake/{label}-{uuid.uuid4().hex}"


def require(spark: SparkSession) -> None:
    """Raise unless the settings that results depend on are as `configure` sets them."""
    for key in ("spark.sql.session.timeZone", "spark.sql.ansi.enabled"):
        if spark.conf.get(key).lower() != SESSION_SETTINGS[key].lower():
            raise RuntimeError(f"{key} must be {SESSION_SETTINGS[key]}; call aerolake.configure(spark)")
