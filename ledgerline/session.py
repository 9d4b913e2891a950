"""Session settings and the scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# What results depend on (zone, ANSI) and what large runs need (AQE).  The
# number of shuffle partitions is left to the cluster; AQE merges small ones.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


ADVISORY_BYTES = 128 << 20


def build_session(
    app_name: str = "ledgerline",
    master: str | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def sized_for(shuffled_bytes: int) -> dict[str, str]:
    """Extra settings for jobs that shuffle about this much.

    AQE merges partitions but, outside skew handling, does not add any: the
    initial number must suit the largest shuffle.
    """
    partitions = max(200, shuffled_bytes // ADVISORY_BYTES)
    return {
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(ADVISORY_BYTES),
    }


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name in the shared folder of ``spark.checkpoint.dir``.

    Where that setting is absent, a folder of this machine will do for a local master
    and is refused for any other.
    """
    return f"{shared_folder(spark)}/ledgerline/{label}-{uuid.uuid4().hex}"


def shared_folder(spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    return tempfile.mkdtemp(prefix="ledgerline-")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` work where no folder has been named."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
