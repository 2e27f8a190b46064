"""SparkSession construction and the few session settings the jobs rely on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job assumes: ANSI casts (so unsafe casts fail loudly and the
# safe ones are explicit try_cast), UTC wall clock, adaptive execution and
# dynamic partition overwrite so re-running one day replaces only that day.
BASE_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.filterPushdown": "true",
    # Lists up to this length reach the Parquet reader value by value (Bloom filters), not as a range.
    "spark.sql.parquet.pushdown.inFilterThreshold": "1000",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "retention", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above.

    ``master`` and ``shuffle_partitions`` are for local runs and tests; on a
    cluster leave them unset so the submit-time configuration wins.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    for k, v in conf.items():
        if not k.startswith("spark.ui") and not k.startswith("spark.driver"):
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an already-running context
                pass
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    Uses ``spark.checkpoint.dir`` as the cluster names it. Only when it is
    unset *and* the master is local (tests, laptops) a scratch folder is
    created; on a cluster an unset value is an error, because a machine-local
    folder would not survive the loss of that machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a shared (distributed) folder.")
        d = tempfile.mkdtemp(prefix="retention-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def cluster_conf(total_cores: int, input_bytes_per_run: int | None = None) -> dict:
    """Sizing for a large cluster (pass to ``build_session(extra=...)``).

    Shuffle partitions start high (3 per core, at least one per 256 MB of
    input) and AQE coalesces them to ~256 MB; scan splits are 256 MB; AQE
    splits skewed join partitions (5x the median and over 512 MB). Nothing
    here forces a broadcast: the automatic threshold stays at its default and
    every explicit broadcast in the library is bounded by construction.
    """
    parts = max(200, 3 * int(total_cores))
    if input_bytes_per_run:
        parts = max(parts, int(input_bytes_per_run // (256 << 20)))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.files.maxPartitionBytes": str(256 << 20),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": str(64 << 20),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
        "spark.sql.adaptive.localShuffleReader.enabled": "true",
    }
