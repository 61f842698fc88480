"""Session helpers: a local session for tests/bench and checkpoint-dir lookup.

On a cluster the session comes from the platform; the library never builds
one itself.  ``checkpoint_dir`` reads ``spark.checkpoint.dir`` from the
running session and only falls back to a caller-supplied directory when the
setting is absent (tests).
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings the library relies on: AQE for runtime re-planning (coalescing,
# skew-join splitting, runtime broadcast of small shuffle outputs) and UTC so
# date arithmetic never depends on the host clock zone.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "equiframe", extra: dict | None = None) -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cpus}]").appName(app)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only when the session leaves it unset is a folder of our own installed:
    ``fallback`` if given (tests), else -- on a ``local[...]`` master only --
    a fresh scratch folder.  A cluster session without the setting is a
    configuration error: a machine-local folder would not survive executor
    loss.
    """
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if fallback is None:
            if not sc.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            fallback = tempfile.mkdtemp(prefix="equiframe-ckpt-")
        found = fallback
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(found)
    return found
