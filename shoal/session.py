"""Session settings the JSON operators rely on.

``configure`` only touches SQL runtime settings, so it is safe on a shared session and
is called by every entry point.  ``build_session`` is for tests and the bench.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Runtime settings the expressions depend on (nothing else is touched; per-write
# options such as dynamic partition overwrite are passed on the write itself).
#  * duplicate keys in one JSON object: the last one wins instead of a null document;
#  * map building (key clean-up can make two keys equal): the last entry wins;
#  * column names resolve case-insensitively, like the Hive tables we feed.
RUNTIME_CONF = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.caseSensitive": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(
    master: str | None = None,
    app: str = "shoal",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A local session for tests and the bench: UI off, UTC, sized shuffles."""
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or cpus))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def scratch_root(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    This is ``spark.checkpoint.dir``, a shared file system the cluster names.  A session on
    one machine (tests, the bench) that has none gets a folder of its own; on a cluster a
    machine's own folder would scatter the data, so its absence is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir is not set; on {master} it must name a shared folder")
        root = tempfile.mkdtemp(prefix="shoal-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")
