"""Session set-up and shared scratch locations.

Everything written by the library (landed files, checkpoints, staged merge output) goes under the
checkpoint directory the cluster names in ``spark.checkpoint.dir``.  We only pick our own directory when
that setting is absent and the session is local (tests); elsewhere its absence is an error.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on.  UTC is required for epoch <-> timestamp <-> date_id parity with the
# oracle; the rest are ordinary AQE settings that a cluster would normally already have.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "starload",
                  extra: dict | None = None) -> SparkSession:
    """A session for tests and the benchmark (clusters bring their own)."""
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**SESSION_DEFAULTS, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library needs to a session somebody else built."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    checkpoint_dir(spark)
    return spark


_FALLBACK_DIR: dict[str, str] = {}


def _local_folder(spark: SparkSession) -> str:
    """A folder of this machine, for a session in one process; executors elsewhere would not see it."""
    try:
        master = spark.sparkContext.master
    except Exception:  # noqa: BLE001 - a remote (Connect) session names no master
        master = spark.conf.get("spark.master", "")
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="starload-ckpt-")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory; set a local one only when the session has none (tests)."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - a remote (Connect) session has no SparkContext: use the setting itself
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            configured = _FALLBACK_DIR.get("dir") or _FALLBACK_DIR.setdefault("dir", _local_folder(spark))
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        configured = _local_folder(spark)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused folder under the shared checkpoint directory."""
    return f"{checkpoint_dir(spark).rstrip('/')}/starload/{name}-{uuid.uuid4().hex}"


def materialize(df, name: str = "table"):
    """Write ``df`` as parquet under the shared checkpoint directory and read it back.

    Cuts the lineage like ``checkpoint()`` (a lost executor recomputes nothing upstream; the files are on
    shared storage), costs one job instead of two, and later scans get column pruning and pushed filters.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    # the schema is known: passing it skips the footer-reading job of schema inference
    kept = df.sparkSession.read.schema(df.schema).parquet(path)
    kept.stored_at = path
    return kept


def discard(df) -> None:
    """Delete a table made by :func:`materialize` that nothing reads any more."""
    path = getattr(df, "stored_at", None)
    if path:
        sc = df.sparkSession.sparkContext
        p = sc._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)
