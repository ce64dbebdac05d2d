"""Session settings shared by jobs, tests and the bench.

All time arithmetic in the package assumes the session time zone is UTC:
movement instants are stored as TIMESTAMP and the analytics use the UTC date
and hour, while London wall-clock values are derived explicitly with
``from_utc_timestamp``.  ``use_utc`` pins the zone on an existing session.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Day replacement writes only the partitions present in the output.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.ansi.enabled": "true",
}


def build_session(master: str = "local[*]", app: str = "trackside",
                  shuffle_partitions: int = 8, extra: dict | None = None) -> SparkSession:
    """Local session for tests and the bench (a cluster passes its own)."""
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.driver.memory", "8g")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    for k, v in {**SESSION_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    use_utc(spark)
    return spark


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the package relies on (cheap, idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the deployment and must be a shared file
    system; it is only filled in here when unset in local mode (tests).
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="trackside-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d.rstrip("/")


def jvm_path(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path on it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = jvm_path(spark, path)
    return fs.exists(p)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    path = f"{root}/trackside/{label}-{uuid.uuid4().hex[:12]}"
    fs, p = jvm_path(spark, path)
    fs.mkdirs(p)
    fs.deleteOnExit(p)   # with the session: what a query reads from it is needed until then
    return path


def cluster_settings(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 256 * 1024 * 1024) -> dict:
    """Partition sizing for a cluster run over ``input_bytes`` of input.

    * scan splits of ``target_partition_bytes`` (row groups permitting), so
      a task's input and its sort/aggregation buffers fit executor memory;
    * an initial shuffle width of about one partition per split, and at
      least two waves of the cluster's cores, which AQE then coalesces
      towards the same advisory size (the analytics shuffles are tiny after
      partial aggregation and collapse to a few partitions);
    * AQE skew handling on, so a hot key in a sort-based operator is split.
    Pass the result to ``SparkSession.builder.config`` or set it at runtime.
    """
    splits = max(1, -(-input_bytes // target_partition_bytes))
    shuffle = max(2 * total_cores, splits)
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
    }
