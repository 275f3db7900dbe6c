"""Session construction and the shared working folder.

Jobs that must cut lineage or stage a table write under the folder the
cluster names in ``spark.checkpoint.dir``. Only when that is unset (local
runs, tests) does :func:`workspace` create one and register it.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of this package relies on. Shuffle partitions are
# left to the caller / cluster defaults; AQE coalesces small partitions and
# splits skewed ones at run time.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def get_session(master: str | None = None, app: str = "starflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Set the runtime SQL settings this package depends on (idempotent)."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)


def spark_context(spark: SparkSession):
    """The session's SparkContext, or None for a Spark Connect session."""
    try:
        return spark.sparkContext
    except Exception:  # Spark Connect sessions have no context on the client
        return None


def task_slots(spark: SparkSession) -> int:
    """Task slots of the cluster (default parallelism)."""
    sc = spark_context(spark)
    if sc is not None:
        return sc.defaultParallelism
    return int(spark.conf.get("spark.default.parallelism", None)
               or spark.conf.get("spark.sql.shuffle.partitions", "200"))


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and staged tables.

    Read from the session; in local mode, when none is named (tests), create a
    private one and register it as the checkpoint dir. On a cluster a missing
    setting is an error.
    """
    sc = spark_context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None) or (sc.getCheckpointDir() if sc else None)
    if not d:
        master = sc.master if sc else ""
        if not (master == "local" or master.startswith("local[")):
            # every node would get a folder of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
        d = tempfile.mkdtemp(prefix="starflow-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if sc is not None and not sc.getCheckpointDir():
        # keep DataFrame.checkpoint() data in the same place
        sc.setCheckpointDir(d)
    return d


def workspace(spark: SparkSession, name: str = "run") -> str:
    """A fresh sub-folder of the shared checkpoint folder for one job."""
    root = checkpoint_root(spark)
    sep = "" if root.endswith("/") else "/"
    return f"{root}{sep}starflow/{name}-{uuid.uuid4().hex[:12]}"


def remove_folder(spark: SparkSession, path: str, encoded: bool = False) -> None:
    """Delete a folder this package staged (or a partition folder that has become empty).

    ``encoded``: the path is a URI, as in the hidden column ``_metadata.file_path``. Sessions
    without a context (Spark Connect) leave the folder to the cluster's clean-up.
    """
    sc = spark_context(spark)
    if sc is None:
        return
    jvm = sc._jvm
    p = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(path)) if encoded else jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(sc._jsc.hadoopConfiguration()).delete(p, True)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``starflow`` importable in Python workers (like ``--py-files``).

    Needed where package code runs inside tasks (``mapInPandas``). The
    package is zipped once per driver process and added once per context.
    """
    import zipfile

    sc = spark_context(spark)
    app = sc.applicationId if sc is not None else f"connect-{spark.conf.get('spark.app.id', '')}"
    if app in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    out = os.path.join(tempfile.mkdtemp(prefix="starflow-pkg-"), "starflow.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)


def scale_conf(input_bytes: int, slots: int, shuffle_fraction: float = 0.3,
               target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Spark settings sized for a job reading ``input_bytes`` on ``slots`` task slots.

    * scan splits of up to 512 MB (``maxPartitionBytes``), but never fewer
      splits than two per slot;
    * initial shuffle partitions so that the expected shuffle volume
      (``shuffle_fraction`` of the input) lands near ``target_partition_bytes``
      per partition, at least two per slot; AQE then coalesces toward the
      same advisory size and splits skewed partitions.

    For 100 TB on 8,000 slots this gives 512 MB scan splits (~200k scan tasks,
    25 waves) and ~120k initial shuffle partitions of ~256 MB each.
    """
    gb = 1 << 30
    split = max(64 << 20, min(512 << 20, input_bytes // max(1, 2 * slots)))
    shuffle_parts = max(2 * slots, int(input_bytes * shuffle_fraction // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(split),
        "spark.sql.shuffle.partitions": str(shuffle_parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(shuffle_parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(max(gb, 4 * target_partition_bytes)),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
    }
