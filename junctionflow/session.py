"""Session construction and the shared working folder.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; it
is read from the running session and never replaced. Only when it is unset (a
local test session) is a private folder created and registered.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every session of ours carries. Shuffle width is left to the caller:
# AQE coalesces small batch shuffles, and stateful streams fix their width at
# the first checkpoint.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot sensor's join partition even when the split costs one more
    # shuffle (e.g. a per-sensor aggregate right after the join): that shuffle
    # carries partial aggregates, while an unsplit partition is one task holding
    # a third of all rows.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def cluster_conf(
    executors: int,
    cores_per_executor: int,
    advisory_partition_bytes: str = "256m",
    state_store: str = "rocksdb",
    state_partitions: int | None = None,
    batch_partitions: int | None = None,
) -> dict[str, str]:
    """Settings for a large batch/stream deployment (pass as ``conf=`` to :func:`get_spark`).

    * batch shuffles start at ``batch_partitions`` (default 4x the cores,
      ``coalescePartitions.initialPartitionNum``) and AQE coalesces them to
      ``advisory_partition_bytes`` per task at run time, so the same job fits a
      100 GB and a 100 TB night. AQE merges partitions but only splits skewed
      join sides, so a job that shuffles raw readings rather than partial
      aggregates (e.g. the profile join without a broadcast) wants about
      shuffled bytes / advisory size here;
    * streams ignore AQE and a stateful query keeps the shuffle width of its first
      checkpoint for good, so ``spark.sql.shuffle.partitions`` is sized for the
      window state instead (default: the cores). Input is
      pre-aggregated per task before that shuffle, so the state stage handles
      (sensors x open windows) rows, not readings, and one wave of tasks per
      micro-batch is enough; 32,000 state partitions would each load a state
      store every 30 s;
    * file splits of 512 MB keep scan tasks few and long enough to amortise start-up;
    * AQE skew-join splitting stays on for hot sensors;
    * stateful streams keep window state in RocksDB (off-heap, spills to disk)
      instead of the JVM heap.
    """
    cores = max(1, executors * cores_per_executor)
    conf = {
        "spark.sql.shuffle.partitions": str(state_partitions or cores),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(batch_partitions or cores * 4),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": advisory_partition_bytes,
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
        "spark.sql.files.maxPartitionBytes": "512m",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    }
    if state_store == "rocksdb":
        conf["spark.sql.streaming.stateStore.providerClass"] = (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        )
    return conf


def get_spark(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "junctionflow",
    conf: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``), set up locally only if unset."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        try:
            root = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key raises on some versions
            root = None
    if not root:
        master = sc.master or ""
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; on a cluster it must name a shared folder "
                "(executors and a restarted driver must all reach it)"
            )
        # Local/test session only: nothing names a shared folder, so make one.
        root = tempfile.mkdtemp(prefix="junctionflow-cp-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str, unique: bool = True) -> str:
    """A fresh sub-folder of the shared folder for one run's tables or checkpoints."""
    leaf = list(parts)
    if unique:
        leaf.append(uuid.uuid4().hex[:12])
    return "/".join([checkpoint_root(spark), "junctionflow", *leaf])
