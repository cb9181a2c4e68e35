"""Spark session settings the model depends on.

Two settings change results, not just speed:

* ``spark.sql.session.timeZone`` = UTC. Casting to timestamp and to date
  follows the session zone, and the day boundary decides ``datediff``.
* ANSI mode stays on (the Spark 4 default): bad casts and zero divisors
  raise instead of silently turning into NULL. Rates use ``try_divide``.

The rest is execution tuning for large inputs: adaptive query execution
(runtime broadcast of sides that turn out small, partition coalescing, and
splitting of skewed join partitions).
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"

TUNING = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None, app_name: str = "martlet",
                  extra: dict | None = None, driver_memory: str | None = None) -> SparkSession:
    """Session with the settings above; UI off. Master, shuffle partitions
    and memory are set only where given: settings made in code override those
    of spark-submit, so a cluster's own values must stay untouched."""
    b = (SparkSession.builder.appName(app_name)
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false"))
    if master:
        b = b.master(master)
    given = {"spark.sql.shuffle.partitions": shuffle_partitions, "spark.driver.memory": driver_memory}
    b = b.config(map={k: str(v) for k, v in given.items() if v is not None})
    for k, v in {**TUNING, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_required(spark)
    return spark


def apply_required(spark: SparkSession) -> None:
    """Settings that change results; safe to call on any existing session."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.ansi.enabled", "true")


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by whoever runs the job (it is a static
    setting) and is used as is; a cluster session without it is an error.
    Only local sessions (tests, local runs) fall back to a private folder,
    which is also registered as the RDD checkpoint folder when the session
    exposes a SparkContext.
    """
    d = spark.conf.get(CHECKPOINT_CONF, None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        sc = None
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        master = spark.conf.get("spark.master", "") or ""  # unknown is no local session
        if not master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder on shared storage: intermediate "
                               "results must survive the loss of the machine that wrote them")
        app = sc.applicationId if sc is not None else id(spark)
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="martlet-ckpt-")
        d = _local_dirs[app]
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d.rstrip("/")


_local_dirs: dict[str | int, str] = {}


def tune_for_input(spark: SparkSession, input_bytes: int, target_partition_bytes: int = 256 << 20) -> int:
    """Size shuffles for an input of ``input_bytes``: about one shuffle
    partition per ``target_partition_bytes`` (so a partition fits an
    executor's memory and spills little), the same target for scan splits
    and as AQE's advisory size (AQE then merges partitions that come out
    small). Returns the shuffle partition count set."""
    n = max(8, -(-input_bytes // target_partition_bytes))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    return n


#: Shuffled bytes that a task reads at most. They are compressed, small columns
#: well; sorted rows take ten to twenty times that in memory.
TASK_BYTES = 16 << 20
#: One shuffle partition, before small ones are merged, for so many bytes of input files.
INPUT_BYTES_A_PARTITION = 4 << 20


def _bytes(size: str) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([bkmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << (10 * "bkmgtp".index(unit or "b"))


def bound_tasks(spark: SparkSession, input_bytes: int) -> None:
    """Keep what a task sorts about the same whatever the input: more shuffle
    partitions for more input, merged only up to TASK_BYTES; of files a scan task
    reads about as much, since it holds what it shuffles. A session's own
    smaller size or larger count stays."""
    size, count = "spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    for c in (size, "spark.sql.files.maxPartitionBytes"):
        if _bytes(spark.conf.get(c)) > TASK_BYTES:
            spark.conf.set(c, str(TASK_BYTES))
    wanted = -(-input_bytes // INPUT_BYTES_A_PARTITION)
    if wanted > int(spark.conf.get(count, None) or spark.conf.get("spark.sql.shuffle.partitions")):
        spark.conf.set(count, str(wanted))
