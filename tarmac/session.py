"""Session settings and the shared work folder.

The engine needs five things from a session: UTC wall clock (all
timestamps are UTC), ANSI mode (overflowing decimal casts raise instead
of turning into NULL), AQE (runtime coalescing, skew-join splitting and
broadcast conversion), broadcast decided on measured sizes only, and
dynamic partition overwrite (slice replace).
``configure`` applies them to any session, ``local_session`` builds one
for tests and benchmarks.
"""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession

ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Join strategy: no broadcast from static estimates (file sizes of
    # compressed columns, products of input sizes for join outputs - both
    # can make the largest table look small); AQE broadcasts a side only
    # after its shuffle output was measured below the limit, otherwise the
    # join stays a shuffle join. Explicit hints only behind a row count
    # (operators.broadcast.bounded_broadcast).
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the engine relies on."""
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tarmac") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "8g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in ENGINE_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def cluster_settings(input_bytes: int, total_cores: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a cluster run over ``input_bytes`` of parquet.

    Scan splits of ``partition_bytes`` (compressed); shuffles start with
    enough partitions that each holds about one split's worth and at
    least two waves of tasks, and AQE coalesces small ones back to the
    same advisory size, so partitions fit executor memory at any scale
    and tiny stages do not pay for thousands of empty tasks (coalescing
    targets the advisory size rather than maximal parallelism, the setting
    Spark recommends for busy clusters).
    """
    initial = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names for checkpoints.

    Read from the running context first, then from ``spark.checkpoint.dir``.
    Only a local-mode session (tests, benchmarks) may fall back to a private
    temporary folder; on a cluster a machine-local folder would not be
    visible to other executors, so an unset directory is an error there.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # sessions without a context handle: conf only
        conf_dir = spark.conf.get("spark.checkpoint.dir", None)
        if not conf_dir:
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        return conf_dir.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return conf_dir.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage (e.g. hdfs:// or s3a://)")
    local_dir = tempfile.mkdtemp(prefix="tarmac-ckpt-")
    sc.setCheckpointDir(local_dir)
    return local_dir


_collectors: list[list[str]] = []


@contextmanager
def work_dirs_made() -> Iterator[list[str]]:
    """The work folders that the block asks for, in order."""
    made: list[str] = []
    _collectors.append(made)
    try:
        yield made
    finally:
        _collectors.remove(made)


def work_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared checkpoint root for one job's tables."""
    path = f"{checkpoint_root(spark)}/tarmac-work/{label}-{uuid.uuid4().hex[:12]}"
    for made in _collectors:
        made.append(path)
    return path


def drop_work(spark: SparkSession, paths: Sequence[str], but_for: DataFrame) -> list[str]:
    """Delete these work folders, except those that ``but_for`` still reads; frames over them stop working.

    Frames nobody holds any more are collected first, so that Spark's cleaner
    also drops the shuffles behind them. Returns the folders left.
    """
    read = {f.split("/tarmac-work/")[1].split("/")[0] for f in but_for.inputFiles() if "/tarmac-work/" in f}
    jvm = spark.sparkContext._jvm
    left = []
    for name in paths:
        if name.rsplit("/", 1)[1] in read:
            left.append(name)
            continue
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    gc.collect()
    jvm.System.gc()
    return left


def materialise(df: DataFrame, label: str = "cut", observe: dict[str, Column] | None = None):
    """Write ``df`` as parquet under the shared checkpoint folder; read it back.

    With ``observe`` ({name: aggregate}), the aggregates are computed by the
    write itself (an ``Observation``, no extra scan) and returned with the
    frame: ``(frame, {name: value})``.
    """
    path = work_dir(df.sparkSession, label)
    if observe:
        obs = Observation(f"{label}_{uuid.uuid4().hex[:8]}")
        df = df.observe(obs, *[agg.alias(name) for name, agg in observe.items()])
    df.write.mode("overwrite").parquet(path)
    back = df.sparkSession.read.parquet(path)
    return (back, obs.get) if observe else back


def in_parallel(*actions, max_workers: int = 4) -> list:
    """Run independent Spark actions from a few driver threads (Spark
    schedules jobs of different threads concurrently); results in order."""
    with ThreadPoolExecutor(max_workers=max_workers) as pool:
        return [f.result() for f in [pool.submit(a) for a in actions]]


def clear_work(spark: SparkSession) -> None:
    """Delete every lineage cut and store folder under the shared checkpoint root.

    For the end of a job: frames that read those tables stop working.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_root(spark)}/tarmac-work")
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
