"""Session settings the mart's semantics depend on, and the shared work folder."""

from __future__ import annotations

import contextlib
import math
import os
import re
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Settings the results depend on (UTC timestamps, strict parsing) and the
# runtime re-planning the joins rely on for hot keys.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

PLANNING_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot key may sit below a join whose output partitioning a later
    # operator reuses; split it anyway rather than leave one task with it.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # No broadcast from plan-time size *estimates* (they can be far off for
    # derived tables at scale). Broadcasts come only from an explicit
    # row-bound check (operators.joins.fits) or from AQE, which decides on
    # the measured size of a finished shuffle stage.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32MB",
}


# Starting shuffle width of a pipeline run: one partition per this many
# bytes of source files, at most MAX_SHUFFLE_PARTITIONS. Shuffles here carry
# projected, pre-aggregated or semi-joined rows (much less than the input),
# and AQE merges partitions below its advisory size, so starting wide is
# cheap while starting narrow cannot be undone at runtime.
SOURCE_BYTES_PER_SHUFFLE_PARTITION = 4 << 30
MAX_SHUFFLE_PARTITIONS = 32768


def fit_shuffle_partitions(spark: SparkSession, source_bytes: int) -> int:
    """Raise ``spark.sql.shuffle.partitions`` to suit ``source_bytes`` of input.

    Never lowers a setting the user chose; returns the width in effect.
    """
    current = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = min(MAX_SHUFFLE_PARTITIONS, math.ceil(source_bytes / SOURCE_BYTES_PER_SHUFFLE_PARTITION))
    if wanted > current:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
        return wanted
    return current


R = TypeVar("R")


def side_by_side(spark: SparkSession, steps: Mapping[str, Callable[[], R]],
                 workers: int = 4) -> dict[str, R]:
    """Run independent driver-side steps from up to ``workers`` threads.

    Each step submits its own Spark jobs; Spark schedules jobs from several
    threads together. A failing step re-raises here after the others finish.
    """
    if workers <= 1 or len(steps) <= 1:
        return {name: step() for name, step in steps.items()}
    # Each step keeps the caller's local properties and job tags (job group,
    # description, scheduler pool), so a fair-scheduler pool set by the user
    # still applies to the steps' jobs. The wrapper is made per step: it
    # snapshots the properties when made, and steps must not share one
    # snapshot (Spark keeps the running query's execution id in it).
    with ThreadPoolExecutor(max_workers=min(workers, len(steps))) as pool:
        futures = {name: pool.submit(inheritable_thread_target(spark)(step))
                   for name, step in steps.items()}
        return {name: future.result() for name, future in futures.items()}


# At most this many input splits per scan of the sources: past it the split
# size grows (up to MAX_SPLIT_BYTES), so a 100 TiB load is not 800k tasks.
MAX_INPUT_SPLITS = 200_000
MAX_SPLIT_BYTES = 1 << 30
_BYTE_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
               "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40, "p": 1 << 50, "pb": 1 << 50}


def conf_bytes(text: str) -> int:
    """A Spark size setting (``134217728b``, ``512m``, ``1g``, ``4096``) in bytes."""
    match = re.fullmatch(r"\s*(\d+)\s*([a-zA-Z]*)\s*", text)
    if not match or match.group(2).lower() not in _BYTE_UNITS:
        raise ValueError(f"not a size: {text!r}")
    return int(match.group(1)) * _BYTE_UNITS[match.group(2).lower()]


def fit_split_size(spark: SparkSession, source_bytes: int) -> int:
    """Raise ``spark.sql.files.maxPartitionBytes`` so ``source_bytes`` of input
    make at most about MAX_INPUT_SPLITS splits. Never lowers a setting the
    user chose; returns the split size in effect, in bytes."""
    key = "spark.sql.files.maxPartitionBytes"
    current = conf_bytes(spark.conf.get(key))
    wanted = min(MAX_SPLIT_BYTES, math.ceil(source_bytes / MAX_INPUT_SPLITS))
    if wanted > current:
        spark.conf.set(key, str(wanted))
        return wanted
    return current


@contextlib.contextmanager
def kept_settings(spark: SparkSession, *keys: str) -> Iterator[None]:
    """Settings ``keys`` of the session come back as they were."""
    before = {key: spark.conf.get(key, None) for key in keys}
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the mart needs to an existing session."""
    for key, value in {**REQUIRED_CONF, **PLANNING_CONF}.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "appmart") -> SparkSession:
    """Create (or reuse) a session with the mart's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; tests and
    the bench pass ``local[N]``.
    """
    builder = (SparkSession.builder.appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false"))
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**REQUIRED_CONF, **PLANNING_CONF}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only in local mode (tests) may it be unset, and
    then a fresh scratch folder is created and registered; on a cluster an
    unset folder is an error, so stored tables never land on executors'
    local disks.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(e.g. on the cluster's distributed file system)")
        path = tempfile.mkdtemp(prefix="appmart-ckpt-")
        sc.setCheckpointDir(path)
    return path


# Stored tables live in write-once folders, so what a size check learns about
# one never goes stale; the results are kept per stored DataFrame.
_SIZE_CHECKS: "weakref.WeakKeyDictionary[DataFrame, dict[tuple, bool]]" = weakref.WeakKeyDictionary()


def size_checks(df: DataFrame) -> dict[tuple, bool] | None:
    """Remembered ``(columns, bounds) -> fits`` results of a stored table; None if ``df`` is not one."""
    return _SIZE_CHECKS.get(df)


def write_once(df: DataFrame) -> DataFrame:
    """Say that ``df`` reads files that are never written again, so its size checks may be remembered."""
    _SIZE_CHECKS[df] = {}
    return df


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into a fresh run folder of the shared folder and
    read it back: cuts the lineage (a lost executor recomputes nothing
    upstream) and later readers get column pruning and filter pushdown."""
    path = run_dir(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return write_once(df.sparkSession.read.parquet(path))


def materialise_bucketed(df: DataFrame, label: str, column: str) -> DataFrame:
    """Like ``materialise``, with the rows bucketed by ``column``: grouping or joining by it
    (and more columns) needs no exchange.

    One shuffle deals the rows out, one file a bucket. The table's name is only lent by the
    session catalog and given back at once; the files stay in the run folder.
    """
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = run_dir(spark, label), f"bucketed_{uuid.uuid4().hex}"
    (df.repartition(buckets, column).write.format("parquet").bucketBy(buckets, column).option("path", path)
     .saveAsTable(name))
    try:
        return write_once(spark.table(name))
    finally:
        spark.sql(f"DROP TABLE {name}")


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh, never-reused sub-folder of the shared folder for one run."""
    base = shared_dir(spark)
    scope = spark.sparkContext.getLocalProperty(_SCOPE)
    return os.path.join(base, *([scope] if scope else []), f"{label}-{uuid.uuid4().hex}")


_SCOPE = "appmart.scratch"


@contextlib.contextmanager
def scratch_folders(spark: SparkSession) -> Iterator[None]:
    """Tables stored within go when it ends, those of its threads (``side_by_side``) too.

    They lie in one folder of their own, which is removed by its exact path. What leaves the
    block must be written elsewhere, not a plan over them.
    """
    sc = spark.sparkContext
    before, scope = sc.getLocalProperty(_SCOPE), f"scratch-{uuid.uuid4().hex}"
    sc.setLocalProperty(_SCOPE, scope)
    try:
        yield
    finally:
        sc.setLocalProperty(_SCOPE, before)
        folder = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(shared_dir(spark), scope))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
