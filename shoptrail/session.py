"""Session helpers shared by every operator."""

from __future__ import annotations

import tempfile
import threading
import uuid

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "shoptrail") -> SparkSession:
    """A session for tests and the bench. A cluster brings its own."""
    parallelism = "8" if cores == "*" else str(cores)
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", parallelism)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.python.unix.domain.socket.enabled", "true")  # a third off every small Python job
        .getOrCreate()
    )


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only a local master gets a temporary one."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="shoptrail-checkpoint-")
    context.setCheckpointDir(shared)


def _drop_shuffles(df: DataFrame) -> None:
    """Remove the shuffle files of ``df``'s own run. Nothing else reads them, and otherwise they stay until the driver collects garbage."""
    plan, cleaner = df._jdf.queryExecution().executedPlan(), df.sparkSession.sparkContext._jsc.sc().cleaner()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec" and cleaner.isDefined():
        for number in list(plan.context().shuffleIds().keySet()):
            cleaner.get().doCleanupShuffle(number, True)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and cut its lineage there.

    Used where a layout or a draw must be fixed before two readers use it, or where an
    iteration would otherwise re-run everything before it. The shuffle files behind it go at once.
    """
    ensure_checkpoint_dir(df.sparkSession)
    run = df.select("*")  # a run of its own: no other action uses its shuffles
    made = run.checkpoint(eager=True)
    _drop_shuffles(run)
    return made


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_writers, _writing = threading.Lock(), {}


@contextmanager
def passing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in here remove their shuffle files when they end. Threads may share a session: the last one restores its setting."""
    session = spark._jsparkSession.sessionUUID()
    with _writers:
        count, before = _writing.get(session) or (0, spark.conf.get(_CLEANUP, "false"))
        _writing[session] = count + 1, before
        spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        with _writers:
            count, before = _writing.pop(session)
            if count > 1:
                _writing[session] = count - 1, before
            else:
                spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back.

    Unlike ``materialize`` this keeps columns, statistics and partitions, so later stages read only what they use.
    """
    ensure_checkpoint_dir(df.sparkSession)
    folder = f"{df.sparkSession.sparkContext.getCheckpointDir()}/stored-{uuid.uuid4().hex}"
    with passing_shuffles(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def discard(df: DataFrame) -> None:
    """Remove the folder of a table that ``stored`` wrote, once everything that reads it has run."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        if "/stored-" not in folder:
            raise ValueError(f"not a stored table: {folder}")
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
