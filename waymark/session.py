"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Drops a query's shuffle files when it has ended.
_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Paths of the tables written within the innermost `only`.
_written: ContextVar[list[str] | None] = ContextVar("written", default=None)


def build_session(app: str = "waymark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update(conf)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only where `spark.checkpoint.dir` is unset and the session runs in local mode is a
    folder made here; on a cluster a machine-local folder would be lost with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="waymark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Queries made and run within drop their shuffle files when they have ended."""
    before = spark.conf.get(_SHUFFLES, None)
    spark.conf.set(_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_SHUFFLES)
        else:
            spark.conf.set(_SHUFFLES, before)


def cut(df: DataFrame) -> DataFrame:
    """Write `df` as a table in the shared folder and go on from there.

    The table outlives its executors, cuts the lineage, gives the planner true sizes and lets later
    steps read only the columns they need. Shuffle files that led to it go once it is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    with swept(spark):
        df.write.parquet(path)
    if (paths := _written.get()) is not None:
        paths.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table._written_to = path
    return table


def drop(*tables: DataFrame) -> None:
    """Deletes tables that `cut` returned and that nothing reads any more; other rows are left alone."""
    for table in tables:
        if path := vars(table).get("_written_to"):
            _delete(table.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def only(make: Callable[[], DataFrame]) -> DataFrame:
    """The table of what `make` returns. Tables that `make` wrote on the way are deleted, so nothing else may read them."""
    paths: list[str] = []
    within = _written.set(paths)
    try:
        made = make()
        _written.reset(within)
        out = cut(made)
    except BaseException:
        if _written.get() is paths:
            _written.reset(within)
        raise
    for path in paths:
        _delete(out.sparkSession, path)
    return out


def cut_partitions(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: like `cut`, but keeps the partitions and the order of rows inside them."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return df.checkpoint(eager=True)
