"""Runtime settings the plans rely on, and the shared folder for staged tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tagweave.fixed import RECOMMEND_MAX

_SETTINGS = {
    # top-k filters up to the largest legal top_n are limited before the shuffle
    "spark.sql.optimizer.windowGroupLimitThreshold": str(RECOMMEND_MAX),
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

_staged: dict[tuple[str, str], str] = {}
_scopes: list[list[str]] = []


def tune(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL settings on a session somebody else created."""
    for key, value in _SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for staged tables: ``spark.checkpoint.dir``, or the context's checkpoint folder.

    A local master without either gets a temporary folder of its own. On a cluster that
    folder would exist on one machine only, so there its absence is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="tagweave-")
        context.setCheckpointDir(folder)
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts lineage like a checkpoint, survives lost executors, and unlike a checkpoint keeps
    column pruning, filter push-down and a known size that join selection can check.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    df.write.parquet(path)
    return spark.read.parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1_000) -> Iterator[None]:
    """Groups of queries that run inside go to Python in Arrow batches of few rows.

    For each row of a group Spark adds up the bytes of the whole batch so far, which for batches of
    10,000 rows takes several times as long as the rows themselves.
    """
    before = spark.conf.get(_BATCH_ROWS)
    spark.conf.set(_BATCH_ROWS, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_ROWS, before)


@contextmanager
def free_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries that run inside give the disk of their shuffles back as soon as they end.

    Meant for tables that are staged: a frame that runs twice has to shuffle twice.
    """
    before = spark.conf.get(_FREE_SHUFFLES, "false")
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def delete_folder(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    place.getFileSystem(conf).delete(place, True)


def discard(staged: DataFrame) -> None:
    """Delete a staged table that nothing needs any more."""
    folder = staged.inputFiles()[0].rpartition("/")[0]
    if folder.rpartition("/")[0].endswith("/staged"):
        delete_folder(staged.sparkSession, folder)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Tables staged inside are deleted at the end, so results have to be written inside, too.

    Tables kept for the whole application (``stage_once``) stay.
    """
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            delete_folder(spark, path)


def stage_once(spark: SparkSession, name: str, source: str, build) -> DataFrame:
    """Stage ``build()`` the first time it is asked for in this application, then re-read it."""
    key = (spark.sparkContext.applicationId, f"{source}|{name}")
    if key not in _staged:
        path = f"{shared_folder(spark)}/staged/{name}-{uuid.uuid4().hex}"
        build().write.parquet(path)
        _staged[key] = path
    return spark.read.parquet(_staged[key])
