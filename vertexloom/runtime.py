"""Session helpers: shared folders, checkpoints, partition sizing, file metadata."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROWS_PER_PARTITION = 2_000_000
SMALL_ROWS_PER_PARTITION = 50_000
MAX_PARTITIONS = 40_000
ASIDE = ".old-"
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 128 * 1024 * 1024

_local_folders: dict[str, str] = {}


def use_local_scratch(spark: SparkSession) -> None:
    """For a session of one machine without ``spark.checkpoint.dir``: work in a temporary folder.

    For entry points, benchmarks and tests. The library itself never falls back to a
    folder of one machine; a session with executors of their own needs the setting.
    """
    context = spark.sparkContext
    if _named_folder(spark) is None and context.master.partition("[")[0] == "local":
        key = context.applicationId
        if key not in _local_folders:
            _local_folders[key] = tempfile.mkdtemp(prefix="vertexloom-")
            atexit.register(shutil.rmtree, _local_folders[key], ignore_errors=True)


def _named_folder(spark: SparkSession) -> str | None:
    return spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach, named by ``spark.checkpoint.dir``."""
    named = _named_folder(spark) or _local_folders.get(spark.sparkContext.applicationId)
    if named is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the executors")
    return named


def scratch_path(spark: SparkSession, what: str) -> str:
    """A path below the shared folder that nobody else uses."""
    return f"{shared_folder(spark).rstrip('/')}/vertexloom-{what}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it from there."""
    path = scratch_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_checkpoint(df: DataFrame) -> None:
    """Delete the files behind a frame made by :func:`checkpoint`."""
    stored = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if stored.isDefined():
        delete_path(df.sparkSession, stored.get())


def partitions_for(spark: SparkSession, rows: int, max_partitions: int = MAX_PARTITIONS) -> int:
    """Shuffle width for ``rows`` rows: few tasks for little data, at most ``max_partitions`` for much.

    At least two, because Spark plans single partitions differently.
    """
    small = min(spark.sparkContext.defaultParallelism, ceil(rows / SMALL_ROWS_PER_PARTITION))
    return max(2, small, min(max_partitions, ceil(rows / ROWS_PER_PARTITION)))


@contextmanager
def planning(spark: SparkSession, *, partitions: int, adaptive: bool | None = None) -> Iterator[None]:
    """Plan with exactly ``partitions`` shuffle partitions.

    Iterative jobs lay out their tables once and rely on that layout in every
    round, so all of their plans must have the same width. In the rounds
    themselves ``adaptive`` planning is off: there is no shuffle it may regroup,
    and frames checkpointed under it forget their partitioning. The settings are
    those of the session: while the block runs, other threads must not plan on it.
    """
    wanted = {"spark.sql.shuffle.partitions": str(partitions)}
    if adaptive is not None:
        wanted["spark.sql.adaptive.enabled"] = str(adaptive).lower()
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def broadcastable_id() -> Column:
    """Whether an ``id`` is short enough that ``BROADCAST_ROWS`` of them may be broadcast.

    Longer ids take the shuffle one by one, so that a single long id changes nothing for the others.
    """
    return F.octet_length("id") <= BROADCAST_BYTES // max(1, BROADCAST_ROWS)


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df``, keyed by ``id``, is small enough to broadcast."""
    size = (
        df.select(F.octet_length("id").alias("bytes"))
        .limit(BROADCAST_ROWS + 1)
        .agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))
        .first()
    )
    return size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES


def _filesystem(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def qualified(spark: SparkSession, path: str) -> str:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _filesystem(spark, path)
    return fs.exists(hadoop_path)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _filesystem(spark, path)
    fs.delete(hadoop_path, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path``, which must be there, when the application ends."""
    fs, hadoop_path = _filesystem(spark, path)
    fs.deleteOnExit(hadoop_path)


def rename_path(spark: SparkSession, source: str, target: str) -> None:
    fs, source_path = _filesystem(spark, source)
    target_path = _filesystem(spark, target)[1]
    fs.mkdirs(target_path.getParent())
    if not fs.rename(source_path, target_path):
        raise OSError(f"cannot move {source} to {target}")


def file_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder."""
    fs, hadoop_path = _filesystem(spark, path)
    return [status.getPath().getName() for status in fs.listStatus(hadoop_path)]


def read_small_text(spark: SparkSession, path: str) -> str:
    """Content of one small metadata file."""
    fs, hadoop_path = _filesystem(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readAllBytes()).decode("utf-8")
    finally:
        stream.close()


def write_small_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small metadata file, replacing it if it is there."""
    fs, hadoop_path = _filesystem(spark, path)
    stream = fs.create(hadoop_path, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def refuse_same_path(spark: SparkSession, source: str, target: str) -> None:
    """Stop before a job deletes the files it is about to read: equal paths, or one inside the other."""
    read, written = (qualified(spark, path).rstrip("/") + "/" for path in (source, target))
    if read.startswith(written) or written.startswith(read):
        raise ValueError(f"output path {target} and input path {source} are the same or one holds the other")


def publish(spark: SparkSession, staged: str, target: str) -> None:
    """Put a finished folder in the place of ``target``; what was there goes once the new one stands.

    Between the two renames nothing stands under the name; :func:`standing` then finds the
    folder that was there.
    """
    before = _aside(spark, target)
    aside = f"{target.rstrip('/')}{ASIDE}{uuid.uuid4().hex}"
    there = path_exists(spark, target)
    if there:
        rename_path(spark, target, aside)
        before.append(aside)
    rename_path(spark, staged, target)
    for old in before:
        delete_path(spark, old)


def standing(spark: SparkSession, path: str) -> str:
    """``path``, or what was there where a replacement broke off before the new folder stood."""
    if not path_exists(spark, path):
        old = _aside(spark, path)
        if old:
            return old[0]
    return path


def _aside(spark: SparkSession, target: str) -> list[str]:
    """Folders that a broken-off replacement of ``target`` has put aside."""
    parent, _, name = target.rstrip("/").rpartition("/")
    if not parent or not path_exists(spark, parent):
        return []
    return [f"{parent}/{n}" for n in sorted(file_names(spark, parent)) if n.startswith(f"{name}{ASIDE}")]
