"""Stored tables: snapshots, incremental reads, sinks and hand-overs between steps."""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ledgerlens.operators.relational import check_key, upsert

#: Rows of a file that ``land`` writes: a stream reads a file in one task.
FILE_ROWS = 50_000


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """Snapshot of a parquet directory (anything with a slash) or a catalogue table."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def stream_table(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """Files appended to a parquet directory since the last run, at most ``max_files`` per micro-batch.

    Leave ``max_files`` out in front of a watermark: each micro-batch moves it, and what a later
    one holds that is older is dropped as late.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def land(df: DataFrame, path: str, batches: int, rows: int = FILE_ROWS) -> int:
    """Append ``df`` in files of about ``rows`` rows at most, as many for each of ``batches`` micro-batches; returns how many a batch takes.

    More rows make more files a batch and not larger ones, so that a batch goes on all cores.  ``df`` should be stored, as its
    rows are counted first.
    """
    per_batch = max(1, math.ceil(df.count() / (batches * rows)))
    append(df.repartition(batches * per_batch), path)
    return per_batch


def overwrite(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def merge_into(spark: SparkSession, path: str, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed upsert of a stored table.

    The merged rows go to a new folder, which is then published as the next version by a file that must not exist yet: a reader
    never sees a half-written version or the rows of a writer that is refused, and a failed attempt leaves the current
    version in place.

    Updates with a repeated or NULL key are refused.  So is a merge whose version another writer has published
    meanwhile; the table then has to be merged again.
    """
    if not check_key(updates, keys).isEmpty():
        raise ValueError(f"updates of {path} repeat a key of {keys} or leave it NULL")
    number, current = latest_version(spark, path)
    merged = updates if current is None else upsert(spark.read.parquet(current), updates, keys)
    target = f"{path}/data/{uuid.uuid4().hex}"
    merged.write.parquet(target)
    if not _publish(spark, f"{path}/versions", number + 1, target):
        raise RuntimeError(f"another writer has merged into version {number + 1} of {path}")
    return spark.read.parquet(target)


def _publish(spark: SparkSession, folder: str, number: int, target: str) -> bool:
    """Whether ``target`` became version ``number``; exactly one of several writers succeeds.

    The file is written in full under another name first and then given its own, so that it is never seen empty.  Giving a name that is
    taken fails: a hard link on a local disk, a rename elsewhere (stores whose rename replaces files need a lock).
    """
    files, draft = _file_system(spark, folder), f"{folder}/.{uuid.uuid4().hex}"
    of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    out = files.create(of(draft), False)
    out.write(bytearray(target.encode()))
    out.close()
    final = f"{folder}/{number:012d}"
    if files.getScheme() != "file":
        return not files.exists(of(final)) and files.rename(of(draft), of(final))
    try:
        os.link(of(draft).toUri().getPath(), of(final).toUri().getPath())
    except FileExistsError:
        return False
    return True


def latest_version(spark: SparkSession, path: str) -> tuple[int, str | None]:
    """Number and folder of the newest published version; (-1, None) before the first."""
    folder = f"{path}/versions"
    files, of = _file_system(spark, folder), spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    if not files.exists(of(folder)):
        return -1, None
    names = [f.getPath().getName() for f in files.listStatus(of(folder))]
    numbers = [int(n) for n in names if n.isdigit()]
    if not numbers:
        return -1, None
    newest = max(numbers)
    data = files.open(of(f"{folder}/{newest:012d}"))
    text = bytes(data.readAllBytes()).decode()
    data.close()
    return newest, text


def _file_system(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


# -- hand-over ----------------------------------------------------------------
def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``; it goes when the application ends.

    Only a local session may do without the setting; its warehouse folder then takes the place.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = spark.conf.get("spark.sql.warehouse.dir")
    folder = f"{base.rstrip('/')}/ledgerlens-{spark.sparkContext.applicationId}"
    if folder not in _folders:
        _folders.add(folder)
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
    return folder


_folders: set[str] = set()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}/{name}"


def hand_over(df: DataFrame, name: str) -> DataFrame:
    """Store a step's result and go on from the stored table.

    What follows does not recompute the step, survives the loss of executors, and is planned
    with the table's real size.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
