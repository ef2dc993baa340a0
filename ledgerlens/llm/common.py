"""Helpers that several operators share."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import ledgerlens
from ledgerlens.sources.tables import fresh_path

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows are handed to per-row code in pieces of this many bytes of text at least.
PIECE_BYTES = 4 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case; every other character as it is."""
    return F.translate(text, UPPER, LOWER)


def text_bytes(text: Column) -> Column:
    """The UTF-8 bytes of a text; NULL as no bytes."""
    return F.coalesce(text.cast("string"), F.lit("")).cast("binary")


def remainder(key: Column, parts: int) -> Column:
    """crc32 of the key as text modulo ``parts``; 0 for a NULL key."""
    return F.coalesce(F.crc32(key.cast("string")) % parts, F.lit(0).cast("long"))


def words(data: bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased.  Byte strings split at x20 and x09-x0D only, and ``lower`` changes A-Z only."""
    return data.lower().split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces(batches: Iterator[pa.RecordBatch], text: str, least: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that no piece goes far beyond ``least`` bytes of the column ``text``.

    A batch of Spark has a number of rows and no bound in bytes; per-row results of long texts
    would add up.  A single longer text is a piece of its own.
    """
    for batch in batches:
        sizes = pc.binary_length(batch.column(text)).to_pylist()
        start = total = 0
        for i, n in enumerate(sizes):
            total += n or 0
            if total >= least:
                yield batch.slice(start, i + 1 - start)
                start, total = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)


_built: dict[Any, Any] = {}


def built_once(key: Any, make) -> Any:
    """What ``make`` builds, kept in this worker process for the tasks to come; the last two only, as a task uses two at most."""
    if key not in _built:
        while len(_built) >= 2:
            _built.pop(next(iter(_built)))
        _built[key] = make()
    return _built[key]


class Shared:
    """A broadcast value, and what a worker builds of it."""

    def __init__(self, spark: SparkSession, value: Any):
        self.name, self.broadcast = uuid.uuid4().hex, spark.sparkContext.broadcast(value)

    def built(self, make) -> Any:
        return built_once(self.name, lambda: make(self.broadcast.value))


def folder_uri(path: str) -> str:
    """A folder of Spark's as a URI that pyarrow's file systems take."""
    if path.startswith("file:"):
        return "file:///" + path[5:].lstrip("/")
    return path if "://" in path else f"file://{os.path.abspath(path)}"


_shipped: set[str] = set()
#: Rows of a batch between Spark and its Python workers at most: both hold whole batches of texts in memory.
BATCH_ROWS = 2000


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application; tasks import it rather than unpickle copies of it.

    Lowers the session's rows of an Arrow batch to ``BATCH_ROWS``, which changes no result.
    """
    rows = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, BATCH_ROWS)
    if (app := spark.sparkContext.applicationId) in _shipped:
        return
    packed, root = io.BytesIO(), Path(ledgerlens.__file__).parent
    with zipfile.ZipFile(packed, "w") as z:
        for file in sorted(root.rglob("*.py")):
            z.write(file, file.relative_to(root.parent))
    folder = folder_uri(fresh_path(spark, "code"))
    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    with store.open_output_stream(f"{base}/ledgerlens.zip", compression=None) as out:
        out.write(packed.getvalue())
    spark.sparkContext.addPyFile(f"{folder}/ledgerlens.zip")
    _shipped.add(app)
