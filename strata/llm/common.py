"""What the operators of this subpackage share: staged tables, Arrow text columns, record streams."""

from __future__ import annotations

import contextlib
import ctypes
import uuid
import weakref
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from strata.session import shared_folder, tune

#: Bytes of text handled at a time inside a task; bounds the memory of the arrays made from it.
BLOCK_BYTES = 2 << 20


#: Rows that Spark hands to a task's Python process at a time. Texts are long: fewer rows than Spark's default bound the memory.
ROWS_PER_BATCH = 2000
#: Bytes of such a hand-over at most (a longer row goes alone); both sides keep several of them outside the executor's heap.
BYTES_PER_BATCH = 4 << 20


#: Folders of the tables that :func:`staged` wrote and somebody still holds.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()


def prepared(spark: SparkSession) -> SparkSession:
    """Batch sizes for Python tasks; shuffle files go with the job that wrote them, since what later jobs need is staged."""
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_PER_BATCH))
    return tune(spark)


def staged(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder (``spark.checkpoint.dir``) as Parquet and read back.

    Cuts the lineage: a lost executor costs the reader a re-read, not a recomputation.
    """
    path = new_path(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    read = df.sparkSession.read.schema(df.schema).parquet(path)
    _FOLDERS[read] = path
    return read


def discard(*frames: DataFrame) -> None:
    """Delete tables that :func:`staged` wrote, after their last reader is through. Other frames, and tables that are gone, are left alone."""
    for frame in frames:
        if (folder := _FOLDERS.pop(frame, None)) is not None:
            context = frame.sparkSession.sparkContext
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession) -> str:
    """A new name under the folder that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"


def tables(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A string column as (bytes, offsets, is_null), without copying the texts."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    nulls = np.asarray(column.is_null())
    return data[offsets[0]:offsets[-1]], offsets - offsets[0], nulls


def slices(offsets: np.ndarray, most: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs [first, last) of rows with at most ``most`` bytes together; a longer row is a run of its own."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def text_blocks(batches: Iterator[pa.RecordBatch], text: str, most: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """Batches cut to blocks of whole rows: (rows, bytes, offsets, is_null) of the text column."""
    for batch in batches:
        if batch.num_rows:
            data, offsets, nulls = utf8(batch.column(text))
            for a, b in slices(offsets, most):
                yield batch.slice(a, b - a), data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a], nulls[a:b]


def mapped(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow(run, schema)`` whose tasks return their memory when ``run`` is through and its arrays are gone."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            give_back()

    return df.mapInArrow(whole, schema)


def give_back() -> None:
    """Return freed memory to the system: Spark keeps a task's Python process for later tasks beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the C library of Linux has it
        ctypes.CDLL(None).malloc_trim(0)


def flat(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of every run, one run after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def lists(values: pa.Array, counts: Sequence[int] | np.ndarray) -> pa.Array:
    """A list column whose rows take ``counts`` values each."""
    return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))).astype(np.int32)), values)
