"""What the operators share: table access, shared storage and Arrow helpers."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from lectern.sources.shared import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Tables that this session's operators have written to the shared folder, in order.
WRITTEN: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    WRITTEN.append(f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}")
    return WRITTEN[-1]


def remove_stored(spark: SparkSession, since: int = 0, but: str | None = None) -> None:
    """Remove the tables written from number ``since`` on, except one. What reads them must be done."""
    for path in [p for p in WRITTEN[since:] if p != but]:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
        WRITTEN.remove(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def chunks(texts: pa.Array, size: int = 8 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of ``texts`` of about ``size`` bytes each; a longer text stands alone."""
    sizes = pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(sizes)
    start = 0
    while start < len(texts):
        before = ends[start] - sizes[start]
        end = max(start + 1, int(np.searchsorted(ends, before + size, "right")))
        yield start, end
        start = end


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column laid end to end, and each row's offset (nulls: empty)."""
    column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        offsets = np.frombuffer(column.buffers()[1], np.int64)
    else:
        offsets = np.frombuffer(column.buffers()[1], np.int32).astype(np.int64)
    offsets = offsets[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = column.buffers()[2]
    flat = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


#: What a worker process keeps over tasks: one object.
_KEPT: dict = {}

Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def kept(key, make: Callable):
    """What ``make`` gives, kept over the tasks of a worker until another key comes."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def tidy(run: Run, keeps: bool = False) -> Run:
    """``run`` for a worker that gives its memory back after each task, and before it what it kept for
    other operators, unless ``run`` keeps something itself."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            forget()
        try:
            yield from run(batches)
        finally:
            give_back()

    return wrapped


def forget() -> None:
    _KEPT.clear()


def give_back() -> None:
    """Free memory that the allocators hold goes back to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass
