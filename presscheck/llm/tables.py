"""Reading inputs and storing intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from presscheck.session import materialise, scratch_path

__all__ = ["free_name", "table", "materialise", "scratch_path", "share", "shared", "slices", "text_bytes"]

# Text that one step of a vectorised scan holds at once. Its arrays take up to
# about 30 times as much.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(name: str, frame: DataFrame) -> str:
    """The name, with as many ``_`` behind it as needed to be no column of the frame."""
    while name.lower() in map(str.lower, frame.columns):
        name += "_"
    return name


def share(spark: SparkSession, value):
    """A broadcast of an object together with its class, for workers without this package."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def shared(broadcast):
    """The object of :func:`share`, on a worker."""
    import pickle

    return pickle.loads(broadcast.value)


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of an Arrow batch with about ``limit`` bytes of text each, one row at least."""
    lengths = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_numpy(
        zero_copy_only=False
    )
    start = size = 0
    for i, n in enumerate(lengths):
        if i > start and size + n > limit:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if start < len(lengths):
        yield batch.slice(start)


def text_bytes(column: pa.Array) -> tuple:
    """UTF-8 bytes of all texts in one array, and where each text starts; null is empty."""
    import numpy as np

    column = pa.compute.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    whole = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
    return whole, offsets - offsets[0]
