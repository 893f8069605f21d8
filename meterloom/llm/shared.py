"""What the operators share: the shared folder, staged tables, Arrow slices, row chunks."""

from __future__ import annotations

import pickle
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import DataFrame, SparkSession

SLICE_BYTES = 2 << 20


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; one of our own only where it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
        named = tempfile.mkdtemp(prefix="meterloom-llm-")
        spark.conf.set("spark.checkpoint.dir", named)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(named)
    return named


def staged_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here."""
    path = staged_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def send(spark: SparkSession, value: object) -> Broadcast:
    """Broadcast an object of bounded size, with its class if that travels by value."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def received(sent: Broadcast) -> object:
    return pickle.loads(sent.value)


def checkpointed(df: DataFrame) -> DataFrame:
    """A small table behind ``checkpoint()``, in the shared folder."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def freed(run: Callable) -> Callable:
    """``run`` over Arrow batches, after which its worker gives back what it no longer uses.

    Workers serve one task after another. What a large model or many small arrays leave
    behind in the allocators would otherwise stay with them beside the next task's.
    """

    def through(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            import ctypes
            import gc

            gc.collect()
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the usual C library
            if trim:
                trim(0)

    return through


def sliced(
    batches: Iterable[pa.RecordBatch], column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``, one row at least."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        ends = np.cumsum(byte_lengths(batch.column(column)))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
            yield batch.slice(first, last - first)
            first = last


def byte_lengths(array: pa.Array) -> np.ndarray:
    return np.diff(text_bytes(array)[1])


def text_bytes(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array and its n + 1 offsets; null rows are empty."""
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or
                                pa.types.is_large_string(array.type) else b"")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, places, data = array.buffers()
    places = np.frombuffer(places, dtype=np.int64 if wide else np.int32)
    places = places[array.offset : array.offset + len(array) + 1].astype(np.int64)
    if len(places) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[places[0] : places[-1]], places - places[0]


def with_columns(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    """``batch`` with new columns at the end; those of the same name are replaced."""
    names = [n for n in batch.schema.names if n not in columns]
    arrays = [batch.column(n) for n in names]
    return pa.RecordBatch.from_arrays([*arrays, *columns.values()], [*names, *columns])
