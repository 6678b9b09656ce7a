"""What several operators share: tables, the shared folder, sized broadcasts."""

from __future__ import annotations

import contextlib
import ctypes
import tempfile
import time
import uuid
import weakref

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .hashing import forget

#: A side is broadcast up to this many bytes, counted before the join; beyond it is shuffled.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset, in local mode."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(schema).parquet(path)
    _written[id(out)] = (weakref.ref(out, lambda _, k=id(out): _written.pop(k, None)), path)
    return out


#: Where DataFrames that materialize returned are kept.
_written: dict[int, tuple] = {}


def discard(df: DataFrame) -> None:
    """Deletes what materialize has written for df, once nothing reads it any more."""
    _, path = _written[id(df)]
    where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def sized(df: DataFrame, row_bytes: int, limit: int = BROADCAST_BYTES) -> DataFrame:
    """Marks a (materialized) side for broadcast when its rows are proven to fit, else leaves it to a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= limit else df


_released = [0.0]


def release(after: float = 0.0) -> None:
    """Gives freed memory of this Python worker back to the system, if that was last done `after` seconds ago or more.

    Workers live on between tasks and stages; what a task has freed would stay with them.
    """
    if time.monotonic() - _released[0] >= after:
        forget()
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # another C library than glibc
            ctypes.CDLL(None).malloc_trim(0)
        _released[0] = time.monotonic()


def slices(batches, column: str, most_bytes: int = 1 << 20):
    """Arrow record batches cut so that a slice's texts hold about most_bytes (one text at least)."""
    import numpy as np

    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        i = batch.schema.get_field_index(column)
        lengths = pc.fill_null(pc.binary_length(batch.column(i)), 0).to_numpy(zero_copy_only=False)
        cut = np.cumsum(lengths) // most_bytes
        at = [0, *(np.flatnonzero(np.diff(cut)) + 1).tolist(), n]
        for lo, hi in zip(at, at[1:]):
            yield batch.slice(lo, hi - lo)
    release()


def text_bytes(column: pa.Array):
    """(buffer uint8, offsets int64 of n+1): the UTF-8 bytes of a text column end to end; null counts as empty."""
    import numpy as np

    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, at - at[0]


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies on every node."""
    import public_tokenizers

    return public_tokenizers.path(name)
