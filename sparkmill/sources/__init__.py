"""Readers of the input tables, intermediate tables in the shared folder, writers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast up to this many bytes, counted before the join; beyond it is shuffled.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only where that is unset, in local mode."""
    where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not where:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        where = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(where)
    return where.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder once and read back: no recomputation, no lineage, and nothing that an executor could lose."""
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, row_bytes: int) -> DataFrame:
    """A stored side, marked for broadcast when its rows are proven to fit, else left to a shuffle."""
    return F.broadcast(df) if df.count() * row_bytes <= BROADCAST_BYTES else df


def write_matches(matches: DataFrame, path: str) -> None:
    """Matches as Parquet, one folder per label of the query."""
    matches.write.partitionBy("ql").parquet(path)


def write_tracks(members: DataFrame, path: str, buckets: int = 64) -> None:
    """Members as Parquet, a folder per bucket of tracks (a hash of track_id), each track's members together and in order."""
    rows = members.withColumn("bucket", F.pmod(F.xxhash64("track_id"), F.lit(buckets)).cast("int"))
    rows.repartition("bucket").sortWithinPartitions("bucket", "track_id", "vec_id").write.partitionBy("bucket").parquet(path)
