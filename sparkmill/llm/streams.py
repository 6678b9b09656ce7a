"""Documents as token streams: ids in ascending doc_id order, with positions in per-queue streams.

Documents are range-partitioned by id (the text is shuffled once), encoded in that order
and written; a document's place in the whole stream of its queue is the total of the
queue's ids in earlier partitions (a table of partitions x queues) plus a running count.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, sized, slices
from .tokens import binaries, encoder

#: Text bytes encoded at once.
SLICE = 2 << 20
#: Groups in which the id counts of tasks are added up.
GROUP_TASKS = 16

_ROWS = pa.schema([("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("queue", pa.string()), ("at", pa.int64()), ("n", pa.int64()), ("ids", pa.binary()), ("counts", pa.binary())])
_DDL = "part int, seq long, doc_id long, queue string, at long, n long, ids binary, counts binary"


def encoded(docs: DataFrame, path: str, end_id: int, queue=None) -> DataFrame:
    """Materialized rows (part, seq, doc_id, queue, at, n, ids as little-endian uint32).

    Rows with seq -1 hold, per partition and queue, the total n; one per partition also has
    the counts of all its ids.  queue: a Column naming the queue of a document.
    """
    queue = F.lit("") if queue is None else queue
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), queue.alias("queue"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text", "queue")

    def run(batches):
        enc, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        at: dict[str, int] = {}
        counts = np.zeros(max(enc.tokenizer.get_vocab_size(), end_id + 1), np.int64)
        for batch in slices(batches, "text", SLICE):
            k = batch.num_rows
            ids, edge = enc.encode(batch.column(2))
            ids, edge = np.insert(ids, edge[1:], end_id), edge + np.arange(k + 1)
            counts += np.bincount(ids, minlength=len(counts))
            places = []
            for q, n in zip(batch.column(1).to_pylist(), np.diff(edge).tolist()):
                places.append(at.get(q, 0))
                at[q] = places[-1] + n
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(k, part, np.int32)), pa.array(np.arange(seq, seq + k)), batch.column(0), batch.column(1), pa.array(places, pa.int64()), pa.array(np.diff(edge)), binaries(ids, edge), pa.nulls(k, pa.binary())],
                schema=_ROWS,
            )
            seq += k
        if at:
            names = list(at)
            k = len(names)
            held = [_packed(counts), *[None] * (k - 1)]
            yield pa.RecordBatch.from_arrays([pa.array([part] * k, pa.int32()), pa.array([-1] * k, pa.int64()), pa.nulls(k, pa.int64()), pa.array(names), pa.nulls(k, pa.int64()), pa.array([at[q] for q in names], pa.int64()), pa.nulls(k, pa.binary()), pa.array(held, pa.binary())], schema=_ROWS)

    return materialize(rows.mapInArrow(run, _DDL), "ids")


def bases(ids: DataFrame) -> DataFrame:
    """(part, queue, base): ids of the queue in earlier partitions."""
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = ids.where("seq = -1").select("part", "queue", "n")
    return totals.select("part", "queue", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))


def placed(ids: DataFrame) -> DataFrame:
    """The document rows with start: where each begins in the whole stream of its queue."""
    base = materialize(bases(ids), "bases")
    return ids.where("seq >= 0").join(sized(base, 64), ["part", "queue"]).withColumn("start", F.col("base") + F.col("at"))


def _packed(counts: np.ndarray) -> bytes:
    """The ids that occur and their counts, compressed."""
    some = np.flatnonzero(counts)
    return zstandard.compress(np.r_[some, counts[some]].astype("<i8").tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    return np.frombuffer(zstandard.decompress(raw), "<i8").reshape(2, -1)


def id_counts(ids: DataFrame) -> np.ndarray:
    """Global count per id.  A task adds up the tables of its partitions, GROUP_TASKS groups of tasks
    add up theirs, and the driver gets one table of the vocabulary's size from each."""

    def total(raws) -> bytes:
        out = np.zeros(0, np.int64)
        for some, n in map(_unpacked, raws):
            if len(some):
                if some[-1] >= len(out):
                    out = np.r_[out, np.zeros(int(some[-1]) + 1 - len(out), np.int64)]
                out[some] += n
        return _packed(out)

    def in_task(batches):
        done = total(x for batch in batches for x in batch.column(0).to_pylist())
        yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId() % GROUP_TASKS], pa.int32()), pa.array([done])], ["g", "counts"])

    def in_group(table):
        return pa.table({"counts": pa.array([total(table.column("counts").to_pylist())])})

    held = ids.where("counts is not null").select("counts").mapInArrow(in_task, "g int, counts binary")
    rows = held.groupBy("g").applyInArrow(in_group, "counts binary").collect()
    some, n = _unpacked(total(r["counts"] for r in rows))
    out = np.zeros(int(some[-1]) + 1 if len(some) else 0, np.int64)
    out[some] = n
    return out
