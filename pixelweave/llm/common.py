"""Shared helpers of the training-data operators: reading, written tables and bounded Arrow slices."""

from __future__ import annotations

import contextlib
import ctypes
import math
import threading
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import discard, written  # noqa: F401 (taken from here by the operators)

#: Text bytes that one numpy step handles at once; one longer document is a step of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def filter_bits(n: int, most: int = 29) -> int:
    """log2 of the slots of a bitmap for n keys: about 16 a key, 64 MB (2**29 bits) at most unless said otherwise."""
    return min(most, max(16, math.ceil(math.log2(max(1, n))) + 4))


def bitmap_blocks(slots: DataFrame) -> DataFrame:
    """block and bits (4 kB) of the bitmap in which the bits numbered by the one column of ``slots`` (from 0) are set."""
    slot = F.col(slots.columns[0]) + 1
    return slots.groupBy(F.bitmap_bucket_number(slot).alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))


def bitmap(slots: DataFrame, bits: int) -> np.ndarray:
    """That bitmap as an array of 2**bits / 8 bytes: bit k & 7 of byte k >> 3 is that of slot k."""
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in bitmap_blocks(slots).collect():  # as large as the bitmap
        out[(r["block"] - 1) << 12 : r["block"] << 12] = np.frombuffer(r["bits"], np.uint8)
    return out


def marked(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return ((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1).astype(bool)


def apart(docs: DataFrame, key: Column, keys: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be among ``keys`` (column ``name``, long) and rows whose key surely isn't, without a shuffle: a
    bitmap of hashed keys is broadcast, whose size is bounded. A null key isn't among any."""
    bits = filter_bits(keys.count())
    slot = lambda x: F.pmod(F.xxhash64(x), F.lit(1 << bits))
    blocks = F.broadcast(bitmap_blocks(keys.select(slot(F.col(name)).alias("slot"))).withColumnsRenamed({"block": "pw_block", "bits": "pw_bits"}))
    at = F.bitmap_bit_position(slot(key) + 1)
    byte = F.conv(F.hex(F.substr("pw_bits", (F.floor(at / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.call_function("shiftright", byte, (at % 8).cast("int")).bitwiseAND(F.lit(1)) == 1, F.lit(False)) & key.isNotNull()
    tested = docs.join(blocks, F.bitmap_bucket_number(slot(key) + 1) == F.col("pw_block"), "left").withColumn("pw_hit", hit).drop("pw_block", "pw_bits")
    return tested.where("pw_hit").drop("pw_hit"), tested.where("not pw_hit").drop("pw_hit")


#: Rows of an Arrow batch: texts of tens of kilobytes still make batches of tens of megabytes.
BATCH_ROWS = 1000


def id_text(docs: DataFrame, *columns: str) -> DataFrame:
    """doc_id and text (or the named ones of them) for a Python function, in batches of bounded rows."""
    conf, key = docs.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(conf.get(key, "10000")) > BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    have = {"doc_id": F.col("doc_id").cast("long"), "text": F.col("text")}
    return docs.select(*(have[c] for c in columns or have))


#: What a Python worker keeps between tasks: name -> function that lets it go.
CACHES: dict[str, Callable[[], None]] = {}


#: Seconds after which an idle worker lets its caches go; the next task of the same operator comes sooner.
IDLE_S = 3.0
_task = 0


def keep_only(name: str = "") -> None:
    """Let go what tasks of other operators left in this worker."""
    for other, clear in list(CACHES.items()):
        if other != name:
            clear()
            del CACHES[other]


def trim() -> None:
    """Give memory that Arrow and the C library hold for later back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def _idle(task: int) -> None:
    if task == _task:
        keep_only()
        trim()


@contextlib.contextmanager
def worker(cache: str = "") -> Iterator[None]:
    """Around a task in a Python worker: workers live on between tasks, also beside stages without any Python."""
    global _task
    _task += 1
    keep_only(cache)
    try:
        yield
    finally:
        trim()
        if CACHES:
            timer = threading.Timer(IDLE_S, _idle, (_task,))
            timer.daemon = True
            timer.start()


Batches = Iterator[pa.RecordBatch]


def map_batches(df: DataFrame, run: Callable[[Batches], Batches], ddl: str, cache: str = "") -> DataFrame:
    """mapInArrow within ``worker``; cache names what the function keeps between tasks."""

    def own(batches: Batches) -> Batches:
        with worker(cache):
            yield from run(batches)

    return df.mapInArrow(own, ddl)


def apply_groups(df: DataFrame, key: str, run: Callable[[pa.Table], pa.Table], ddl: str) -> DataFrame:
    """applyInArrow over groups of a key within ``worker``."""

    def own(table: pa.Table) -> pa.Table:
        with worker():
            return run(table)

    return df.groupBy(key).applyInArrow(own, ddl)


def slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of at most ``limit`` text bytes: (rows, bytes, offsets). Null is empty."""
    if not batch.num_rows:
        return
    arr = pc.fill_null(batch.column(batch.schema.get_field_index(column)), "" if not pa.types.is_binary(batch.schema.field(column).type) else b"")
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    _, offs, data = arr.buffers()
    offs = np.frombuffer(offs, kind)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    at = 0
    while at < len(arr):
        end = max(at + 1, int(np.searchsorted(offs, offs[at] + limit, "right")) - 1)
        yield batch.slice(at, end - at), data[offs[at] : offs[end]], offs[at : end + 1] - offs[at]
        at = end


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    return [x or "" for x in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def arrow_batch(schema: pa.Schema, **cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x := cols[f.name], pa.Array) else pa.array(x, f.type) for f in schema], schema=schema)
