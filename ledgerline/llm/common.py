"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import os
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import checkpoint_dir


BATCH_BYTES = 8 << 20


def prepare(spark: SparkSession) -> None:
    """What the operators need of a session. Batches that go to Python workers are bounded in bytes (texts may be
    long), unless the session sets a bound. Workers on this machine import the library from where the
    driver has it, whatever folder they run in; on a cluster it is installed or sent with --py-files."""
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound) == f"{64 << 20}b":  # Spark's own setting
        spark.conf.set(bound, BATCH_BYTES)
    env = spark.sparkContext.environment
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    have = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in have:
        env["PYTHONPATH"] = os.pathsep.join([root, *have])


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared folder and read back. Lost executors lose nothing of it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Column names that df doesn't have, for helper columns beside a caller's own."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = f"_{n}"
        taken.add(n.lower())
        out.append(n)
    return out


def sum_slices(parts: DataFrame, n_slices: int, width: int) -> np.ndarray:
    """Add up per-task counter arrays of ``width``, cut into ``n_slices`` rows (slice int, counts binary of int32).

    The sums run in tasks, a slice each. The driver gets 16 bits a counter: the logarithm of its sum, in steps of
    1/2048 of a doubling, which keeps the counters' order but for sums that differ by less than 1/3000.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                total[k] = total.get(k, 0) + np.frombuffer(v, np.int32).astype(np.int64)
        if total:
            logs = [np.minimum(2048 * np.log2(a + 1), 65535).astype(np.uint16).tobytes() for a in total.values()]
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(logs, pa.binary())],
                                             ["slice", "counts"])

    out = np.zeros(width, np.uint16)
    for r in parts.repartition(n_slices, "slice").mapInArrow(add, "slice int, counts binary").collect():
        n = width // n_slices
        out[r["slice"] * n:(r["slice"] + 1) * n] = np.frombuffer(r["counts"], np.uint16)
    return out


def slices_of(counts: np.ndarray, n_slices: int) -> Iterator[pa.RecordBatch]:
    """What ``sum_slices`` adds up: this task's counters, without slices that are all zero."""
    rows = [(k, a.astype(np.int32).tobytes()) for k, a in enumerate(np.split(counts, n_slices)) if a.any()]
    if rows:
        yield pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.int32()), pa.array([a for _, a in rows], pa.binary())],
            ["slice", "counts"])


@contextmanager
def without_cycle_search() -> Iterator[None]:
    """For loops that make many small objects and no cycles: searching for cycles over large memos takes a fifth
    of their time. Reference counting goes on as ever."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield
    finally:
        if was:
            gc.enable()


@lru_cache(None)
def _trim():
    """glibc's malloc_trim; None where the C library has none."""
    try:
        return ctypes.CDLL(None).malloc_trim
    except (AttributeError, OSError, TypeError):
        return None


def give_back() -> None:
    """Give a worker's freed memory back to the system, at the end of a task that held much. Workers live on, idle or in the next
    stage's tasks, and what they keep is missing to the executor."""
    pa.default_memory_pool().release_unused()
    if _trim():
        _trim()(0)


def as_bytes(col: str) -> F.Column:
    """A text column's UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(col), F.lit("")).cast("binary")


FILTER_BITS = 24  # a key filter has 2**24 bits
FILTER_SLICES = 32


def filter_places(keys: np.ndarray, bits: int = FILTER_BITS) -> np.ndarray:
    """A key's bit (64-bit integer keys)."""
    h = keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) >> np.uint64(64 - bits)).astype(np.int64)


def key_filter(keys: DataFrame, bits: int = FILTER_BITS):
    """A broadcast bit set of fixed size (2**bits bits) with the bits of one column of long keys.

    It spares work for rows that can't match; false hits are left to a join. Tasks fill sets of their own, joined
    by OR in a few tasks; the driver gets one set, however many keys there are."""

    def rows(total: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.int32()), pa.array([a.tobytes() for a in total.values()], pa.binary())],
                ["slice", "bits"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << bits, bool)
        for b in batches:
            total[filter_places(b.column(0).drop_null().to_numpy(zero_copy_only=False), bits)] = True
        cut = np.split(np.packbits(total), FILTER_SLICES)
        yield from rows({k: a for k, a in enumerate(cut) if a.any()})

    def either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for b in batches:
            for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                a = np.frombuffer(v, np.uint8)
                total[k] = total[k] | a if k in total else a
        yield from rows(total)

    kind = "slice int, bits binary"
    got = {r[0]: r[1] for r in keys.mapInArrow(fill, kind).repartition(FILTER_SLICES, "slice").mapInArrow(either, kind).collect()}
    empty = bytes((1 << bits) // 8 // FILTER_SLICES)
    return keys.sparkSession.sparkContext.broadcast(b"".join(got.get(k, empty) for k in range(FILTER_SLICES)))


def filter_bits(broadcast) -> np.ndarray:
    return np.unpackbits(np.frombuffer(broadcast.value, np.uint8)).view(bool)
