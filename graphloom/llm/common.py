"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

U64 = np.uint64


def partitions(spark: SparkSession) -> int:
    """The session's shuffle width; every bucket count of this subpackage is a multiple of it, so it follows the data."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, vectorised: every input bit affects every output bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling."""
    out, have = a, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def bytes_of(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def chunks(batches: Iterable[pa.RecordBatch], text: str, limit: int) -> Iterator[pa.Table]:
    """Join Arrow batches, or cut them, into tables of about ``limit`` bytes of text."""
    held, size = [], 0
    for batch in batches:
        lengths = np.diff(np.frombuffer(batch.column(text).cast(pa.large_binary()).buffers()[1], np.int64)[batch.column(text).offset :][: batch.num_rows + 1]) if batch.num_rows else np.zeros(0, np.int64)
        at = 0
        while at < batch.num_rows:
            room = np.searchsorted(np.cumsum(lengths[at:]), limit - size) + 1
            part = batch.slice(at, int(room))
            size += int(lengths[at : at + part.num_rows].sum())
            at += part.num_rows
            held.append(part)
            if size >= limit:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def hand_back() -> None:
    """Give the memory that was freed back to the system: workers live longer than tasks, and executors' memory counts all."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not glibc
        pass


def release(f: Callable) -> Callable:
    """``f`` (of one or two tables), after which a Python worker hands the memory it freed back to the system, so that
    executors don't fill up with what their workers once needed."""

    def one(table):
        try:
            return f(table)
        finally:
            hand_back()

    def two(left, right):
        try:
            return f(left, right)
        finally:
            hand_back()

    return one if f.__code__.co_argcount == 1 else two
