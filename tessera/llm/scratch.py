"""Shared scratch tables: lineage is cut by writing Parquet to the folder that driver and executors share."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import tempfile
import uuid
from collections.abc import Callable
from itertools import islice
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where that is unset (tests)."""
    at = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        at = spark.sparkContext.getCheckpointDir() or f"file://{_own_dir(spark)}"
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def _own_dir(spark: SparkSession) -> str:
    """A folder that goes when this process ends; only for one machine, as executors elsewhere would not see it."""
    if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    at = tempfile.mkdtemp(prefix="tessera-")
    atexit.register(shutil.rmtree, at, True)
    return at


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tessera-{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` once and reads it back, so later stages survive lost executors."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def forget(df: DataFrame) -> None:
    """Deletes the files behind a table made by ``stored`` once no later plan reads it."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    for file in df.inputFiles()[:1]:
        path = jvm.org.apache.hadoop.fs.Path(file).getParent()
        if path.getName().startswith("tessera-"):
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


HELD: dict[tuple[str, str], Any] = {}


def resident(kind: str, key: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task: one vocabulary or model at a time.

    Workers outlive the stages of a job, so what another operator left is given back first.
    """
    if (kind, key) not in HELD:
        vacate()
        HELD[kind, key] = make()
    return HELD[kind, key]


def vacate() -> None:
    """Gives a worker's memory back to the system."""
    HELD.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run):
    """An Arrow function of batches that keeps nothing: a worker's memory is given back before a task and after it."""

    @functools.wraps(run)
    def tidied(batches):
        vacate()
        try:
            yield from run(batches)
        finally:
            vacate()

    return tidied


class Kept:
    """What was made of short texts, up to ``most`` bytes: when it is full, the half that came first goes.

    Texts of more than ``longest`` characters are not kept. Values are bytes, numbers, or pairs of bytes and text.
    """

    #: Bytes of an entry besides its characters and its value's, and of a pair.
    ENTRY, PAIR = 180, 120

    def __init__(self, most: int, longest: int = 64) -> None:
        self.most, self.longest = most, longest
        self.values: dict[str, Any] = {}
        self.size = 0

    def get(self, texts: list[str]) -> list[Any]:
        """The value of each text, None where there is none."""
        return list(map(self.values.get, texts))

    def add(self, new: dict[str, Any]) -> None:
        new = {k: v for k, v in new.items() if len(k) <= self.longest}
        self.size += self.ENTRY * len(new) + sum(map(len, new))
        some = next(iter(new.values()), 0)
        if isinstance(some, bytes):
            self.size += sum(map(len, new.values()))
        elif isinstance(some, tuple):
            self.size += sum(self.PAIR + len(a) + len(b) for a, b in new.values())
        self.values |= new
        while self.size > self.most:
            n = len(self.values)
            self.values = dict(islice(self.values.items(), (n + 1) // 2, None))
            self.size = self.size * len(self.values) // n

    def clear(self) -> None:
        self.values, self.size = {}, 0

    def __len__(self) -> int:
        return len(self.values)


def chunks(column: pa.Array, most: int = 1 << 24):
    """(first row, rows without nulls) of runs of rows of about ``most`` bytes, or of one longer row."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    row = 0
    while row < len(column):
        stop = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, "right")) - 1)
        yield row, column.slice(row, stop - row)
        row = stop


def gathered(codes: np.ndarray, parts: list[bytes], step: int = 1 << 17) -> tuple[np.ndarray, np.ndarray]:
    """(the 32-bit numbers of ``parts[c]`` for each code in turn, how many numbers each code has)."""
    sizes = np.fromiter(map(len, parts), np.int32, len(parts)) >> 2
    pool = np.frombuffer(b"".join(parts), np.uint32)
    starts = np.cumsum(sizes, dtype=np.int64) - sizes
    n = sizes[codes]
    out = np.empty(int(n.sum(dtype=np.int64)), np.uint32)
    done = 0
    for k in range(0, len(codes), step):  # in steps that stay in the processor's cache
        m = n[k : k + step]
        ends = np.cumsum(m, dtype=np.int64)
        total = int(ends[-1])
        at = np.repeat(starts[codes[k : k + step]] - ends + m, m)
        at += np.arange(total)
        out[done : done + total] = pool[at]
        done += total
    return out, n


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def even_labels(n: int, each: int) -> list[int]:
    """``each`` labels for every one of ``n`` hash partitions, so that groups by label fill partitions alike.

    Labels are integers picked by the partition that Spark's hash (Murmur3, seed 42) sends them to.
    """
    found: list[list[int]] = [[] for _ in range(n)]
    short, at, step = n, 0, max(1024, 4 * n * each)
    while short and at < 64 * step:
        x = np.arange(at, at + step, dtype=np.uint32)
        k = x * np.uint32(0xCC9E2D51)
        k = (k << np.uint32(15) | k >> np.uint32(17)) * np.uint32(0x1B873593)
        h = np.uint32(42) ^ k
        h = (h << np.uint32(13) | h >> np.uint32(19)) * np.uint32(5) + np.uint32(0xE6546B64)
        h ^= np.uint32(4)
        h = (h ^ h >> np.uint32(16)) * np.uint32(0x85EBCA6B)
        h = (h ^ h >> np.uint32(13)) * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
        for label, part in enumerate((h.astype(np.int32).astype(np.int64) % n).tolist(), at):
            if len(found[part]) < each:
                found[part].append(label)
                short -= len(found[part]) == each
        at += step
    return [x for part in found for x in part]
