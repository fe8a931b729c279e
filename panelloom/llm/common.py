"""Helpers shared by the corpus operators: words of Arrow text columns as numpy arrays, rolling
hashes, checkpoints in the shared folder, and connected components.

Text is handled as UTF-8 bytes of a whole Arrow batch, in slices of a few megabytes, so that a
task's memory does not depend on the number of rows. All hashes are fixed functions of the bytes:
the same text has the same hash in every task, session and run.
"""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that are handled at once within a task (one longer row is handled alone).
SLICE_BYTES = 1 << 21


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)
_BYTE_CODE = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)


def _inverse(odd: int) -> np.uint64:
    return np.uint64(pow(int(odd), -1, 1 << 64))


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the step and of its inverse modulo 2**64."""
    up, down = np.full(size, _STEP), np.full(size, _inverse(_STEP))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = _powers(1 << max(16, (size - 1).bit_length()))
    return up[:size], down[:size]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the row offsets into them; NULL rows are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def row_slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes in all, at least one row each."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, min(last, rows)
        first = last


def _byte_set(separators: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in separators:
        table[low : high + 1] = False
    return table


#: Bytes of the words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ of a text whose A-Z are lower-cased.
ALNUM = _byte_set([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])
#: Bytes of the words [^\x20\x09-\x0D]+.
SPACED = _byte_set([(0x20, 0x20), (0x09, 0x0D)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def find_words(raw: np.ndarray, offsets: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte starts and ends of all words, and for each row the index of its first word."""
    inside = in_word[raw]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    start[edges] = inside[edges]
    edges = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    end[edges] = inside[edges]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_spans(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; spans are sorted and disjoint."""
    out = np.empty(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        last = max(first + 1, int(np.searchsorted(ends, starts[first] + 2 * SLICE_BYTES, "right")))
        base, stop = starts[first], ends[last - 1]
        up, down = powers(int(stop - base))
        total = np.zeros(stop - base + 1, np.uint64)
        np.cumsum(_BYTE_CODE[raw[base:stop]] * up, out=total[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        first = last
    return mix(out)


def window_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` word hashes (across rows too; the caller masks those)."""
    count = len(words) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(count, np.uint64)
    for k in range(width):
        out *= _STEP
        out += words[k : k + count]
    return mix(out)


def rows_of(first_word: np.ndarray) -> np.ndarray:
    """The row of each word, from the index of each row's first word."""
    return np.repeat(np.arange(len(first_word) - 1), np.diff(first_word))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def list_array(values: pa.Array, lengths: np.ndarray) -> pa.Array:
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), values)


def free_name(df: DataFrame, *wanted: str) -> list[str]:
    """Names like ``wanted`` that no column of ``df`` has, whatever the case."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


#: Settings of Python workers, unless the session has its own: workers outlive their tasks, and what
#: they keep of one operator's memory is missing in the next.
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": "1048576"}


def with_workers(df: DataFrame) -> DataFrame:
    """``df``, after making sure that Python workers look for this package where the driver found it
    (they also do where it is installed or was shipped with the job), and give back memory they freed."""
    env, here = df.sparkSession.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    paths = [p for p in env.get("PYTHONPATH", "").split(":") if p]
    if here not in paths:
        env["PYTHONPATH"] = ":".join([*paths, here])
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    return df


_FOLDERS: dict[str, str] = {}


def _folder(spark: SparkSession) -> str:
    """This session's folder for intermediate tables in the shared folder of spark.checkpoint.dir
    (unset, as in tests: in the warehouse), removed when the program ends."""
    app = spark.sparkContext.applicationId
    if app not in _FOLDERS:
        shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
        _FOLDERS[app] = f"{shared.rstrip('/')}/corpus-{app}-{uuid.uuid4().hex[:8]}"
        atexit.register(_remove, spark, _FOLDERS[app])
    return _FOLDERS[app]


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is not None and not context._jsc.sc().isStopped():
        where = context._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(context._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows of ``df``, computed once and stored as a table in the shared folder.

    A stored table survives the loss of executors, cuts the plan, and tells the optimiser its true
    size; the estimates of a plan that is cut by checkpoint() are carried on, and multiply in loops.
    """
    path = f"{_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_in = path
    return out


def discard(*tables: DataFrame) -> None:
    """Remove stored tables that nothing reads any more."""
    for table in tables:
        _remove(table.sparkSession, table.stored_in)


def is_empty(df: DataFrame) -> bool:
    return len(df.take(1)) == 0


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node that each end of an edge reaches.

    ``edges`` has columns a and b (bigint). Each round keeps for every node the least label among
    its neighbours and then jumps to that label's own label, so that chains shrink by half or more.
    Only the least label of a node travels, reduced in each task before the shuffle.
    """
    both = checkpointed(
        edges.where("a <> b").select("a", "b").union(edges.where("a <> b").select(F.col("b"), F.col("a"))).distinct()
    )
    labels = checkpointed(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("label")).withColumnRenamed("a", "node"))
    while True:
        near = (
            both.join(labels, both["b"] == labels["node"])
            .groupBy("a")
            .agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, labels["node"] == near["a"]).select("node", F.least("label", "near").alias("label"), F.col("label").alias("was"))
        target = labels.select(F.col("node").alias("t"), F.col("label").alias("jump"))
        step = checkpointed(
            lower.join(target, lower["label"] == target["t"], "left").select("node", F.least("label", F.coalesce("jump", "label")).alias("label"), "was")
        )
        discard(labels)
        labels = step
        if is_empty(step.where("label <> was")):
            discard(both)
            return labels.select("node", F.col("label").alias("component"))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
