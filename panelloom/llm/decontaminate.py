"""Benchmark decontamination by winnowing.

A window is ``SPAN`` consecutive words of a benchmark item. Over the hashes of all ``GRAM``-word
runs the least hash of every ``SPAN - GRAM + 1`` neighbours is kept, on both sides. A window that
occurs in a document has there the same least hash as in the item, so looking up the kept hashes
misses no shared span of ``SPAN`` words or more; each find is then compared word by word and
neighbouring windows grow into maximal hit spans.

The benchmark is the query set: it is dealt into blocks of ``BLOCK_BYTES`` of text, and each block
is broadcast. Documents are read once and never shuffled; with more blocks, a document passes one
block after the other within its task, so no row needs an identity and no key can be hot.

Defined results: NULL or wordless text has no words and no hits; an item of fewer than ``SPAN``
words is one window of its own length; a wordless item never occurs; repeated rows are judged
alike; an item whose id is NULL marks hit words but cannot be listed; an empty benchmark hits
nothing; further columns pass through, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import common as C

SPAN = 10
GRAM = 5
#: Text of the benchmark in one broadcast block.
BLOCK_BYTES = 16 << 20

FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hit_from", T.ArrayType(T.LongType())),
        T.StructField("hit_to", T.ArrayType(T.LongType())),
        T.StructField("items", T.ArrayType(T.LongType())),
    ]
)


class Windows:
    """All distinct windows of one length: their hashes, words and items."""

    def __init__(self, words: np.ndarray, starts: np.ndarray, items: np.ndarray, width: int):
        hashes = np.zeros(len(starts), np.uint64)
        for k in range(width):
            hashes = hashes * C._STEP + words[starts + k]
        order = np.argsort(hashes, kind="stable")
        self.width = width
        self.hashes, first, inverse = np.unique(hashes[order], return_index=True, return_inverse=True)
        self.words = words[starts[order][first][:, None] + np.arange(width)]
        pairs = np.unique(np.stack([inverse, items[order]], axis=1), axis=0)
        self.items = pairs[:, 1]
        self.item_from = np.searchsorted(pairs[:, 0], np.arange(len(self.hashes) + 1))

    def find(self, words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Those starts where a window occurs, and which window."""
        if not len(self.hashes) or not len(starts):
            return starts[:0], starts[:0]
        hashes = np.zeros(len(starts), np.uint64)
        for k in range(self.width):
            hashes = hashes * C._STEP + words[starts + k]
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        same = self.hashes[at] == hashes
        starts, at = starts[same], at[same]
        same = (words[starts[:, None] + np.arange(self.width)] == self.words[at]).all(axis=1)
        return starts[same], at[same]


def _least(grams: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring hashes."""
    out = grams[: max(0, len(grams) - width + 1)].copy()
    for k in range(1, width):
        np.minimum(out, grams[k : k + len(out)], out=out)
    return out


def _windows_in(first_word: np.ndarray, width: int, total: int) -> np.ndarray:
    """Whether a window of ``width`` words may start at each word without leaving its row."""
    count = max(0, total - width + 1)
    end_of_row = np.repeat(first_word[1:], np.diff(first_word))[:count]
    return np.arange(count) + width <= end_of_row


class Block:
    """The windows and the kept hashes of some benchmark items."""

    def __init__(self, ids: list[int | None], texts: list[str | None], span: int, gram: int):
        self.span, self.gram = span, gram
        raw, offsets = C.text_bytes(pa.array(texts, pa.large_string()))
        raw = C.lower_ascii(raw)
        starts, ends, first = C.find_words(raw, offsets, C.ALNUM)
        words, sizes = C.hash_spans(raw, starts, ends), np.diff(first)
        self.ids = np.array([-1 if i is None else i for i in ids], np.int64)
        self.named = np.array([i is not None for i in ids], bool)
        rows = C.rows_of(first)
        full = np.flatnonzero(_windows_in(first, span, len(words)))
        self.full = Windows(words, full, rows[full], span)
        self.kept = np.unique(_least(C.window_hashes(words, gram), span - gram + 1)[full]) if len(full) else np.zeros(0, np.uint64)
        self.short = []
        for width in range(1, span):
            if (sizes == width).any():
                at = first[:-1][sizes == width]
                self.short.append(Windows(words, at, rows[at], width))

    def hits(self, words: np.ndarray, first: np.ndarray) -> list[tuple[Windows, np.ndarray, np.ndarray]]:
        found = []
        if len(self.kept):
            least = _least(C.window_hashes(words, self.gram), self.span - self.gram + 1)
            inside = _windows_in(first, self.span, len(words))
            turn = np.flatnonzero(np.r_[True, least[1:] != least[:-1]]) if len(least) else np.zeros(0, np.int64)
            value = least[turn]
            at = np.minimum(np.searchsorted(self.kept, value), len(self.kept) - 1)
            known = np.repeat(self.kept[at] == value, np.diff(np.r_[turn, len(least)]))
            found.append((self.full, *self.full.find(words, np.flatnonzero(known & inside))))
        for windows in self.short:
            starts = np.flatnonzero(_windows_in(first, windows.width, len(words)))
            found.append((windows, *windows.find(words, starts)))
        return found


def _lists(values: list[np.ndarray]) -> pa.Array:
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return C.list_array(pa.array(flat.astype(np.int64)), np.array([len(v) for v in values], np.int64))


def _examine(column: pa.Array, block: Block) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray], list[np.ndarray]]:
    """Number of words, hit spans (from, to) and items of each text."""
    raw, offsets = C.text_bytes(column)
    counts, begin, end, items = [], [], [], []
    none = np.zeros(0, np.int64)
    for i, j in C.row_slices(offsets):
        part = C.lower_ascii(raw[offsets[i] : offsets[j]])
        starts, ends, first = C.find_words(part, offsets[i : j + 1] - offsets[i], C.ALNUM)
        words = C.hash_spans(part, starts, ends)
        counts.append(np.diff(first))
        found = block.hits(words, first)
        edge = np.zeros(len(words) + 1, np.int64)
        listed = []
        for windows, at, which in found:
            np.add.at(edge, at, 1)
            np.add.at(edge, at + windows.width, -1)
            row = np.searchsorted(first, at, "right") - 1
            seen = np.unique(np.stack([row, which], axis=1), axis=0) if len(at) else np.zeros((0, 2), np.int64)
            size = windows.item_from[seen[:, 1] + 1] - windows.item_from[seen[:, 1]]
            step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
            item = windows.items[np.repeat(windows.item_from[seen[:, 1]], size) + step]
            listed.append(np.stack([np.repeat(seen[:, 0], size), item], axis=1))
        covered = np.cumsum(edge[:-1]) > 0
        turn = covered.copy()
        turn[1:] &= ~covered[:-1]
        turn[first[:-1][first[:-1] < len(words)]] = covered[first[:-1][first[:-1] < len(words)]]
        close = covered.copy()
        close[:-1] &= ~covered[1:]
        last = first[1:][np.diff(first) > 0] - 1
        close[last] = covered[last]
        froms, tos = np.flatnonzero(turn), np.flatnonzero(close) + 1
        pairs = np.concatenate(listed) if listed else np.zeros((0, 2), np.int64)
        pairs = pairs[block.named[pairs[:, 1]]]
        pairs = np.unique(np.stack([pairs[:, 0], block.ids[pairs[:, 1]]], axis=1), axis=0)
        of_span, of_pair = np.searchsorted(froms, first), np.searchsorted(pairs[:, 0], np.arange(j - i + 1))
        for k in range(j - i):
            a, b = of_span[k], of_span[k + 1]
            begin.append(froms[a:b] - first[k] if b > a else none)
            end.append(tos[a:b] - first[k] if b > a else none)
            items.append(pairs[of_pair[k] : of_pair[k + 1], 1])
    return np.concatenate(counts) if counts else none, begin, end, items


def _merge(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of two sets of spans, as sorted spans that neither meet nor overlap."""
    order = np.argsort(begin, kind="stable")
    begin, reach = begin[order], np.maximum.accumulate(end[order])
    new = np.r_[True, begin[1:] > reach[:-1]]
    return begin[new], reach[np.r_[np.flatnonzero(new)[1:] - 1, len(reach) - 1]]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    carry: list[str] | None = None,
    found: str = "leaks",
    span: int = SPAN,
    gram: int = GRAM,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) and ``found``: a struct of n_words, the hit
    spans in words (hit_from, hit_to, end exclusive) and the ids of the items that occur."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("text"))
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    carry = docs.columns if carry is None else carry
    source = docs if text in carry else docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`"))
    source_columns = source.columns
    result = T.StructType([*[docs.schema[c] for c in carry], T.StructField(found, FOUND)])
    shared = []
    for k in range(blocks):
        own = items if blocks == 1 else items.where(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == k)
        rows = own.collect()  # one block of bounded size
        shared.append(spark.sparkContext.broadcast(Block([r[0] for r in rows], [r[1] for r in rows], span, gram)))

    def examine(batches):
        for batch in batches:
            column = batch.column(source_columns.index(text))
            counts, begin, end, listed = _examine(column, shared[0].value)
            for other in shared[1:]:
                _, more_begin, more_end, more = _examine(column, other.value)
                for k in range(len(begin)):
                    if len(more_begin[k]):
                        begin[k], end[k] = _merge(np.r_[begin[k], more_begin[k]], np.r_[end[k], more_end[k]])
                    if len(more[k]):
                        listed[k] = np.unique(np.r_[listed[k], more[k]])
            leaks = pa.StructArray.from_arrays([pa.array(counts.astype(np.int64)), _lists(begin), _lists(end), _lists(listed)], ["n_words", "hit_from", "hit_to", "items"])
            yield pa.RecordBatch.from_arrays([*[batch.column(source_columns.index(c)) for c in carry], leaks], [*carry, found])

    return C.with_workers(source).mapInArrow(examine, result)


def leak_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and the hit spans themselves."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, carry=["doc_id"], found="leaks")
    hit = F.aggregate(F.zip_with("leaks.hit_to", "leaks.hit_from", lambda b, a: b - a), F.lit(0).cast("long"), lambda x, y: x + y)
    names = F.array_sort(F.transform("leaks.items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        F.col("leaks.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("leaks.items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
        F.arrays_zip(F.col("leaks.hit_from").alias("hit_from"), F.col("leaks.hit_to").alias("hit_to")).alias("hit_spans"),
    )


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without any hit word, with their own columns."""
    (found,) = C.free_name(docs, "leaks")
    return find_leaks(docs, benchmark, found=found).where(F.size(f"{found}.hit_from") == 0).drop(found)
