"""Ranked lexical search by an Aho-Corasick scan of the documents.

Terms are the maximal runs of ``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``, only A-Z lower-cased. The terms
of all items form one automaton. Both its patterns and the scanned text carry a guard (a space) at each
boundary of a term, so whole terms match and nothing else, and neighbours share their guard. The automaton
is broadcast and reads the documents' text twice, each time from end to end and without any index:

1. the first scan counts documents and terms, and for each item term the documents that hold it;
   one small row per task and term leaves the task;
2. the second scan takes a document's term frequencies, turns them into whole-number weights and adds
   them to the items that a term belongs to. A task keeps the best ``TOP`` documents of each item.

The tasks' best meet in two steps, first within one of ``SALTS`` groups of tasks, so no task receives
an item's rows from all tasks at once. Documents never shuffle, and a frequent term costs no more
than its matches in the text.

Items are the query set. They are dealt by item_id into blocks of about ``BLOCK_BYTES`` of distinct
terms and ``BLOCK_ITEMS`` items; one block after the other is collected, broadcast and scanned for,
so the size of what is broadcast or on the driver does not grow with their number. (Only an item that is larger by itself exceeds the bound.)

Defined results: NULL and termless texts are no documents (N does not count them); rows that repeat a
doc_id are documents of their own, and each may be listed; a NULL doc_id counts in the statistics and is
listed after equal scores; rows of one item_id are one item with the terms of all; rows with a NULL
item_id are no items; an item without terms, or none of whose terms score above 0, has no row; columns
besides ids and texts are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property, reduce
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import common as C

TOP = 50
BLOCK_BYTES = 1 << 20
BLOCK_ITEMS = 1024
SALTS = 64
#: Scores of documents times items that are held at once.
CELLS = 1 << 21

#: Bytes of terms, and the translation that lower-cases them and makes a space of all others.
TERM = C._byte_set([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
_GUARD = 0x20
_FOLD = np.where(TERM, C.lower_ascii(np.arange(256, dtype=np.uint8)), np.uint8(_GUARD)).astype(np.uint8)

RANKED = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType()), T.StructField("part", T.IntegerType())])
COUNTED = T.StructType([T.StructField("term", T.IntegerType()), T.StructField("number", T.LongType())])
#: Rows of a count that are no term's: documents, and all their terms.
DOCUMENTS, OCCURRENCES = -1, -2


@dataclass
class Terms:
    """The distinct terms of some items, and the items of each term, as positions in ``items``."""

    terms: list[bytes]
    items: np.ndarray
    item_from: np.ndarray
    of_term: np.ndarray
    weights: np.ndarray | None = field(default=None)

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        """Built once in each worker; bytes stand as the characters of the same codes."""
        found = ahocorasick.Automaton()
        for k, term in enumerate(self.terms):
            found.add_word(f" {term.decode('latin-1')} ", k)
        if self.terms:
            found.make_automaton()
        return found

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "automaton"}

    def matches(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Places of the closing guards of all matches, and the terms."""
        if not self.terms:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        both = np.fromiter(chain.from_iterable(self.automaton.iter(text.decode("latin-1"))), np.int64)
        return both[::2], both[1::2]


def item_terms(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, term): the distinct terms of each item."""
    source = items.select(F.col(f"`{item_id}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text")).where("item_id IS NOT NULL")
    kind = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("term", T.BinaryType())])

    def read(batches):
        for batch in batches:
            raw, offsets = C.text_bytes(batch.column(1))
            for i, j in C.row_slices(offsets):
                part = _FOLD[raw[offsets[i] : offsets[j]]]
                starts, ends, first = C.find_words(part, offsets[i : j + 1] - offsets[i], TERM)
                ids = batch.column(0)[i:j].take(pa.array(C.rows_of(first)))
                whole = part.tobytes()
                yield pa.RecordBatch.from_arrays([ids, pa.array([whole[a:b] for a, b in zip(starts.tolist(), ends.tolist())], pa.binary())], kind.names)

    return C.with_workers(source).mapInArrow(read, kind).distinct()


def _blocks(pairs: DataFrame, block_bytes: int) -> Iterator[Terms]:
    size, items = pairs.agg(F.sum(F.octet_length("term") + 8), F.count_distinct("item_id")).head()
    blocks = max(1, math.ceil((size or 0) / block_bytes), math.ceil(items / BLOCK_ITEMS))
    for k in range(blocks):
        table = pairs.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k).toArrow()
        ids, names = table["item_id"].to_numpy(), table["term"].to_pylist()
        if not names:
            continue
        terms = sorted(set(names))
        place = {t: n for n, t in enumerate(terms)}
        items, which = np.unique(ids, return_inverse=True)
        term = np.array([place[t] for t in names])
        order = np.lexsort((which, term))
        yield Terms(terms, items, np.searchsorted(term[order], np.arange(len(terms) + 1)), which[order])


def _frequencies(column: pa.Array, block: Terms):
    """For slices of rows: the first row, the number of terms of each, and row, term and frequency
    of what the automaton met."""
    raw, offsets = C.text_bytes(column)
    for i, j in C.row_slices(offsets):
        sizes = np.diff(offsets[i : j + 1])
        begin = offsets[i:j] - offsets[i] + np.arange(1, j - i + 1)
        text = np.full(int(sizes.sum()) + (j - i) + 1, _GUARD, np.uint8)
        part = _FOLD[raw[offsets[i] : offsets[j]]]
        text[np.arange(len(part)) + np.repeat(np.arange(1, j - i + 1), sizes)] = part
        opens = np.flatnonzero((text[:-1] == _GUARD) & (text[1:] != _GUARD)) + 1
        number = np.diff(np.searchsorted(opens, np.r_[begin, len(text)]))
        at, term = block.matches(text.tobytes())
        row = np.searchsorted(begin, at - 1, "right") - 1
        pair, tf = np.unique(row * len(block.terms) + term, return_counts=True)
        yield i, number, pair // max(1, len(block.terms)), pair % max(1, len(block.terms)), tf


def _count(docs: DataFrame, block) -> dict[int, int]:
    """Documents, occurrences of terms, and documents of each of the block's terms."""

    def scan(batches):
        own = block.value
        held, docs_met, met = np.zeros(len(own.terms), np.int64), 0, 0
        for batch in batches:
            for _, number, _, term, _ in _frequencies(batch.column(0), own):
                held += np.bincount(term, minlength=len(held))
                docs_met += int((number > 0).sum())
                met += int(number.sum())
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[DOCUMENTS, OCCURRENCES, some].astype(np.int32)), pa.array(np.r_[docs_met, met, held[some]].astype(np.int64))], COUNTED.names)

    counted = C.with_workers(docs.select("text")).mapInArrow(scan, COUNTED).groupBy("term").agg(F.sum("number").alias("number"))
    return {r["term"]: r["number"] for r in counted.collect()}  # at most a block's terms


def _best(item, doc, known, score, top: int):
    """The ``top`` best rows of each item: by score, then doc_id, then those without one."""
    order = np.lexsort((doc, ~known, -score, item))
    item, doc, known, score = item[order], doc[order], known[order], score[order]
    start = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.zeros(0, np.int64)
    turn = np.arange(len(item)) - np.repeat(start, np.diff(np.r_[start, len(item)]))
    keep = turn < top
    return item[keep], doc[keep], known[keep], score[keep]


def _score(docs: DataFrame, block, total_docs: int, total_terms: int, top: int) -> DataFrame:
    def scan(batches):
        from pyspark import TaskContext

        own, kept = block.value, (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64))
        least = np.ones(len(own.items), np.int64)  # what a score must reach to be kept
        rows_at_once = max(1, CELLS // len(own.items))
        for batch in batches:
            ids = batch.column(0)
            doc_of, known_of = ids.fill_null(0).to_numpy(zero_copy_only=False), np.asarray(ids.is_valid())
            for i, number, row, term, tf in _frequencies(batch.column(1), own):
                length = np.array([50 + 50 * n * total_docs // total_terms for n in number.tolist()], np.int64)
                value = own.weights[term] * (1_000_000_000 * tf // (1000 * tf + 20 * length[row]))
                for a in range(0, len(number), rows_at_once):
                    lo, hi = np.searchsorted(row, [a, a + rows_at_once])
                    count = own.item_from[term[lo:hi] + 1] - own.item_from[term[lo:hi]]
                    step = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                    item = own.of_term[np.repeat(own.item_from[term[lo:hi]], count) + step]
                    rows = min(rows_at_once, len(number) - a)
                    cells = np.zeros(rows * len(own.items), np.int64)
                    np.add.at(cells, np.repeat(row[lo:hi] - a, count) * len(own.items) + item, np.repeat(value[lo:hi], count))
                    cells = cells.reshape(rows, len(own.items))
                    r, c = np.nonzero(cells >= least)
                    new = c, doc_of[i + a + r], known_of[i + a + r], cells[r, c]
                    kept = _best(*[np.concatenate(both) for both in zip(kept, new)], top)
                    full = np.bincount(kept[0], minlength=len(least)) == top
                    last = np.searchsorted(kept[0], np.arange(len(least)), "right") - 1
                    least[full] = kept[3][last[full]]
        item, doc, known, score = kept
        part = np.full(len(item), TaskContext.get().partitionId() % SALTS)
        yield pa.RecordBatch.from_arrays([pa.array(own.items[item]), pa.array(doc, mask=~known), pa.array(score), pa.array(part.astype(np.int32))], RANKED.names)

    return C.with_workers(docs.select("doc_id", "text")).mapInArrow(scan, RANKED)


def _leading(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id")))
    return rows.withColumn("rank", turn).where(F.col("rank") <= top)


def search(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", top: int = TOP, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """item_id, rank, doc_id and score of the ``top`` best documents of each item."""
    context = docs.sparkSession.sparkContext
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    pairs = C.checkpointed(item_terms(items, item_id, item_text))
    found = []
    for block in _blocks(pairs, block_bytes):
        shared = context.broadcast(block)
        counts = _count(docs, shared)
        shared.destroy()
        n, total = counts.get(DOCUMENTS, 0), counts.get(OCCURRENCES, 0)
        if not total:
            break
        block.weights = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * counts.get(k, 0) + 1))) for k in range(len(block.terms))], np.int64)
        shared = context.broadcast(block)
        found.append(C.checkpointed(_score(docs, shared, n, total, top)))
        shared.destroy()
    C.discard(pairs)
    rows = reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], RANKED)
    rows = _leading(_leading(rows, ["item_id", "part"], top).drop("rank"), ["item_id"], top)
    return rows.select("item_id", "rank", "doc_id", "score")


def search_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """item_id, rank, doc_id and score: the 50 best documents of each benchmark item."""
    return search(docs, benchmark)
