"""Removal of repeated passages by super-k-mer partitioning.

A window is ``WINDOW`` consecutive words. Its minimiser is the least hash of its runs of ``GRAM``
words, a function of the window's words alone, so equal windows have equal minimisers. Consecutive
windows that share a minimiser form one unit (a super-k-mer).

1. Units are counted by minimiser, reduced in each task before the shuffle. A minimiser met once
   has no repeated window, so its unit goes no further: only repeated minimisers' units travel.
2. Those units travel as packed strings (their words once, joined by spaces) to their minimiser's
   bucket. Buckets arrive sorted, and a task works through them one after the other: it sorts the
   windows of a bucket, compares equal ones byte by byte, and returns the spans of repeated ones.
   A bucket holds at most ``HOT`` units here, so a task's memory is bounded.
3. A minimiser with more units than that (a passage in very many documents) is not gathered. Its
   windows are counted by a 128-bit fingerprint, again reduced before the shuffle, and the rows of
   repeated ones are found by a salted join.
4. Spans go back to their documents, which lose the covered words.

Steps 2 and 4 share one shuffle of the texts.

Defined results: NULL and short texts have no window and keep all words; a window that occurs twice
in one document is repeated; windows are judged on the input; rows that repeat a document (the same
doc_id and text) count as two texts and both lose the words; rows of one doc_id with different texts
are different texts; rows without doc_id are told apart by their text; further columns pass through, whatever their names.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import common as C

WINDOW = 35
GRAM = 4
#: Units of one minimiser beyond which its windows are counted without gathering them.
HOT = 2048
#: Windows in one unit at most; a longer run (periodic text) is cut, each window stays in one unit.
LONGEST = 512
SALTS = 16

UNIT = "mini long, weight int, rid long, tag long, start int"
PACKED = "mini long, n long, packed string, rid long, tag long, start int"
SPAN = "rid long, tag long, begin int, finish int"
PRINT = "h1 long, h2 long, rid long, tag long, start int"


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, by doubling."""
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[: len(values) - reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def units(raw: np.ndarray, offsets: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """Units of some texts: row, first window (word number in the row), number of windows,
    minimiser, and 2 if the minimiser may occur twice in the unit, else 1."""
    starts, ends, first = C.find_words(raw, offsets, C.SPACED)
    words = C.hash_spans(raw, starts, ends)
    count = len(words) - window + 1
    if count <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64), none
    grams = C.window_hashes(words, gram)
    least = _sliding_least(grams, window - gram + 1)
    row = C.rows_of(first)[:count]
    inside = np.arange(count) + window <= first[1:][row]
    at = np.flatnonzero(inside)
    if not len(at):
        return at, at, at, at.astype(np.uint64), at
    new = np.r_[True, (np.diff(at) > 1) | (row[at[1:]] != row[at[:-1]]) | (least[at[1:]] != least[at[:-1]])]
    new_at = np.flatnonzero(new)
    since = np.arange(len(at)) - np.repeat(new_at, np.diff(np.r_[new_at, len(at)]))
    begin = np.flatnonzero(since % LONGEST == 0)
    length = np.diff(np.r_[begin, len(at)])
    start = at[begin]
    # Two equal runs of words less than two windows apart: the unit around them may repeat itself.
    order = np.argsort(grams, kind="stable")
    close = (grams[order[1:]] == grams[order[:-1]]) & (np.diff(order) < 2 * window)
    marks = np.zeros(len(grams) + 1, np.int64)
    marks[order[1:][close] + 1] = 1
    marks = np.cumsum(marks)
    twice = (marks[np.minimum(start + length + window - gram, len(grams))] - marks[start] > 0) | (length > window - gram + 1)
    return row[start], start - first[row[start]], length, least[start], 1 + twice.astype(np.int64)


def _find_units(src: DataFrame, window: int, gram: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            raw, offsets = C.text_bytes(batch.column(2))
            for i, j in C.row_slices(offsets):
                row, start, _, mini, weight = units(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window, gram)
                rows = pa.array(row + i)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(C.signed(mini)), pa.array(weight.astype(np.int32)), batch.column(0).take(rows), batch.column(1).take(rows), pa.array(start.astype(np.int32))],
                    ["mini", "weight", "rid", "tag", "start"],
                )

    return C.with_workers(src).mapInArrow(run, UNIT)


def _pack(chosen: DataFrame, rid: str, tag: str, text: str, asked_for: str, window: int, gram: int) -> DataFrame:
    """Packed strings of the units that start at each row's ``asked_for`` (starts with counts)."""
    names = chosen.columns

    def run(batches):
        for batch in batches:
            raw, offsets = C.text_bytes(batch.column(names.index(text)))
            wanted = batch.column(names.index(asked_for))
            rids, tags = batch.column(names.index(rid)), batch.column(names.index(tag))
            for i, j in C.row_slices(offsets):
                row, start, length, mini, _ = units(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], window, gram)
                keep, counts, packed = [], [], []
                for k in range(i, j):
                    asked = {int(x["start"]): x["n"] for x in wanted[k].as_py()}
                    words = raw[offsets[k] : offsets[k + 1]].tobytes().split()
                    for u in range(*np.searchsorted(row, [k - i, k - i + 1])):
                        if (n := asked.get(int(start[u]))) is not None:
                            keep.append(u)
                            counts.append(n)
                            packed.append(b" ".join(words[start[u] : start[u] + length[u] + window - 1]))
                rows = pa.array(row[keep] + i, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(C.signed(mini[keep])), pa.array(counts, pa.int64()), pa.array(packed, pa.binary()).cast(pa.string()), rids.take(rows), tags.take(rows), pa.array(start[keep].astype(np.int32))],
                    ["mini", "n", "packed", "rid", "tag", "start"],
                )

    return C.with_workers(chosen).mapInArrow(run, PACKED)


def _windows(packed: pa.Array, window: int):
    """All windows of packed units: first byte, last byte, unit, number in the unit; and the bytes
    and word hashes with the windows' first words."""
    raw, offsets = C.text_bytes(packed)
    starts, ends, first = C.find_words(raw, offsets, C.SPACED)
    unit = C.rows_of(first)
    at = np.flatnonzero(np.arange(len(starts)) + window <= first[1:][unit])
    return raw, starts[at], ends[at + window - 1], unit[at], at - first[unit[at]], C.hash_spans(raw, starts, ends), at


def repeated_windows(packed: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Units, first and last windows of the runs of windows that occur more than once, by sorting."""
    raw, begin, end, unit, number, words, at = _windows(packed, window)
    data = raw.tobytes()
    hashes = C.window_hashes(words, window)[at] if len(at) else np.zeros(0, np.uint64)
    order = np.argsort(hashes, kind="stable")
    new = np.r_[True, hashes[order[1:]] != hashes[order[:-1]]] if len(order) else np.zeros(0, bool)
    edges = np.r_[np.flatnonzero(new), len(order)]
    repeated = np.zeros(len(at), bool)
    for r in np.flatnonzero(np.diff(edges) > 1):
        same = order[edges[r] : edges[r + 1]]
        texts = [data[a:b] for a, b in zip(begin[same].tolist(), end[same].tolist())]
        if texts.count(texts[0]) == len(texts):
            repeated[same] = True
        else:  # different windows with one hash
            repeated[same] = [texts.count(t) > 1 for t in texts]
    hit = np.flatnonzero(repeated)
    if not len(hit):
        return hit, hit, hit
    cut = np.r_[True, (np.diff(hit) > 1) | (unit[hit[1:]] != unit[hit[:-1]])]
    last = np.r_[np.flatnonzero(cut)[1:] - 1, len(hit) - 1]
    return unit[hit[cut]], number[hit[cut]], number[hit[last]]


def _spans(table: pa.Table, window: int) -> pa.RecordBatch:
    """Spans of repeated windows of whole buckets."""
    unit, first, last = repeated_windows(table["packed"].combine_chunks(), window)
    rows = table.take(pa.array(unit))
    start = rows["start"].to_numpy().astype(np.int64)
    return pa.RecordBatch.from_arrays(
        [rows["rid"].combine_chunks(), rows["tag"].combine_chunks(), pa.array((start + first).astype(np.int32)), pa.array((start + last + window).astype(np.int32))],
        ["rid", "tag", "begin", "finish"],
    )


def _some_buckets(table: pa.Table) -> list[pa.Table]:
    """A table that is sorted by minimiser, in parts of about a slice of bytes, cut between buckets."""
    mini = table["mini"].to_numpy()
    edges = np.r_[0, np.flatnonzero(mini[1:] != mini[:-1]) + 1, len(mini)]
    reach = np.r_[0, np.cumsum(pc.binary_length(table["packed"]).to_numpy())][edges]
    return [table.slice(edges[i], edges[j] - edges[i]) for i, j in C.row_slices(reach)]


def _count_sorted(packed: DataFrame, window: int) -> DataFrame:
    """Spans of repeated windows, from units that arrive sorted by minimiser."""

    def run(batches):
        held = None
        for batch in batches:
            for first in range(0, batch.num_rows, HOT):
                table = pa.Table.from_batches([batch.slice(first, HOT)])
                held = table if held is None else pa.concat_tables([held, table])
                mini = held["mini"].to_numpy()
                done = int(np.searchsorted(mini, mini[-1]))
                if done:
                    for part in _some_buckets(held.slice(0, done)):
                        yield _spans(part, window)
                    held = held.slice(done)
        if held is not None and held.num_rows:
            yield _spans(held, window)

    narrow = packed.select("mini", "packed", "rid", "tag", "start")
    return C.with_workers(narrow).repartition("mini").sortWithinPartitions("mini").mapInArrow(run, SPAN)


def _count_hot(packed: DataFrame, window: int) -> DataFrame:
    """Spans of repeated windows of minimisers with very many units."""

    def run(batches):
        for batch in batches:
            column = batch.column(0)
            for i, j in C.row_slices(C.text_bytes(column)[1]):
                _, _, _, unit, number, words, at = _windows(column[i:j], window)
                rows = pa.array(unit + i)
                start = batch.column(3).to_numpy()[unit + i] + number
                prints = [C.window_hashes(w, window)[at] if len(at) else np.zeros(0, np.uint64) for w in (words, C.mix(words + np.uint64(0xC3)))]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(C.signed(p)) for p in prints], batch.column(1).take(rows), batch.column(2).take(rows), pa.array(start.astype(np.int32))],
                    ["h1", "h2", "rid", "tag", "start"],
                )

    prints = C.with_workers(packed).select("packed", "rid", "tag", "start").mapInArrow(run, PRINT)
    repeated = prints.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2")
    salted = repeated.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    found = prints.withColumn("salt", F.pmod(F.xxhash64("rid", "start"), F.lit(SALTS)).cast("int")).join(salted, ["h1", "h2", "salt"], "left_semi")
    return found.select("rid", "tag", F.col("start").alias("begin"), (F.col("start") + window).alias("finish"))


def _cut(joined: DataFrame, carry: list[str], columns: list[str], text: str, out: str) -> DataFrame:
    kind = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())])
    names = joined.columns

    def run(batches):
        for batch in batches:
            raw, offsets = C.text_bytes(batch.column(names.index(text)))
            spans = batch.column(names.index(columns[0]))
            totals, removed, texts = [], [], []
            for k in range(batch.num_rows):
                words = raw[offsets[k] : offsets[k + 1]].tobytes().split()
                keep = np.ones(len(words), bool)
                for span in spans[k].as_py() or ():
                    keep[span["begin"] : span["finish"]] = False
                totals.append(len(words))
                removed.append(len(words) - int(keep.sum()))
                texts.append(b" ".join(compress(words, keep.tolist())))
            result = pa.StructArray.from_arrays([pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())], kind.names)
            yield pa.RecordBatch.from_arrays([*[batch.column(names.index(c)) for c in carry], result], [*carry, out])

    return C.with_workers(joined).mapInArrow(run, T.StructType([*[joined.schema[c] for c in carry], T.StructField(out, kind)]))


def cut_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None, out: str = "kept", window: int = WINDOW, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) and ``out``: a struct of n_words, n_removed
    and the text of the words that stay, joined by one space."""
    carry = docs.columns if carry is None else carry
    rid, tag, spans, asked_for = C.free_name(docs, "rid", "tag", "spans", "starts")
    # A row is known by its doc_id and a hash of its text: rows of one doc_id may hold different texts.
    ident = F.coalesce(F.col(f"`{doc_id}`").cast("long"), F.xxhash64(F.col(f"`{text}`"), F.lit("no doc_id")))
    mark = F.xxhash64(F.col(f"`{text}`"), F.col(f"`{doc_id}`").isNull())
    keyed = docs.select(ident.alias(rid), mark.alias(tag), *[F.col(f"`{c}`") for c in dict.fromkeys([*carry, text])])
    src = keyed.select(F.col(rid).alias("rid"), F.col(tag).alias("tag"), F.col(f"`{text}`").alias("text"))
    found = _find_units(src, window, gram)
    counts = C.checkpointed(found.groupBy("mini").agg(F.sum("weight").alias("n")).where("n > 1"))
    starts = found.join(counts, "mini").groupBy("rid", "tag").agg(F.collect_set(F.struct("start", "n")).alias(asked_for))
    # Both joins with the texts shuffle the same columns, so Spark does it once.
    starts = starts.select(F.col("rid").alias(rid), F.col("tag").alias(tag), asked_for)
    packed = _pack(keyed.join(starts, [rid, tag]), rid, tag, text, asked_for, window, gram)
    repeats = _count_sorted(packed.where(F.col("n") <= hot), window)
    if not C.is_empty(counts.where(F.col("n") > hot)):
        repeats = repeats.unionByName(_count_hot(packed.where(F.col("n") > hot), window))
    by_doc = repeats.groupBy("rid", "tag").agg(F.collect_list(F.struct("begin", "finish")).alias(spans))
    by_doc = by_doc.select(F.col("rid").alias(rid), F.col("tag").alias(tag), spans)
    return _cut(keyed.join(by_doc, [rid, tag], "left"), carry, [spans], text, out)


def repeat_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of every document."""
    out = cut_repeats(docs.select("doc_id", "text"), carry=["doc_id"])
    return out.select("doc_id", "kept.n_words", "kept.n_removed", F.sha2(F.col("kept.text").cast("binary"), 256).alias("kept_sha256"))
