"""Periodic runs of words within documents, by seed and extend on diagonals.

Words are ``[^\\x20\\x09-\\x0D]+``. A run is a stretch of consecutive words with smallest period q and a
length of at least ``max(SHORTEST, 3 q)`` that no neighbouring word extends keeping period q. On the
diagonal of lag q (word i against word i + q) it is a stretch of matches of at least
``max(SHORTEST - q, 2 q)`` words: its guaranteed overlap.

1. *Index.* Lags are taken by octaves. In the octave of k to 2k - 1 (the first one: 1 to 15) the
   guaranteed overlap is at least 2k - 1 words, so it holds a whole k-gram that starts at a multiple
   of k: the seed. All k-grams are named exactly, each by the names of its halves, and only those
   that occur twice in their document are named further.
2. *Pairs.* Each seed is paired with the equal k-grams of its document at lags of the octave. That are
   at most k lags for every k-th word, so the pairs of an octave never outnumber the words, however
   repetitive a text is; a text of n words needs about n log n steps in all.
3. *Extension.* Pairs of one lag stand in the order of their places. The furthest word that the lag
   has covered tells whether a pair continues the stretch before it; only a stretch's first pair
   grows to the left and its last one to the right, by less than k words, in halving steps.
4. A stretch of lag q that spans the same words as one of a smaller lag has that smaller period.

Rows never meet each other: words are named together with their row, so texts are handled in slices
of a few megabytes within a task, and nothing is shuffled. One longer text is handled alone; it
needs some forty bytes a word and octave that still repeats.

Defined results: NULL, empty and wordless texts have no runs and an empty collapsed text; rows that
repeat a doc_id are independent of each other; further columns pass through, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import common as C

SHORTEST = 24
#: A run holds its period at least so many times.
TIMES = 3
#: The first octave's k-gram; its lags are all below twice that.
GRAM = 8

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
FOUND = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


class Names:
    """Exact names of all 2**j-grams: equal grams of one row have equal names, all others differ."""

    def __init__(self, words: np.ndarray, row: np.ndarray):
        self.size = len(words)
        own = C.mix(words ^ C.mix(row.astype(np.uint64) + np.uint64(1)))
        self.levels, self.alive = [], np.arange(self.size)
        self._name(own)

    def _name(self, values: np.ndarray) -> None:
        """Name the living places by their values; a place whose value is met once dies, under a name of its own."""
        _, name, count = np.unique(values, return_inverse=True, return_counts=True)
        repeated = count[name] > 1
        self.alive = self.alive[repeated]
        level = np.arange(self.size, 2 * self.size)
        level[self.alive] = name[repeated]
        self.levels.append(level)

    def double(self) -> None:
        last, step = self.levels[-1], 1 << (len(self.levels) - 1)
        both = self.alive[self.alive + step < self.size]
        both = both[last[both + step] < self.size]
        self.alive = both
        self._name(last[both] * np.int64(2 * self.size) + last[both + step])

    def grow(self, at: np.ndarray, lag: np.ndarray, levels: int, right: bool) -> np.ndarray:
        """How far the matches of each diagonal go on from a word, less than 2**levels words."""
        far = np.zeros(len(at), np.int64)
        for j in reversed(range(levels)):
            step = 1 << j
            here = at + far if right else at - far - step
            valid = (here + lag + step <= self.size) & (here >= 0)
            same = self.levels[j][np.where(valid, here, 0)] == self.levels[j][np.where(valid, here + lag, 0)]
            far += step * (valid & same)
        return far


def find_stretches(words: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and smallest periods of all runs, by start and period."""
    names = Names(words, row)
    found = [np.zeros((3, 0), np.int64)]
    levels = GRAM.bit_length() - 1
    for _ in range(levels):
        names.double()
    low, high = 1, 2 * GRAM
    while len(names.alive):
        found.append(_octave(names, levels, low, high))
        names.double()
        levels += 1
        low, high = high, 2 * high
    start, end, lag = np.concatenate(found, axis=1)
    order = np.lexsort((lag, end, start))
    start, end, lag = start[order], end[order], lag[order]
    first = np.r_[True, (start[1:] != start[:-1]) | (end[1:] != end[:-1])] if len(start) else np.zeros(0, bool)
    start, end, lag = start[first], end[first], lag[first]
    order = np.lexsort((lag, start))
    return start[order], end[order], lag[order]


def _octave(names: Names, levels: int, low: int, high: int) -> np.ndarray:
    """Long enough stretches of the lags from ``low`` to ``high`` - 1, by seeds of 2**levels words."""
    gram, size, level = 1 << levels, names.size, names.levels[levels]
    order = np.lexsort((names.alive, level[names.alive]))
    places = names.alive[order]
    key = level[places] * np.int64(size + 1) + places
    seeds = names.alive[names.alive % gram == 0]
    base = level[seeds] * np.int64(size + 1)
    begin = np.searchsorted(key, base + np.minimum(seeds + low, size))
    number = np.searchsorted(key, base + np.minimum(seeds + high, size)) - begin
    seed = np.repeat(seeds, number)
    lag = places[np.repeat(begin - (np.cumsum(number) - number), number) + np.arange(number.sum())] - seed
    order = np.lexsort((seed, lag))
    seed, lag = seed[order], lag[order]
    # The furthest word that a lag has covered: where a pair starts there, its stretch goes on.
    goes_on = (lag[1:] == lag[:-1]) & (seed[1:] == seed[:-1] + gram)
    first, last = np.r_[True, ~goes_on][: len(seed)], np.r_[~goes_on, True][: len(seed)]
    begin, end, lag = seed[first], seed[last] + gram, lag[first]
    begin = begin - names.grow(begin, lag, levels, right=False)
    end = end + names.grow(end, lag, levels, right=True) + lag
    long = end - begin >= np.maximum(SHORTEST, TIMES * lag)
    return np.stack([begin[long], end[long], lag[long]])


def _kept_words(size: int, start: np.ndarray, end: np.ndarray, lag: np.ndarray) -> np.ndarray:
    """All words but those that a run holds after its first period."""
    edge = np.zeros(size + 1, np.int64)
    np.add.at(edge, start + lag, 1)
    np.add.at(edge, end, -1)
    return np.cumsum(edge[:-1]) == 0


def _joined(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, row: np.ndarray, rows: int) -> pa.Array:
    """Each row's words joined by one space."""
    sizes = ends - starts
    space = np.r_[row[1:] == row[:-1], False] if len(row) else np.zeros(0, bool)
    wide = sizes + space
    offsets = np.r_[0, np.cumsum(wide)]
    at = np.arange(offsets[-1]) - np.repeat(offsets[:-1] - starts, wide)
    out = raw[np.minimum(at, max(0, len(raw) - 1))] if len(raw) else np.zeros(0, np.uint8)
    out[offsets[1:][space] - 1] = 0x20
    of_row = offsets[np.searchsorted(row, np.arange(rows + 1))]
    return pa.Array.from_buffers(pa.large_string(), rows, [None, pa.py_buffer(of_row.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes())])


def _examine(raw: np.ndarray, offsets: np.ndarray) -> pa.Array:
    rows = len(offsets) - 1
    starts, ends, first = C.find_words(raw, offsets, C.SPACED)
    row = C.rows_of(first)
    start, end, lag = find_stretches(C.hash_spans(raw, starts, ends), row)
    keep = _kept_words(len(starts), start, end, lag)
    of_run = row[start] if len(start) else np.zeros(0, np.int64)
    runs = pa.StructArray.from_arrays([pa.array(start - first[of_run]), pa.array(end - start), pa.array(lag)], [f.name for f in RUN])
    listed = C.list_array(runs, np.bincount(of_run, minlength=rows))
    text = _joined(raw, starts[keep], ends[keep], row[keep], rows).cast(pa.string())
    return pa.StructArray.from_arrays([pa.array(np.diff(first).astype(np.int64)), listed, text], FOUND.names)


def find_runs(docs: DataFrame, text: str = "text", carry: list[str] | None = None, found: str = "periodic") -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) and ``found``: a struct of n_words, the runs
    (start, length and period in words, by start and period) and the collapsed text, which is the
    words outside of what repeats, joined by one space. A column of that name gets it an underscore."""
    carry = docs.columns if carry is None else carry
    found, seen = C.free_name(docs.select(*[F.col(f"`{c}`") for c in carry]), found, "seen")
    source = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").alias(seen))

    def run(batches):
        for batch in batches:
            raw, offsets = C.text_bytes(batch.column(len(carry)))
            for i, j in C.row_slices(offsets):
                result = _examine(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays([*[c[i:j] for c in batch.columns[: len(carry)]], result], [*carry, found])

    return C.with_workers(source).mapInArrow(run, T.StructType([*[docs.schema[c] for c in carry], T.StructField(found, FOUND)]))


def strongest(runs: Column) -> Column:
    """The run with the greatest exact length / period; of equal ones the first. NULL without runs."""
    better = lambda best, x: best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"])
    return F.aggregate(runs, F.lit(None).cast(RUN), lambda best, x: F.when(better(best, x), x).otherwise(best))


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """``docs``, in a tenth of which (by a hash of the doc_id) the words from some place on repeat.

    With h = crc32 of the decimal doc_id and g = h div 10, texts of h mod 10 = 0 and n > 0 words have
    each word i >= a replaced by word a + (i - a) mod p, a = g mod n, p = 1 + (n - a) div (3 + g mod 8).
    """
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    parts = docs.select("doc_id", "text", F.when(h % 10 == 0, words).alias("words"), h.alias("h"))
    parts = parts.selectExpr("doc_id", "text", "words", "h div 10 AS g", "CASE WHEN size(words) > 0 THEN CAST(size(words) AS BIGINT) END AS n")
    parts = parts.selectExpr("*", "g % n AS a").selectExpr("*", "1 + (n - a) div (3 + g % 8) AS p")
    again = F.expr("transform(words, (w, i) -> CASE WHEN i >= a THEN words[CAST(a + (i - a) % p AS INT)] ELSE w END)")
    return parts.select("doc_id", F.coalesce(F.when(F.col("n").isNotNull(), F.array_join(again, " ")), F.col("text")).alias("text"))


def periodic_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the strongest run, and hashes of all runs and of the collapsed text."""
    found = find_runs(docs, carry=["doc_id"], found="periodic").withColumn("best", strongest(F.col("periodic.runs")))
    lines = F.transform("periodic.runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("periodic.runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2(F.col("periodic.collapsed"), 256).alias("collapsed_sha256"),
    )
