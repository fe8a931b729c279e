"""Near-duplicate documents by DartMinHash.

An element of weight w owns the region [0, w) x [0, oo) of a plane (weight, time), on which hashed
darts fall at rate one. Everything about a dart (its place, its coordinate, its mark) is a hash of
the element, the unit cell and its number there, so two texts see the same darts in the part of
their regions that they share. Each coordinate keeps its earliest dart; two texts agree on a
coordinate with the probability of their weighted Jaccard similarity. Only the darts before a time
that suffices for all coordinates are drawn, about ``k (ln k + 2)`` for a text of any length; the
few texts that lack a coordinate draw twice as far.

Elements are the five-word runs of the lower-cased words (a shorter text is one run). With
``weights="one"``, the production setting, each distinct run weighs 1 and the similarity is that of
sets, as near-duplicate contracts state it; ``weights="count"`` weighs a run by its occurrences.

Rows: texts of the same words form one class first. Signatures of class representatives are cut
into bands; texts that share a band are candidates, and each candidate pair is verified on its
whole sets, unless links found before join the two already. A band of at most ``SMALL`` texts tries
all its pairs. In a larger one each text first tries the band's most shared document, then those
that failed try theirs, ``LEADERS`` times; so a group of copies costs pairs in proportion to its
members. The links so far join into components, and where a large band still holds several, every
pair of its texts from different components is verified, in pairs of blocks of bounded size that
are reduced to links within a task. The components are those of all pairs that share a band.

Rows are known by doc_id and text: a doc_id that stands for several different texts has the links of
each of them. Classes are numbered by their least document; of several classes with the same one, all
but one get a number of their own, which never shows in the result.

Defined results: NULL and wordless texts are alone; rows that repeat a document get the same
class; a NULL doc_id has the class of its text but never represents one; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import common as C
from panelloom.llm.embeddings import _roots

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 28
ROWS = 6
#: Members of a band that try all their pairs.
SMALL = 32
#: Turns by leaders before the members of a large band that are still apart meet in blocks.
LEADERS = 3
#: Texts of a block: of one of a few, of one of many; and five-word runs of a block, about.
FEW_BLOCK = 128
BLOCK = 512
BLOCK_RUNS = 1_000_000
#: Numbers of darts in a unit cell: the distribution function of Poisson(1).
_POISSON = np.cumsum(np.exp(-1.0) / np.cumprod(np.r_[1.0, np.arange(1, 12)]))
_LOW32 = np.uint64(0xFFFFFFFF)

SKETCH = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("mark", T.LongType()),
        T.StructField("key_a", T.LongType()),
        T.StructField("key_b", T.LongType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)
LINK = "a long, b long"
SET = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("runs", T.ArrayType(T.LongType()))])


def _spread(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For repeated items: the index of each copy's item, and the copy's number."""
    total = np.cumsum(counts)
    which = np.repeat(np.arange(len(counts)), counts)
    return which, np.arange(len(which)) - np.repeat(total - counts, counts)


def dart_signatures(elements: np.ndarray, weights: np.ndarray, first: np.ndarray, k: int) -> np.ndarray:
    """Signatures (rows x k) of weighted sets: row i owns elements[first[i]:first[i+1]], none of
    them empty. Each entry holds a dart's time (32 bits, the least wins) and its mark (32 bits)."""
    sets = len(first) - 1
    out = np.full((sets, k), np.uint64(0xFFFFFFFFFFFFFFFF))
    mass = np.add.reduceat(weights, first[:-1]) if sets else np.zeros(0)
    reach = k * (np.log(k) + 2) / mass
    begin, todo = np.zeros(sets, np.int64), np.arange(sets)
    while len(todo):
        stop = np.ceil(reach[todo]).astype(np.int64)
        element, _ = _spread((first[1:] - first[:-1])[todo])
        owner = element
        element = first[:-1][todo][owner] + _
        across = np.ceil(weights[element]).astype(np.int64)
        span = (stop - begin[todo])[owner]
        which, cell = _spread(across * span)
        level, time = cell % across[which], begin[todo][owner][which] + cell // across[which]
        owner, element = owner[which], element[which]
        seed = C.mix(elements[element] ^ C.mix(level.astype(np.uint64) * C._STEP + time.astype(np.uint64) + np.uint64(1)))
        darts = np.searchsorted(_POISSON, (seed >> np.uint64(11)) / float(1 << 53), "right")
        which, number = _spread(darts)
        owner, element, level, time = owner[which], element[which], level[which], time[which]
        dart = C.mix(seed[which] + (number.astype(np.uint64) + np.uint64(1)) * C._BASE)
        place = C.mix(dart)
        at_weight = level + (place & np.uint64(0xFFFFFF)) / float(1 << 24)
        part = (place >> np.uint64(24)) & np.uint64(0xFFFFF)
        at_time = time + part / float(1 << 20)
        keep = (at_weight < weights[element]) & (at_time < reach[todo][owner])
        owner, dart = owner[keep], dart[keep]
        coordinate = ((dart >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
        stamp = np.minimum((time[keep].astype(np.uint64) << np.uint64(20)) | part[keep], _LOW32)
        value = (stamp << np.uint64(32)) | (dart & _LOW32)
        np.minimum.at(out.reshape(-1), todo[owner] * k + coordinate.astype(np.int64), value)
        lacking = (out[todo] == np.uint64(0xFFFFFFFFFFFFFFFF)).any(axis=1)
        todo = todo[lacking]
        # A time that ended within a cell is drawn again from that cell's start.
        begin[todo] = np.floor(reach[todo]).astype(np.int64)
        reach[todo] *= 2
    return out


def shingle_sets(words: np.ndarray, first: np.ndarray, width: int, count: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct runs of ``width`` words by row: their rows, hashes and weights, sorted by row; and
    the number of runs of each row. A row of fewer words, but not none, is one run."""
    sizes = np.diff(first)
    runs = C.window_hashes(words, width)
    start = np.flatnonzero(np.arange(len(runs)) + width <= np.repeat(first[1:], sizes)[: len(runs)])
    row = np.repeat(np.arange(len(sizes)), np.maximum(0, sizes - width + 1))
    value = runs[start]
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    extra = np.zeros(len(short), np.uint64)
    for k, r in enumerate(short):
        extra[k] = C.window_hashes(words[first[r] : first[r + 1]], int(sizes[r]))[0] + np.uint64(sizes[r])
    row, value = np.r_[row, short], np.r_[value, extra]
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (value[1:] != value[:-1])] if len(row) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    weights = np.diff(np.r_[at, len(row)]).astype(float) if count else np.ones(len(at))
    return row[at], value[at], weights, np.bincount(row[at], minlength=len(sizes))


def _texts(column: pa.Array):
    """Slices of a text column: rows, word hashes, and the first word of each row."""
    raw, offsets = C.text_bytes(column)
    for i, j in C.row_slices(offsets, C.SLICE_BYTES // 2):
        part = C.lower_ascii(raw[offsets[i] : offsets[j]])
        starts, ends, first = C.find_words(part, offsets[i : j + 1] - offsets[i], C.ALNUM)
        yield i, j, C.hash_spans(part, starts, ends), first


def _band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.zeros((len(signatures), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(signatures), np.uint64(b + 1))
        for r in range(rows):
            key = C.mix(key * C._STEP + signatures[:, b * rows + r])
        keys[:, b] = key
    return keys


def _sketches(column: pa.Array, bands: int, rows: int, width: int, count: bool):
    """Keys of the word sequence (two hashes; 0, 0 without words) and band keys of each text."""
    for i, j, words, first in _texts(column):
        total = np.zeros(len(words) + 1, np.uint64)
        keys = []
        for salt in (np.uint64(0x51), np.uint64(0xA7)):
            up, down = C.powers(len(words) + 1)
            np.cumsum(C.mix(words + salt) * up[: len(words)], out=total[1:])
            key = C.mix((total[first[1:]] - total[first[:-1]]) * down[first[:-1]] + np.diff(first).astype(np.uint64))
            keys.append(np.where(np.diff(first) > 0, key, np.uint64(0)))
        row, value, weights, sizes = shingle_sets(words, first, width, count)
        some = np.flatnonzero(sizes)
        begin = np.r_[0, np.cumsum(sizes[some])]
        bandkeys = _band_keys(dart_signatures(value, weights, begin, bands * rows), bands, rows)
        lengths = np.where(sizes > 0, bands, 0)
        yield i, j, keys, C.list_array(pa.array(C.signed(bandkeys.reshape(-1))), lengths)


def sketch(docs: DataFrame, doc_id: str, text: str, bands: int, rows: int, width: int, weights: str) -> DataFrame:
    """doc_id, a mark of its text, the keys of its word sequence and its band keys, for each row."""

    def make(batches):
        for batch in batches:
            for i, j, keys, lists in _sketches(batch.column(2), bands, rows, width, weights == "count"):
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], pa.array(C.signed(keys[0])), pa.array(C.signed(keys[1])), lists], SKETCH.names)

    return C.with_workers(_marked(docs, doc_id, text)).mapInArrow(make, SKETCH)


def _marked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, mark (a hash of the text) and text."""
    body = F.col(f"`{text}`")
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.xxhash64(body).alias("mark"), body.alias("text"))


def run_sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id and the distinct five-word runs of its text (hashed to 64 bits)."""

    def make(batches):
        for batch in batches:
            for i, j, words, first in _texts(batch.column(1)):
                _, value, _, sizes = shingle_sets(words, first, width, False)
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], C.list_array(pa.array(C.signed(value)), sizes)], SET.names)

    return C.with_workers(docs).mapInArrow(make, SET)


def _verified(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets are as similar as asked."""
    left = sets.select(F.col("doc_id").alias("a"), F.col("runs").alias("runs_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("runs").alias("runs_b"))
    both = F.size(F.array_intersect("runs_a", "runs_b"))
    joined = pairs.join(left, "a").join(right, "b")
    return joined.where(both >= similarity * (F.size("runs_a") + F.size("runs_b") - both)).select("a", "b")


def near_links(reps: DataFrame, nodes: DataFrame, texts: DataFrame, similarity: float, width: int) -> DataFrame:
    """Verified links (a > b) between the representatives (doc_id, bands) that share a band.

    ``nodes`` tells which text (rep, mark) of ``texts`` (doc_id, mark, text) each one stands for."""
    shared = reps.select(F.explode("bands").alias("band"), "doc_id")
    counted = C.checkpointed(_counted(shared, "band"))
    members = C.checkpointed(shared.join(counted, "band").select(F.array("band").alias("cell"), "doc_id", "n"))
    wanted = members.select(F.col("doc_id").alias("node")).distinct().join(nodes, "node").select("node", F.col("rep").alias("doc_id"), "mark")
    whole = texts.join(wanted, ["doc_id", "mark"]).select(F.col("node").alias("doc_id"), "text").dropDuplicates(["doc_id"])
    sets = C.checkpointed(run_sets(whole, width))
    links, open_, turn = None, members, 1
    while True:
        large = C.checkpointed(_with_leaders(open_.where(F.col("n") > SMALL)))
        lists = open_.where(F.col("n") <= SMALL).groupBy("cell").agg(F.array_sort(F.collect_set("doc_id")).alias("ids"))
        each = F.expr("flatten(transform(ids, (x, i) -> transform(slice(ids, 1, i), y -> struct(x AS a, y AS b))))")
        tried = lists.select(F.explode(each).alias("p")).select("p.a", "p.b")
        tried = tried.union(large.select(F.greatest("doc_id", "leader"), F.least("doc_id", "leader"))).distinct()
        good = C.checkpointed(_verified(tried, sets, similarity))
        links = good if links is None else links.union(good)
        same = (F.greatest("doc_id", "leader") == good["a"]) & (F.least("doc_id", "leader") == good["b"])
        failed = C.checkpointed(large.join(good, same, "left_anti").select("cell", "doc_id"))
        if turn == LEADERS or C.is_empty(failed):
            break
        counted = C.checkpointed(_counted(failed, "cell"))
        open_ = C.checkpointed(failed.join(counted, "cell"))
        turn += 1
    apart = _apart(members.where(F.col("n") > SMALL).select("cell", "doc_id"), C.components(links), sets)
    return links if apart is None else links.union(_compare(apart, sets, similarity))


def _apart(large: DataFrame, named: DataFrame, sets: DataFrame) -> DataFrame | None:
    """The members of large cells that hold several components, dealt to pairs of blocks (cell, low,
    high) so that all pairs meet but those within the cell's largest component."""
    known = large.join(named, F.col("doc_id") == F.col("node"), "left").select("cell", "doc_id", F.coalesce("component", "doc_id").alias("label"))
    sized = C.checkpointed(known.join(sets.select("doc_id", F.size("runs").cast("long").alias("runs")), "doc_id"))
    parts = sized.groupBy("cell", "label").agg(F.count("*").alias("n"), F.sum("runs").alias("runs"))
    cells = parts.groupBy("cell").agg(F.max(F.struct("n", "label", "runs")).alias("main"), F.sum("n").alias("n"), F.sum("runs").alias("runs")).where("n > main.n")

    def blocks(n: Column, runs: Column) -> Column:
        return F.greatest(F.least(F.lit(8), F.ceil(n / FEW_BLOCK)), F.ceil(n / BLOCK), F.ceil(runs / BLOCK_RUNS)).cast("int")

    rest = blocks(F.col("n") - F.col("main.n"), F.col("runs") - F.col("main.runs"))
    cells = C.checkpointed(cells.select("cell", F.col("main.label").alias("main"), blocks(F.col("main.n"), F.col("main.runs")).alias("first"), rest.alias("rest")))
    if C.is_empty(cells):
        return None
    # The largest component's blocks come first and meet only those of the rest.
    within = F.col("label") == F.col("main")
    own = F.when(within, F.pmod(F.xxhash64("doc_id"), F.col("first"))).otherwise(F.col("first") + F.pmod(F.xxhash64("doc_id"), F.col("rest"))).cast("int")
    others = F.sequence(F.when(within, F.col("first")).otherwise(F.lit(0)), F.col("first") + F.col("rest") - 1)
    dealt = sized.join(cells, "cell").select("cell", "doc_id", "label", own.alias("own"), F.explode(others).alias("other"))
    return dealt.select("cell", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), (F.col("own") > F.col("other")).cast("int").alias("side"), "doc_id", "label")


def similar_pairs(values: np.ndarray, offsets: np.ndarray, side: np.ndarray, same: bool, similarity: float, columns: int = 4096) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of sets (places) within a block (``same``) or from side 0 to side 1 that are as
    similar as asked; set i is values[offsets[i]:offsets[i+1]]."""
    sizes = np.diff(offsets)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    left = np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    place = np.zeros(len(sizes), np.int64)
    place[left] = np.arange(len(left))
    place[right] = np.arange(len(right))
    found, token, times = np.unique(values, return_inverse=True, return_counts=True)
    # Only what several sets hold, and both sides, counts towards a pair.
    shared = times > 1
    if not same:
        shared = (np.bincount(token[side[rows] == 0], minlength=len(found)) > 0) & (np.bincount(token[side[rows] == 1], minlength=len(found)) > 0)
    number = np.cumsum(shared) - 1
    keep = shared[token]
    token, rows = number[token[keep]], rows[keep]
    order = np.argsort(token, kind="stable")
    token, rows = token[order], rows[order]
    both = np.zeros((len(left), len(right)))
    for k in range(0, int(shared.sum()), columns):
        i, j = np.searchsorted(token, (k, k + columns))
        at, row = token[i:j] - k, rows[i:j]
        x = np.zeros((len(left), columns), np.float32)
        mine = side[row] == 0
        x[place[row[mine]], at[mine]] = 1
        y = x
        if not same:
            y = np.zeros((len(right), columns), np.float32)
            y[place[row[~mine]], at[~mine]] = 1
        both += x @ y.T
    near = both >= similarity * (sizes[left][:, None] + sizes[right][None, :] - both)
    if same:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    return left[i], right[j]


def _compare(apart: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """Links between the labels that verified pairs of the blocks join."""

    def run(block: pa.Table) -> pa.Table:
        side, label = block["side"].to_numpy(), block["label"].to_numpy()
        low, high = block["low"][0].as_py(), block["high"][0].as_py()
        names, node = np.unique(label, return_inverse=True)
        if len(names) == 1 or (low != high and len(np.unique(side)) == 1):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        runs = block["runs"].combine_chunks()
        offsets = runs.offsets.to_numpy()
        values = runs.values.to_numpy()[offsets[0] : offsets[-1]]
        i, j = similar_pairs(values, offsets - offsets[0], side, low == high, similarity)
        root = _roots(node[i], node[j], names)
        return pa.table({"a": names[names != root], "b": root[names != root]})

    # The runs meet their places in the blocks by document, and go on to the blocks.
    blocks = apart.join(sets, "doc_id").select("cell", "low", "high", "side", "label", "runs")
    return C.checkpointed(C.with_workers(blocks).groupBy("cell", "low", "high").applyInArrow(run, LINK))


def _counted(cells: DataFrame, key: str) -> DataFrame:
    """The cells that more than one document shares, and their numbers."""
    return cells.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def _with_leaders(large: DataFrame) -> DataFrame:
    """The members of large cells beside their cell's leader: of its members the one that most large
    cells hold, as the text that others were copied from does; the least of several."""
    degree = large.groupBy("doc_id").agg(F.count("*").alias("degree"))
    lead = large.join(degree, "doc_id").groupBy("cell").agg(F.min(F.struct((-F.col("degree")).alias("d"), "doc_id"))["doc_id"].alias("leader"))
    return large.join(C.checkpointed(lead), "cell").where("doc_id <> leader").select("cell", "doc_id", "leader")


def near_groups(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
    width: int = SHINGLE,
    weights: str = "one",
) -> DataFrame:
    """One row per row of ``docs``: doc_id, group_id (the least document of its group, itself
    included) and kept (whether it is that document)."""
    return marked_groups(docs, doc_id, text, similarity, bands, rows, width, weights).drop("mark")


def _classes(worded: DataFrame) -> DataFrame:
    """The classes of equal word sequences: their keys, the least document (rep) with a mark of its
    text, and the class's number (node)."""
    first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))).alias("first")
    classes = worded.groupBy("key_a", "key_b").agg(first).where("first IS NOT NULL")
    classes = C.checkpointed(classes.select("key_a", "key_b", F.col("first.doc_id").alias("rep"), "first.mark"))
    # Few documents stand for several texts; those of one text need no number but their own.
    shared = classes.groupBy("rep").agg(F.count("*").alias("n"), F.min(F.struct("key_a", "key_b")).alias("own")).where("n > 1")
    other = F.col("own").isNotNull() & (F.col("own") != F.struct("key_a", "key_b"))
    node = F.when(other, F.xxhash64("rep", "key_a", "key_b")).otherwise(F.col("rep")).alias("node")
    numbered = classes.join(C.checkpointed(shared.select("rep", "own")), "rep", "left")
    return C.checkpointed(numbered.select("key_a", "key_b", "rep", "mark", node))


def marked_groups(docs: DataFrame, doc_id: str, text: str, similarity: float, bands: int, rows: int, width: int, weights: str) -> DataFrame:
    """doc_id, mark (a hash of the text), group_id and kept of every row."""
    sketches = C.checkpointed(sketch(docs, doc_id, text, bands, rows, width, weights))
    worded = sketches.where("NOT (key_a = 0 AND key_b = 0)")
    classes = _classes(worded)
    nodes = classes.select("node", "rep", "mark")
    standing = (worded["doc_id"] == nodes["rep"]) & (worded["mark"] == nodes["mark"])
    reps = worded.join(nodes, standing).select(F.col("node").alias("doc_id"), "bands").dropDuplicates(["doc_id"])
    joined = C.components(near_links(reps, nodes, _marked(docs, doc_id, text), similarity, width))
    labelled = classes.join(joined, "node", "left").select("key_a", "key_b", "rep", "node", F.coalesce("component", "node").alias("label"))
    # A component's least number is its least document, unless a number of other kind is in it.
    odd = labelled.where("node <> rep").select("label").distinct()
    least = C.checkpointed(labelled.join(odd, "label", "left_semi").groupBy("label").agg(F.min("rep").alias("least")))
    named = labelled.join(least, "label", "left").select("key_a", "key_b", F.coalesce("least", "label").alias("group_id"))
    out = sketches.select("doc_id", "mark", "key_a", "key_b").join(C.checkpointed(named), ["key_a", "key_b"], "left")
    group = F.coalesce("group_id", "doc_id")
    return out.select("doc_id", "mark", group.alias("group_id"), F.coalesce(F.col("doc_id") == group, F.lit(False)).alias("kept"))


def drop_near_copies(docs: DataFrame) -> DataFrame:
    """The documents of which one stays for each group, with their own columns.

    Equal rows of the document that stays count as one; rows without a doc_id cannot be told apart
    and stay. Of a doc_id with several texts each goes or stays by itself; near copies among them
    are one document and stay together.
    """
    groups = marked_groups(docs, "doc_id", "text", SIMILARITY, BANDS, ROWS, SHINGLE, "one")
    gone = groups.where("doc_id IS NOT NULL AND NOT kept").select(F.col("doc_id").alias("gone_id"), F.col("mark").alias("gone_mark")).distinct()
    same = (docs["doc_id"].cast("long") == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_mark"])
    named = docs.where("doc_id IS NOT NULL").join(gone, same, "left_anti").dropDuplicates(["doc_id", "text"])
    return named.select(docs.columns).unionByName(docs.where("doc_id IS NULL"))
