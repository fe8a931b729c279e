"""Near-duplicate vectors by cross-polytope hashing.

Equal vectors of a label form one class first. A class is hashed by ``TABLES`` tables: a vector is
rotated by three rounds of random signs and a fast Hadamard transform, and its nearest vertex of the
cross-polytope (the largest coordinate and its sign) is one hash; ``HASHES`` of them make a bucket.
Besides its own bucket a vector probes the next ones, in order of how little the coordinates would
have to change. Two vectors are compared if any of their buckets of a table is the same.

Buckets arrive sorted in tasks that hold one block at a time. A bucket of more than ``BLOCK``
vectors is cut by a hash into blocks, and each pair of blocks is compared by itself, so no bucket is
gathered and none loses pairs. All candidates are verified by their cosine in double precision. A
pair that meets in several buckets counts in the least of them only, so each block can return, per
vector, its number of links and the least vector that it reaches there: no pair leaves a task.

Defined results: a vector that is NULL, empty, zero or holds NULL or non-finite components, or whose
label or vec_id is NULL, links with nothing and is its own component; vectors of different length
never link; rows that repeat a vector (or a vec_id) are vectors of their own, linked with each
other; further columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelloom.llm import common as C

COSINE = 0.98
TABLES = 6
HASHES = 2
PROBES = 2
#: Vectors in one block; two blocks and their products are all that a task holds.
BLOCK = 1024

HASHED = "rep long, copies long, label string, vector array<double>, codes array<long>"
LINKED = "rep long, links long, root long"


def hadamard(x: np.ndarray) -> np.ndarray:
    """The Walsh-Hadamard transform of each row; the number of columns is a power of two."""
    half = 1
    while half < x.shape[1]:
        pair = x.reshape(len(x), -1, 2, half)
        x = np.stack([pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]], axis=2).reshape(len(x), -1)
        half *= 2
    return x


def _rotated(x: np.ndarray, seed: int) -> np.ndarray:
    signs = np.random.default_rng(seed).integers(0, 2, (3, x.shape[1])) * 2.0 - 1
    for s in signs:
        x = hadamard(x * s)
    return x / x.shape[1] ** 1.5


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def bucket_codes(x: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """The codes (rows x tables*probes) of the buckets that unit vectors probe."""
    size = 1 << max(1, (x.shape[1] - 1).bit_length())
    x = np.pad(x, ((0, 0), (0, size - x.shape[1])))
    near = min(size, probes)
    out = np.zeros((len(x), tables * probes), np.uint64)
    for t in range(tables):
        code, cost = np.full((len(x), 1), np.uint64(t + 1)), np.zeros((len(x), 1))
        for h in range(hashes):
            y = _rotated(x, 7919 * (t * hashes + h) + 13)
            top = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :near]
            value = np.take_along_axis(y, top, 1)
            vertex = (top * 2 + (value > 0)).astype(np.uint64)
            more = (np.abs(value[:, :1]) - np.abs(value)) ** 2
            code = C.mix(code[:, :, None] * C._STEP + vertex[:, None, :] + np.uint64(1)).reshape(len(x), -1)
            cost = (cost[:, :, None] + more[:, None, :]).reshape(len(x), -1)
        best = np.argsort(cost, axis=1, kind="stable")[:, :probes]
        out[:, t * probes : (t + 1) * probes] = np.take_along_axis(code, best, 1)
    return out


def _hash_classes(classes: DataFrame, tables: int, hashes: int, probes: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            vectors = batch.column(3)
            values, offsets = vectors.values.to_numpy(), vectors.offsets.to_numpy()
            sizes = np.diff(offsets)
            codes = np.zeros((len(sizes), tables * probes), np.int64)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                found = bucket_codes(unit_rows(values[offsets[rows][:, None] + np.arange(size)]), tables, hashes, probes)
                codes[rows] = np.sort(C.signed(C.mix(found + np.uint64(size))), axis=1)
            lists = C.list_array(pa.array(codes.reshape(-1)), np.full(len(sizes), tables * probes))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], lists], ["rep", "copies", "label", "vector", "codes"])

    return C.with_workers(classes).mapInArrow(run, HASHED)


def _roots(a: np.ndarray, b: np.ndarray, names: np.ndarray) -> np.ndarray:
    """The least name that each vertex reaches over the edges (a, b)."""
    label = names.copy()
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        if (label == before).all():
            return label


def compare_block(rep: np.ndarray, copies: np.ndarray, side: np.ndarray, x: np.ndarray, codes: np.ndarray, code: int, same: bool, cosine: float) -> tuple[np.ndarray, ...]:
    """Links within a block (``same``) or between the two sides of a pair of blocks: rep, links and
    root of linked vectors."""
    left = np.flatnonzero(side == 0)
    right = left if same else np.flatnonzero(side == 1)
    found_a, found_b = [], []
    for k in range(0, len(left), BLOCK):
        close = x[left[k : k + BLOCK]] @ x[right].T >= cosine
        if same:
            close &= np.arange(len(right))[None, :] > np.arange(k, min(k + BLOCK, len(left)))[:, None]
        i, j = np.nonzero(close)
        for part in range(0, len(i), 1 << 15):
            a, b = left[k + i[part : part + (1 << 15)]], right[j[part : part + (1 << 15)]]
            first = np.ones(len(a), bool)
            for c in range(codes.shape[1]):
                earlier = codes[a, c] < code
                if not earlier.any():
                    break
                first &= ~(earlier & (codes[b] == codes[a, c][:, None]).any(axis=1))
            found_a.append(a[first])
            found_b.append(b[first])
    a, b = (np.concatenate(f) if f else np.zeros(0, np.int64) for f in (found_a, found_b))
    links = np.bincount(a, copies[b], len(rep)) + np.bincount(b, copies[a], len(rep))
    root = _roots(a, b, rep)
    some = np.unique(np.r_[a, b])
    return rep[some], links[some].astype(np.int64), root[some]


def _compare(blocks: DataFrame, cosine: float) -> DataFrame:
    """Links of blocks that arrive sorted by (label, code, low, high)."""

    def run(batches):
        def done(table: pa.Table):
            label = table["label"].combine_chunks().dictionary_encode().indices.to_numpy()
            keys = np.stack([label, *[table[c].to_numpy() for c in ("code", "low", "high")]], axis=1)
            edges = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
            rep, copies, side = (table[c].to_numpy() for c in ("rep", "copies", "side"))
            vectors, codes = table["vector"].combine_chunks(), table["codes"].combine_chunks()
            values, offsets = vectors.values.to_numpy(), vectors.offsets.to_numpy()
            codes = codes.values.to_numpy()[codes.offsets[0].as_py() : codes.offsets[-1].as_py()].reshape(len(rep), -1)
            out = []
            for a, b in zip(edges[:-1], edges[1:]):
                if b - a < 2:
                    continue
                sizes = np.diff(offsets[a : b + 1])
                for size in np.unique(sizes):
                    rows = a + np.flatnonzero(sizes == size)
                    x = unit_rows(values[offsets[rows][:, None] + np.arange(size)])
                    out.append(compare_block(rep[rows], copies[rows], side[rows], x, codes[rows], int(keys[a, 1]), keys[a, 2] == keys[a, 3], cosine))
            columns = [np.concatenate(c) for c in zip(*out)] if out else [np.zeros(0, np.int64)] * 3
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["rep", "links", "root"])

        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            last = np.ones(held.num_rows, bool)
            for c in ("label", "code", "low", "high"):
                last &= np.asarray(pc.equal(held[c], held[c][held.num_rows - 1]))
            cut = int(np.argmax(last))
            if cut:
                yield done(held.slice(0, cut).combine_chunks())
                held = held.slice(cut).combine_chunks()
        if held is not None and held.num_rows:
            yield done(held.combine_chunks())

    key = ["label", "code", "low", "high"]
    return C.with_workers(blocks).repartition(*key).sortWithinPartitions(*key).mapInArrow(run, LINKED)


def near_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    tables: int = TABLES,
    hashes: int = HASHES,
    probes: int = PROBES,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding, label)."""
    x = F.col("embedding")
    able = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.coalesce(able & finite & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), x.cast("array<double>").alias("vector"), usable.alias("usable")
    )
    usable_rows = rows.where("usable").select("vec_id", "label", "vector")
    classes = C.checkpointed(usable_rows.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    hashed = C.checkpointed(_hash_classes(classes.select("rep", "copies", "label", "vector"), tables, hashes, probes))
    placed = hashed.select("rep", "label", F.explode("codes").alias("code"))
    counted = placed.groupBy("label", "code").agg(F.count("*").alias("members")).where("members > 1")
    cells = hashed.select("*", F.explode("codes").alias("code")).join(C.checkpointed(counted), ["label", "code"])
    number = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64("rep"), number).cast("int")
    cells = cells.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), number - 1)))
    blocks = cells.select(
        "label",
        "code",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
        "rep",
        "copies",
        "vector",
        "codes",
    )
    found = C.checkpointed(_compare(blocks, cosine))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = C.components(found.where("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    known = (
        classes.join(links, "rep", "left")
        .join(joined, F.col("rep") == F.col("node"), "left")
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    alone = rows.where("NOT usable").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = usable_rows.join(known, ["label", "vector"]).select("vec_id", "n_links", "component_id").unionByName(alone)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
