"""Language identification: averaged hashed subword embeddings with a linear softmax.

A text is lower-cased (A-Z), its runs of other ASCII than letters become one space, and every run of
2 to 4 bytes is hashed to one of ``BUCKETS`` rows of an embedding matrix. The mean of a text's rows
goes through a linear softmax. Both matrices are trained by stochastic gradient descent in numpy on a
bounded sample of labelled rows. A part of the sample is held back: it sets the temperature that
calibrates the scores, and the score below which a prediction is rejected so that about
``REJECTED`` of right predictions would be lost.

The mean and the linear map commute, so tasks get the product of the matrices: one score per bucket
and language, in a broadcast of BUCKETS x languages numbers. Every text is read whole, in slices.

Defined results: NULL text and text without a letter are ``und`` with score 0; so is every text if
nothing could be learned. Rows without a label, or with a NULL doc_id, are predicted but never
learned from; repeated rows are predicted alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import common as C

BUCKETS = 1 << 14
DIMENSIONS = 16
ORDERS = (2, 3, 4)
#: At most so many labelled rows are learned from, spread evenly over the languages.
SAMPLE_ROWS = 4000
#: Hashes of doc_ids are counted in 2 ** BUCKET_BITS ranges.
BUCKET_BITS = 12
EPOCHS = 5
RATE = 0.2
#: One in so many sampled rows calibrates instead of training.
HELD_BACK = 5
REJECTED = 0.0005
UNKNOWN = "und"

_SPACE = 0x20
_FOLD = np.full(256, _SPACE, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


@dataclass(frozen=True)
class Model:
    languages: list[str]
    scores: np.ndarray  # buckets x languages, divided by the temperature
    bias: np.ndarray
    threshold: float


def folded(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space at both ends and single spaces within, and their offsets."""
    sizes = np.diff(offsets)
    row = np.repeat(np.arange(len(sizes)), sizes)
    out = np.full(len(raw) + 2 * len(sizes), _SPACE, np.uint8)
    out[np.arange(len(raw)) + 2 * row + 1] = _FOLD[raw]
    begin = offsets + 2 * np.arange(len(offsets))
    keep = out != _SPACE
    keep[1:] |= out[:-1] != _SPACE
    keep[begin[:-1]] = True
    return out[keep], np.r_[0, np.cumsum(keep)][begin]


def buckets(text: np.ndarray, offsets: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all runs of ``order`` bytes within a row, and their number for each row."""
    counts = np.maximum(0, np.diff(offsets) - order + 1)
    size = len(text) - order + 1
    if size <= 0:
        return np.zeros(0, np.int64), np.zeros_like(counts)
    code = np.full(size, np.uint32(order))
    for k in range(order):
        code = code * np.uint32(0x01000193) ^ text[k : k + size]
    code ^= code >> np.uint32(15)
    code *= np.uint32(0x85EBCA6B)
    code >>= np.uint32(32 - BUCKETS.bit_length() + 1)
    inside = np.ones(len(text), bool)
    for k in range(1, order):
        at = offsets[1:] - k
        inside[at[at >= offsets[:-1]]] = False
    return code[inside[:size]], counts


def _row_sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    out = np.zeros((len(counts), values.shape[1]))
    some = counts > 0
    if some.any():
        out[some] = np.add.reduceat(values, (np.cumsum(counts) - counts)[some], axis=0, dtype=np.float64)
    return out


def _bags(docs: DataFrame) -> DataFrame:
    """lang, held back or not, and the buckets of each text with their shares."""
    kind = T.StructType([T.StructField("lang", T.StringType()), T.StructField("held", T.BooleanType()), T.StructField("bucket", T.ArrayType(T.IntegerType())), T.StructField("share", T.ArrayType(T.FloatType()))])

    def make(batches):
        for batch in batches:
            raw, offsets = C.text_bytes(batch.column(2))
            for i, j in C.row_slices(offsets):
                text, begin = folded(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                of_row: list[list[np.ndarray]] = [[] for _ in range(j - i)]
                for order in ORDERS:
                    found, counts = buckets(text, begin, order)
                    for k, part in enumerate(np.split(found, np.cumsum(counts)[:-1])):
                        of_row[k].append(part)
                bags = [np.unique(np.concatenate(parts), return_counts=True) for parts in of_row]
                sizes = np.array([len(b) for b, _ in bags])
                values = [C.list_array(pa.array(np.concatenate([b for b, _ in bags]).astype(np.int32)), sizes), C.list_array(pa.array(np.concatenate([n / n.sum() for _, n in bags]).astype(np.float32)), sizes)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], *values], kind.names)

    return C.with_workers(docs).mapInArrow(make, kind)


def remainder(doc_id: str) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4))


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of ``text`` and non-null ``lang`` of documents whose remainder is not 2.

    Each language gives its first rows by a hash of the doc_id, in turn, up to ``sample_rows`` in
    all; only their ids and then their bags of buckets reach the driver.
    """
    labelled = docs.where((remainder("doc_id") != 2) & F.col("lang").isNotNull()).select("doc_id", "lang", F.xxhash64("doc_id").alias("at"))
    # Only hashes of the least buckets that hold enough rows of a language are put in order.
    bucket = F.shiftright("at", 64 - BUCKET_BITS)
    counts = labelled.groupBy("lang", bucket.alias("bucket")).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("lang").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0))).where(F.col("before") < sample_rows)
    first = labelled.join(counts.groupBy("lang").agg(F.max("bucket").alias("upto")), "lang").where(bucket <= F.col("upto"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("at", "doc_id"))
    chosen = first.drop("upto").withColumn("turn", turn).where(F.col("turn") <= sample_rows).orderBy("turn", "at", "lang").limit(sample_rows)
    ids = docs.sparkSession.createDataFrame(chosen.select("doc_id").distinct().collect(), "sample_id long")
    sample = docs.where(F.col("text").rlike(r"\p{L}") & F.col("lang").isNotNull()).join(F.broadcast(ids), F.col("doc_id") == F.col("sample_id"))
    held = F.pmod(F.xxhash64("doc_id", F.lit("held back")), F.lit(HELD_BACK)) == 0
    table = _bags(sample.select("lang", held.alias("held"), "text")).orderBy("lang", "held", "bucket").toArrow()
    languages = sorted(set(table["lang"].to_pylist()))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0), np.float32), np.zeros(0), 0.0)
    labels = [languages.index(x) for x in table["lang"].to_pylist()]
    bags = [(b.values.to_numpy(), s.values.to_numpy()) for b, s in zip(table["bucket"], table["share"])]
    return _fit(languages, labels, bags, table["held"].to_pylist())


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def _fit(languages: list[str], labels: list[int], bags: list[tuple[np.ndarray, np.ndarray]], held: list[bool]) -> Model:
    random = np.random.default_rng(17)
    embed = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    linear, bias = np.zeros((DIMENSIONS, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    fit = [k for k in range(len(bags)) if not held[k]] or list(range(len(bags)))
    steps, total = 0, EPOCHS * len(fit)
    for _ in range(EPOCHS):
        for k in random.permutation(fit):
            bucket, share = bags[k]
            rate = np.float32(RATE * (1 - steps / total))
            hidden = share @ embed[bucket]
            error = _softmax(hidden @ linear + bias)
            error[labels[k]] -= 1
            back = linear @ error
            linear -= rate * np.outer(hidden, error)
            bias -= rate * error
            # The shares of a long text are small; the root keeps its step from vanishing.
            embed[bucket] -= rate * (share * np.float32(len(bucket) ** 0.5))[:, None] * back
            steps += 1
    scores = embed @ linear
    check = [k for k in range(len(bags)) if held[k]] or fit
    logits = np.array([bags[k][1] @ scores[bags[k][0]] + bias for k in check])
    truth = np.array([labels[k] for k in check])
    # Targets a little below one, so that rows without any error don't ask for endless certainty.
    target = np.full(logits.shape, 1 / (len(truth) + 2) / max(1, len(languages) - 1))
    target[np.arange(len(truth)), truth] = (len(truth) + 1) / (len(truth) + 2)
    grid = 2.0 ** np.arange(-6, 10.25, 0.25)
    loss = [-(target * _log_softmax(logits / t)).sum(axis=1).mean() for t in grid]
    heat = grid[int(np.argmin(loss))]
    sure = _softmax(logits / heat)
    right = np.sort(sure.max(axis=1)[sure.argmax(axis=1) == truth])
    lost = int(REJECTED * (len(right) + 1))
    # Fewer right rows than one lost row needs: half the least of their scores.
    threshold = float(right[lost - 1]) if lost else 0.5 * float(right[0]) if len(right) else 0.0
    return Model(languages, (scores / heat).astype(np.float32), bias / heat, threshold)


def predict(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None, found: str = "language") -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) and ``found``: a struct of lang_pred, score
    and rejected."""
    carry = docs.columns if carry is None else carry
    (seen,) = C.free_name(docs, "seen")
    lettered = F.when(F.col(f"`{text}`").rlike(r"\p{L}"), F.col(f"`{text}`"))
    source = docs.select(*[F.col(f"`{c}`") for c in carry], lettered.alias(seen))
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("rejected", T.BooleanType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        names = pa.array([*own.languages, UNKNOWN])
        for batch in batches:
            column = batch.column(len(carry))
            raw, offsets = C.text_bytes(column)
            which, best = np.full(len(column), len(own.languages)), np.zeros(len(column))
            known = np.asarray(column.is_valid()) & bool(own.languages)
            for i, j in C.row_slices(offsets):
                if not known[i:j].any():
                    continue
                part, begin = folded(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                total, number = np.zeros((j - i, len(own.languages))), np.zeros(j - i)
                for order in ORDERS:
                    found_, counts = buckets(part, begin, order)
                    total += _row_sums(own.scores[found_], counts)
                    number += counts
                sure = _softmax(total / np.maximum(number, 1)[:, None] + own.bias)
                which[i:j] = np.where(known[i:j], sure.argmax(axis=1), which[i:j])
                best[i:j] = np.where(known[i:j], sure.max(axis=1), 0.0)
            lost = ~known | (best < own.threshold)
            result = pa.StructArray.from_arrays([names.take(pa.array(which)), pa.array(best), pa.array(lost)], kind.names)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], result], [*carry, found])

    return C.with_workers(source).mapInArrow(run, T.StructType([*[docs.schema[c] for c in carry], T.StructField(found, kind)]))


def predictions(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every document."""
    model = train(docs.select("doc_id", "lang", "text"))
    out = predict(docs.select("doc_id", "text"), model, carry=["doc_id"])
    return out.select("doc_id", F.coalesce(remainder("doc_id") == 2, F.lit(False)).alias("held_out"), "language.lang_pred", "language.score", "language.rejected")


def drop_rejected(docs: DataFrame) -> DataFrame:
    """The documents whose language is known with enough certainty, with their own columns."""
    (found,) = C.free_name(docs, "language")
    return predict(docs, train(docs), found=found).where(f"NOT {found}.rejected").drop(found)
