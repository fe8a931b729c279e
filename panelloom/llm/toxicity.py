"""Toxicity scores: FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text whose A-Z are lower-cased. A text's features
are the 32-bit hashes of its words, pairs and triples of neighbouring words, and skip-grams: pairs
with one or two words between them. A feature counts once per text, so a text's length or a
repeated line does not decide.

The model is learned online, one document after the other, by FTRL-proximal: each coordinate has
its own learning rate, which falls with the gradients that it has seen, and the L1 term keeps at
zero what the sample gives no clear evidence for. What is left is a short sorted list of hashes and
weights, which is broadcast; its size is bounded by the sample, not by the corpus. Scoring reads every
text whole, in slices, within its task: no shuffle, no row depends on another.

The sample is at most about ``SAMPLE_ROWS`` labelled documents, half of each label where there are
enough, chosen by a hash of the doc_id. Scores are probabilities at that balance of labels, so a
label that is rare in the corpus is found as readily as a frequent one. (Weights that undo the balance
were tried: where one document stands for a dozen its gradient outgrows the L1 term, which then
clears nothing.) Features of fewer than ``MIN_DOCS`` sampled documents are left out.

Defined results: NULL and wordless texts have the score of a text without any known feature, which
is the bias alone; repeated rows are scored alike; rows with a NULL doc_id or label are never learned
from; a doc_id with several labels has the greatest, one with several texts teaches the least of
them; with nothing to learn from every score is 0; further columns pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelloom.llm import common as C

SAMPLE_ROWS = 8_000
MIN_DOCS = 3
EPOCHS = 4
#: Learning rate, its smoothing, and the strengths of L1 and L2.
ALPHA, BETA, L1, L2 = 3.0, 1.0, 8.0, 0.0
#: Words between the two of a pair: none is a bigram, more are skip-grams.
GAPS = (0, 1, 2)

_SEED = np.array([0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89, 0x452821E638D01377], np.uint64)
_FIRST, _SECOND, _THIRD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)
#: Features are sifted by their upper bits before they are looked up.
_SIFT = 20


@dataclass(frozen=True)
class Model:
    codes: np.ndarray  # sorted hashes of features with a weight
    weights: np.ndarray
    bias: float


def _words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = C.lower_ascii(raw)
    starts, ends, first = C.find_words(low, offsets, C.ALNUM)
    return C.hash_spans(low, starts, ends), first


def features(words: np.ndarray, first: np.ndarray):
    """The features of each kind: their hashes, and the rows they belong to."""
    row = C.rows_of(first)

    def together(reach: int) -> np.ndarray:
        return row[: max(0, len(row) - reach)] == row[reach:]

    yield _code(words * _FIRST + _SEED[0]), row
    for kind, gap in enumerate(GAPS, 1):
        inside = np.flatnonzero(together(gap + 1))
        yield _code(words[inside] * _FIRST + words[inside + gap + 1] * _SECOND + _SEED[kind]), row[inside]
    inside = np.flatnonzero(together(2))
    yield _code(words[inside] * _FIRST + words[inside + 1] * _SECOND + words[inside + 2] * _THIRD + _SEED[-1]), row[inside]


def _code(mixed: np.ndarray) -> np.ndarray:
    return (C.mix(mixed) >> np.uint64(32)).astype(np.uint32)


def remainder(doc_id: str) -> F.Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5))


def labelled_ids(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> DataFrame:
    """(sample_id, label): the documents' ids that may be learned from, each once."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (remainder("doc_id") != 0))
    known = rows.groupBy(F.col("doc_id").alias("sample_id")).agg(F.max(F.col(label).cast("int")).alias("label"))
    return known.join(docs.select(F.col("doc_id").alias("sample_id")), "sample_id", "left_semi")


def train(docs: DataFrame, labels: DataFrame, text: str = "text", label: str = "toxic", sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model of ``text``, learned from labelled documents whose remainder is not 0."""
    known = C.checkpointed(labelled_ids(docs, labels, label))
    counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    wanted = {0: sample_rows // 2, 1: sample_rows // 2}
    for one, other in ((0, 1), (1, 0)):
        wanted[one] = max(wanted[one], sample_rows - counts.get(other, 0))
    share = {k: min(1.0, wanted[k] / n) for k, n in counts.items() if k in wanted}
    if not share:
        return Model(np.zeros(0, np.uint32), np.zeros(0), -np.inf)
    draw = F.pmod(F.xxhash64("sample_id", F.lit("toxicity sample")), F.lit(1 << 20))
    limit = F.coalesce(*[F.when(F.col("label") == k, F.lit(int(s * (1 << 20)))) for k, s in share.items()])
    ids = known.where(draw < limit)
    # Bounded by the shares above; a document id that many rows repeat gives one text.
    sample = (
        docs.where(F.col("doc_id").isNotNull())
        .select(F.col("doc_id").alias("sample_id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
        .join(F.broadcast(ids), "sample_id")
        .groupBy("sample_id", "label")
        .agg(F.min("text").alias("text"))
    )
    kind = T.StructType([T.StructField("sample_id", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("words", T.ArrayType(T.LongType()))])

    def read(batches):
        for batch in batches:
            raw, offsets = C.text_bytes(batch.column(2))
            for i, j in C.row_slices(offsets):
                words, first = _words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                listed = C.list_array(pa.array(C.signed(words)), np.diff(first))
                yield pa.RecordBatch.from_arrays([batch.column(0)[i:j], batch.column(1)[i:j], listed], kind.names)

    table = C.with_workers(sample.select(F.col("sample_id").cast("long"), "label", "text")).mapInArrow(read, kind).toArrow()
    C.discard(known)
    order = np.argsort(C.mix(table["sample_id"].to_numpy().view(np.uint64) + _SEED[0]), kind="stable")
    truth = table["label"].to_numpy()[order]
    lists = table["words"].combine_chunks()
    flat, begin = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
    texts = [flat[begin[k] : begin[k + 1]] for k in order]
    return fit(texts, truth)


def _features_of(words: np.ndarray) -> np.ndarray:
    return np.unique(np.concatenate([codes for codes, _ in features(words, np.array([0, len(words)]))]))


def fit(texts: list[np.ndarray], truth: np.ndarray) -> Model:
    """FTRL-proximal over word hashes of texts; keeps features that enough texts hold."""
    if not len(texts):
        return Model(np.zeros(0, np.uint32), np.zeros(0), -np.inf)
    met, kept = np.zeros(1 << 24, np.uint16), []
    for words in texts:
        kept.append(_features_of(words))
        slots = kept[-1] >> np.uint32(8)
        met[slots] += met[slots] < 65535
    kept = [codes[met[codes >> np.uint32(8)] >= min(MIN_DOCS, len(texts))] for codes in kept]
    known, number = np.unique(np.concatenate(kept), return_counts=True)
    known = known[number >= min(MIN_DOCS, len(texts))]
    bags = []
    for codes in kept:
        at = np.minimum(np.searchsorted(known, codes), max(0, len(known) - 1))
        bags.append(at[known[at] == codes] if len(known) else at[:0])
    z, n = np.zeros(len(known) + 1), np.zeros(len(known) + 1)  # the last one is the bias
    l1 = np.full(len(known) + 1, L1)
    l1[-1] = 0

    def weights(at):
        own, strength = z[at], l1[at]
        return np.where(np.abs(own) > strength, (np.sign(own) * strength - own) / ((BETA + np.sqrt(n[at])) / ALPHA + L2), 0.0)

    for _ in range(EPOCHS):
        for k, bag in enumerate(bags):
            at = np.r_[bag, len(known)]
            w = weights(at)
            slope = _sigmoid(w.sum()) - truth[k]
            before = np.sqrt(n[at])
            n[at] += slope * slope
            z[at] += slope - (np.sqrt(n[at]) - before) / ALPHA * w
    final = weights(np.arange(len(known) + 1))
    some = np.flatnonzero(final[:-1])
    return Model(known[some], final[some], float(final[-1]))


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -700, 700)))


def predict(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None, found: str = "toxicity") -> DataFrame:
    """The columns ``carry`` of ``docs`` (default: all) and ``found``: the score of each text. (Where
    ``found`` is taken, underscores follow it.)"""
    carry = docs.columns if carry is None else carry
    found, seen = C.free_name(docs.select(*[F.col(f"`{c}`") for c in carry]), found, "seen")
    source = docs.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").alias(seen))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        own = shared.value
        sift = np.zeros(1 << _SIFT, bool)
        sift[own.codes >> np.uint32(32 - _SIFT)] = True
        for batch in batches:
            raw, offsets = C.text_bytes(batch.column(len(carry)))
            total = np.full(len(offsets) - 1, own.bias)
            for i, j in C.row_slices(offsets):
                if not len(own.codes):
                    break
                words, first = _words(raw[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                pairs = []
                for codes, row in features(words, first):
                    some = np.flatnonzero(sift[codes >> np.uint32(32 - _SIFT)])
                    at = np.minimum(np.searchsorted(own.codes, codes[some]), len(own.codes) - 1)
                    same = own.codes[at] == codes[some]
                    pairs.append(row[some[same]] * len(own.codes) + at[same])
                once = np.unique(np.concatenate(pairs))
                total[i:j] += np.bincount(once // len(own.codes), own.weights[once % len(own.codes)], j - i)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(carry)], pa.array(_sigmoid(total) * (total > -np.inf))], [*carry, found])

    return C.with_workers(source).mapInArrow(run, T.StructType([*[docs.schema[c] for c in carry], T.StructField(found, T.DoubleType())]))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = train(docs.select("doc_id", "text"), labels)
    out = predict(docs.select("doc_id", "text"), model, carry=["doc_id"], found="score")
    return out.select(
        "doc_id",
        F.coalesce(remainder("doc_id") == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below one half, with their own columns."""
    (found,) = C.free_name(docs, "toxicity")
    return predict(docs, train(docs, labels), found=found).where(f"{found} < 0.5").drop(found)
