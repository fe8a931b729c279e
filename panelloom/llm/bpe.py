"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

**Sufficient lookahead.** Merges happen in the order of their ranks. Whether a rule (u, v) merges at
a place depends on text to the right of u: on v itself, and on rules of higher priority that take a
token from v's right edge (v, its right part, that part's right part, ...) before v is complete or
used. Such a rule (s, x) depends in turn on the text right of s. Its rank is lower each time, so the
longest such chain is found by one pass over the merge list in rank order. The greatest reach over
all rules is the lookahead: a token that ends so many bytes before the end of what has been read
can't change any more. The transducer emits those tokens and keeps only the bytes behind them, so it
needs the same memory for a word of any length. Cutting at a token's end is safe, as no merge
crosses it.

Text is first cut into pieces by the vocabulary's pattern; merges never cross a piece. Pieces are
found in slices of about 64 K characters that end between two words. Pieces that were met before
come from a bounded memo.

**Decoding** feeds the bytes of the ids, a slice at a time, to a UTF-8 state machine that holds back
an incomplete character; bytes that are no character give U+FFFD.

Defined results: NULL text counts as empty; empty text has no ids, and the digest of no ids is that
of the empty string; a special token's text in a document gives the special id; further columns and
repeated rows pass through.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import math
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from panelloom.llm import common as C

# The pattern that cuts text into pieces, and the next safe cut between two words.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
BETWEEN_WORDS = regex.compile(r"(?<=\p{L}) (?=\p{L})")

#: Characters in one slice, bytes that are merged at once beyond the lookahead, memo entries.
SLICE = 1 << 16
STEP = 2048
MEMO = 400_000
#: Pieces of at most so many characters go through the memo; those of at most WHOLE bytes merge at once.
SHORT = 64
WHOLE = 64
#: Ranks behind all rules.
_NEVER = (math.inf, -1)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable characters of
    Latin-1 for themselves, the others for code points from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def lookahead(rules: list[tuple[int, int, int]], size: Callable[[int], int]) -> int:
    """The bytes to the right of a place that can decide whether a merge crosses it.

    ``rules`` are (left, right, result) in rank order; ``size`` gives a token's bytes.
    """
    made = {w: (k, v) for k, (_, v, w) in enumerate(rules)}
    ranks: dict[int, list[int]] = {}
    reach: dict[int, list[int]] = {}
    most = 0
    for k, (u, v, _) in enumerate(rules):
        token, before, beyond = v, k, 0
        while True:
            if token in ranks and (i := bisect_left(ranks[token], before)):
                beyond = max(beyond, reach[token][i - 1])
            if token not in made:
                break
            before, token = made[token]
        own = size(v) + beyond
        most = max(most, own)
        ranks.setdefault(u, []).append(k)
        reach.setdefault(u, []).append(max(own, reach[u][-1] if reach.get(u) else 0))
    return most


class Vocabulary:
    """A byte-level BPE vocabulary in the JSON format of public tokenizers."""

    def __init__(self, source: bytes):
        data = json.loads(source)
        ids, letters = data["model"]["vocab"], byte_letters()
        self.special = {t["content"]: t["id"] for t in data["added_tokens"]}
        names = ids | self.special
        self.bytes = [b""] * (max(names.values()) + 1)
        for name, i in ids.items():
            self.bytes[i] = bytes(letters[c] for c in name)
        for name, i in self.special.items():
            self.bytes[i] = name.encode()
        self.text = [str(i) for i in range(len(self.bytes))]
        self.first = [0] * 256
        for letter, b in letters.items():
            self.first[b] = ids[letter]
        rules = []
        for merge in data["model"]["merges"]:
            a, b = merge if isinstance(merge, list) else merge.split(" ")
            rules.append((ids[a], ids[b], ids[a + b]))
        self.rules = {(u, v): (k, w) for k, (u, v, w) in enumerate(rules)}
        self.lookahead = lookahead(rules, lambda i: len(self.bytes[i]))
        self.cut = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.memo = _Memo(self)

    def merged_short(self, piece: bytes) -> list[int]:
        """As ``merged``, with the rules of all pairs in a list whose least is sought for each merge: faster
        for a short piece. A merge changes the rules of its two neighbours only."""
        ids, rule = [self.first[b] for b in piece], self.rules.get
        found = [rule(pair, _NEVER) for pair in zip(ids, ids[1:])]
        while found and (least := min(found)) is not _NEVER:
            k = found.index(least)
            ids[k : k + 2] = [least[1]]
            del found[k]
            if k:
                found[k - 1] = rule((ids[k - 1], ids[k]), _NEVER)
            if k < len(found):
                found[k] = rule((ids[k], ids[k + 1]), _NEVER)
        return ids

    def merged(self, piece: bytes) -> list[int]:
        """The ids of some bytes, least rank first, leftmost first among equals."""
        ids: list[int | None] = [self.first[b] for b in piece]
        n, rules = len(ids), self.rules
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*rules[pair], i, pair) for i in range(n - 1) if (pair := (ids[i], ids[i + 1])) in rules]
        heap = [(rank, i, pair, w) for rank, w, i, pair in heap]
        heapq.heapify(heap)
        while heap:
            _, i, pair, w = heapq.heappop(heap)
            j = after[i]
            if j >= n or ids[i] != pair[0] or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = w, None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (right := (w, ids[after[i]])) in rules:
                    rank, made = rules[right]
                    heapq.heappush(heap, (rank, i, right, made))
            if before[i] >= 0 and (left := (ids[before[i]], w)) in rules:
                rank, made = rules[left]
                heapq.heappush(heap, (rank, before[i], left, made))
        return [i for i in ids if i is not None]

    def stream(self, parts: Iterable[bytes]) -> Iterator[list[int]]:
        """Ids of one piece that comes in parts, each token as soon as it is stable."""
        held = b""
        for part in parts:
            for k in range(0, len(part), STEP):
                held += part[k : k + STEP]
                if len(held) < self.lookahead + STEP:
                    continue
                end, out = 0, []
                for i in self.merged(held):
                    if end + len(self.bytes[i]) > len(held) - self.lookahead:
                        break
                    end += len(self.bytes[i])
                    out.append(i)
                held = held[end:]
                yield out
        yield self.merged(held)

    def encode(self, text: str) -> Iterator[Iterable[int]]:
        """The ids of a text, a slice at a time."""
        parts = self.cut.split(text) if self.cut and any(s in text for s in self.special) else [text]
        for k, part in enumerate(parts):
            if k % 2:
                yield [self.special[part]]
                continue
            begin = 0
            while begin < len(part):
                end = len(part)
                if end - begin > SLICE and (cut := BETWEEN_WORDS.search(part, begin + SLICE)):
                    end = cut.start()
                yield from self._slice(PIECES.findall(part, begin, end))
                begin = end

    def _slice(self, pieces: list[str]) -> Iterator[Iterable[int]]:
        if max(map(len, pieces)) <= SHORT:
            yield chain.from_iterable(map(self.memo.__getitem__, pieces))
            return
        for piece in pieces:
            yield from [self.memo[piece]] if len(piece) <= SHORT else self.stream([piece.encode()])

    def decode(self, slices: Iterable[Iterable[int]]) -> Iterator[str]:
        """The text of some ids, a slice at a time; an incomplete character waits for its rest."""
        state, table = codecs.getincrementaldecoder("utf-8")("replace"), self.bytes
        for ids in slices:
            yield state.decode(b"".join(map(table.__getitem__, ids)))
        yield state.decode(b"", final=True)


class _Memo(dict):
    """Ids of short pieces; emptied when it is full."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= MEMO:
            self.clear()
        data = piece.encode()
        words = self.vocabulary
        ids = self[piece] = tuple(words.merged_short(data) if len(data) <= WHOLE else chain.from_iterable(words.stream([data])))
        return ids


_LOADED: dict[int, Vocabulary] = {}


def _shared(docs: DataFrame, path: str | None) -> Callable[[], Vocabulary]:
    """Reads the vocabulary file on the driver (a few MB) and hands it to the tasks; each worker
    process builds it once."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, "rb") as file:
        source = file.read()
    handle, key = docs.sparkSession.sparkContext.broadcast(source), hash(source)

    def get() -> Vocabulary:
        if key not in _LOADED:
            _LOADED[key] = Vocabulary(handle.value)
        return _LOADED[key]

    return get


def _texts(column: pa.Array) -> Iterator[str]:
    for value in column:
        yield value.as_py() or ""


def encode(docs: DataFrame, text: str = "text", ids: str = "token_ids", vocabulary: str | None = None) -> DataFrame:
    """``docs`` with the ids of each text in a further column (array<int>)."""
    get, columns = _shared(docs, vocabulary), docs.columns

    def run(batches):
        for batch in batches:
            column = batch.column(columns.index(text))
            _, offsets = C.text_bytes(column)
            for i, j in C.row_slices(offsets):
                coded = [np.fromiter(chain.from_iterable(get().encode(t)), np.int32) for t in _texts(column[i:j])]
                lists = C.list_array(pa.array(np.concatenate(coded)), np.array([len(c) for c in coded]))
                yield pa.RecordBatch.from_arrays([*[c[i:j] for c in batch.columns], lists], [*columns, ids])

    return C.with_workers(docs).mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))]))


def decode(tokens: DataFrame, ids: str = "token_ids", text: str = "decoded", vocabulary: str | None = None) -> DataFrame:
    """``tokens`` with the text of each list of ids in a further column (NULL: empty)."""
    get, columns = _shared(tokens, vocabulary), tokens.columns

    def run(batches):
        for batch in batches:
            out = ["".join(get().decode([value.as_py() or []])) for value in batch.column(columns.index(ids))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.string())], [*columns, text])

    return C.with_workers(tokens).mapInArrow(run, T.StructType([*tokens.schema.fields, T.StructField(text, T.StringType())]))


ROUND_TRIP = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them. Ids stream from
    the encoder through both digests a slice at a time."""
    get = _shared(docs, vocabulary)

    def digests(text: str, words: Vocabulary) -> tuple[int, str, str]:
        count, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()

        def passed() -> Iterator[list[int]]:
            nonlocal count
            for ids in words.encode(text):
                if ids := list(ids):
                    of_ids.update((("," if count else "") + ",".join(map(words.text.__getitem__, ids))).encode())
                    count += len(ids)
                    yield ids

        for part in words.decode(passed()):
            of_text.update(part.encode())
        return count, of_ids.hexdigest(), of_text.hexdigest()

    def run(batches):
        for batch in batches:
            rows = [digests(t, get()) for t in _texts(batch.column(1))]
            counts, ids, texts = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())], ROUND_TRIP.names)

    return C.with_workers(docs).selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text").mapInArrow(run, ROUND_TRIP)
