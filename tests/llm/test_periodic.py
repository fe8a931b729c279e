"""Periodic runs equal those of brute force over all lags."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pyarrow as pa
import pytest

from panelloom.llm import common as C
from panelloom.llm import periodic

SPACES = r"[\x20\x09-\x0D]+"


def brute(words):
    """(start, length, period) of all runs: each lag's stretches of matches; the least lag of a span."""
    n, least = len(words), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            begin = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i > begin and i + q - begin >= max(24, 3 * q):
                least.setdefault((begin, i + q), q)
            i += i == begin
    return sorted(((b, e - b, q) for (b, e), q in least.items()), key=lambda r: (r[0], r[2]))


def kept(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def examine(texts):
    raw, offsets = C.text_bytes(pa.array(texts, pa.string()))
    found = periodic._examine(raw, offsets).to_pylist()
    return [([(r["start"], r["length"], r["period"]) for r in x["runs"]], x["collapsed"]) for x in found]


def repeated(rnd, n, letters):
    words = [rnd.choice(letters) for _ in range(n)]
    for _ in range(rnd.choice([0, 1, 3])):
        if n > 30:
            p, a = rnd.randint(1, n // 3), rnd.randrange(n)
            for i in range(a, a + rnd.randint(0, n - a)):
                words[i] = words[a + (i - a) % p]
    return words


@pytest.mark.parametrize("letters", ["a", "ab", "abc", [f"w{k}" for k in range(40)]])
def test_random_texts(letters):
    rnd = random.Random(len(letters))
    texts = [repeated(rnd, rnd.choice([0, 1, 23, 24, 25, 50, 200, 400]), letters) for _ in range(120)]
    for words, got in zip(texts, examine([" ".join(w) for w in texts])):
        runs = brute(words)
        assert got == (runs, kept(words, runs))


def test_grams_that_recur_within_a_period():
    """Blocks in an order in which every pair of neighbours occurs twice: no gram's next occurrence
    is one period on, and still the run is found. Then near misses at the least length and power."""
    rnd = random.Random(5)
    block = {c: [f"{c}{rnd.randrange(5)}" for _ in range(40)] for c in "AB"}
    unit = [w for c in "AAABABBB" for w in block[c]]
    cases = [unit * 3, unit * 2 + unit[:-1], ["x", *unit * 4, "y"], list("ab") * 12, list("ab") * 11 + ["a"], list("abcdefgh") * 3, list("abcdefghi") * 3, list("abcdefghi") * 2 + list("abcdefgh")]
    for words, got in zip(cases, examine([" ".join(w) for w in cases])):
        assert got[0] == brute(words)
    assert (0, 960, 320) in examine([" ".join(unit * 3)])[0][0]


def test_very_long_texts():
    assert examine(["a " * 200_000])[0] == ([(0, 200_000, 1)], "a")
    rnd = random.Random(1)
    unit = [str(rnd.randrange(9)) for _ in range(70_000)]
    runs, text = examine([" ".join(["#", *unit * 3])])[0]
    assert (1, 210_000, 70_000) in runs and len(text.split()) <= 70_001


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[a + (i - a) % p] if i >= a else w for i, w in enumerate(words)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def report_of(doc_id, text):
    words = planted(doc_id, [w for w in re.split(SPACES, text or "") if w])
    runs = brute(words)
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
    milli = 1000 * best[1] // best[2] if runs else None
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    return (doc_id, len(runs), *best, milli, sha(lines), sha(kept(words, runs)))


def test_documents_and_odd_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    odd = [(-1, None), (-2, ""), (-3, " \t\n"), (-4, "x  y z " * 30), (-5, "é b\x0bc\x1cd " * 40), (None, "a b " * 20), (-6, "same " * 30), (-6, "same " * 30), (-6, "other")]
    # Ids whose hash asks for a repetition, on NULL, wordless and short texts.
    chosen = [i for i in range(10**6, 10**6 + 200) if zlib.crc32(str(i).encode()) % 10 == 0][:5]
    odd += list(zip(chosen, [None, "", " ", "one", "a b c d e f g h i j k l m n o p q r s t u v w x y z"]))
    docs = docs.union(spark.createDataFrame(odd, "doc_id long, text string"))
    out = periodic.periodic_report(periodic.with_planted_runs(docs))
    assert out.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [report_of(r.doc_id, r.text) for r in docs.collect()]
    assert sum(1 for r in want if r[1]) > 20
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)


def test_clashing_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a " * 30, 5)], "doc_id long, text string, seen int").selectExpr("*", "2 AS Periodic")
    out = periodic.find_runs(docs)
    assert out.columns == [*docs.columns, "periodic_"]
    row = out.first()
    assert (row.Periodic, row.seen, row.periodic_.n_words, row.periodic_.collapsed) == (2, 5, 30, "a")
    assert periodic.find_runs(docs.limit(0)).collect() == [] == periodic.periodic_report(docs.limit(0)).collect()
