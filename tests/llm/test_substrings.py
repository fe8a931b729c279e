"""Super-k-mer buckets: removed words equal those of brute force, hot minimisers included."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from panelloom.llm import substrings


def brute(rows, window):
    texts = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    count = Counter(tuple(w[i : i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts):
        gone = {j for i in range(len(w) - window + 1) if count[tuple(w[i : i + window])] > 1 for j in range(i, i + window)}
        out.append((str(d), len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out)


def found(df, **options):
    return sorted((str(r.doc_id), r.kept.n_words, r.kept.n_removed, r.kept.text) for r in substrings.cut_repeats(df, **options).collect())


@pytest.mark.parametrize("hot", [2048, 2])
@pytest.mark.parametrize("window, gram", [(6, 3), (5, 2)])
def test_random_texts_and_odd_rows(spark, hot, window, gram):
    rnd = random.Random(3)
    base = [" ".join(rnd.choice(["a", "b", "cé", "dd"]) for _ in range(40)) for _ in range(6)]

    def text():
        mixed = rnd.choice(base)[:40] + "  \n" + rnd.choice(base)[10:60]
        return rnd.choice(["", "x", "a b", rnd.choice(base), mixed, " ".join(rnd.choice("abcdefghijkl") for _ in range(rnd.randint(0, 80))), "p q r " * 20])

    rows = [(k, text()) for k in range(80)] + [(None, "a b c d e f g h i j"), (None, "z y x w v u t s"), (7, None)]
    rows += [(500, "one two three four five six seven eight"), (500, "one two three four five six seven eight"), (501, "s " * 3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS rid", "2 AS spans")
    assert found(df, window=window, gram=gram, hot=hot) == brute(rows, window)


@pytest.mark.parametrize("hot", [2048, 3])
def test_documents(spark, hot):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    assert found(docs, hot=hot) == brute([tuple(r) for r in docs.collect()], 35)


def test_different_windows_of_one_hash_are_told_apart(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(substrings.C, "window_hashes", lambda words, width: np.zeros(max(0, len(words) - width + 1), np.uint64))
    unit, first, last = substrings.repeated_windows(pa.array(["a b c", "a b d", "a b c"]), 3)
    assert (unit.tolist(), first.tolist(), last.tolist()) == ([0, 2], [0, 0], [0, 0])


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert substrings.repeat_report(docs).collect() == []


@pytest.mark.parametrize("hot", [substrings.HOT, 1])
def test_texts_of_one_doc_id_are_judged_apart(spark, hot):
    w, u = (" ".join(f"{c}{k}" for k in range(60)) for c in "wu")
    docs = spark.createDataFrame([(1, w), (2, w), (1, u), (None, u + " x"), (None, w)], "doc_id long, text string")
    got = sorted((str(r.doc_id), r.text, r.kept.n_removed) for r in substrings.cut_repeats(docs, hot=hot).collect())
    # u is also the first sixty words of another row; w stands in three.
    assert got == sorted([("1", w, 60), ("2", w, 60), ("1", u, 60), ("None", u + " x", 60), ("None", w, 60)])
    alone = spark.createDataFrame([(1, w), (2, w), (1, u)], "doc_id long, text string")
    assert sorted((r.text[0], r.kept.n_removed) for r in substrings.cut_repeats(alone, hot=hot).collect()) == [("u", 0), ("w", 60), ("w", 60)]
