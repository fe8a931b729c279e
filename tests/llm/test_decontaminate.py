"""Winnowing: hits and items equal those of brute force, whatever the blocks."""

import hashlib
import random
import re

import pytest

from panelloom.llm import decontaminate


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, span):
    windows = {}
    for i, t in items:
        if w := words(t):
            n = min(span, len(w))
            for k in range(len(w) - n + 1):
                windows.setdefault(tuple(w[k : k + n]), set()).add(i)
    out = []
    for d, t in docs:
        w, hit, held = words(t), set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (run := tuple(w[k : k + n])) in windows:
                    hit |= set(range(k, k + n))
                    held |= windows[run]
        out.append((str(d), len(w), len(hit), sorted(str(i) for i in held if i is not None)))
    return sorted(out)


@pytest.mark.parametrize("block", [16 << 20, 120])
def test_random_texts_and_odd_rows(spark, block):
    rnd = random.Random(1)

    def text(n):
        return " ".join(rnd.choice(["a", "B", "é", "ab", "x-y"]) for _ in range(n))

    items = [(k, text(rnd.choice([0, 1, 3, 9, 10, 11, 30]))) for k in range(30)] + [(None, text(4)), (3, text(12)), (99, None)]
    docs = [(k, text(rnd.choice([0, 1, 5, 12, 60]))) for k in range(60)] + [(60, None), (61, ""), (62, items[6][1]), (62, items[6][1]), (None, items[7][1])]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS leaks_", "2 AS n_words")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.find_leaks(frame, bench, span=5, gram=2, block_bytes=block)
    assert out.columns == [*frame.columns, "leaks"]
    got = sorted((str(r.doc_id), r.leaks.n_words, sum(b - a for a, b in zip(r.leaks.hit_from, r.leaks.hit_to)), sorted(map(str, r.leaks["items"]))) for r in out.collect())
    assert got == brute(docs, items, 5)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()], 10)
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.leak_report(docs, bench).collect())
    assert got == [(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in want]
    clean = decontaminate.drop_leaking(docs, bench)
    assert clean.columns == docs.columns
    assert {str(r.doc_id) for r in clean.collect()} == {d for d, _, h, _ in want if not h}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontaminate.leak_report(docs, none).collect()] == [0]
    assert decontaminate.leak_report(docs.limit(0), none).collect() == []
