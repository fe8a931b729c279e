"""Ranked search equals brute force, whatever the blocks."""

import math
import random
import re
from collections import Counter

import pytest

from panelloom.llm import search


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(docs, items, top=50):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in df}
    wanted = {}
    for i, t in items:
        if i is not None:
            wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, own in wanted.items():
        scored = []
        for d, b in bags:
            m = 100 - 50 + 50 * sum(b.values()) * n_docs // total
            score = sum(weight[t] * (10**9 * b[t] // (1000 * b[t] + 20 * m)) for t in own if t in b)
            if score > 0:
                scored.append((-score, d is None, d))
        out += [(i, k + 1, d, -s) for k, (s, _, d) in enumerate(sorted(scored, key=lambda r: (r[0], r[1], r[2] or 0))[:top])]
    return sorted(out, key=repr)


def found(out):
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(map(tuple, out.collect()), key=repr)


@pytest.mark.parametrize("block", [1 << 20, 40])
@pytest.mark.parametrize("top", [3, 50])
def test_random_texts_and_odd_rows(spark, block, top):
    rnd = random.Random(2)
    letters = ["a", "A", "é", "É", "ab", "b1", "x-y", "_", "aa", "ß.q"]

    def text(n):
        return rnd.choice(" \t,@")[0].join(rnd.choice(letters) for _ in range(n))

    docs = [(k % 90, text(rnd.choice([0, 1, 2, 10, 80]))) for k in range(120)] + [(None, "a ab"), (None, "b1"), (200, None), (201, ""), (202, ". ,"), (203, "a" * 3000 + " a")]
    items = [(k, text(rnd.choice([1, 2, 9]))) for k in range(12)] + [(3, "aa q"), (3, "aa q"), (None, "a"), (50, None), (51, "nowhere"), (52, "-")]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS score", "2 AS item_id").repartition(5)
    bench = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id")
    assert found(search.search(frame, bench, top=top, block_bytes=block)) == brute(docs, items, top)


def test_few_cells_at_once(spark, monkeypatch):
    monkeypatch.setattr(search, "CELLS", 7)
    docs = [(k, "p q " * (k % 5) + "r") for k in range(60)]
    items = [(1, "p"), (2, "q r"), (3, "r p")]
    got = search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), top=9)
    assert found(got) == brute(docs, items, 9)


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    want = brute([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in bench.collect()])
    assert found(search.search_report(docs, bench)) == want and len(want) == 2000


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert found(search.search_report(docs, items.limit(0))) == []
    assert found(search.search_report(docs.limit(0), items)) == []
    assert found(search.search_report(docs.selectExpr("doc_id", "CAST(NULL AS STRING) AS text"), items)) == []


def test_documents_never_shuffle(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    block = search.Terms([b"a"], search.np.array([1]), search.np.array([0, 1]), search.np.array([0]), search.np.array([5]))
    plan = search._score(docs, spark.sparkContext.broadcast(block), 1, 3, 50)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
