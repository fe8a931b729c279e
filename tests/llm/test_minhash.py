"""DartMinHash: agreement equals weighted similarity; groups equal those of brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from panelloom.llm import minhash


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_groups(rows):
    """Least doc_id reachable over pairs of similarity 0.8 or more, by comparing all pairs that share a run."""
    sets = {d: frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if (w := words(t)) else frozenset() for d, t in rows}
    holders, parent = {}, {d: d for d in sets}
    for d, s in sets.items():
        for run in s:
            holders.setdefault(run, []).append(d)

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for d, s in sets.items():
        for e, both in Counter(e for run in s for e in holders[run] if e < d).items():
            if both >= 0.8 * (len(s) + len(sets[e]) - both):
                a, b = root(d), root(e)
                parent[max(a, b)] = min(a, b)
    return {d: root(d) for d in sets}


def test_agreement_estimates_weighted_similarity():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 500).astype(np.uint64)
    errors = []
    for _ in range(20):
        part = rng.permutation(pool)[:90]
        a, b = part[:60], part[20:]
        wa, wb = rng.uniform(0.2, 4, 60), rng.uniform(0.2, 4, 70)
        s = minhash.dart_signatures(np.r_[a, b], np.r_[wa, wb], np.array([0, 60, 130]), 256)
        x, y = dict(zip(a.tolist(), wa)), dict(zip(b.tolist(), wb))
        keys = set(x) | set(y)
        exact = sum(min(x.get(k, 0), y.get(k, 0)) for k in keys) / sum(max(x.get(k, 0), y.get(k, 0)) for k in keys)
        errors.append((s[0] == s[1]).mean() - exact)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_short_and_long_sets_fill_all_coordinates():
    s = minhash.dart_signatures(np.arange(1, 5002, dtype=np.uint64), np.ones(5001), np.array([0, 1, 5001]), 168)
    assert (s != np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_groups_match_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = brute_groups([(r.doc_id, r.text) for r in docs.collect()])
    got = {r.doc_id: r.group_id for r in minhash.near_groups(docs).collect()}
    assert got == want
    kept = minhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {d for d, g in want.items() if d == g}


def test_large_group_of_near_copies_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(minhash, "SMALL", 4)
    base = [f"w{k}" for k in range(120)]
    rows = [(k, " ".join(w if i != k % 100 else f"x{k}" for i, w in enumerate(base))) for k in range(60)]
    rows += [(1000, None), (1001, ""), (1002, "..."), (1003, "one two"), (1004, "One, two"), (1005, "other two"), (7, rows[7][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS band", "2 AS group_id", "3 AS kept")
    out = minhash.near_groups(docs).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r.group_id for r in out}
    assert got == brute_groups(rows)
    kept = [r.doc_id for r in minhash.drop_near_copies(docs).collect()]
    assert sorted(kept) == [0, 1000, 1001, 1002, 1003, 1005]


def test_copies_of_a_large_group_that_differ_from_its_leaders(spark):
    rnd = random.Random(7)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(700):
        copy = list(base)
        for at in rnd.sample(range(200), rnd.randint(2, 7)):
            copy[at] = f"x{k}a{at}"
        rows.append((k, " ".join(copy)))
    # Copies of one edited text, far from the others, whose bands the common words still share.
    other = [w if i % 17 else f"y{i}" for i, w in enumerate(base)]
    rows += [(1000 + k, " ".join(w if i != 3 * k else f"z{k}" for i, w in enumerate(other))) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.group_id for r in minhash.near_groups(docs).collect()} == brute_groups(rows)


@pytest.mark.parametrize("same", [True, False])
def test_block_pairs_match_brute_force(same):
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, rng.integers(1, 50))) for _ in range(80)]
    side = np.zeros(80, np.int64) if same else np.arange(80) % 2
    offsets = np.r_[0, np.cumsum([len(s) for s in sets])]
    a, b = minhash.similar_pairs(np.concatenate(sets), offsets, side, same, 0.4, columns=7)
    want = set()
    for i in range(80):
        for j in range(80):
            both = len(np.intersect1d(sets[i], sets[j]))
            if (i < j if same else side[i] < side[j]) and both >= 0.4 * (len(sets[i]) + len(sets[j]) - both):
                want.add((i, j))
    assert set(zip(a.tolist(), b.tolist())) == want


@pytest.mark.parametrize("rows", [[], [(None, "a b c d e f"), (None, None)]])
def test_empty_and_unnamed(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert minhash.near_groups(docs).count() == len(rows)
    assert minhash.drop_near_copies(docs).count() == len(rows)


def test_each_text_of_a_document_keeps_its_links(spark):
    w, u = ([f"{c}{k}" for k in range(60)] for c in "wu")
    rows = [(1, " ".join(w)), (1, " ".join(u)), (5, " ".join([*u, "x"])), (6, " ".join([*w, "y"])), (6, " ".join(f"v{k}" for k in range(60))), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS mark", "2 AS node")
    out = sorted((r.doc_id, r.group_id) for r in minhash.near_groups(docs).collect())
    assert out == [(1, 1), (1, 1), (1, 1), (5, 1), (6, 1), (6, 6)]
    kept = {(r.doc_id, r.text) for r in minhash.drop_near_copies(docs).collect()}
    assert kept == {rows[0], rows[1], rows[4], rows[5]}
    # The lesser document is linked through a text that another number stands for.
    rows = [(3, "zz " + " ".join(w)), (4, " ".join(u)), (4, " ".join(w))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.group_id) for r in minhash.near_groups(docs).collect()) == [(3, 3), (4, 3), (4, 4)]
