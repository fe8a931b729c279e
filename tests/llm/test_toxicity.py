"""Toxicity: features, the learner against a plain reading of FTRL, held-out accuracy, odd rows."""

import math
import zlib

import numpy as np
import pytest

from panelloom.llm import toxicity


def report(docs, labels):
    out = toxicity.toxicity_report(docs, labels)
    assert out.columns == ["doc_id", "held_out", "score", "predicted"]
    return out


def hashes(*texts):
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    return toxicity._words(raw, np.r_[0, np.cumsum([len(t.encode()) for t in texts])])


def test_features_are_words_pairs_triples_and_skips_within_a_row():
    words, first = hashes("a b c d", "b c")
    kinds = [(len(codes), row.tolist()) for codes, row in toxicity.features(words, first)]
    assert kinds == [(6, [0, 0, 0, 0, 1, 1]), (4, [0, 0, 0, 1]), (2, [0, 0]), (1, [0]), (2, [0, 0])]
    (one, _), (pair, _), *_ = toxicity.features(words, first)
    assert one[1] == one[4] and pair[1] == pair[3] and len(set(one.tolist())) == 4
    upper, _ = hashes("A-B, C d", "b\nC")
    assert upper.tolist() == words.tolist()


def plain_ftrl(texts, truth):
    z, n = {}, {}

    def w(i):
        strength = 0 if i == "bias" else toxicity.L1
        if abs(z.get(i, 0.0)) <= strength:
            return 0.0
        rate = (toxicity.BETA + math.sqrt(n.get(i, 0.0))) / toxicity.ALPHA + toxicity.L2
        return (math.copysign(strength, z[i]) - z[i]) / rate

    for _ in range(toxicity.EPOCHS):
        for features, y in zip(texts, truth):
            now = {i: w(i) for i in [*features, "bias"]}
            slope = 1 / (1 + math.exp(-sum(now.values()))) - y
            for i, own in now.items():
                before = n.get(i, 0.0)
                n[i] = before + slope * slope
                z[i] = z.get(i, 0.0) + slope - (math.sqrt(n[i]) - math.sqrt(before)) / toxicity.ALPHA * own
    return {i: w(i) for i in z if w(i)}


def test_weights_equal_a_plain_reading_of_ftrl():
    rnd = np.random.default_rng(1)
    truth = (rnd.random(150) < 0.3).astype(int)
    texts = [" ".join([*rnd.choice(list("abcdefg"), 12), *(["bad"] if y else [])]) for y in truth]
    words = [hashes(t)[0] for t in texts]
    features = [toxicity._features_of(w) for w in words]
    number = {}
    for f in features:
        for i in f.tolist():
            number[i] = number.get(i, 0) + 1
    want = plain_ftrl([[i for i in f.tolist() if number[i] >= toxicity.MIN_DOCS] for f in features], truth)
    model = toxicity.fit(words, truth)
    assert model.bias == pytest.approx(want.pop("bias"))
    assert dict(zip(model.codes.tolist(), model.weights)) == pytest.approx(want)
    assert model.codes.tolist() == sorted(want)


def test_scores_are_those_of_the_model(spark):
    model = toxicity.Model(*[np.array(x) for x in zip(*sorted(zip(toxicity._features_of(hashes("you bad one")[0]).tolist(), [1.0, -2.0, 3.0, 0.5, 1.5, 2.5, -1.0])))], -1.0)
    model = toxicity.Model(model.codes.astype(np.uint32), model.weights, -1.0)
    docs = spark.createDataFrame([(1, "You BAD one"), (2, "you bad one you bad one"), (3, None), (4, ""), (5, "one " * 3)], "doc_id long, text string").selectExpr("*", "9 AS seen", "8 AS score")
    assert toxicity.predict(docs.withColumnRenamed("seen", "toxicity"), model).columns[-1] == "toxicity_"
    out = toxicity.predict(docs, model)
    assert out.columns == [*docs.columns, "toxicity"]
    for r in out.collect():
        codes = set(toxicity._features_of(hashes(r.text or "")[0]).tolist())
        total = -1.0 + sum(w for c, w in zip(model.codes.tolist(), model.weights) if c in codes)
        assert r.toxicity == pytest.approx(1 / (1 + math.exp(-total)))


def test_held_out_rows_are_recognised(spark):
    """Texts of neutral words; toxic ones hold a marker word, a marker pair, or a pair with a gap."""
    rnd = np.random.default_rng(3)
    marks = [["vile"], ["go", "away"], ["not", "so", "nice"]]
    docs, labels = [], []
    for k in range(3000):
        toxic, text = int(rnd.random() < 0.2), rnd.choice(["go", "away", "not", "nice", *"abcdefghij"], 30).tolist()
        text = [w for a, w in enumerate(text) if a < 1 or (text[a - 1], w) != ("go", "away")]
        for mark in [marks[rnd.integers(3)]] * (3 * toxic):
            at = rnd.integers(len(text))
            text[at:at] = mark if len(mark) < 3 else ["not", str(rnd.integers(10**6)), "nice"]
        docs.append((k, " ".join(text)))
        labels.append((k, toxic))
    out = report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")).collect()
    held = [r for r in out if r.held_out]
    assert {r.doc_id for r in held} == {k for k in range(3000) if zlib.crc32(str(k).encode()) % 5 == 0}
    truth = dict(labels)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.93
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_labels_of_held_out_rows_are_not_read(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.remainder("doc_id") == 0, 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    got = sorted(map(tuple, report(docs, labels).collect()))
    assert got == sorted(map(tuple, report(docs.withColumn("lang", toxicity.F.lit("x")).repartition(5), flipped).collect()))
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    clean = [r for r in got if truth.get(r[0]) == 0]
    assert sum(r[3] for r in clean) <= 0.01 * len(clean)
    taught = [r for r in got if truth.get(r[0]) == 1 and not r[1]]
    assert sum(r[3] for r in taught) > 0.6 * len(taught)


def test_odd_and_empty_tables(spark):
    rows = [(None, None), (1, None), (2, ""), (3, "word"), (3, "word"), (3, "another"), (None, "word")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS sample_id", "2 AS label", "3 AS toxicity")
    labels = spark.createDataFrame([(None, 1), (1, None), (2, 0), (3, 1), (3, 0), (77, 1)], "doc_id long, toxic int")
    assert report(docs, labels).count() == len(rows)
    assert {(r.score, r.predicted) for r in report(docs, labels.limit(0)).collect()} == {(0.0, 0)}
    assert report(docs.limit(0), labels).collect() == []
    kept = toxicity.drop_toxic(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_a_small_sample_of_a_rare_label(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('t', id % 50, IF(id % 10 = 0, ' vile', '')) AS text")
    labels = spark.range(4000).selectExpr("id AS doc_id", "CAST(id % 10 = 0 AS INT) AS toxic")
    model = toxicity.train(docs, labels, sample_rows=300)
    out = toxicity.predict(docs, model, carry=["doc_id"]).collect()
    assert np.mean([(r.toxicity >= 0.5) == (r.doc_id % 10 == 0) for r in out]) > 0.99
