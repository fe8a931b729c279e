"""Language identification: held-out accuracy, contract of odd rows, calibration."""

import numpy as np

from panelloom.llm import langid

DATA = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_accuracy_and_remainder(spark):
    docs = spark.read.parquet(DATA)
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = langid.predictions(docs).collect()
    assert len(rows) == len(lang)
    held = [r for r in rows if r.held_out]
    assert 0.15 < len(held) / len(rows) < 0.35
    assert np.mean([lang[r.doc_id] == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.rejected for r in rows) <= 0.01 * len(rows)


def test_prediction_ignores_everything_but_text(spark):
    docs = spark.read.parquet(DATA).limit(200)
    model = langid.train(spark.read.parquet(DATA))
    one = {r.doc_id: r.language for r in langid.predict(docs, model).collect()}
    other = docs.selectExpr("doc_id", "text", "'xx' AS lang", "'same' AS source", "1 AS language_")
    for r in langid.predict(other, model).collect():
        assert r.language == one[r.doc_id]


def test_odd_rows(spark):
    kind = "doc_id long, text string, lang string, language string"
    good = [(k, "the of and this that with " * 5, "en", "a") for k in range(40)] + [(100 + k, "der die das und nicht ein " * 5, "de", "a") for k in range(40)]
    odd = [(900, None, "en", "x"), (901, "", "en", "x"), (902, "123 !?", "en", "x"), (903, "a", None, "x"), (None, "the of and", "en", "x"), (904, "١٢", "de", "x"), (5, good[5][1], "en", "a"), (905, "the " * 200_000, None, "x")]
    docs = spark.createDataFrame(good + odd, kind)
    out = {}
    for r in langid.predictions(docs).collect():
        out.setdefault(r.doc_id, []).append(r)
    for k in (900, 901, 902, 904):
        assert (out[k][0].lang_pred, out[k][0].score) == ("und", 0.0)
    assert out[905][0].lang_pred == "en" and out[903][0].lang_pred in ("en", "de")
    assert len(out[5]) == 2 and out[5][0] == out[5][1]
    assert out[None][0].held_out is False
    kept = langid.drop_rejected(docs)
    assert kept.columns == docs.columns and kept.where("doc_id = 900").count() == 0


def test_nothing_to_learn(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.predictions(empty).collect() == []
    unlabelled = spark.createDataFrame([(1, "abc", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in langid.predictions(unlabelled).collect()] == [("und", 0.0)]
