"""Splits, imputation, scaling, classifier."""

import numpy as np
import pandas as pd
import pytest

from panelloom.operators import model as J


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(5)
    n = 2000
    x, label = rng.normal(size=n), rng.integers(0, 2, n)
    pdf = pd.DataFrame({"id": range(n), "label": label, "x": x + 2 * label, "z": rng.normal(size=n)})
    pdf["group"] = np.where(label == 1, rng.choice(["a", "b"], n), rng.choice(["b", "c"], n))
    pdf.loc[pdf.id % 10 == 0, "x"] = np.nan
    df = spark.createDataFrame(pdf)
    from pyspark.sql import functions as F

    return df.withColumn("x", F.nanvl("x", F.lit(None).cast("double")))


def test_split_is_stable_and_stratified(data):
    a = J.stratified_split(data, "id", "label").select("id", "label", "is_train").toPandas()
    b = J.stratified_split(data.repartition(3), "id", "label").select("id", "label", "is_train").toPandas()
    assert a.sort_values("id").is_train.tolist() == b.sort_values("id").is_train.tolist()
    assert all(abs(share - 0.8) < 0.05 for share in a.groupby("label").is_train.mean())
    folds = J.stratified_folds(data, "id", "label").toPandas()
    assert sorted(folds.fold.unique()) == [0, 1, 2, 3, 4]


def test_imputation_uses_training_values(spark):
    train = spark.createDataFrame([(1.0, "b"), (2.0, "a"), (9.0, "a"), (None, "b"), (4.0, None)], "x double, s string")
    values = J.fit_imputation(train, numeric=["x"], nominal=["s"])
    assert values == {"x": 3.0, "s": "a"}
    filled = J.impute(spark.createDataFrame([(None, None)], "x double, s string"), values).first()
    assert tuple(filled) == (3.0, "a")


def test_constant_columns_are_only_centred(spark):
    df = spark.createDataFrame([(5.0, 1.0), (5.0, 3.0)], "c double, v double")
    out = J.standardise(df, J.fit_scaling(df, ["c", "v"])).collect()
    assert [r.c for r in out] == [0.0, 0.0]
    assert [round(r.v, 6) for r in out] == [-0.707107, 0.707107]


def test_classifier_separates_and_auc_is_exact(data):
    rows = J.stratified_split(data, "id", "label")
    values = J.fit_imputation(rows.filter("is_train"), numeric=["x", "z"], nominal=["group"])
    filled = J.impute(rows, values)
    model = J.purchase_classifier(["x", "z"], ["group"], "label").fit(filled.filter("is_train"))
    scored, auc = J.score_and_auc(model, filled.filter("NOT is_train"), "label")
    pdf = scored.select("label", "pred_1").toPandas()
    pos, neg = pdf[pdf.label == 1].pred_1.values, pdf[pdf.label == 0].pred_1.values
    expected = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    assert auc.first()["auc"] == pytest.approx(expected) and expected > 0.85


def newton(x, y, ridge=0.0):
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        beta += np.linalg.solve((x.T * (p * (1 - p))) @ x + ridge * np.eye(len(beta)), x.T @ (y - p) - ridge * beta)
    return beta


@pytest.mark.parametrize("ridge", [0.0, 2.5])
def test_coefficients_equal_those_of_numpy(spark, ridge):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(900, 3))
    y = (rng.random(900) < 1 / (1 + np.exp(-(0.4 + x @ [1.5, -0.7, 0.0])))).astype(int)
    pdf = pd.DataFrame(x, columns=["a", "b", "c"]).assign(y=y, fold=np.arange(900) % 4)
    df = spark.createDataFrame(pdf).unionByName(spark.createDataFrame([(None, 1.0, 1.0, 1, 0), (1.0, 1.0, 1.0, None, 0)], "a double, b double, c double, y int, fold int"))
    whole = J.fit_logistic(df, ["a", "b", "c"], "y", ridge=ridge)
    assert whole.coefficients[0] == pytest.approx(newton(x, y, ridge), abs=1e-8) and whole.steps < 12
    by_fold, fit = J.cross_validate(df, ["a", "b", "c"], "y", folds=4, ridge=ridge)
    got = {r.fold: r for r in by_fold.collect()}
    for k in range(4):
        others, own = pdf.fold != k, pdf.fold == k
        beta = newton(x[others], y[others], ridge)
        assert fit.coefficients[k] == pytest.approx(beta, abs=1e-8)
        score, label = x[own] @ beta[1:], y[own]
        pos, neg = score[label == 1], score[label == 0]
        assert got[k].auc == pytest.approx(np.mean(pos[:, None] > neg[None, :]))
    with pytest.raises(ValueError, match="determine"):
        J.fit_logistic(df.selectExpr("1.0D AS one", "y").dropna(), ["one"], "y")


def test_ml_classifier_finds_the_same_coefficients(data):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    rows = data.dropna(subset=["x"]).select("x", "z", "label")
    ml = LogisticRegression(labelCol="label", tol=1e-12, maxIter=200).fit(VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(rows))
    ours = J.fit_logistic(rows, ["x", "z"], "label").coefficients[0]
    assert ours == pytest.approx([ml.intercept, *ml.coefficients], abs=1e-6)


def test_auc_of_a_group_without_events_is_unknown(spark):
    from panelloom.operators.ranking import roc_auc

    df = spark.createDataFrame([("a", 0.1, 0), ("a", 0.9, 1), ("b", 0.5, 0)], "g string, s double, y int")
    assert {r.g: r.auc for r in roc_auc(df, "s", "y", ["g"]).collect()} == {"a": 1.0, "b": None}
