"""Purchase model: stable splits, imputation, scaling, logistic regression, cross-validation and AUC."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelloom.operators.ranking import quantiles, roc_auc

_BUCKETS = 10_000


def hash_bucket(key: Column, seed: str = "") -> Column:
    """Bucket 0..9999 from a digest of the key: the same on every run and cluster."""
    text = F.concat(F.lit(seed), key.cast("string")) if seed else key.cast("string")
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") % _BUCKETS


def stratified_split(df: DataFrame, key: str, label: str, share: float = 0.8, seed: str = "") -> DataFrame:
    """Add ``is_train``. Keys are hashed within their stratum, so each label value gets about
    the same share; no stratum is ever gathered or sorted."""
    stratum = F.coalesce(F.col(label).cast("string"), F.lit(""))
    bucket = hash_bucket(F.concat_ws("|", stratum, F.col(key).cast("string")), seed)
    return df.withColumn("is_train", bucket < int(share * _BUCKETS))


def stratified_folds(df: DataFrame, key: str, label: str, folds: int = 5, seed: str = "") -> DataFrame:
    """Add ``fold`` (0..folds-1), usable as the fold column of a cross validator."""
    stratum = F.coalesce(F.col(label).cast("string"), F.lit(""))
    bucket = hash_bucket(F.concat_ws("|", stratum, F.col(key).cast("string")), seed)
    return df.withColumn("fold", bucket % folds)


def fit_imputation(train: DataFrame, numeric: Sequence[str] = (), nominal: Sequence[str] = ()) -> dict[str, object]:
    """Median / most frequent value per column of the training set (ties: smallest value)."""
    values: dict[str, object] = {}
    if numeric:
        # One row per column name comes back.
        for row in quantiles(train, numeric, {"median": 0.5}).collect():
            values[row["column"]] = row["median"]
    if nominal:
        # All modes with one aggregation; one row per column name comes back.
        texts = train.select(*[F.col(c).cast("string").alias(c) for c in nominal]).unpivot([], list(nominal), "column", "value")
        counts = texts.filter(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
        tops = counts.groupBy("column").agg(F.min_by("value", F.struct((-F.col("n")).alias("n"), "value")).alias("mode"))
        values |= {row["column"]: row["mode"] for row in tops.collect()}
    return values


def impute(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items()}) if values else df


def fit_scaling(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and standard deviation per column of the training set (one row comes back)."""
    row = train.agg(
        *[F.avg(c).alias(f"{c}_mean") for c in columns], *[F.stddev_samp(c).alias(f"{c}_sd") for c in columns]
    ).first()
    return {c: (row[f"{c}_mean"], row[f"{c}_sd"]) for c in columns}


def standardise(df: DataFrame, scaling: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Centre and scale; a constant column is only centred."""
    return df.withColumns(
        {c: (F.col(c) - F.lit(mean)) / F.lit(sd if sd else 1.0) for c, (mean, sd) in scaling.items() if mean is not None}
    )


def purchase_classifier(numeric: Sequence[str], nominal: Sequence[str], label: str) -> Pipeline:
    """Logistic regression on all predictors; texts are one-hot encoded, numbers scaled."""
    indexed, encoded = [f"{c}_index" for c in nominal], [f"{c}_onehot" for c in nominal]
    stages = []
    if numeric:
        stages += [
            VectorAssembler(inputCols=list(numeric), outputCol="_numbers"),
            StandardScaler(inputCol="_numbers", outputCol="_scaled", withMean=True, withStd=True),
        ]
    if nominal:
        stages += [
            StringIndexer(inputCols=list(nominal), outputCols=indexed, handleInvalid="keep"),
            OneHotEncoder(inputCols=indexed, outputCols=encoded, handleInvalid="keep"),
        ]
    stages += [
        VectorAssembler(inputCols=(["_scaled"] if numeric else []) + encoded, outputCol="features"),
        LogisticRegression(featuresCol="features", labelCol=label),
    ]
    return Pipeline(stages=stages)


@dataclass(frozen=True)
class LogisticFit:
    """Coefficients of each model, the intercept first, and the Newton steps that were taken."""

    features: tuple[str, ...]
    coefficients: Mapping[int, tuple[float, ...]]
    steps: int


def _products(names: Sequence[str]) -> list[tuple[int, int]]:
    return [(i, j) for i in range(len(names) + 1) for j in range(i, len(names) + 1)]


def _logit(beta: Column, features: Sequence[str]) -> Column:
    total = beta[0]
    for k, name in enumerate(features, 1):
        total = total + beta[k] * F.col(name)
    return total


def _beta(models: Mapping[int, Sequence[float]], model: Column) -> Column:
    """The coefficients of a row's model; a literal map, as large as the models are."""
    pairs = [x for k, b in models.items() for x in (F.lit(k), F.array(*[F.lit(float(v)) for v in b]))]
    return F.create_map(*pairs)[model]


def fit_logistic(
    df: DataFrame, features: Sequence[str], label: str, leave_out: str | None = None, groups: Sequence[int] = (0,), ridge: float = 0.0, steps: int = 30, tolerance: float = 1e-10
) -> LogisticFit:
    """Logistic regression by iteratively reweighted least squares on distributed sums.

    A Newton step is one aggregation: the weighted products of the features and their products with
    the residuals, reduced in each task; the driver solves a system as large as the number of features. With
    ``leave_out`` there is one model for each value in ``groups``, fitted to the rows of all other
    values, and every step serves all models. ``ridge`` is the weight of the squared coefficients, the
    intercept's too. Rows with a NULL feature or label are left out. Raises ``ValueError`` where the
    sums have no solution, as with a feature that others determine.
    """
    columns = [label, *features, *([leave_out] if leave_out else [])]
    rows = df.select(*columns).dropna(subset=[label, *features])
    models = F.array(*[F.lit(g) for g in groups])
    taught = rows.withColumn("_model", F.explode(models))
    if leave_out:
        taught = taught.where(~F.col("_model").eqNullSafe(F.col(leave_out)))
    x = [F.lit(1.0), *[F.col(c).cast("double") for c in features]]
    pairs, size = _products(features), len(features) + 1
    beta = {g: np.zeros(size) for g in groups}
    for step in range(1, steps + 1):
        chance = 1 / (1 + F.exp(-_logit(_beta(beta, F.col("_model")), features)))
        weighed = taught.withColumn("_p", chance)
        sums = weighed.groupBy("_model").agg(
            *[F.sum(F.col("_p") * (1 - F.col("_p")) * x[i] * x[j]).alias(f"h{i}_{j}") for i, j in pairs],
            *[F.sum((F.col(label) - F.col("_p")) * x[i]).alias(f"g{i}") for i in range(size)],
        )
        moved = 0.0
        for row in sums.collect():
            own = beta[row["_model"]]
            curve = np.diag(np.full(size, float(ridge)))
            for i, j in pairs:
                curve[i, j] += row[f"h{i}_{j}"]
                curve[j, i] = curve[i, j]
            try:
                change = np.linalg.solve(curve, np.array([row[f"g{i}"] for i in range(size)]) - ridge * own)
            except np.linalg.LinAlgError as error:
                raise ValueError("the features do not determine the coefficients") from error
            beta[row["_model"]] = own + change
            moved = max(moved, float(np.abs(change).max()))
        if moved < tolerance:
            break
    return LogisticFit(tuple(features), {g: tuple(map(float, b)) for g, b in beta.items()}, step)


def predict_logistic(df: DataFrame, fit: LogisticFit, model: Column | None = None) -> DataFrame:
    """``df`` and ``pred_1``, by the model that ``model`` names (default: the only one)."""
    beta = _beta(fit.coefficients, F.lit(next(iter(fit.coefficients))) if model is None else model)
    return df.withColumn("pred_1", 1 / (1 + F.exp(-_logit(beta, fit.features))))


def cross_validate(df: DataFrame, features: Sequence[str], label: str, fold: str = "fold", folds: int = 5, ridge: float = 0.0) -> tuple[DataFrame, LogisticFit]:
    """AUC of each fold under the model that was fitted without it: ``fold, n_pos, n_neg, auc``."""
    fit = fit_logistic(df, features, label, fold, range(folds), ridge)
    scored = predict_logistic(df.dropna(subset=[label, *features]), fit, F.col(fold).cast("int"))
    return roc_auc(scored, "pred_1", label, [fold]), fit


def score(model: PipelineModel, test: DataFrame) -> DataFrame:
    """The test rows with the probability of the event (label 1)."""
    scored = model.transform(test)
    return scored.select(*test.columns, vector_to_array("probability")[1].alias("pred_1"))


def score_and_auc(model: PipelineModel, test: DataFrame, label: str) -> tuple[DataFrame, DataFrame]:
    scored = score(model, test)
    return scored, roc_auc(scored, "pred_1", label)
