"""Exact order statistics against brute force, including hot groups and hot values."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from panelloom.operators.quality import box_stats, numeric_summary
from panelloom.operators.ranking import _ranged, quantiles, roc_auc, running_totals

PROBABILITIES = {"q1": 0.25, "median": 0.5, "q3": 0.75, "p99": 0.99}


def frame(spark, pdf, schema):
    return spark.createDataFrame(pdf, schema)


@pytest.mark.parametrize("kind", ["uniform", "hot_value", "heavy_tail", "negative", "tiny"])
def test_quantiles_equal_numpy(spark, kind):
    rng = np.random.default_rng(1)
    v = {
        "uniform": rng.uniform(0, 1, 3000),
        "hot_value": np.where(rng.uniform(size=3000) < 0.4, 7.0, rng.normal(size=3000)),
        "heavy_tail": np.exp(rng.normal(0, 6, 3000)),
        "negative": -np.exp(rng.normal(0, 3, 3000)),
        "tiny": rng.uniform(-1e-300, 1e-300, 500),
    }[kind]
    g = np.where(rng.uniform(size=len(v)) < 0.5, "hot", rng.choice(list("abc"), len(v)))
    pdf = pd.DataFrame({"g": g, "v": v})
    got = quantiles(frame(spark, pdf, "g string, v double"), ["v"], PROBABILITIES, ["g"]).toPandas().set_index("g")
    for group, part in pdf.groupby("g"):
        for name, p in PROBABILITIES.items():
            assert got.loc[group, name] == pytest.approx(np.quantile(part.v, p), rel=1e-12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.floats(-1e6, 1e6)), min_size=1, max_size=60))
def test_median_of_any_list(spark, values):
    known = [v for v in values if v is not None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r["median"] for r in quantiles(df, ["v"], {"median": 0.5}).collect()]
    assert got == ([pytest.approx(float(np.median(known)))] if known else [])


def test_null_group_keeps_its_own_quantile(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 5.0)], "g string, v double")
    got = {r["g"]: r["median"] for r in quantiles(df, ["v"], {"median": 0.5}, ["g"]).collect()}
    assert got == {None: 2.0, "a": 5.0}


def test_ranges_keep_the_order(spark):
    rng = np.random.default_rng(2)
    v = np.concatenate([rng.normal(size=500), np.exp(rng.normal(0, 50, 500)), -np.exp(rng.normal(0, 50, 500)), [0.0]])
    pdf = _ranged(spark.createDataFrame(pd.DataFrame({"v": v})), [], "v").toPandas()
    assert pdf.sort_values("v")._part.is_monotonic_increasing and pdf._part.nunique() == 8


@pytest.mark.parametrize("by", [[], ["g"]])
def test_a_hot_group_of_a_narrow_range_is_spread(spark, by):
    """One group, all values within 0.01 %: no range holds much more than the mean."""
    df = spark.range(60_000).select(F.lit("a").alias("g"), (F.lit(1e12) + F.col("id")).alias("v"))
    per_part = _ranged(df, by, "v").groupBy("_part").count().toPandas()["count"]
    assert len(per_part) == 8 and per_part.max() < 1.5 * per_part.mean()
    got = quantiles(df, ["v"], {"median": 0.5}, by).first()
    assert got["median"] == 1e12 + 29_999.5


def test_infinity_and_nan(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0,), (inf,), (float("nan"),), (3.0,), (-inf,), (None,)], "v double")
    s = numeric_summary(df).first()
    assert (s["min"], s["median"], s["max"], s["n_missing"], s["n_rows"]) == (-inf, 2.0, inf, 2, 6)
    one = numeric_summary(spark.createDataFrame([(1.0,), (float("nan"),), (3.0,)], "v double")).first()
    assert (one["mean"], one["max"], one["n_missing"], one["median"]) == (2.0, 3.0, 1, 2.0)
    both = quantiles(spark.createDataFrame([(inf,), (inf,)], "v double"), ["v"], {"m": 0.5}).first()
    assert both["m"] == inf


def test_approximate_quantiles_are_values_of_the_data(spark):
    df = spark.range(1, 1002).select(F.col("id").cast("double").alias("v"))
    s = numeric_summary(df, approximate=True).first()
    assert (s["q1"], s["median"], s["q3"]) == (251.0, 501.0, 751.0)


def test_running_totals_equal_cumsum(spark):
    pdf = pd.DataFrame({"v": np.random.default_rng(3).integers(0, 40, 500).astype(float)})
    got = running_totals(spark.createDataFrame(pdf), [], "v", {"n": F.lit(1)}).toPandas().sort_values("v")
    expected = pdf.groupby("v").size().cumsum()
    assert got.n_through.tolist() == expected.tolist()
    assert set(got.n_total) == {500}


def test_auc_equals_pair_counting(spark):
    rng = np.random.default_rng(4)
    score, label = rng.integers(0, 30, 300) / 30, rng.integers(0, 2, 300)
    pos, neg = score[label == 1], score[label == 0]
    expected = np.mean((pos[:, None] > neg[None, :]) + 0.5 * (pos[:, None] == neg[None, :]))
    df = spark.createDataFrame(pd.DataFrame({"s": score, "y": label}))
    assert roc_auc(df, "s", "y").first()["auc"] == pytest.approx(expected)


def test_summary_and_box_of_a_group(spark):
    v = [1.0, 2.0, 3.0, 4.0, 100.0, None]
    df = spark.createDataFrame([(x,) for x in v], "v double")
    s = numeric_summary(df).first()
    assert (s["min"], s["median"], s["max"], s["n_missing"]) == (1.0, 3.0, 100.0, 1)
    b = box_stats(df).first()
    assert (b["whisker_low"], b["whisker_high"], b["n_outliers"]) == (1.0, 4.0, 1)
