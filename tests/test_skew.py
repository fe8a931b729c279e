"""Results with one entity holding a third of all rows equal brute force."""

import numpy as np
import pandas as pd
import pytest

from panelloom.operators import measures as M
from panelloom.operators import summary as I


@pytest.fixture(scope="module")
def hot(spark):
    rng = np.random.default_rng(9)
    n = 30_000
    pdf = pd.DataFrame(
        {
            "customer_number": np.where(rng.uniform(size=n) < 0.34, "hot", rng.integers(0, 500, n).astype(str)),
            "year": rng.integers(2000, 2005, n),
            "type": rng.choice(["Breakdown", "Complaint", "Inquiry"], n),
            "priority": rng.choice(["High", "Low"], n),
            "reaction_time": rng.exponential(size=n),
        }
    )
    return pdf, spark.createDataFrame(pdf).repartition(8)


def test_measures_of_a_hot_entity(hot):
    pdf, df = hot
    got = M.case_measures(df).toPandas().set_index(["customer_id", "year"]).sort_index()
    grouped = pdf.groupby(["customer_number", "year"])
    assert got.n_cases.tolist() == grouped.size().sort_index().tolist()
    assert np.allclose(got.avg_reaction_time, grouped.reaction_time.mean().sort_index())
    unhappy = pdf[pdf.type != "Inquiry"].groupby(["customer_number", "year"]).size()
    assert got.all_dissatisfaction.sum() == unhappy.sum()
    assert got.loc[("hot", 2000), "all_dissatisfaction"] == unhappy.loc[("hot", 2000)]


def test_summary_of_a_hot_group(hot):
    pdf, df = hot
    out = I.group_summary(df, ["type"], ["reaction_time"], entity="customer_number").toPandas().set_index("type")
    for kind, part in pdf.groupby("type"):
        row = out.loc[kind]
        assert row.n_observations == len(part) and row.n_customers == part.customer_number.nunique()
        assert row.reaction_time_median == pytest.approx(part.reaction_time.median(), rel=1e-12)
        assert row.reaction_time_sd == pytest.approx(part.reaction_time.std())


def test_installed_base_distinct_counts(hot):
    pdf, df = hot
    got = M.installed_base_measures(df.withColumnRenamed("priority", "equipment_group")).toPandas()
    got = got.set_index(["customer_id", "year"]).sort_index()
    grouped = pdf.groupby(["customer_number", "year"])
    assert got.n_equipment_types.tolist() == grouped.type.nunique().sort_index().tolist()
    assert got.installed_hw_cum.loc["hot"].tolist() == grouped.size().loc["hot"].cumsum().tolist()
