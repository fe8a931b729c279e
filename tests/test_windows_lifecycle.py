"""Window features, purchase and treatment features, final filter."""

from conftest import rows
from pyspark.sql import functions as F

from panelloom.operators import lifecycle as H
from panelloom.operators import windows as G


def series(spark, values, entity="a"):
    data = [(entity, 2000 + i, v) for i, v in enumerate(values)]
    return spark.createDataFrame(data, "customer_id string, year long, v double")


def column(df, name):
    return [r[name] for r in df.orderBy("customer_id", "year").collect()]


def test_cumulative_counts_null_as_zero(spark):
    out = G.cumulative(series(spark, [1.0, None, 2.0]), {"v": "c"})
    assert column(out, "c") == [1.0, 1.0, 3.0]


def test_rolling_mean_needs_a_full_known_frame(spark):
    df = series(spark, [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0])
    assert column(G.rolling_mean(df, {"v": "r"}, 3), "r") == [None, None, 2.0, None, None, None, 6.0]
    zeroed = column(G.rolling_mean(df, {"v": "r"}, 3, null_as_zero=True), "r")
    assert zeroed[:4] == [None, None, 2.0, 5.0 / 3]


def test_fill_down_then_up_is_idempotent(spark):
    df = series(spark, [None, 1.0, None, 2.0, None])
    assert column(G.fill(df, ["v"], "down"), "v") == [None, 1.0, 1.0, 2.0, 2.0]
    once = G.fill(df, ["v"], "downup")
    assert column(once, "v") == [1.0, 1.0, 1.0, 2.0, 2.0]
    assert column(G.fill(once, ["v"], "downup"), "v") == column(once, "v")


def test_lag_never_crosses_entities(spark):
    df = series(spark, [1.0, 2.0]).unionByName(series(spark, [9.0], "b"))
    assert column(G.lag_value(df, "v", "p"), "p") == [None, 1.0, None]


def test_first_period_and_flags(spark):
    df = G.first_period_where(series(spark, [0.0, 3.0, 1.0]), {"first": F.col("v") > 0})
    df = G.ever_and_post(df, {"first": ("ever", "post")})
    assert rows(df, "year", "first", "ever", "post") == [(2000, 2001, True, 0), (2001, 2001, True, 1), (2002, 2001, True, 1)]
    never = G.ever_and_post(G.first_period_where(series(spark, [0.0]), {"first": F.col("v") > 0}), {"first": ("ever", "post")})
    assert rows(never, "first", "ever", "post") == [(None, False, 0)]


def panel(spark, data):
    return spark.createDataFrame(
        data, "customer_id string, year long, relationship_status string, to_sum_opps_won long, ts_first_explore_year long"
    )


def test_tenure_and_prospect_time(spark):
    df = panel(spark, [("a", 2000, "pre_relationship", None, None), ("a", 2001, "active", 0, None), ("a", 2002, "active", 1, None)])
    out = H.tenure_features(df)
    assert rows(out, "year", "first_purchase_year", "customer_tenure", "prospect_tenure", "years_since_first_purchase") == [
        (2000, 2001, 0, 1, -1),
        (2001, 2001, 1, 0, 0),
        (2002, 2001, 2, 0, 1),
    ]


def test_first_purchase_comes_from_the_first_series_that_moves(spark):
    df = spark.createDataFrame(
        [("a", 2000, 0, 0), ("a", 2001, 0, 2), ("a", 2002, 1, 2)], "customer_id string, year long, won long, erp long"
    )
    out = H.first_purchase_date(df, ["won", "erp"])
    # 2002 overwrites the carried value because the first series starts there.
    assert column(out, "ft_purchase_at_t_date") == [None, 2001, 2002]


def test_recency(spark):
    df = panel(spark, [("a", 2000, "active", 1, None), ("a", 2001, "active", 0, None), ("a", 2002, "active", 2, None)])
    out = H.recency(df)
    assert column(out, "lt_purchase_at_T_date") == [2000, 2000, 2002]
    assert column(out, "duration_since_last_purchase") == [None, 1, 2]


def test_treatment_time_for_treated_and_never_treated(spark):
    data = [("t", y, "active", 0, 2001) for y in range(2000, 2003)] + [("n", y, "active", 0, None) for y in range(2000, 2003)]
    out = H.treatment_features(panel(spark, data), base_year=2002)
    got = {(r.customer_id, r.year): (r.treatment, r.time_to_treat, r.ever_treated) for r in out.collect()}
    assert got["t", 2000] == (0, -1, 1) and got["t", 2002] == (1, 1, 1)
    assert got["n", 2000] == (0, -2, 0) and got["n", 2002] == (0, 0, 0)
    out = H.value_at_event(out.withColumn("tenure", F.col("year") - 1999), "tenure", "at_event")
    assert rows(out.select("customer_id", "at_event").distinct(), "customer_id", "at_event") == [("n", 3), ("t", 2)]


def test_final_panel_drops_whole_suspicious_entities(spark):
    schema = (
        "customer_id string, year long, relationship_status string, country string, customer_name string,"
        " to_sum_val_opps_won double, first_purchase_year long, time_to_treat long, n long"
    )
    data = [
        ("tiny", 2000, "active", "DE", "x", 5.0, 2000, 0, None),
        ("tiny", 2001, "active", "DE", "x", 500.0, 2000, 1, None),
        ("huge", 2000, "active", "DE", "x", 2e7, 2000, 0, None),
        ("name", 2000, "active", "DE", "My TEST account", 50.0, 2000, 0, None),
        ("idle", 2000, "active", "DE", "x", 50.0, None, 0, None),
        (None, 2000, "active", "DE", "dummy", 50.0, 2000, 0, None),
        ("good", 2000, "active", "DE", None, None, 2000, None, None),
        ("good", 2001, "pre_relationship", None, None, None, 2000, None, None),
        ("good", 1990, "active", "DE", None, None, 2000, None, None),
        ("abroad", 2000, "active", "FR", None, 2e7, 2000, None, None),
    ]
    df = spark.createDataFrame(data, schema)
    kept = H.finalise_panel(df, 1995, 2005, "DE")
    # Active gaps become 0; event times and rows before the relationship stay unknown.
    assert rows(kept, "customer_id", "year", "to_sum_val_opps_won", "n", "time_to_treat") == [
        ("good", 2000, 0.0, 0, None),
        ("good", 2001, None, None, None),
    ]
    bad = H.suspicious_entities(df, "DE")
    assert {r.customer_id for r in bad.collect()} == {"tiny", "huge", "name", "idle", None}
