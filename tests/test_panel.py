"""Grid, attaching, masking: NULL rules and invariants."""

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.config import PanelKeys
from panelloom.operators import measures as M
from panelloom.operators import panel as P
from panelloom.operators.schema import resolve_column


@pytest.fixture()
def opportunities(spark):
    return spark.createDataFrame(
        [
            (1, "a", 2001, 2001, "Won", "Software", 50.0),
            (2, "a", 2001, 2001, None, "Software", 70.0),
            (3, "a", 2003, 2003, "Lost (autom.)", None, None),
            (4, None, 2002, 2002, "Won", "Laser machine", None),
            (5, "late", 2030, 2030, "Open", "Other", 1.0),
            (6, "edge", 2008, 2009, "Lost", "Press brake", 5.0),
            (7, "nothing", None, None, "Won", "Other", 9.0),
        ],
        "to_id int, to_customer_id string, to_start_year long, to_close_year long, to_opportunity_status string,"
        " to_product_category string, to_expected_value double",
    )


def grid(opportunities):
    firsts = P.first_event(opportunities, "to_customer_id", "to_start_year", 2000, 2003)
    return P.base_panel(firsts, 2000, 2003)


def test_grid_is_dense_and_keeps_the_null_entity(opportunities):
    panel = grid(opportunities)
    # "late" lies more than 5 years after the range, "nothing" has no year at all.
    assert sorted({r[0] for r in panel.select("customer_id").collect()}, key=repr) == sorted(["a", "edge", None], key=repr)
    assert panel.count() == 3 * 4
    assert panel.select("customer_id", "year").distinct().count() == 12
    status = {(r.customer_id, r.year): r.relationship_status for r in panel.collect()}
    assert status["a", 2000] == "pre_relationship" and status["a", 2001] == "active"
    assert status["edge", 2003] == "pre_relationship"


def test_monthly_and_daily_grids(spark):
    df = spark.createDataFrame([("a", "2024-01-15")], "id string, d string").select("id", F.col("d").cast("date").alias("d"))
    daily = PanelKeys("id", "day", "day")
    panel = P.base_panel(P.first_event(df, "id", "d", "2024-01-10", "2024-01-20", daily), "2024-01-10", "2024-01-20", daily)
    assert panel.count() == 11 and panel.filter("relationship_status = 'active'").count() == 6
    monthly = PanelKeys("id", "month", "month")
    panel = P.base_panel(P.first_event(df, "id", "d", "2024-01-01", "2024-12-01", monthly), "2024-01-01", "2024-12-01", monthly)
    assert panel.count() == 12
    distance = panel.select(monthly.distance(F.lit("2024-01-01").cast("date")).alias("n"))
    assert sorted(r.n for r in distance.collect()) == list(range(12))


def test_opportunity_counts_treat_null_status_and_category_as_no(opportunities):
    table = {(r.customer_id, r.year): r for r in M.opportunity_measures(opportunities).collect()}
    a = table["a", 2001]
    assert (a.to_number_of_opps, a.to_sum_opps_closed, a.to_sum_opps_won) == (2, 1, 1)
    assert a.to_value_software == 50.0 and a.to_opp_winning_probability == 1.0
    # Automatic losses count as closed overall, but not per category.
    assert table["a", 2003].to_sum_opps_closed == 1 and table["a", 2003].to_closed_software == 0
    assert table["edge", 2009].to_closed_hw_mt_standalone == 1
    # The value of a won opportunity is unknown: the sum is 0, not NULL.
    assert table[None, 2002].to_sum_val_opps_won == 0.0


@pytest.mark.parametrize("how", ["join", "align"])
def test_attaching_keeps_rows_and_matches_null_entities(opportunities, how):
    panel, table = grid(opportunities), M.opportunity_measures(opportunities)
    out = P.attach_measures(panel, table) if how == "join" else P.align_measures(panel, [table])
    assert out.count() == panel.count()
    won = {(r.customer_id, r.year): r.to_sum_opps_won for r in out.collect()}
    assert won[None, 2002] == 1 and won[None, 2001] is None and won["a", 2001] == 1


def test_align_equals_chain_of_joins(spark, opportunities):
    panel = grid(opportunities)
    one = M.opportunity_measures(opportunities).select("customer_id", "year", "to_number_of_opps")
    two = one.withColumnRenamed("to_number_of_opps", "other").withColumn("year", F.col("year") + 1)
    aligned = P.align_measures(panel, [one, two])
    joined = P.attach_measures(P.attach_measures(panel, one), two)
    names = ("customer_id", "year", "relationship_status", "to_number_of_opps", "other")
    assert rows(aligned, *names) == rows(joined, *names)


def test_align_refuses_ambiguous_columns(opportunities):
    table = M.opportunity_measures(opportunities)
    with pytest.raises(ValueError, match="twice"):
        P.align_measures(grid(opportunities), [table, table])


def test_secondary_id_never_matches_null(spark):
    panel = spark.createDataFrame(
        [("a", 2000, "S1"), ("b", 2000, None), ("c", 2000, None)], "customer_id string, year long, sap string"
    )
    table = spark.createDataFrame([("S1", 2000, 5), (None, 2000, 99)], "customer_id string, year long, n int")
    out = P.attach_measures(panel, table, on="sap")
    assert rows(out, "customer_id", "n") == [("a", 5), ("b", None), ("c", None)]
    moved = P.rekey_measures(table, panel.select("customer_id", "sap"), "sap")
    assert rows(moved, "customer_id", "n") == [("a", 5)]


def test_mask_is_unknown_before_and_zero_while_active(spark):
    df = spark.createDataFrame(
        [("pre_relationship", 5), ("active", None), ("active", 3), (None, 4)], "relationship_status string, n long"
    )
    assert [r.n for r in P.mask_inactive(df, ["n"]).collect()] == [None, 0, 3, None]


def test_counts_per_source_use_one_shuffle(spark):
    a = spark.createDataFrame([("x", 2000), ("x", 2000), (None, 2001)], "id string, y long")
    b = spark.createDataFrame([("x", 2000)], "who string, y long")
    table = M.count_by_source({"a": (a, "id", F.col("y")), "b": (b, "who", F.col("y"))})
    assert rows(table, "customer_id", "year", "n_a", "n_b") == [("x", 2000, 2, 1), (None, 2001, 1, 0)]


def test_missing_optional_columns(spark):
    bare = spark.createDataFrame([("x", 2000), (None, 2000), ("x", None)], "account string, year long")
    assert rows(M.meeting_measures(bare), "customer_id", "completed_meetings_num_total", "total_meeting_duration") == [("x", 1, 0.0)]
    assert rows(M.mail_measures(bare), "customer_id", "mails_total", "mails_high_priority") == [("x", 1, 0)]
    with pytest.raises(ValueError, match="period"):
        M.meeting_measures(bare.drop("year"))


def test_missions_delayed_as_text_or_boolean(spark):
    text = spark.createDataFrame([("m", 2000, "Mission delayed"), ("m", 2000, None)], "mission_id string, year long, delayed string")
    flag = spark.createDataFrame([("m", 2000, True), ("m", 2000, None)], "mission_id string, year long, delayed boolean")
    for df in (text, flag):
        assert M.mission_measures(df).first().n_delayed_missions == 1


def test_synonyms_are_tried_in_order(spark):
    df = spark.createDataFrame([(1, 2)], "status int, state int")
    assert resolve_column(df, "opportunity_status", ("state", "status")) == "state"
    assert resolve_column(df, "nothing", ("else",)) is None


def test_result_does_not_depend_on_partitions_or_order(opportunities):
    a = P.align_measures(grid(opportunities), [M.opportunity_measures(opportunities)])
    mixed = opportunities.orderBy(F.desc("to_id")).repartition(5)
    b = P.align_measures(grid(mixed), [M.opportunity_measures(mixed)])
    assert rows(a, *a.columns) == rows(b, *a.columns)


def test_category_dictionary_as_lists_or_as_a_joined_table(spark, opportunities):
    lists = {"t_software": ["Software"], "t_hw_lt_standalone": ["Laser machine", "Software"]}
    pairs = [(g, c) for g, names in lists.items() for c in names]
    table = spark.createDataFrame(pairs, "category_group string, category string")
    a, b = M.opportunity_measures(opportunities, lists), M.opportunity_measures(opportunities, table)
    assert rows(a, *a.columns) == rows(b, *a.columns)
