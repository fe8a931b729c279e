"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as contract
from panelloom.operators import convert as V
from panelloom.operators import measures as M
from panelloom.operators import panel as P
from panelloom.operators import summary as I
from panelloom.operators import windows as G
from panelloom.workloads import fixtures
from panelloom.workloads import panel_queries as q
from panelloom.workloads.fixtures import Tables
from panelloom.workloads.registry import QUERIES

DATA = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_python_in_plans(spark, name):
    if name in ("purchase_classifier", "ingest_text_first"):
        pytest.skip("writes files or fits a model while being built")
    text = plan(contract.queries()[name](spark, DATA))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "SinglePartition, REPARTITION"):
        assert word not in text, word


def test_aligned_measures_and_all_windows_share_one_exchange(no_broadcast):
    t = Tables(no_broadcast, DATA)
    tables = [
        M.opportunity_measures(t.view("v_opportunities")),
        M.meeting_measures(t.view("v_meetings")),
        M.mail_measures(t.view("v_mail_log")),
    ]
    panel = P.align_measures(q.grid(t), tables)
    panel = G.cumulative(panel, {"to_number_of_opps": "c"})
    panel = G.rolling_mean(panel, {"to_number_of_opps": "r"}, 3)
    panel = G.fill(panel, ["mails_total"], "downup")
    text = plan(panel)
    # One exchange per aggregated input (grid and three tables) and one for everything after.
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 5
    assert "SortMergeJoin" not in text


def test_entity_filter_reaches_the_scans(no_broadcast):
    t = Tables(no_broadcast, DATA)
    panel = P.align_measures(q.grid(t), [M.opportunity_measures(t.view("v_opportunities"))])
    text = plan(G.cumulative(panel, {"to_number_of_opps": "c"}).filter("customer_id = 5"))
    assert text.count("EqualTo(o_custkey,5)") >= 2


def test_only_needed_columns_are_read(spark):
    text = plan(M.opportunity_measures(Tables(spark, DATA).view("v_opportunities")).select("customer_id", "to_number_of_opps"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "o_totalprice" not in schema and "o_orderstatus" not in schema


def test_measures_aggregate_before_the_shuffle(spark):
    text = plan(M.case_measures(Tables(spark, DATA).view("v_cases")))
    assert re.search(r"HashAggregate.*\n.*Exchange hashpartitioning\(.*\n.*HashAggregate.*partial_", text)


def test_panel_joins_lines_and_orders_once(spark):
    text = plan(q.features(Tables(spark, DATA)))
    assert "lineitem.parquet" not in text  # the join is stored; five inputs read it


def test_installed_base_is_shuffled_once(spark):
    installed = Tables(spark, DATA).view("v_installed_base")
    text = plan(M.installed_base_measures(installed).drop("installed_hw_cum"))
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", text)) == 1


def test_tasks_that_join_lines_grow_with_the_files(no_broadcast, monkeypatch):
    monkeypatch.setattr(fixtures, "LINES_PER_TASK", 1000)
    text = plan(QUERIES["service_counts"].build(Tables(no_broadcast, DATA)))
    tasks = [int(n) for n in re.findall(r"Exchange hashpartitioning\(l_orderkey#\d+L, (\d+)\), REPARTITION_BY_NUM", text)]
    assert tasks and min(tasks) > 8


def test_date_layouts_stay_out_of_methods_too_long_to_compile(spark):
    names = ["a", "b", "c"]
    texts = spark.createDataFrame([("05.03.2020", "2020-03-05", "43895")], names)
    typed = V.convert_types(texts, V.ConversionSpec(mixed_dates=tuple(names)))
    assert [str(v) for v in typed.first()] == ["2020-03-05"] * 3
    methods = typed._jdf.queryExecution().debug().codegenToSeq()
    assert all(methods.apply(i)._3().maxMethodCodeSize() < 8000 for i in range(methods.size()))


def test_measured_layouts_read_a_text_once(spark, monkeypatch):
    read = []
    date = V.P.Layout.date
    monkeypatch.setattr(V.P.Layout, "date", lambda self, fields: read.append(self.name) or date(self, fields))
    texts = spark.createDataFrame([("05.03.2020",), ("06.03.2020",), ("2020-03-07",), ("none",), (None,)], ["a"])
    plan = V.plan_conversion(texts, V.ConversionSpec(dates=("a",)))
    assert sorted(read) == sorted(x.name for x in V.P.DATE_LAYOUTS)
    assert plan.successes["a", "mixed_dates"] == 3 and plan.successes["a", "date:dmy"] == 2


def test_group_summary_reads_the_stored_join(spark, monkeypatch):
    stored = []
    keep = fixtures.Tables.stored
    monkeypatch.setattr(fixtures.Tables, "stored", lambda self, name, df: stored.append((name, plan(df))) or keep(self, name, df))
    QUERIES["group_summary"].build(Tables(spark, DATA))
    assert [name for name, text in stored if "lineitem.parquet" in text] == ["lines"]


def test_entities_are_counted_without_their_statistics(spark):
    rows = [("a", 1, 1.0), ("a", 1, 3.0), ("a", None, 5.0), (None, 2, 7.0)]
    out = I.group_summary(spark.createDataFrame(rows, "type string, entity long, m double"), ["type"], ["m"], entity="entity")
    found = {r["type"]: (r["n_observations"], r["n_customers"], r["m_mean"], r["m_median"]) for r in out.collect()}
    assert found == {"a": (3, 2, 3.0, 3.0), None: (1, 1, 7.0, 7.0)}
    by_entity = re.findall(r"HashAggregate\(keys=\[type#\d+, \w*entity#\d+L\], functions=\[([^\]]*)\]", plan(out))
    assert by_entity and not any(by_entity)


def test_tables_whose_measures_are_not_asked_for_share_a_shuffle(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # else exchanges are reused at run time only
    try:
        text = plan(q.features(Tables(spark, DATA)).select("customer_id", "year", "to_number_of_opps"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    counted = re.findall(r"[-+] (\w+) [^\n]*hashpartitioning\(\w+#\d+L, (?:mission|completion)_year#", text)
    assert sorted(counted) == ["Exchange", "ReusedExchange"]


def test_stored_tables_are_packed(spark):
    files = Tables(spark, DATA).stored("few", spark.range(10)).inputFiles()
    assert files and all(f.endswith(".zstd.parquet") for f in files)
