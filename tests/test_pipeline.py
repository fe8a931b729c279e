"""Extract files to stored panel, end to end."""

import pytest

from panelloom.config import PanelSpec
from panelloom.plans import pipeline
from panelloom.sources import extracts as X
from panelloom.sources import steps
from panelloom.sources.catalog import source_specs

PREAMBLE = ["report", "made by x", "", "----"]


def write(root, dataset, lines, preamble=4):
    folder = root / "raw" / dataset
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text("\n".join([*PREAMBLE[:preamble], *lines]) + "\n")


@pytest.fixture()
def root(tmp_path):
    write(
        tmp_path,
        "opportunities",
        [
            "ID,Customer ID,Account,Start Date,Close Date,Opportunity Status,Expected Value,Product Category,Country",
            "1,7,Alpha,01.02.2010,01.06.2010,Won,\"1,000.50\",Software,Germany",
            "1,7,Alpha,01.02.2010,01.06.2010,Won,\"1,000.50\",Software,Germany",
            "2,7,Alpha,01.02.2011,01.06.2011,Lost,500,Laser machine,Germany",
            "3,8,Beta,01.02.2009,15.06.2012,Won,5,Service,Germany",
            "4,9,Test firm,01.02.2009,15.06.2012,Won,5000,Service,Germany",
        ],
    )
    write(tmp_path, "customers", ["Account ID,SAP ID,Name,Phone", "7,S7,Alpha,1", "8,,Beta,2", "9,S9,Test firm,3"])
    write(
        tmp_path,
        "software_sales",
        ["Endkunde,Gültig ab,X5 Generation,Umsatz", "S7,15.03.2011,Monitoring suite,100", "S7,16.03.2012,Bend tool,50"],
        preamble=0,
    )
    write(
        tmp_path,
        "cases",
        ["Case Number,Customer Number,CW,Case Type,Priority,Reaction Time", "c1,S7,2011/7,Breakdown,High,\"1,5\""],
        preamble=2,
    )
    write(tmp_path, "machine_orders", ["Equipmentnummer,Nummer Vertriebsauftrag,Land", "e1,o1,DE"], preamble=0)
    write(tmp_path, "order_headers", ["Verkaufsbeleg,Land", "o1,AT"], preamble=0)
    return tmp_path


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_from_files_to_panel(spark, root):
    landed = pipeline.ingest(spark, source_specs(str(root / "raw")), str(root))
    assert {"opportunities", "customers", "software_sales", "cases", "machine_orders"} == set(landed)
    orders = spark.read.parquet(landed["machine_orders"]).first()
    assert (orders["land.x"], orders["land.y"]) == ("DE", "AT")

    summary, errors = pipeline.clean_layer(spark, str(root), as_of="2020-01-01")
    assert errors == {}
    counts = {r.dataset: (r.rows_raw, r.rows_cleaned, r.status) for r in summary.collect()}
    assert counts["opportunities"] == (5, 4, "success")

    paths = pipeline.build(spark, str(root), PanelSpec(first_period=2010, last_period=2013, lead_in=2))
    panel = {(r.customer_id, r.year): r for r in spark.read.parquet(paths["panel"]).collect()}
    # Beta sold for 5 only and the test firm is no customer: both are gone.
    assert {c for c, _ in panel} == {"7"} and {y for _, y in panel} == {2010, 2011, 2012, 2013}
    row = panel["7", 2011]
    assert (row.to_number_of_opps, row.to_sum_opps_won, row.to_cum_val_opps_won) == (1, 0, 1000.5)
    assert (row.ts_sales_total_exploration, row.n_breakdowns, row.avg_reaction_time) == (100.0, 1, 1.5)
    assert (row.treatment, row.time_to_treat, row.customer_tenure) == (1, 0, 2)
    assert panel["7", 2012].ts_sales_num_sw_exploit == 1
    meta = spark.read.parquet(paths["metadata"]).first()
    assert (meta.n_rows, meta.n_treated) == (4, 1)


@pytest.mark.filterwarnings("ignore::UserWarning")
def test_unchanged_steps_are_used_again(spark, root, monkeypatch):
    """A second run reads no source; a changed file rebuilds what was made from it, and nothing else."""
    read, cleaned, built, real = [], [], [], (X.load_source, pipeline.clean, pipeline.build_panel)
    monkeypatch.setattr(X, "load_source", lambda s, spec: read.append(spec.root.rsplit("/", 1)[1]) or real[0](s, spec))
    monkeypatch.setattr(pipeline, "clean", lambda df, spec: cleaned.append(spec) or real[1](df, spec))
    monkeypatch.setattr(pipeline, "build_panel", lambda inputs, spec: built.append(spec) or real[2](inputs, spec))
    specs = {n: s for n, s in source_specs(str(root / "raw")).items() if (root / "raw" / n).exists()}
    panel_spec = PanelSpec(first_period=2010, last_period=2013, lead_in=2)

    def run(spec=panel_spec):
        for calls in (read, cleaned, built):
            calls.clear()
        landed = pipeline.ingest(spark, specs, str(root))
        summary, errors = pipeline.clean_layer(spark, str(root), as_of="2020-01-01")
        paths = pipeline.build(spark, str(root), spec)
        assert errors == {}
        counts = {tuple(r) for r in summary.collect()}
        return landed, counts, sorted(map(str, spark.read.parquet(paths["panel"]).collect()))

    first = run()
    assert {"cases", "order_headers", "machine_orders"} <= set(read) and len(cleaned) == 5 and len(built) == 1
    assert run() == first and (read, cleaned, built) == ([], [], [])

    # A change to the headers of orders reaches the orders; the panel does not read these.
    extract = root / "raw" / "order_headers" / "a.csv"
    extract.write_text(extract.read_text().replace("AT", "CH!"))
    again = run()
    assert set(read) == {"order_headers", "order_partners", "machine_orders"} - (set() if "order_partners" in specs else {"order_partners"})
    assert len(cleaned) == 1 and built == [] and again[1:] == first[1:]

    extract = root / "raw" / "cases" / "a.csv"
    extract.write_text(extract.read_text() + 'c2,S7,2012/9,Breakdown,High,"2,5"\n')
    third = run()
    assert read == ["cases"] and len(cleaned) == 1 and len(built) == 1
    assert ("cases", 2, 2, "success") in third[1] and third[2] != first[2]

    # Other settings build the panel alone; a build that fails is never taken for finished.
    other = PanelSpec(first_period=2010, last_period=2012, lead_in=2)
    monkeypatch.setattr(pipeline, "build_panel", lambda inputs, spec: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(other)
    monkeypatch.setattr(pipeline, "build_panel", lambda inputs, spec: built.append(spec) or real[2](inputs, spec))
    assert len(run(other)[2]) == 3 and (read, cleaned) == ([], []) and len(built) == 1


def test_settings_are_described_alike_in_every_run():
    from panelloom.plans.cleaners import clean_specs

    one, two = (steps.step_key(clean_specs("2020-01-01")) for _ in range(2))
    assert one == two != steps.step_key(clean_specs("2020-01-02"))
    assert " at 0x" not in str(steps.described(clean_specs("2020-01-01")))
