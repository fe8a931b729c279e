"""Extract files with preambles and differing headers, stored layers, step reuse, panel output."""

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.config import PanelKeys
from panelloom.sources import extracts as X
from panelloom.sources import records as R
from panelloom.sources import layers as L
from panelloom.sources.catalog import source_specs


def write(folder, name, lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


PREAMBLE = ["report", "", "made by x", "----"]


def test_preamble_header_drift_and_quotes(spark, tmp_path):
    write(tmp_path / "in", "a.csv", [*PREAMBLE, "id,name", '1,"x, y"', "2,report", "", "3,"])
    write(tmp_path / "in", "b.csv", [*PREAMBLE, "name,extra,id", "z,9,4"])
    write(tmp_path / "in", "c.csv", ["only", "two"])
    with pytest.warns(UserWarning, match="no header"):
        df = X.read_text_first(spark, X.list_sources(spark, str(tmp_path / "in"), "*.csv"), preamble=4)
    # A data line that repeats a preamble line is kept.
    assert rows(df, "id", "name", "extra") == sorted(
        [("1", "x, y", None), ("2", "report", None), ("3", None, None), ("4", "z", "9")], key=repr
    )
    assert {f.dataType.simpleString() for f in df.schema if f.name in ("id", "name", "extra")} == {"string"}
    assert {"_file", "_block", "_line"} <= set(df.columns)


def test_only_the_first_block_of_a_split_file_loses_lines(spark, tmp_path):
    write(tmp_path / "big", "a.csv", [*PREAMBLE, "id,text", *[f"{i},{'t' * 40}" for i in range(5000)]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
        df = X.read_text_first(spark, [str(tmp_path / "big" / "a.csv")], preamble=4)
        assert df.select("_block").distinct().count() > 5
        ids = [int(r.id) for r in df.orderBy("_file", "_block", "_line").collect()]
        assert ids == list(range(5000))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_missing_files_are_skipped(spark, tmp_path):
    write(tmp_path / "in", "a.csv", ["id", "1"])
    with pytest.warns(UserWarning, match="skipping"):
        df = X.read_text_first(spark, [str(tmp_path / "in" / "a.csv"), str(tmp_path / "gone.csv")])
    assert df.count() == 1
    with pytest.warns(UserWarning):
        assert X.read_text_first(spark, [str(tmp_path / "gone.csv")]) is None
    with pytest.warns(UserWarning, match="no files"):
        assert X.load_source(spark, X.SourceSpec(str(tmp_path / "nowhere"))) is None


def test_catalog_rules(spark, tmp_path):
    write(tmp_path / "contacts", "a.csv", [*PREAMBLE, "ID,Phone,E-Mail", "1,555,a@b"])
    write(tmp_path / "customers", "a.csv", [*PREAMBLE, "Account ID,SAP ID,Name,Other", "1,S1,n,o"])
    write(tmp_path / "registered_products", "a.csv", [*PREAMBLE, "Serial ID", "1"])
    write(tmp_path / "software_sales", "a.csv", ["Geschäftsjahr;Umsatz", "2020;5"])
    write(tmp_path / "opportunities" / "deep", "a.csv", [*PREAMBLE, "ID", "1"])
    specs = source_specs(str(tmp_path))
    specs["software_sales"] = source_specs(str(tmp_path), delimiter=";")["software_sales"]
    with pytest.warns(UserWarning):
        loaded = X.load_all(spark, specs)
    visible = {n: [c for c in df.columns if not c.startswith("_")] for n, df in loaded.items()}
    assert visible == {
        "opportunities": ["ID"],
        "software_sales": ["geschaftsjahr", "umsatz"],
        "customers": ["Account ID", "SAP ID", "Name"],
        "contacts": ["ID"],
        "registered_products": ["Serial ID_reg_prod"],
    }


def test_orders_keep_fan_out_and_clashing_names(spark):
    orders = spark.createDataFrame([("o1", "a"), ("o2", "b"), (None, "c")], "no string, land string")
    header = spark.createDataFrame([("o1", "h"), (None, "never")], "beleg string, land string")
    partner = spark.createDataFrame([("o1", "p1"), ("o1", "p2")], "beleg string, rolle string")
    out = X.enrich_orders(orders, header, partner, "no", "beleg", "beleg")
    got = [(r["no"], r["land.x"], r["land.y"], r["rolle"]) for r in out.collect()]
    assert sorted(got, key=repr) == sorted(
        [("o1", "a", "h", "p1"), ("o1", "a", "h", "p2"), ("o2", "b", None, None), (None, "c", None, None)], key=repr
    )


def test_layers(spark, tmp_path):
    assert L.read_layer(spark, str(tmp_path), "raw", "x") is None
    L.write_layers({"x": spark.range(3)}, str(tmp_path), "raw")
    assert L.read_layers(spark, str(tmp_path), "raw", ["x", "y"])["x"].count() == 3


def test_steps_are_reused_by_key_and_rebuilt_when_incomplete(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    key = L.fingerprint("config", 1)
    assert L.checkpointed(spark, "step", build, key).count() == 1
    assert L.checkpointed(spark, "step", build, key).count() == 1
    assert L.checkpointed(spark, "step", build, L.fingerprint("config", 2)).count() == 2
    # Data without the completion marker is not trusted.
    folder = L.shared_folder(spark)
    spark.range(50).write.parquet(f"{folder}/step/half/data")
    assert L.checkpointed(spark, "step", build, "half").count() == 3


def test_panel_is_written_by_period_with_metadata(spark, tmp_path):
    data = [(f"c{i}", y, i % 2, "DE", float(i), i % 2) for i in range(20) for y in (2000, 2001)]
    df = spark.createDataFrame(data, "customer_id string, year long, ever_treated int, country string, to_sum_val_opps_won double, treatment int")
    paths = L.write_panel(df, str(tmp_path), "panel", PanelKeys())
    back = spark.read.parquet(paths["panel"])
    assert back.count() == 40 and len(list((tmp_path / "panel/panel/year=2000").glob("*.parquet"))) <= 2
    pruned = back.filter(F.col("year") == 2000)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in pruned
    meta = spark.read.parquet(paths["metadata"]).first()
    assert (meta.n_rows, meta.n_customers, meta.n_treated, meta.first_year) == (40, 20, 10, 2000)
    assert spark.read.parquet(paths["summary"]).count() == 2


def test_lines_that_do_not_fit_are_reported_per_file(spark, tmp_path):
    write(tmp_path / "in", "good.csv", ["id,name", "1,a"])
    write(tmp_path / "in", "bad.csv", ["id,name", "1,a,b,c", "2,b"])
    df = X.read_text_first(spark, X.list_sources(spark, str(tmp_path / "in"), "*.csv"))
    report = {r._file.rsplit("/", 1)[1]: (r.has_warnings, r.n_failed) for r in X.warnings_by_file(df).collect()}
    assert report == {"good.csv": (False, 0), "bad.csv": (True, 1)}


def test_line_breaks_in_cells_and_headers_are_records(spark, tmp_path):
    write(tmp_path / "in", "a.csv", [*PREAMBLE, "id,text,n", '1,"line one', 'line two",7', "2,plain,8", "3,too,many,cells", '4,"say ""hi""",9'])
    write(tmp_path / "in", "b.csv", [*PREAMBLE, 'id,"how', 'happy?",n', "5,very,1"])
    write(tmp_path / "in", "c.csv", [*PREAMBLE, "id,text,n", "6,whole,2"])
    df = X.read_text_first(spark, X.list_sources(spark, str(tmp_path / "in"), "*.csv"), preamble=4)
    good = X.fitting(df)
    assert rows(good, "id", "text", "n") == sorted(
        [("1", "line one\nline two", "7"), ("2", "plain", "8"), ("4", 'say "hi"', "9"), ("5", None, "1"), ("6", "whole", "2")], key=repr
    )
    assert rows(good.where("id = 5"), "how\nhappy?") == [("very",)]
    bad = X.quarantine(df).collect()
    assert [r[X.CORRUPT] for r in bad] == ["3,too,many,cells"] and bad[0]["_file"].endswith("a.csv")
    assert {r.has_warnings for r in X.warnings_by_file(df).collect()} == {True, False}


CELLS = ["abc", "", '5" x', '"q, r"', '"a\nb"', '"x ""y"" \n\n z"', '""', '"t"u', '"end\n"', '""""', '"a"b"c', '",\n"",\n"']


@pytest.mark.parametrize("split", ["200", "3000", "128m"])
def test_records_of_splits_equal_reading_whole_files(spark, tmp_path, split):
    rnd = random.Random(7)
    for name in ("a", "b", "c"):
        body = [",".join([str(i), *rnd.choices(CELLS if name != "c" else CELLS[:4], k=3)]) for i in range(300)]
        if name == "b":
            body = ['0,"' + "long\n" * 300 + '",x,y', *body, '300,"never closed\n,x']
        write(tmp_path, f"{name}.csv", body)
    paths, schema = [str(tmp_path / f"{n}.csv") for n in "abc"], "a string, b string, c string, d string"
    options = {"sep": ",", "escape": '"'}
    want = spark.read.schema(schema).options(**options, multiLine=True).csv(paths)
    keys = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, (split, "0")):
            spark.conf.set(k, v)
        found = R.records(spark, paths, ",").where("trim(value) <> ''")
        parsed = found.select("_file", "_block", "_line", F.from_csv("value", schema, options).alias("r")).select("*", "r.*").collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    text = lambda row: tuple(x and x.rstrip("\n") for x in row)
    assert sorted((text(r[4:]) for r in parsed), key=repr) == sorted((text(r) for r in want.collect()), key=repr)
    if split == "200":
        assert len({(r._file, r._block) for r in parsed}) > 50
    placed = [r.a for r in sorted((r for r in parsed if "a.csv" in r._file), key=lambda r: (r._block, r._line))]
    assert placed == [str(i) for i in range(300)]


def test_lines_of_one_split_are_dealt_to_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(R, "CHUNK_LINES", 5, raising=False)
    rnd = random.Random(3)
    body = [",".join([str(i), *rnd.choices(CELLS, k=3)]) for i in range(400)]
    write(tmp_path, "a.csv", ["head", "er", *body, '400,"' + "long\n" * 40 + '",x,y'])
    schema, options = "a string, b string, c string, d string", {"sep": ",", "escape": '"'}
    write(tmp_path, "b.csv", [*body, '400,"' + "long\n" * 40 + '",x,y'])
    want = spark.read.schema(schema).options(**options, multiLine=True).csv(str(tmp_path / "b.csv")).collect()
    keys = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")  # small tables would be put together
    before = {k: spark.conf.get(k) for k in keys}
    try:
        for k, v in zip(keys, ("false", "-1")):
            spark.conf.set(k, v)
        found = R.records(spark, [str(tmp_path / "a.csv")], ",", skip=2).withColumn("task", F.spark_partition_id()).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    parsed = spark.createDataFrame([(r.value,) for r in found], "value string").select(F.from_csv("value", schema, options).alias("r")).select("r.*")
    text = lambda row: tuple(x and x.rstrip("\n") for x in row)
    assert sorted(map(text, parsed.collect()), key=repr) == sorted(map(text, want), key=repr)
    assert {r._block for r in found} == {0} and min(r._line for r in found) == 3
    # Nothing gathers the lines of a split in one task.
    assert len({r.task for r in found}) > 4


def test_preambles_with_quotes_and_long_headers(spark, tmp_path):
    header = 'id,"' + "\n".join(f"line {i}" for i in range(20)) + '",n'
    write(tmp_path / "in", "a.csv", ['by "x', "----", header, '1,"a', 'b",2', "3,c,4"])
    write(tmp_path / "in", "b.csv", ['by "x', "----", "id,n", "5,6"])
    df = X.read_text_first(spark, X.list_sources(spark, str(tmp_path / "in"), "*.csv"), preamble=2)
    assert rows(df, "id", "n") == [("1", "2"), ("3", "4"), ("5", "6")]
    assert [r[0] for r in df.where("id = 1").select("`" + "\n".join(f"line {i}" for i in range(20)) + "`").collect()] == ["a\nb"]


def test_headers_of_many_files_take_one_query(spark, tmp_path):
    def jobs(number):
        paths = [str(tmp_path / f"{i}.csv") for i in range(number)]
        spark.sparkContext.setJobGroup(f"headers {number}", "")
        try:
            found = X._layouts(spark, paths, 1, ",")
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert {x.header for x in found.values()} == {"id,a", "id,b"} and len(found) == number
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"headers {number}"))

    for i in range(400):
        write(tmp_path, f"{i}.csv", ["made by x", f"id,{'ab'[i % 2]}", "1,2"])
    # One query: a listing, its two shuffles and its result.
    assert jobs(40) == jobs(400) <= 4


def test_only_changed_periods_of_a_panel_are_written(spark, tmp_path):
    schema = "customer_id string, year long, ever_treated int, country string, to_sum_val_opps_won double, treatment int"

    def panel(years, raised=()):
        return spark.createDataFrame([(f"c{i}", y, i % 2, "DE", float(i) + (y in raised), i % 2) for i in range(9) for y in years], schema)

    def files():
        return {p: p.stat().st_mtime_ns for p in sorted((tmp_path / "panel/panel").rglob("*.parquet"))}

    def written(df, **options):
        before = files() if (tmp_path / "panel/panel").exists() else {}
        paths = L.write_panel(df, str(tmp_path), "panel", PanelKeys(), **options)
        back = spark.read.parquet(paths["panel"]).select(df.columns)
        assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
        assert spark.read.parquet(paths["metadata"]).first().n_rows == df.count()
        return {p.parent.name for p, at in files().items() if before.get(p) != at}

    assert written(panel([2000, 2001])) == {"year=2000", "year=2001"}
    assert written(panel([2001, 2000])) == set()
    assert written(panel([2000, 2001, 2002])) == {"year=2002"}
    assert written(panel([2000, 2001, 2002], raised=[2001])) == {"year=2001"}
    # A period that is gone, or other columns, replace the table.
    assert written(panel([2001, 2002])) == {"year=2001", "year=2002"}
    assert written(panel([2001, 2002]).withColumn("more", F.lit(1))) == {"year=2001", "year=2002"}
    # A run that was lost while it wrote leaves no mark to be trusted.
    spark.createDataFrame([], L._MARKS).write.mode("overwrite").parquet(str(tmp_path / "panel/periods"))
    assert written(panel([2001, 2002])) == {"year=2001", "year=2002"}
    # Runs with a name of their own leave the others as they are.
    before = files()
    paths = L.write_panel(panel([2005]), str(tmp_path), "panel", PanelKeys(), run="2024-05-01")
    assert paths["panel"].endswith("panel_2024-05-01/panel") and files() == before
