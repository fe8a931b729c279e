"""Parsers, column-level conversion, names, de-duplication and cleaners."""

import datetime as dt

import pytest
from conftest import rows
from pyspark.sql import functions as F

from panelloom.functions import names as N
from panelloom.functions import parsing as P
from panelloom.operators import cleaning as E
from panelloom.operators import convert as V
from panelloom.operators import quality as Q
from panelloom.operators import schema as S
from panelloom.plans import cleaners


def parsed(spark, expression, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.out for r in df.orderBy("i").select(expression(F.col("v")).alias("out")).collect()]


def test_numbers(spark):
    texts = ["1,234.5", "12,34", "$ 99", "50%", "n/a", "", None, "-3", "1.2.3", "€ 1,5 "]
    assert parsed(spark, P.number, texts) == [1234.5, 12.34, 99.0, 0.5, None, None, None, -3.0, None, 1.5]


def test_booleans(spark):
    assert parsed(spark, P.boolean, [" Yes", "X", "off", "", "maybe", None]) == [True, True, False, False, None, None]


def test_serials(spark):
    assert parsed(spark, P.serial_date, ["43831", "43831.9", "x", "99999999999"]) == [dt.date(2020, 1, 1)] * 2 + [None, None]
    assert parsed(spark, P.serial_timestamp, ["43831.5", "1e300"]) == [dt.datetime(2020, 1, 1, 12), None]


def test_calendar_week(spark):
    assert parsed(spark, lambda c: P.calendar_week(c)["year"], ["2020/7", "7/2020", ""]) == [2020, None, None]
    assert parsed(spark, lambda c: P.calendar_week(c)["week"], ["2020/7", "2020-52", "x"]) == [7, 52, None]


def texts(spark, **columns):
    names = list(columns)
    data = list(zip(*columns.values()))
    return spark.createDataFrame(data, ", ".join(f"{n} string" for n in names))


@pytest.mark.parametrize(
    "values, reading",
    [
        (["2020-01-31", "2020/2/3", "20200304"], "date:ymd"),
        (["31.01.2020", "1.2.2020"], "date:dmy"),
        (["01-31-2020", "12-25-2020"], "date:mdy"),
        (["31.01.2020 10:00:00"], "date:dmy_hms"),
        (["43831", "43832"], "serial_date"),
        (["nothing", "here"], "text"),
    ],
)
def test_date_layout_is_chosen_per_column(spark, values, reading):
    plan = V.plan_conversion(texts(spark, d=values), V.ConversionSpec(dates=("d",)))
    assert plan.chosen == {"d": reading}


def test_rare_layouts_fall_back_to_mixed_reading(spark):
    values = ["31.01.2020"] + ["2020-13-45"] * 19 + ["2020-05-01"]
    plan = V.plan_conversion(texts(spark, d=values), V.ConversionSpec(dates=("d",)))
    assert plan.chosen == {"d": "mixed_dates"}
    got = [r.d for r in plan.apply(texts(spark, d=values)).collect()]
    assert got[0] == dt.date(2020, 1, 31) and got[-1] == dt.date(2020, 5, 1) and got[1] is None


def test_dates_after_the_latest_do_not_count(spark):
    df = texts(spark, d=["01.01.2099"] * 3)
    assert V.plan_conversion(df, V.ConversionSpec(dates=("d",), latest_date="2045-12-31")).chosen["d"] == "mixed_dates"


def test_gate_keeps_text_below_five_percent(spark):
    few = ["1"] + ["word"] * 30
    assert V.plan_conversion(texts(spark, n=few), V.ConversionSpec(numeric=("n",))).chosen["n"] == "text"
    many = ["1"] * 101 + ["word"] * 5000
    assert V.plan_conversion(texts(spark, n=many), V.ConversionSpec(numeric=("n",))).chosen["n"] == "text"
    assert V.plan_conversion(texts(spark, n=many), V.ConversionSpec(numeric=("n",), min_count=100)).chosen["n"] == "number"
    assert V.plan_conversion(texts(spark, n=[None]), V.ConversionSpec(numeric=("n",))).chosen["n"] == "text"


def test_timestamps_ignore_the_session_time_zone(spark):
    df = texts(spark, t=["2020-03-29 02:30:00", "bad"])
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
        assert [r.t for r in V.parse_timestamps(df, ["t"]).collect()] == [dt.datetime(2020, 3, 29, 2, 30), None]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_report_lists_failing_examples(spark):
    df = texts(spark, n=["1", "b", "a", "a", "c", "d", "e", "f", None])
    plan = V.plan_conversion(df, V.ConversionSpec(numeric=("n",)))
    row = V.conversion_report(df, plan).first()
    assert (row.non_null, row.valid, row.nulls_introduced) == (8, 1, 7)
    assert row.examples == "a | b | c | d | e"


def test_names():
    assert N.clean_name("Größe (m²) %") == "grosse_m2_percent"
    assert N.clean_name("5. Generation") == "x5_generation"
    assert N.clean_name("startDate") == "start_date"
    assert N.numbered(["a", "a", "b", "a"]) == ["a", "a_2", "b", "a_3"]
    assert N.question_name("How many\r\nproducts? (1 = few)") == "how_many_products"


def test_one_question_may_feed_two_columns(spark):
    df = texts(spark, how_long=["3"], other=["x"])
    out = S.label_questions(df, {"investment": "how_.*", "implementation": "how_.*"})
    assert out.columns == ["other", "investment", "implementation"]


def test_dedupe_keeps_the_first_row_even_for_hot_and_null_keys(spark):
    data = [(None if i % 3 == 0 else "hot", i, f"row {i}") for i in range(1000)]
    df = spark.createDataFrame(data, "k string, i int, v string").repartition(8)
    assert rows(E.dedupe_first(df, ["k"], ["i"]), "k", "v") == [("hot", "row 1"), (None, "row 0")]
    plan = E.dedupe_first(df, ["k"], ["i"])._jdf.queryExecution().toString()
    assert "Window" not in plan and "partial_min_by" in plan


def test_survey_scores_and_quality(spark):
    df = spark.createDataFrame(
        [(1, None, 4, 4), (2, 3, 3, 3), (3, 1, 7, 1), (4, None, None, None)],
        "id int, core_competency int, hardware_proximity int, competitor_count int",
    )
    items = E.likert_columns(df, exclude=["id"])
    assert items == ["core_competency", "hardware_proximity", "competitor_count"]
    out = E.response_quality(E.likert_scores(df, items), items)
    assert rows(out, "id", "core_alignment_score", "straight_line_responses", "response_range") == [
        (1, None, True, 0),
        (2, 6, True, 0),
        (3, 8, False, 6),
        (4, None, True, None),
    ]
    assert "likert" not in E.likert_columns(df.withColumn("likert", F.lit(9)))


def test_quality_profiles(spark):
    df = spark.createDataFrame(
        [("a", None, dt.date(2020, 1, 2), dt.date(2020, 1, 1)), ("a", None, None, dt.date(2020, 1, 1))],
        "customer_id string, empty string, start_date date, end_date date",
    )
    assert S.drop_empty_columns(df).columns == ["customer_id", "start_date", "end_date"]
    assert rows(Q.missing_profile(df, top=2), "column", "missing_count", "missing_percent") == [("empty", 2, 100.0), ("start_date", 1, 50.0)]
    check = Q.date_order_check(df).first()
    assert (check.both_present, check.violations, check.violation_percent) == (1, 1, 100.0)
    nulls = spark.createDataFrame([("a",), (None,)], "customer_id string")
    assert Q.distinct_profile(nulls).first().n_distinct == 2
    assert set(Q.integrity_check(df)) == {"types", "missing", "distinct", "dates"}
    assert rows(Q.type_profile(df, ["gone"]).filter("item = 'missing_column'"), "name") == [("gone",)]


def test_every_cleaner_runs_and_reports_failures(spark):
    position = {"_file": "f", "_block": 0, "_line": 1}

    def raw(**cells):
        data = [(*position.values(), *cells.values()), (position["_file"], 0, 2, *cells.values())]
        schema = "_file string, _block int, _line int, " + ", ".join(f"`{c.replace('__', ' ')}` string" for c in cells)
        return spark.createDataFrame(data, schema)

    datasets = {
        "quotes": raw(id="1", customer_id="7", total="$ 5,50", date="01.02.2020", status="Open "),
        "software_sales": raw(endkunde="7", umsatz="1.234", gultig_ab="20200131", x5_generation="BOOST"),
        "machine_orders": raw(Equipmentnummer="9", Anschaffungsdatum="31.01.2020", Nettowert="10"),
        "installed_base": raw(equipment_number="9", start_up_1_date="2020-01-31", customer_number="7"),
        "missions": raw(mission_id="5", cw="2020/7", waiting_time_days="3", missions_delayed="Mission delayed"),
        "customers": raw(Account__ID="7", SAP__ID="S7", Name=" A  B "),
        "contacts": raw(id="1", account_id="7", created="31.01.2020"),
        "meetings": raw(id="1", account_id="7", start_date_time="31.01.2020 10:00:00", end_date_time="31.01.2020 11:30:00"),
        "mails": raw(id="1", account_id="7", sent_on="31.01.2020 07:59:00", subject="re: see attached"),
        "other_activities": raw(id="1", start_date_time="31.01.2020 17:10:00", end_date_time="31.01.2020 17:00:00"),
        "registered_products": raw(id_reg_prod="1", warranty_end_date_reg_prod="31.12.2019", customer_id_reg_prod="7"),
        "survey": raw(How__many__competitor__products__do__exist="3", How__would__you__rate__the__competitions__best__alternative="4"),
        "unknown_dataset": raw(a="1"),
    }
    cleaned, errors = cleaners.clean_all(datasets, as_of="2020-06-30")
    assert set(errors) == {"unknown_dataset"}
    first = {name: df.collect() for name, df in cleaned.items()}
    assert all(len(found) == 1 for name, found in first.items() if name != "survey")
    assert first["quotes"][0].tq_total_value == 5.5 and first["quotes"][0].tq_year == 2020
    assert first["software_sales"][0].ts_year == 2020
    assert first["customers"][0].customer_name == "A B"
    assert first["meetings"][0].meeting_duration_minutes == 90.0 and first["meetings"][0].meeting_weekday == "Friday"
    assert first["mails"][0].is_business_hours is False and first["mails"][0].has_attachment is True
    assert first["other_activities"][0].duration_suspicious is True
    assert first["registered_products"][0].warranty_status == "expired"
    assert first["survey"][0].competition_pressure == 7
    assert first["contacts"][0].data_quality_score == 1.0


def test_accidental_parses_never_replace_a_large_column(spark):
    df = spark.range(100_000).select(F.when(F.col("id") < 200, F.col("id").cast("string")).otherwise("words").alias("n"))
    assert V.plan_conversion(df, V.ConversionSpec(numeric=("n",))).chosen["n"] == "text"


def test_unparsed_texts_are_kept(spark):
    df = texts(spark, n=["1", "2", "many", None])
    out = V.convert_types(df, V.ConversionSpec(numeric=("n",)), keep_unparsed=True)
    assert rows(out, "n", "n_unparsed") == sorted([(1.0, None), (2.0, None), (None, "many"), (None, None)], key=repr)


def test_amounts_in_other_spellings(spark):
    amounts = {"1.234,56": 1234.56, "12,50 EUR": 12.5, "(12)": -12.0, "$1,234.50": 1234.5, "1,234": 1234.0, "40 %": 0.4, "-3": -3.0, "1.5": 1.5}
    df = spark.createDataFrame([(k,) for k in amounts], "t string").select("t", P.number(F.col("t")).alias("v"))
    assert {r.t: r.v for r in df.collect()} == pytest.approx(amounts)


def test_opportunity_dates_are_read_value_by_value(spark):
    from panelloom.plans import cleaners

    texts = ["2020-03-25", "2021-04-26", "2019-05-27"] + [f"{d}.06.2018" for d in range(20, 26)] + ["43831"]
    rows = [(str(k), t, "2020-01-01", k) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "ID string, `Close Date` string, `Start Date` string, _line int")
    out = {r.to_id: str(r.to_close_date) for r in cleaners.clean(df, cleaners.OPPORTUNITIES, ["_line"]).collect()}
    want = texts[:3] + [f"2018-06-{d}" for d in range(20, 26)] + ["2020-01-01"]
    assert out == {str(k): w for k, w in enumerate(want)}


def test_layouts_are_chosen_by_file_with_the_column_behind_them(spark):
    from panelloom.operators import convert as V

    data = [("a", f"{d:02}.03.2001") for d in range(1, 29)] + [("b", f"03/{d:02}/2002") for d in range(1, 29)]
    data += [("c", "31.12.2003"), ("c", "no date"), (None, "2004-05-06"), ("d", None), ("e", "never"), ("a", "later")]
    df = spark.createDataFrame(data, "file string, day string")
    spec = V.ConversionSpec(dates=("day",))
    got = {(r.file, str(r.day), r.day_unparsed) for r in V.convert_by_group(df, spec, "file").collect()}
    assert got == (
        {("a", f"2001-03-{d:02}", None) for d in range(1, 29)}
        | {("b", f"2002-03-{d:02}", None) for d in range(1, 29)}
        | {("c", "2003-12-31", None), ("c", "None", "no date"), (None, "2004-05-06", None), ("d", "None", None), ("e", "None", "never"), ("a", "None", "later")}
    )
    # Counts of files seen apart add up to those of all files.
    parts = [V.layout_evidence(df.where(w), spec, "file") for w in ("file = 'a'", "file <> 'a' OR file IS NULL")]
    both, whole = (V.merged_evidence(e) for e in (parts[0].union(parts[1]), V.layout_evidence(df, spec, "file")))
    assert sorted(map(str, both.collect())) == sorted(map(str, whole.collect()))
    assert V.convert_by_group(df, V.ConversionSpec(), "file").columns == df.columns
