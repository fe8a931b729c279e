"""States of a profile: merged parts equal the whole, from one scan; comparison before and after."""

import datetime as dt

from panelloom.operators import quality as Q

SCHEMA = "part int, id string, amount double, start_date date, end_date date, note string"


def rows(n):
    day = dt.date(2020, 1, 1)
    return [(k % 3, f"i{k % 40}", None if k % 5 == 0 else float(k), day + dt.timedelta(k % 9), None if k % 4 == 0 else day + dt.timedelta(4), None) for k in range(n)]


def test_merged_parts_equal_the_whole(spark):
    df = spark.createDataFrame(rows(200), SCHEMA)
    merged = Q.integrity_profile(Q.merge_states(Q.profile_states(df, ["part"])))
    whole = Q.integrity_profile(Q.profile_states(df.drop("part")))
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
    got = {r.column: r for r in merged.collect()}
    assert set(got) == {"id", "amount", "start_date", "end_date", "note", "start_date > end_date"}
    values = [float(k) for k in range(200) if k % 5]
    assert (got["amount"].missing_count, got["amount"].min, got["amount"].max) == (40, 1.0, 199.0)
    assert abs(got["amount"].mean - sum(values) / len(values)) < 1e-9
    assert abs(got["id"].n_distinct - 40) <= 2 and got["note"].n_distinct == 0 and got["note"].mean is None
    order = got["start_date > end_date"]
    assert order.violations == sum(k % 9 > 4 for k in range(200) if k % 4) and order.n_distinct is None


def test_one_scan_and_empty_tables(spark, tmp_path):
    df = spark.createDataFrame(rows(30), SCHEMA)
    df.write.parquet(str(tmp_path / "d"))
    plan = Q.profile_states(spark.read.parquet(str(tmp_path / "d")))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1
    empty = {r.column: r for r in Q.integrity_profile(Q.profile_states(df.limit(0).drop("part"))).collect()}
    assert empty["amount"].rows == 0 and empty["amount"].missing_percent is None
    assert Q.merge_states(Q.profile_states(df.limit(0), ["part"])).count() == 0


def test_columns_of_one_side(spark):
    df = spark.createDataFrame(rows(30), SCHEMA)
    before, after = (Q.integrity_profile(Q.profile_states(d)) for d in (df.drop("end_date"), df.drop("note")))
    status = {r.column: r.status for r in Q.compare_profiles(before, after).collect()}
    assert status == {"part": "both", "id": "both", "amount": "both", "start_date": "both", "note": "dropped", "end_date": "added", "start_date > end_date": "added"}
