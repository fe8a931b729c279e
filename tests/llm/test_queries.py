"""Registered queries and the pipeline on the smallest data."""

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from panelloom.llm import decontaminate, minhash, queries, sanitise

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - {"op13_ranked_search"}))
def test_one_row_per_row(spark, name):
    out = contract.queries()[name](spark, DATA)
    table = "embeddings" if name.startswith("op4_") else "pages" if name[:3] in ("op6", "op8", "op9") else "documents"
    assert out.count() == spark.read.parquet(f"{DATA}/{table}.parquet").count()


def test_pipeline(spark):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == ["language", "near_copies", "leaks", "personal_data", "tokens"]
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = corpus_pipeline.run(spark, DATA)
    assert out.columns == [*docs.columns, "token_ids", "n_tokens"]
    kept = out.count()
    assert 0.5 * docs.count() < kept <= docs.count()
    assert minhash.near_groups(out).where("NOT kept").count() == 0
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    assert decontaminate.leak_report(out, bench).where("contaminated").count() == 0
    assert sanitise.personal_report(out).where("n_email + n_ip + n_card + n_phone > 0").count() == 0


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_and_empty_tables(spark, k):
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", "en", "s", 0), (3, "the of and", None, None, 3), (3, "the of and", None, None, 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for df in (docs, docs.limit(0), docs.selectExpr("*", "1 AS leaks", "2 AS language", "3 AS personal", "4 AS token_ids")):
        out = corpus_pipeline.STAGES[k][1](spark, df, DATA)
        assert out.columns[: len(df.columns)] == df.columns
        out.collect()
