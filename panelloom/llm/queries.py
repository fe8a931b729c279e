"""The registered queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from panelloom.llm import bpe, decontaminate, embeddings, langid, mainhtml, minhash, periodic, sanitise, search, substrings, toxicity, urls, warc
from panelloom.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@_query
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predictions(read_table(spark, sf_dir, "documents"))


@_query
def op2_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(read_table(spark, sf_dir, "documents"))


@_query
def op3_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(read_table(spark, sf_dir, "documents"))


@_query
def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_vectors(read_table(spark, sf_dir, "embeddings"))


@_query
def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sanitise.personal_report(read_table(spark, sf_dir, "documents"))


@_query
def op6_url_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.verdicts(read_table(spark, sf_dir, "pages"))


@_query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leak_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@_query
def op8_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.revisit_report(read_table(spark, sf_dir, "pages"))


@_query
def op9_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mainhtml.page_texts(read_table(spark, sf_dir, "pages"))


@_query
def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeat_report(read_table(spark, sf_dir, "documents"))


@_query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


@_query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_report(periodic.with_planted_runs(read_table(spark, sf_dir, "documents")))


@_query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


ORACLES["op8_revisits"] = warc.ORACLE
