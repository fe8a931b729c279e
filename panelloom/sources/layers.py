"""Stored layers, step reuse and the final panel, all as Parquet."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.config import PanelKeys
from panelloom.operators.summary import key_variable_summary, panel_metadata
from panelloom.sources.shared import remove_at_exit, shared_folder, stored


def write_layer(df: DataFrame, root: str, layer: str, name: str, compression: str | None = None) -> str:
    path = f"{root}/{layer}/{name}"
    df.write.mode("overwrite").parquet(path, compression=compression)
    return path


def read_layer(spark: SparkSession, root: str, layer: str, name: str) -> DataFrame | None:
    """The stored table, or None if it was never written."""
    return _read(spark, f"{root}/{layer}/{name}")


def _read(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def write_layers(datasets: Mapping[str, DataFrame], root: str, layer: str) -> dict[str, str]:
    return {name: write_layer(df, root, layer, name) for name, df in datasets.items()}


def read_layers(spark: SparkSession, root: str, layer: str, names) -> dict[str, DataFrame]:
    found = {name: read_layer(spark, root, layer, name) for name in names}
    return {name: df for name, df in found.items() if df is not None}


def fingerprint(*parts: object) -> str:
    """Short digest of configuration values and input descriptions."""
    return hashlib.sha256(json.dumps([repr(p) for p in parts]).encode()).hexdigest()[:16]


def checkpointed(
    spark: SparkSession, name: str, build: Callable[[], DataFrame], key: str, folder: str | None = None
) -> DataFrame:
    """A step's stored output if one with the same ``key`` is complete, else build and store it.

    Reading the table back cuts the lineage, and the table outlives lost executors. The
    marker is written after the data, so a half-written step is never reused.
    """
    path = f"{shared_folder(spark, folder)}/{name}/{key}"
    if _read(spark, f"{path}/complete") is None:
        build().write.mode("overwrite").parquet(f"{path}/data")
        spark.range(1).write.mode("overwrite").parquet(f"{path}/complete")
    return spark.read.parquet(f"{path}/data")


def _period_marks(panel: DataFrame, period: str) -> dict[object, tuple]:
    """Number of rows and a digest of all values by period: one small row each."""
    marks = [F.sum(F.xxhash64(*panel.columns, F.lit(seed)).cast("decimal(38,0)")).cast("string").alias(f"mark{seed}") for seed in (1, 2)]
    rows = panel.groupBy(period).agg(F.count(F.lit(1)).alias("n"), *marks).collect()
    return {row[0]: tuple(map(str, row[1:])) for row in rows}


def write_panel(
    panel: DataFrame, root: str, name: str, keys: PanelKeys = PanelKeys(), run: str | None = None
) -> dict[str, str]:
    """The panel by period, with its metadata and a summary of its key variables beside it.

    Only periods whose rows differ from what is stored are written: a run that adds a year writes
    that year. New or fewer columns, and periods that are gone, replace the whole table. With ``run``
    (a date, say) the panel has a folder of its own and earlier runs stay as they are.

    Rows are rebalanced by period: tasks, and with them files, grow with the data, as Spark splits
    large periods and joins small ones by the advisory partition size. Digests of the periods are
    kept beside the panel; those of periods to be written are withdrawn first, so that a lost run's
    half-written periods are written again.
    """
    spark, base = panel.sparkSession, f"{root}/{name}" if run is None else f"{root}/{name}_{run}"
    paths = {part: f"{base}/{part}" for part in ("panel", "metadata", "summary")}
    made = stored(panel, "panel")
    schema = fingerprint(sorted((f.name, f.dataType.simpleString()) for f in made.schema))
    new = {(schema, str(k)): (k, v) for k, v in _period_marks(made, keys.period).items()}
    old = {(r["schema"], r["period"]): tuple(r["marks"]) for r in (_read(spark, f"{base}/periods") or _no_marks(spark)).collect()}
    whole = not old or bool(old.keys() - new.keys())
    changed = [k for k, (_, marks) in new.items() if whole or old.get(k) != marks]

    def enter(known) -> None:
        table = spark.createDataFrame([(*k, list(new[k][1])) for k in known], _MARKS)
        table.coalesce(1).write.mode("overwrite").parquet(f"{base}/periods")

    if changed:
        enter([k for k in new if k not in changed])
        part = made if whole else made.where(_is_among(F.col(keys.period), [new[k][0] for k in changed]))
        writer = part.hint("rebalance", keys.period).write.mode("overwrite").partitionBy(keys.period)
        writer.option("partitionOverwriteMode", "static" if whole else "dynamic").parquet(paths["panel"])
        enter(new)
    panel_metadata(made, keys.entity, keys.period).write.mode("overwrite").parquet(paths["metadata"])
    key_variable_summary(made).write.mode("overwrite").parquet(paths["summary"])
    return paths


_MARKS = "schema string, period string, marks array<string>"


def _no_marks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], _MARKS)


def _is_among(column: Column, values: list) -> Column:
    known = column.isin([v for v in values if v is not None])
    return F.coalesce(known, F.lit(False)) | (column.isNull() if None in values else F.lit(False))
