"""Finished steps of a build that are used again while what they were made from is unchanged.

A step's key is a digest of its inputs' files (paths, sizes, modification times), its settings and
this package's code; no row is read for it. A manifest beside the layers holds the key under which a
step's output was last completed, with facts about it such as row counts. The key is withdrawn before
an output is touched and entered after it is complete, so what a lost job left behind is never used.
"""

from __future__ import annotations

import dataclasses
import hashlib
import json
from collections.abc import Callable, Mapping
from functools import lru_cache, partial
from pathlib import Path

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

#: Folder of the manifests under the root of the layers.
MANIFESTS = "manifests"


def files_digest(spark: SparkSession, path: str, glob: str = "*", recursive: bool = True) -> str:
    """Digest of the files under a path: names, sizes and modification times; ``absent`` without any.

    Only metadata is read, in tasks, and one small row comes back however many files there are.
    """
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", recursive)
    try:
        files = reader.load(path).select("path", "length", "modificationTime")
    except PySparkException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return "absent"
        raise
    marks = [F.xxhash64("path", "length", "modificationTime", F.lit(seed)).cast("decimal(38,0)") for seed in (1, 2)]
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("bytes"), *[F.sum(m).alias(f"m{i}") for i, m in enumerate(marks)]).first()
    return ":".join(str(x) for x in row) if row["n"] else "absent"


@lru_cache(maxsize=1)
def code_digest() -> str:
    """Digest of this package's source files: other code never meets outputs of this one."""
    root = Path(__file__).resolve().parents[1]
    found = hashlib.sha256()
    for path in sorted(root.rglob("*.py")):
        if "llm" not in path.relative_to(root).parts:
            found.update(f"{path.relative_to(root)}\0".encode() + path.read_bytes())
    return found.hexdigest()[:16]


def described(value: object) -> object:
    """Settings as plain data that reads the same in every run; functions by name and fixed arguments."""
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        return {f.name: described(getattr(value, f.name)) for f in dataclasses.fields(value)}
    if isinstance(value, Mapping):
        return {str(k): described(v) for k, v in sorted(value.items(), key=lambda kv: str(kv[0]))}
    if isinstance(value, (list, tuple)):
        return [described(v) for v in value]
    if isinstance(value, (set, frozenset)):
        return sorted(json.dumps(described(v), sort_keys=True) for v in value)
    if isinstance(value, partial):
        return ["partial", described(value.func), described(value.args), described(value.keywords)]
    if callable(value):
        inner = [described(cell.cell_contents) for cell in getattr(value, "__closure__", None) or ()]
        return [value.__module__, value.__qualname__, inner, described(getattr(value, "__defaults__", None) or ())]
    return value if value is None or isinstance(value, (bool, int, float, str)) else repr(value)


def step_key(*parts: object) -> str:
    text = json.dumps([code_digest(), *[described(p) for p in parts]], sort_keys=True)
    return hashlib.sha256(text.encode()).hexdigest()[:32]


def _facts(spark: SparkSession, path: str) -> tuple[str | None, dict]:
    try:
        row = spark.read.schema("key string, facts string").json(path).first()
    except PySparkException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    return (row["key"], json.loads(row["facts"])) if row is not None and row["facts"] else (None, {})


def _enter(spark: SparkSession, path: str, key: str | None, facts: Mapping) -> None:
    row = spark.createDataFrame([(key, json.dumps(facts))], "key string, facts string")
    row.coalesce(1).write.mode("overwrite").json(path)


def reused(spark: SparkSession, root: str, step: str, key: str, build: Callable[[], Mapping]) -> tuple[dict, bool]:
    """The facts of a step, and whether its finished output was used again.

    ``build`` writes the output and returns its facts (plain data). It runs when the step was never
    finished under ``key``; an error leaves the step unfinished.
    """
    path = f"{root}/{MANIFESTS}/{step}"
    known, facts = _facts(spark, path)
    if known == key:
        return facts, True
    if known is not None:
        _enter(spark, path, None, {})
    facts = dict(build())
    _enter(spark, path, key, facts)
    return facts, False
