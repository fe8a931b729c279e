"""Registration of queries: a builder, an output shape and (where SQL can) an oracle."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.workloads.fixtures import VIEWS, Tables

# Kind -> (Spark expression, SQL expression). Doubles are compared after rounding; the
# tiny shift keeps sums that differ in the last bit on the same side of a rounding step.
_SHAPES: dict[str, tuple[Callable[[Column], Column], str]] = {
    "long": (lambda c: c.cast("long"), "CAST({c} AS BIGINT)"),
    "text": (lambda c: c.cast("string"), "CAST({c} AS VARCHAR)"),
    "bool": (lambda c: c.cast("boolean"), "CAST({c} AS BOOLEAN)"),
    "date": (lambda c: c.cast("date"), "CAST({c} AS DATE)"),
    "ts": (lambda c: c.cast("timestamp_ntz"), "CAST({c} AS TIMESTAMP)"),
    "ratio": (lambda c: F.round(c.cast("double") + 1e-9, 6), "round(CAST({c} AS DOUBLE) + 1e-9, 6)"),
    "money": (lambda c: F.round(c.cast("double") + 1e-6, 4), "round(CAST({c} AS DOUBLE) + 1e-6, 4)"),
}


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    shape: str
    sql: str | None

    def run(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        df = self.build(Tables(spark, sf_dir))
        return df.select(*[_SHAPES[kind][0](F.col(f"`{c}`")).alias(c) for c, kind in _fields(self.shape)])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        columns = ", ".join(f'{_SHAPES[kind][1].format(c=_quoted(c))} AS {_quoted(c)}' for c, kind in _fields(self.shape))
        ctes = _needed(self.sql) | {"_result": self.sql}
        return "WITH " + ",\n".join(f"{n} AS ({q})" for n, q in ctes.items()) + f"\nSELECT {columns} FROM _result"


def _quoted(name: str) -> str:
    return f'"{name}"'


def _fields(shape: str) -> list[tuple[str, str]]:
    return [tuple(f.split(":")) for f in shape.split()]


QUERIES: dict[str, Query] = {}

# Named building blocks of the oracles, in order of dependency.
CTES: dict[str, str] = dict(VIEWS)


def cte(name: str, sql: str) -> None:
    CTES[name] = sql


def _needed(sql: str) -> dict[str, str]:
    wanted: set[str] = set()
    stack = [sql]
    while stack:
        text = stack.pop()
        for name in CTES:
            if name not in wanted and re.search(rf"\b(FROM|JOIN) {name}\b", text):
                wanted.add(name)
                stack.append(CTES[name])
    return {n: q for n, q in CTES.items() if n in wanted}


def query(name: str, shape: str, sql: str | None = None):
    def register(build: Callable[[Tables], DataFrame]):
        QUERIES[name] = Query(name, build, shape, sql)
        return build

    return register
