"""Text-first ingest of delimited extracts whose files may differ in their header.

Nothing is typed on the way in: every column lands as text, together with the position
of the row (``_file``, ``_block``, ``_line``), which later steps use as a total order.
"""

from __future__ import annotations

import csv
import io
import re
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelloom.functions.names import numbered
from panelloom.operators.quality import ingest_warnings
from panelloom.operators.schema import clean_names, suffix_names
from panelloom.sources.records import line_maps, records, split_starts, text_lines

POSITION = ("_file", "_block", "_line")
CORRUPT = "_corrupt"
#: Lines after the preamble that are read at first in search of a header's end.
_HEADER_LINES = 8


@dataclass(frozen=True)
class SourceSpec:
    """Where a dataset's files are and how they are laid out."""

    root: str
    glob: str = "*"
    recursive: bool = False
    preamble: int = 0
    delimiter: str = ","
    tidy_names: bool = False
    suffix: str = ""
    keep: tuple[str, ...] = ()
    drop: tuple[str, ...] = ()


def list_sources(
    spark: SparkSession, root: str, glob: str = "*", recursive: bool = False, pattern: str | None = None
) -> list[str]:
    """Paths of the files under ``root``; only names are read, not contents."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", glob)
    files = reader.option("recursiveFileLookup", recursive).load(root).select("path")
    if pattern is not None:
        files = files.filter(F.regexp_extract("path", "[^/]+$", 0).rlike(pattern))
    return sorted(row.path for row in files.collect())


@dataclass(frozen=True)
class _Layout:
    """A file's header, the number of lines before its body, and whether its records may span lines."""

    header: str
    skip: int
    spans: bool


def _present(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The paths that exist; the others are reported. No job reads them for that."""
    found = []
    for path in paths:
        try:
            spark.read.text(path)
            found.append(path)
        except PySparkException as error:
            warnings.warn(f"skipping {path}: {error.getCondition() or error}", stacklevel=3)
    return found


def _layouts(spark: SparkSession, paths: Sequence[str], preamble: int, delimiter: str) -> dict[str, _Layout]:
    """Layouts by path, from one query over all files; a file without a header is reported.

    Lines are told by their distance from the file's first line, so none are sorted, and no more than the
    asked first lines of a file come here. Headers with line breaks in quotes that are longer than these
    ask again.
    """
    try:
        lines = text_lines(spark, paths)
    except PySparkException:
        paths = _present(spark, paths)
        if not paths:
            return {}
        lines = text_lines(spark, paths)
    maps = line_maps(lines, delimiter).groupBy("_file").agg(F.max("_opens").alias("spans"))
    flags = maps.select("_file", F.lit(0).alias("n"), F.lit(None).cast("string").alias("value"), "spans")
    heads: dict[str, list[str]] = {}
    spans: dict[str, bool] = {}
    found: dict[str, _Layout] = {}
    asked, ahead = {_located(path): path for path in paths}, _HEADER_LINES
    while asked:
        starts = F.broadcast(split_starts(lines).where(F.col("_block") == 0).drop("_block"))
        first = lines.where(F.col("_block") == 0).join(starts, "_file")
        first = first.select("_file", (F.col("_seq") - F.col("_split") + 1).alias("n"), "value")
        first = first.where(F.col("n") <= preamble + ahead).withColumn("spans", F.lit(None).cast("boolean"))
        for row in sorted((first if spans else first.union(flags)).collect(), key=lambda r: r.n):
            if row.n == 0:
                spans[_located(row._file)] = row.spans
            else:
                heads.setdefault(_located(row._file), []).append(row.value)
        longer = {}
        for where, path in asked.items():
            head = heads.get(where, [])
            ends = [end for end in range(preamble + 1, len(head) + 1) if "\n".join(head[preamble:end]).count('"') % 2 == 0]
            if len(head) <= preamble:
                warnings.warn(f"skipping {path}: no header after {preamble} preamble lines", stacklevel=3)
            elif ends or len(head) < preamble + ahead:
                end = ends[0] if ends else len(head)
                found[path] = _Layout("\n".join(head[preamble:end]), end, spans[where])
            else:
                longer[where] = path
        asked, ahead = longer, 4 * ahead
        if asked:
            heads, lines = {}, text_lines(spark, list(asked.values()))
    return found


def _header_names(line: str, delimiter: str) -> list[str]:
    """Column names of a header line, honouring quotes; blank names get a number."""
    names = next(csv.reader(io.StringIO(line, newline=""), delimiter=delimiter))
    return numbered(name.strip() or f"column_{i + 1}" for i, name in enumerate(names))


def _body(spark: SparkSession, paths: Sequence[str], skip: int) -> DataFrame:
    """Lines after the first ``skip`` of every file, with their position.

    Files stay splittable. Only the first block of a file can hold the lines to skip, so only
    there lines are numbered, from the first one's place (a row per file); no line is shuffled.
    """
    lines = text_lines(spark, paths)
    starts = split_starts(lines).where(F.col("_block") == 0)
    placed = lines.join(F.broadcast(starts), ["_file", "_block"], "left")
    number = F.when(F.col("_block") == 0, F.col("_seq") - F.col("_split") + 1).otherwise(F.col("_seq"))
    # Later filters may be moved before the one here, so lines to skip have no text to be read.
    value = F.when((F.col("_block") > 0) | (number > skip), F.col("value"))
    return placed.select("_file", "_block", number.alias("_line"), value.alias("value")).where("value IS NOT NULL")


def _located(path: str) -> str:
    """A path in one spelling: file metadata quotes names and writes file:///, listings file:/."""
    return re.sub("^file:/+", "/", unquote(path))


def read_text_first(
    spark: SparkSession, paths: Sequence[str], preamble: int = 0, delimiter: str = ","
) -> DataFrame | None:
    """All files as one table of text columns; absent columns are NULL.

    A file that is missing or has no header is skipped with a warning. Files are grouped
    by header first, so the plan has one branch per distinct header, not per file.
    All files stay splittable; where quoted cells span lines, splits learn from each other where
    their records begin (see ``records``). ``_corrupt`` holds records that do not fit their header
    (see ``quarantine``).
    """
    layouts = _layouts(spark, paths, preamble, delimiter) if paths else {}
    alike: dict[_Layout, list[str]] = {}
    for path in paths:
        if path in layouts:
            alike.setdefault(layouts[path], []).append(path)
    by_header: dict[str, list[DataFrame]] = {}
    for layout, files in alike.items():
        body = records(spark, files, delimiter, layout.skip) if layout.spans else _body(spark, files, layout.skip)
        by_header.setdefault(layout.header, []).append(body.select(*POSITION, "value"))
    parts = []
    for header, bodies in by_header.items():
        fields = [*_header_names(header, delimiter), CORRUPT]
        schema = ", ".join(f"`{c.replace('`', '``')}` STRING" for c in fields)
        options = {"sep": delimiter, "escape": '"', "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        body = reduce(DataFrame.unionByName, bodies).filter(F.trim("value") != "")
        parsed = body.select(*POSITION, F.from_csv("value", schema, options).alias("_row"))
        parts.append(parsed.select(*POSITION, *[F.col("_row").getField(c).alias(c) for c in fields]))
    if not parts:
        warnings.warn("no files were loaded", stacklevel=2)
        return None
    return union_fill(parts)


def warnings_by_file(df: DataFrame) -> DataFrame:
    """Which files hold lines that do not fit their header, and how many."""
    return ingest_warnings(df.withColumn("_failed", F.col(CORRUPT).isNotNull()), "_file", "_failed")


def quarantine(df: DataFrame) -> DataFrame:
    """The records that do not fit their header: where they stand, and their text."""
    return df.filter(F.col(CORRUPT).isNotNull()).select(*POSITION, CORRUPT)


def fitting(df: DataFrame) -> DataFrame:
    """The records that fit their header, without the quarantine column."""
    return df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT) if CORRUPT in df.columns else df


def union_fill(tables: Sequence[DataFrame | None]) -> DataFrame | None:
    """Stack tables by column name; absent columns are NULL, absent tables are left out."""
    present = [t for t in tables if t is not None]
    if not present:
        return None
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), present)


def load_source(spark: SparkSession, spec: SourceSpec) -> DataFrame | None:
    """Read the files of one dataset and apply its column rules."""
    try:
        paths = list_sources(spark, spec.root, spec.glob, spec.recursive)
    except PySparkException as error:
        warnings.warn(f"no files under {spec.root}: {error.getCondition() or error}", stacklevel=2)
        return None
    df = read_text_first(spark, paths, spec.preamble, spec.delimiter)
    if df is None:
        return None
    inner = (*POSITION, CORRUPT)
    if spec.keep:
        df = df.select(*inner, *[f"`{c}`" for c in spec.keep if c in df.columns])
    df = df.drop(*spec.drop)
    names = [c for c in df.columns if c not in inner]
    body = df.select(*[f"`{c}`" for c in names])
    if spec.tidy_names:
        body = clean_names(body)
    if spec.suffix:
        body = suffix_names(body, spec.suffix)
    return df.withColumnsRenamed(dict(zip(names, body.columns)))


def load_all(spark: SparkSession, specs: Mapping[str, SourceSpec]) -> dict[str, DataFrame]:
    """Every dataset that has files; the others are reported by a warning and left out."""
    loaded = {name: load_source(spark, spec) for name, spec in specs.items()}
    return {name: df for name, df in loaded.items() if df is not None}


def drop_columns_like(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Remove columns (such as phone and mail of contacts) before anything is stored."""
    return df.drop(*names)


def enrich_orders(
    orders: DataFrame,
    header: DataFrame | None,
    partner: DataFrame | None,
    order_key: str,
    header_key: str,
    partner_key: str,
) -> DataFrame:
    """Orders with order header and partner roles; several partners give several rows.

    Column names that occur on both sides get ``.x`` (left) and ``.y`` (right). An order
    without a number matches nothing.
    """
    out = orders
    for side, key in ((header, header_key), (partner, partner_key)):
        if side is None:
            continue
        clash = {c for c in side.columns if c in out.columns and c != key and c != order_key}
        left = out.withColumnsRenamed({c: f"{c}.x" for c in clash})
        right = side.withColumnsRenamed({c: f"{c}.y" for c in clash} | {key: "_key"})
        out = left.join(right, left[order_key] == right["_key"], "left").drop("_key")
    return out
