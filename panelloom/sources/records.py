"""Where the records of delimited text begin, when quoted cells hold line breaks.

A line break inside a quoted cell does not end a record, so whether a line begins one depends on all
lines before it. That dependence is a function of two states, outside and inside of a quoted cell:
each line maps the state at its start to the state at its end, and such maps compose. So files stay
splittable:

1. each line's map is computed alone (``line_maps``);
2. splits are cut into chunks of a fixed number of lines; within a chunk the maps are composed by
   running totals, and the chunk's own map is one small row;
3. the chunks' maps are composed along each file, which gives the state at the start of every chunk;
4. with it every chunk knows its record starts. Lines of one record are joined within the chunk;
   only a record that crosses a chunk's end meets its other parts by a shuffle.

Chunks are dealt to several times as many tasks as there are splits, so what a task holds depends
neither on the size of a split nor on that of the input.

A quote opens a cell only at the cell's start; inside, two of them stand for one. Elsewhere quotes
are ordinary characters, as the CSV reader takes them. The records equal those of a reader that goes
through each file from its beginning; only a cell that is never closed ends without the file's last
line break.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# States within a line: text outside, start of a cell, inside of quotes, after a quote inside.
_TEXT, _START, _INSIDE, _QUOTE = range(4)
_AT_QUOTE = {_TEXT: _TEXT, _START: _INSIDE, _INSIDE: _QUOTE, _QUOTE: _INSIDE}

#: Lines of a chunk, and the tasks that a split's chunks are dealt to.
CHUNK_LINES = 1 << 14
TASKS_PER_SPLIT = 16


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All lines with their file, split and order: ``_file, _block, _seq, value``."""
    return spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_seq"),
        "value",
    )


def split_starts(lines: DataFrame) -> DataFrame:
    """One row per split: ``_file, _block`` and the ``_seq`` of its first line, which names the split as well."""
    return lines.groupBy("_file", "_block").agg(F.min("_seq").alias("_split"))


def _ends_inside(value: Column, delimiter: str, inside: bool) -> Column:
    """Whether a line ends inside a quoted cell, when it begins so or not."""
    parts = F.split(value, '"')
    outside = lambda text: F.when(text.endswith(delimiter), _START).otherwise(_TEXT)
    first = F.lit(_INSIDE) if inside else F.when(parts[0] == "", _START).otherwise(outside(parts[0]))

    def step(state: Column, text: Column) -> Column:
        """The state after a quote and the text up to the next one."""
        met = F.lit(_TEXT)
        for before, after in _AT_QUOTE.items():
            met = F.when(state == before, after).otherwise(met)
        return F.when((text == "") | (met == _INSIDE), met).otherwise(outside(text))

    after = F.aggregate(F.slice(parts, 2, F.size(parts)), first, step)
    return F.when(value.contains('"'), after == _INSIDE).otherwise(F.lit(inside))


def line_maps(lines: DataFrame, delimiter: str) -> DataFrame:
    """Adds each line's map: ``_opens`` (the end state from outside) and ``_stays`` (from inside)."""
    return lines.withColumns(
        {"_opens": _ends_inside(F.col("value"), delimiter, False), "_stays": _ends_inside(F.col("value"), delimiter, True)}
    )


def _composed(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    """Adds the composition of all maps before a row: ``_set`` (the state that some earlier map
    set whatever came before it, or NULL) and ``_flips`` (how often it was turned since)."""
    until = Window.partitionBy(*keys).orderBy(*order)
    flip = (F.col("_opens") & ~F.col("_stays")).cast("int")
    df = df.withColumn("_turns", F.sum(flip).over(until.rowsBetween(Window.unboundedPreceding, 0)))
    sets = F.when(F.col("_opens") == F.col("_stays"), F.struct(F.col("_opens").alias("state"), F.col("_turns").alias("turns")))
    last = F.last(sets, ignorenulls=True).over(until.rowsBetween(Window.unboundedPreceding, -1))
    df = df.withColumn("_last", last)
    flips = F.col("_turns") - flip - F.coalesce(F.col("_last.turns"), F.lit(0))
    return df.withColumns({"_set": F.col("_last.state"), "_flips": flips}).drop("_last")


def _state(start: Column) -> Column:
    """The state before a row, from the state at the start of its group."""
    return F.coalesce(F.col("_set"), start) != (F.col("_flips") % 2 == 1)


def _chunk_states(lines: DataFrame, splits: DataFrame) -> DataFrame:
    """One row per chunk: its file and split, its number along the file (``_at``), and the state at its start and end."""
    turned = F.sum((F.col("_opens") & ~F.col("_stays")).cast("int"))
    last = F.max(F.when(F.col("_opens") == F.col("_stays"), F.struct("_line", F.col("_opens").alias("state"), F.col("_turns").alias("turns"))))
    chunks = lines.groupBy("_split", "_chunk").agg(last.alias("last"), turned.alias("turned"))
    odd = (F.col("turned") - F.coalesce(F.col("last.turns"), F.lit(0))) % 2 == 1
    maps = chunks.join(splits, "_split").select(
        "_file",
        "_block",
        "_split",
        "_chunk",
        (F.coalesce(F.col("last.state"), F.lit(False)) != odd).alias("_opens"),
        (F.coalesce(F.col("last.state"), F.lit(True)) != odd).alias("_stays"),
    )
    along = Window.partitionBy("_file").orderBy("_block", "_chunk")
    before = _composed(maps, ["_file"], "_block", "_chunk").withColumns(
        {"_at": F.row_number().over(along), "_starts_inside": _state(F.lit(False))}
    )
    ends = F.when(F.col("_starts_inside"), F.col("_stays")).otherwise(F.col("_opens"))
    return before.select("_file", "_block", "_split", "_chunk", "_at", "_starts_inside", ends.alias("_ends_inside"))


def _glued(pieces: Column) -> Column:
    return F.array_join(F.transform(F.array_sort(pieces), lambda p: p["value"]), "\n")


def records(spark: SparkSession, paths: Sequence[str], delimiter: str, skip: int = 0) -> DataFrame:
    """``_file, _block, _line, value``: one row per record, which stands where its first line does.

    The first ``skip`` lines of each file are none. Every chunk of a split is worked through by itself.
    """
    read = text_lines(spark, paths)
    splits, tasks = split_starts(read), TASKS_PER_SPLIT * read.rdd.getNumPartitions()
    chunk = ["_split", "_chunk"]
    # A row per split is sent to the tasks that read it; the file's name does not travel with each line.
    lines = line_maps(read, delimiter).join(F.broadcast(splits), ["_file", "_block"])
    lines = lines.withColumn("_line", F.col("_seq") - F.col("_split") + 1).where((F.col("_block") > 0) | (F.col("_line") > skip))
    lines = lines.select("_split", F.floor((F.col("_line") - 1) / CHUNK_LINES).alias("_chunk"), "_line", "value", "_opens", "_stays")
    lines = _composed(lines.repartition(tasks, *chunk), chunk, "_line")
    states = _chunk_states(lines, splits)

    order = Window.partitionBy(*chunk).orderBy("_line")
    known = lines.join(states.select(*chunk, "_starts_inside"), chunk).withColumn("_begins", ~_state(F.col("_starts_inside")))
    number = F.sum(F.col("_begins").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    pieces = (
        known.withColumn("_record", number)
        .groupBy(*chunk, "_record")
        .agg(F.min("_line").alias("_line"), _glued(F.collect_list(F.struct("_line", "value"))).alias("value"))
        .join(states, chunk)
    )
    # The last piece of a chunk that ends inside a cell goes on; piece 0 goes on from an earlier chunk.
    last = F.max("_record").over(Window.partitionBy(*chunk))
    pieces = pieces.withColumn("_open", F.col("_ends_inside") & (F.col("_record") == last))
    whole = pieces.where("NOT _open AND _record > 0").select("_file", "_block", "_line", "value")
    parts = pieces.where("_open OR _record = 0")
    along = Window.partitionBy("_file").orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    owner = F.max(F.when(F.col("_record") > 0, F.col("_at"))).over(along)
    # One or two rows per chunk: a tail, which belongs to the last head before its chunk, and a head.
    parts = parts.withColumn("_owner", F.when(F.col("_record") > 0, F.col("_at")).otherwise(owner))
    head = F.max(F.when(F.col("_record") > 0, F.struct("_block", "_line")))
    joined = parts.groupBy("_file", "_owner").agg(
        head.alias("_head"), _glued(F.collect_list(F.struct("_at", "_line", "value"))).alias("value")
    )
    return whole.unionByName(joined.select("_file", "_head._block", "_head._line", "value"))
