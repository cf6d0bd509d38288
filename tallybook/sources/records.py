"""Records of delimited text whose quoted fields may hold line breaks, read in parallel.

Files are split at any byte and read as lines, once, into a written table that holds
each line's place and what it does to an open quote. A line is a function on two states,
outside and inside a quoted field, and most lines leave both as they are; only the others
(the first and last lines of a record with breaks) are looked at to learn the state at
the start of every block, by running compositions within blocks and then over a file's
blocks. Blocks where every line is a record stay where they are; the lines of the other
blocks are put together within their block, and what a block's end tears apart meets in
one more grouping.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tallybook.errors import FormatDetectionError
from tallybook.workspace import stage

#: A record of several lines may be this long: a quote that is never closed must not gather a whole file.
RECORD_BYTES = 1 << 20
#: Blocks are broadcast (40 bytes each) up to this many; beyond, the join moves rows.
BROADCAST_BLOCKS = 500_000

# What a line's text does, quote by quote: at a field's start, inside a bare field, inside quotes,
# right after a closing quote.
_START, _BARE, _QUOTED, _CLOSED = range(4)


@dataclass(frozen=True)
class Lines:
    """The written lines of a file or folder, judged under some delimiters."""

    rows: DataFrame
    delimiters: tuple[str, ...]
    #: One written row per block: its lines and, per delimiter, how many of them turn quotes and their cells.
    blocks: DataFrame
    #: Delimiters under which some block is not whole; the others need no look at single lines.
    torn: frozenset[str]

    def judged(self, delimiter: str) -> DataFrame:
        """Lines with open_out, open_in (a quote is open after it, by state before) and cells_out, cells_in (its delimiters)."""
        kept = [c for c in self.rows.columns if not c.startswith("_f")]
        return self.rows.select(*kept, f"_f{self.delimiters.index(delimiter)}.*")


def _occurrences(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _walked(segments: Column, delimiter: str, start: int) -> Column:
    """(mode, cells) after a line, cut at its quotes, that starts in mode ``start``."""

    def through(mode: Column, cells: Column, text: Column) -> Column:
        outside = mode != _QUOTED
        return F.struct(
            F.when(~outside | (text == ""), mode).when(text.endswith(delimiter), _START).otherwise(_BARE).alias("mode"),
            (cells + F.when(outside, _occurrences(text, delimiter)).otherwise(0)).alias("cells"),
        )

    def step(so_far: Column, text: Column) -> Column:
        mode = so_far["mode"]
        opened = F.when(mode == _START, _QUOTED).when(mode == _QUOTED, _CLOSED).when(mode == _CLOSED, _QUOTED).otherwise(_BARE)
        return through(opened, so_far["cells"], text)

    first = through(F.lit(start), F.lit(0), F.element_at(segments, 1))
    return F.aggregate(F.slice(segments, 2, F.greatest(F.size(segments) - 1, F.lit(0))), first, step)


def _function(line: Column, delimiter: str) -> Column:
    segments = F.split(line, '"')
    out, inside = _walked(segments, delimiter, _START), _walked(segments, delimiter, _QUOTED)
    quoted = line.contains('"')
    return F.struct(
        F.when(quoted, out["mode"] == _QUOTED).otherwise(False).alias("open_out"),
        F.when(quoted, inside["mode"] == _QUOTED).otherwise(True).alias("open_in"),
        F.when(quoted, out["cells"]).otherwise(_occurrences(line, delimiter)).alias("cells_out"),
        F.when(quoted, inside["cells"]).otherwise(0).alias("cells_in"),
    )


def staged_lines(spark: SparkSession, path: str | list[str], delimiters: Sequence[str]) -> Lines:
    """Every line of the file, folder or listed files, as bytes in a string, with where it lies.

    ``at`` grows along a block (a part of a file that one task reads). It is written with
    the line, so that it means the same to every later pass, however executors come and go.
    A line ends at a line feed; a carriage return before it belongs to the line break.
    """
    read = spark.read.option("lineSep", "\n").text(path)
    rows = read.select(
        F.col("_metadata.file_path").alias("source_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.xxhash64("_metadata.file_path", "_metadata.file_block_start").alias("block_key"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
        F.octet_length("value").alias("n_bytes"),
        F.rtrim("value", F.lit("\r")).isin("", "﻿").alias("blank"),
    )
    shown = F.make_valid_utf8("line")
    functions = [_function(shown, d).alias(f"_f{i}") for i, d in enumerate(delimiters)]
    lines = stage(rows.select("*", *functions), "lines")
    full = ~F.col("blank")
    blocks = lines.groupBy("source_path", "block", "block_key").agg(
        F.min("at").alias("first"),
        F.count(F.lit(1)).alias("n"),
        F.count_if("blank").alias("blanks"),
        F.min(F.when(full, F.col("at"))).alias("lead"),
        *(
            F.struct(
                F.count_if(F.col(f"_f{i}.open_out") | ~F.col(f"_f{i}.open_in")).alias("turns"),
                F.min(F.when(full, F.col(f"_f{i}.cells_out"))).alias("least"),
                F.max(F.when(full, F.col(f"_f{i}.cells_out"))).alias("most"),
            ).alias(f"_f{i}")
            for i in range(len(delimiters))
        ),
    )
    blocks = stage(blocks, "blocks")
    turned = blocks.agg(*(F.count_if((F.col(f"_f{i}.turns") > 0) | ~_blank_first()) for i in range(len(delimiters)))).first()
    return Lines(lines, tuple(delimiters), blocks, frozenset(d for d, n in zip(delimiters, turned, strict=True) if n))


def _blank_first() -> Column:
    """Of a block's row: its blank lines all come before its others."""
    return F.col("blanks") == F.coalesce(F.col("lead") - F.col("first"), F.col("n"))


def _swaps() -> Column:
    return F.col("open_out") & ~F.col("open_in")


def _composed(rows: DataFrame, by: str, order: str) -> DataFrame:
    """``rows`` with the composition of their functions so far: ``swapped`` and, if some line sets the state, ``base``.

    The state after a row is ``base``, or else the state at the start, changed if ``swapped``.
    """
    window = W.partitionBy(by).orderBy(order).rowsBetween(W.unboundedPreceding, 0)
    counted = rows.withColumn("swapped", F.sum(_swaps().cast("int")).over(window) % 2 == 1)
    set_here = F.when(F.col("open_out") == F.col("open_in"), F.col("open_out") != F.col("swapped"))
    return counted.withColumn("base", F.last(set_here, ignorenulls=True).over(window))


def staged_blocks(lines: Lines, delimiter: str) -> DataFrame:
    """One row per block: its lines, its first line that is not blank, whether it starts inside quotes, and
    whether it is ``whole``: each of its lines is a record of its own, but for blank ones before them.
    """
    counted = lines.blocks.select(
        "source_path", "block", "block_key", "first", "n", "blanks", "lead", f"_f{lines.delimiters.index(delimiter)}.turns"
    )
    kept = ("source_path", "block", "block_key", "n", "blanks", "lead", "starts_open")
    if delimiter not in lines.torn:
        return counted.withColumn("starts_open", F.lit(False)).select(*kept, F.lit(True).alias("whole"))
    turning = F.col("open_out") | ~F.col("open_in")
    judged = lines.judged(delimiter)
    composed = _composed(judged.where(turning).select("block_key", "at", "open_out", "open_in"), "block_key", "at")
    total = composed.groupBy("block_key").agg(F.max_by(F.struct("base", "swapped"), "at").alias("total"))
    after = {side: F.coalesce(F.col("total.base"), F.lit(opened)) != F.coalesce("total.swapped", F.lit(False)) for side, opened in (("open_out", False), ("open_in", True))}
    # A file has one row per block here, whatever its lines.
    whole_file = W.partitionBy("source_path").orderBy("block")
    over = _composed(stage(counted.join(total, "block_key", "left").withColumns(after).drop("total"), "blocks"), "source_path", "block")
    state = F.coalesce(F.col("base"), F.lit(False)) != F.col("swapped")
    started = over.withColumn("ends_open", state).withColumn(
        "starts_open", F.coalesce(F.lag("ends_open").over(whole_file), F.lit(False))
    )
    whole = ~F.col("starts_open") & (F.col("turns") == 0) & _blank_first()
    return stage(started.select(*kept, whole.alias("whole")), "blocks")


def _placed(lines: Lines, delimiter: str, blocks: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Lines of blocks that are not whole, with ``inside`` (the state before them) and ``number``, the record
    of the block they belong to; 0 is the one that an earlier block began."""
    torn = blocks.where(~F.col("whole")).select("block_key", "starts_open")
    rows = lines.judged(delimiter).select(
        "source_path", "source_file", "block", "block_key", "at", "blank", "open_out", "open_in", *columns
    )
    composed = _composed(rows.join(torn, "block_key"), "block_key", "at")
    window = W.partitionBy("block_key").orderBy("at")
    after = F.coalesce("base", "starts_open") != F.col("swapped")
    inside = F.coalesce(F.lag("_after").over(window), F.col("starts_open"))
    begins = (~F.col("inside") & ~F.col("blank")).cast("bigint")
    number = F.sum(begins).over(window.rowsBetween(W.unboundedPreceding, 0))
    stated = composed.withColumn("_after", after).withColumn("inside", inside)
    return stated.withColumn("number", number).where(F.col("inside") | ~F.col("blank")).drop("_after", "base", "swapped")


def _offsets(blocks: DataFrame, placed: DataFrame | None) -> DataFrame:
    """Staged: per block ``before``, the records that begin in earlier blocks of its file."""
    if placed is None:
        torn = blocks.limit(0).select("block_key", F.lit(0).cast("bigint").alias("torn"))
    else:
        torn = placed.groupBy("block_key").agg(F.max("number").alias("torn"))
    records = F.when(F.col("whole"), F.col("n") - F.col("blanks")).otherwise(F.coalesce("torn", F.lit(0)))
    earlier = W.partitionBy("source_path").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    before = F.coalesce(F.sum("records").over(earlier), F.lit(0))
    # Whether its last record goes on in the next block that has lines.
    goes_on = F.coalesce(F.lead("starts_open").over(W.partitionBy("source_path").orderBy("block")), F.lit(False))
    counted = blocks.join(torn, "block_key", "left").withColumn("records", records)
    return stage(counted.withColumns({"before": before, "goes_on": goes_on}).drop("torn", "n", "blanks"), "offsets")


def _beside(rows: DataFrame, blocks: DataFrame) -> DataFrame:
    """``rows`` with their block's columns; broadcast while the number of blocks is small."""
    small = blocks.count() <= BROADCAST_BLOCKS
    return rows.join(F.broadcast(blocks) if small else blocks, "block_key")


@dataclass(frozen=True)
class Numbered:
    """Records of ``lines`` under one delimiter: lines of torn blocks placed, and what begins in which block. Written."""

    lines: Lines
    delimiter: str
    placed: DataFrame | None
    offsets: DataFrame

    @classmethod
    def of(cls, lines: Lines, delimiter: str, columns: Sequence[str]) -> Numbered:
        blocks = staged_blocks(lines, delimiter)
        placed = stage(_placed(lines, delimiter, blocks, columns), "placed") if delimiter in lines.torn else None
        return cls(lines, delimiter, placed, _offsets(blocks, placed))


def record_widths(lines: Lines, delimiter: str) -> DataFrame:
    """Per file the least and greatest number of cells of its records, and how many records it has."""
    if delimiter not in lines.torn:  # a line, a record
        cells = f"_f{lines.delimiters.index(delimiter)}"
        return (
            lines.blocks.where(F.col("n") > F.col("blanks"))
            .groupBy("source_path")
            .agg(
                (F.min(f"{cells}.least") + 1).cast("int").alias("least"),
                (F.max(f"{cells}.most") + 1).cast("int").alias("most"),
                F.sum(F.col("n") - F.col("blanks")).alias("records"),
            )
        )
    found = Numbered.of(lines, delimiter, ("cells_out", "cells_in"))
    key = found.offsets.select("block_key", "whole", "before")
    plain = _beside(lines.judged(delimiter).select("source_path", "block_key", "blank", "cells_out"), key)
    plain = plain.where("whole and not blank").select("source_path", (F.col("cells_out") + 1).alias("width"))
    cells = F.when(F.col("inside"), F.col("cells_in")).otherwise(F.col("cells_out"))
    numbered = _beside(found.placed, key).withColumn("record_number", F.col("before") + F.col("number"))
    torn = numbered.groupBy("source_path", "record_number").agg((F.sum(cells) + 1).alias("width"))
    return (
        plain.unionByName(torn.select("source_path", F.col("width").cast("int").alias("width")))
        .groupBy("source_path")
        .agg(F.min("width").alias("least"), F.max("width").alias("most"), F.count(F.lit(1)).alias("records"))
    )


def numbered_records(lines: Lines, delimiter: str) -> Numbered:
    """What ``records`` and ``first_records`` read.

    A record of several lines that is longer than RECORD_BYTES, as after a quote that is
    never closed, is an error that names the file: it must not be gathered.
    """
    found = Numbered.of(lines, delimiter, ("line", "n_bytes"))
    if found.placed is None:
        return found
    sizes = _torn_parts(found).groupBy("source_file", "source_path", "record_number").agg(
        F.sum(F.col("n_bytes") + 1).alias("size"), F.count(F.lit(1)).alias("n")
    )
    long = sizes.where((F.col("n") > 1) & (F.col("size") > RECORD_BYTES)).first()
    if long is not None:
        raise FormatDetectionError(f"{long.source_file}: record {long.record_number} has an open quote for {long.size} bytes")
    return found


def _torn_parts(found: Numbered) -> DataFrame:
    ends = found.offsets.where(~F.col("whole")).select("block_key", "before", "records", "goes_on")
    return _beside(found.placed, ends).withColumn("record_number", F.col("before") + F.col("number"))


def records(found: Numbered, last_block: int | None = None) -> DataFrame:
    """source_path, source_file, record_number (from 1, along its file) and record, its bytes in a string.

    Blank lines outside quotes are no records. A record keeps its inner line breaks as they
    are; its last carriage return is dropped. ``last_block`` leaves out later blocks.
    """
    name = ("source_path", "source_file")
    slim = found.lines.judged(found.delimiter).select(*name, "block", "block_key", "at", "blank", "line")
    near = F.lit(True) if last_block is None else F.col("block") <= last_block
    slim = slim.where(near)
    plain = _beside(slim, found.offsets.select("block_key", "whole", "before", "lead")).where("whole and not blank")
    plain = plain.select(
        *name, (F.col("before") + F.col("at") - F.col("lead") + 1).alias("record_number"), F.col("line").alias("record")
    )

    columns = (*name, "record_number", "record")
    if found.placed is None:
        return plain.withColumn("record", _without_return())
    parts = _torn_parts(found).where(near)

    def joined(order: str, text: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, text))), lambda x: x[text]), "\n")

    # A record within one block is put together there; only those at a block's edge move again.
    edge = (F.col("number") == 0) | ((F.col("number") == F.col("records")) & F.col("goes_on"))
    by_block = parts.withColumn("edge", edge).groupBy(*name, "block", "edge", "record_number").agg(joined("at", "line").alias("record"))
    pieces = stage(by_block, "pieces")
    torn = pieces.where("edge").groupBy(*name, "record_number").agg(joined("block", "record").alias("record"))
    every = plain.unionByName(pieces.where("not edge").select(*columns)).unionByName(torn.select(*columns))
    return every.withColumn("record", _without_return())


def _without_return() -> Column:
    """A record without its last carriage return: bytes, not characters, as the text has not been decoded yet."""
    shorter = F.substring(F.col("record").cast("binary"), 1, F.octet_length("record") - 1).cast("string")
    return F.when(F.col("record").endswith("\r"), shorter).otherwise(F.col("record"))


def first_records(found: Numbered) -> DataFrame:
    """Each file's first record. The blocks in which files begin are few, and known from the offsets;
    one block more is read for a record that goes on in it."""
    last = found.offsets.where("before = 0").agg(F.max("block")).first()[0]
    return records(found, last_block=last or 0).where("record_number = 1")
