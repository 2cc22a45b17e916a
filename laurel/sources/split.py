"""Records that span lines, read by many tasks.

Spark splits a text file at any separator, at byte ranges of its choice.  A first pass sums
what each range opens or closes; there is one row of these for a range.  A second one starts
each range from the state that the earlier ones leave and puts its records together; only
what crosses a border between ranges is shuffled.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from laurel.session import stage

BLOCK = ["file", "block"]
MEASURES = ["quotes", "from_outside", "from_inside"]


def pieces(spark: SparkSession, path, separator: str) -> DataFrame:
    """Rows ``(file, block, i, value)``: the text between separators, ``i`` ascending in a byte range.

    A file is known by a 64-bit hash of its path.
    """
    return spark.read.option("lineSep", separator).text(path).select(
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("i"), "value",
    )


def before(amount: Column) -> Column:
    """The sum of ``amount`` over the earlier byte ranges of the file."""
    ranges = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(amount).over(ranges), F.lit(0))


def _stretches(batches, columns):
    """The rows of a batch that lie in one byte range: its key, and the columns."""
    for batch in batches:
        file, block = (batch.column(c).to_numpy() for c in BLOCK)
        cuts = np.flatnonzero((file[1:] != file[:-1]) | (block[1:] != block[:-1])) + 1
        borders = [0, *cuts.tolist(), batch.num_rows] if batch.num_rows else []
        for start, end in zip(borders, borders[1:]):
            some = batch.slice(start, end - start)
            yield (int(file[start]), int(block[start])), [some.column(c) for c in columns]


def _change(string: np.ndarray, outside: np.ndarray, inside: np.ndarray) -> np.ndarray:
    return np.where(string == 1, inside, outside)


def range_sums(measured: DataFrame) -> DataFrame:
    """The ``MEASURES`` of each byte range, of the two states it may start in."""

    def run(batches):
        sums = {}
        for key, columns in _stretches(batches, MEASURES):
            quotes, outside, inside = (c.to_numpy() for c in columns)
            if key not in sums and sums:
                yield emit(sums)
                sums = {}
            open_, one, other = sums.get(key, (0, 0, 0))
            string = (open_ + np.cumsum(quotes) - quotes) % 2
            one += _change(string, outside, inside).sum()
            other += _change(1 - string, outside, inside).sum()
            sums[key] = ((open_ + quotes.sum()) % 2, one, other)
        if sums:
            yield emit(sums)

    def emit(sums):
        rows = [(*key, *map(int, found)) for key, found in sums.items()]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], [*BLOCK, *MEASURES])

    return measured.select(*BLOCK, *MEASURES).mapInArrow(run, "file long, block long, quotes long, from_outside long, from_inside long")


def range_parts(rows: DataFrame, separator: str) -> DataFrame:
    """``file, block, at, value, whole``: the records of a byte range, of which the first and the last may be parts.

    ``rows`` has the ``string`` and ``level`` that its range starts with.  A record ends at a
    separator outside strings and on level 0.
    """

    def run(batches):
        now, state, at, held = None, (0, 0), 0, []
        for key, columns in _stretches(batches, [*MEASURES, "string", "level", "value"]):
            quotes, outside, inside, string, level = (c.to_numpy() for c in columns[:-1])
            out = []
            if key != now:
                if held:
                    out.append((*now, at, separator.join(held), False))
                now, state, at, held = key, (string[0], level[0]), 0, []
            opened = (state[0] + np.cumsum(quotes) - quotes) % 2
            levels = state[1] + np.cumsum(_change(opened, outside, inside))
            strings = (opened + quotes) % 2
            state = strings[-1], levels[-1]
            values, begin = columns[-1].to_pylist(), 0
            for end in (np.flatnonzero((strings == 0) & (levels == 0)) + 1).tolist():
                held += values[begin:end]
                out.append((*key, at, separator.join(held), True))
                at, begin, held = at + 1, end, []
            held += values[begin:]
            if out:
                yield emit(out)
        if held:
            yield emit([(*now, at, separator.join(held), False)])

    def emit(rows):
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], [*BLOCK, "at", "value", "whole"])

    # in order, also where the states came by a shuffle
    rows = rows.sortWithinPartitions(*BLOCK, "i").select(*BLOCK, *MEASURES, "string", "level", "value")
    return rows.mapInArrow(run, "file long, block long, at long, value string, whole boolean")


def records(read: DataFrame, separator: str) -> DataFrame:
    """``value, first, whole``: the records of ``pieces`` with ``MEASURES``; ``first`` is that of its file.

    What follows the last end of a file is a record too, with ``whole`` false.
    """
    sums = stage(range_sums(read), "ranges").withColumn("string", before(F.col("quotes")) % 2)
    change = F.when(F.col("string") == 1, F.col("from_inside")).otherwise(F.col("from_outside"))
    starts = sums.select(*BLOCK, "string", before(change).alias("level"))
    parts = range_parts(read.join(stage(starts, "starts"), BLOCK), separator)
    within = F.col("whole") & (F.col("at") > 0)
    earlier = Window.partitionBy("file").orderBy("block", "at").rowsBetween(Window.unboundedPreceding, -1)
    record = F.coalesce(F.sum(F.col("whole").cast("int")).over(earlier), F.lit(0))
    texts = F.transform(F.sort_array(F.collect_list(F.struct("block", "at", "value"))), lambda p: p["value"])
    crossing = parts.where(~within).withColumn("record", record).groupBy("file", "record").agg(
        F.array_join(texts, separator).alias("value"), F.max("whole").alias("whole")
    )
    return parts.where(within).select("value", F.lit(False).alias("first"), "whole").unionByName(
        crossing.select("value", (F.col("record") == 0).alias("first"), "whole")
    )


def _odd_quotes(text: Column) -> Column:
    return (F.length(text) - F.length(F.replace(text, F.lit('"'), F.lit("")))).cast("long") % 2


def _brackets(text: Column, inside: bool) -> Column:
    """Open braces less closed ones outside strings, the closing one at the end of the piece included.

    ``text`` has no escapes; ``inside``: it starts within a string.
    """
    outside = F.regexp_replace(text, r'^[^"]*("|\z)', "") if inside else text
    open_end = _odd_quotes(text) == (0 if inside else 1)
    outside = F.regexp_replace(outside, r'"[^"]*("|\z)', "")
    opened = F.length(outside) - F.length(F.replace(outside, F.lit("{"), F.lit("")))
    return (opened - F.when(open_end, 0).otherwise(1)).cast("long")


def json_objects(spark: SparkSession, path) -> DataFrame:
    """Column ``value``: the objects of files that hold one JSON array (or objects in a row) each.

    The separator is the closing brace.  No JSON escape holds one, so no piece starts within
    an escape.  Whatever stands between the objects is left out; an object cut off by the
    end of the file is, too.
    """
    read = pieces(spark, path, "}").withColumn("plain", F.regexp_replace("value", r"(?s)\\.", ""))
    read = read.select(
        *BLOCK, "i", "value", _odd_quotes(F.col("plain")).alias("quotes"),
        _brackets(F.col("plain"), False).alias("from_outside"), _brackets(F.col("plain"), True).alias("from_inside"),
    )
    found = records(read, "}").where("whole")
    return found.select(F.concat(F.regexp_replace("value", r"^[^{]*", ""), F.lit("}")).alias("value"))


def csv_records(spark: SparkSession, path) -> DataFrame:
    """``value, first``: the records of CSV files whose quoted values may hold line ends.

    A value that holds a quote is quoted and doubles it, so a record ends at a line end
    after an even number of quotes.  The last one may lack its line end.  Empty lines between
    records count as records.
    """
    read = pieces(spark, path, "\n").select(
        *BLOCK, "i", "value", _odd_quotes(F.col("value")).alias("quotes"),
        F.lit(0).cast("long").alias("from_outside"), F.lit(0).cast("long").alias("from_inside"),
    )
    return records(read, "\n").select(F.regexp_replace("value", r"\r\z", "").alias("value"), "first")
