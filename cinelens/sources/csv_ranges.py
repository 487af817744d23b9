"""Records of large CSV files, read by many tasks although quoted fields hold line breaks.

The files are read as plain lines, which Spark splits by byte ranges like any
text (and from any store it can read). Whether a line is inside a quoted field
follows from the number of quotes before it: one pass counts quotes per range,
a running sum over the ranges of a file tells how each one begins, and a
second pass cuts every range into records. Only the pieces of records that
cross a border are gathered and joined. The fields of a record are parsed by
``from_csv``.

Quotes must stand as writers of quoted CSV put them: around a field, doubled
inside it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

WHOLE, BEGIN, GO_ON = 0, 1, 2
_PIECES = "file string, pos long, kind int, header boolean, record string"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``value, file, begin``: every line (cut at ``\\n`` only) with the byte range it was read in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"))


def ranges_inside_quotes(lines: DataFrame) -> dict[str, frozenset[int]]:
    """Ranges that begin inside a quoted field, by file (at most one number per byte range)."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "begin").agg(F.sum(quotes).alias("n"))
    before = F.sum("n").over(Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1))
    inside = counts.select("file", "begin", (before % 2).alias("odd")).where("odd = 1")
    return {r.file: frozenset(r.begins) for r in inside.groupBy("file").agg(F.collect_set("begin").alias("begins")).collect()}


class _Cutter:
    """Cuts the lines of one range into records; lines come in order."""

    def __init__(self, file: str, begin: int, inside: bool):
        self.file, self.at, self.open = file, begin + (begin > 0), inside
        self.kind, self.first, self.lines, self.start = (GO_ON if inside else WHOLE), begin == 0, [], self.at

    def cut(self, values: list[str], quotes: np.ndarray, sizes: np.ndarray):
        """Records that end in these lines, as ``(pos, kind, header, record)``."""
        states = (np.cumsum(quotes) + self.open) % 2
        ends = self.at + np.cumsum(sizes + 1)
        done = 0
        for k in np.flatnonzero(states == 0).tolist():
            self.lines += values[done:k + 1]
            yield from self.piece(self.kind)
            self.kind, self.start, done = WHOLE, int(ends[k]), k + 1
        self.lines += values[done:]
        if len(values):
            self.open, self.at = int(states[-1]), int(ends[-1])

    def piece(self, kind: int):
        record, self.lines = "\n".join(self.lines), []
        if kind == WHOLE and record in ("", "\r"):
            return
        header, self.first = self.first, False
        yield self.start, kind, header, record

    def rest(self):
        """What is left at the end of the range: a record that goes on in the next one."""
        if self.lines:
            yield from self.piece(BEGIN if self.kind == WHOLE else GO_ON)


def _cut(inside: dict, whole: bool):
    """Records that lie in one range (``whole``), or the pieces of those that do not."""
    def emit(cutter, pieces):
        rows = [(cutter.file, *p) for p in pieces if (p[1] == WHOLE) == whole]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (
                pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()))], names=[c.split()[0] for c in _PIECES.split(", ")])

    def run(batches):
        cutter = key = None
        for batch in batches:
            if not batch.num_rows:
                continue
            values, files, begins = batch.columns
            quotes = pc.count_substring(values, '"').to_numpy(zero_copy_only=False).astype(np.int64)
            sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.int64)
            text, begin, file = values.to_pylist(), begins.to_numpy(zero_copy_only=False), files.dictionary_encode()
            code = file.indices.to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(begin) != 0) | (np.diff(code) != 0)) + 1
            for a, z in zip([0, *turns.tolist()], [*turns.tolist(), len(text)]):
                now = (file.dictionary[int(code[a])].as_py(), int(begin[a]))
                if now != key:
                    if cutter is not None:
                        yield from emit(cutter, list(cutter.rest()))
                    cutter, key = _Cutter(*now, now[1] in inside.get(now[0], ())), now
                yield from emit(cutter, list(cutter.cut(text[a:z], quotes[a:z], sizes[a:z])))
        if cutter is not None:
            yield from emit(cutter, list(cutter.rest()))
    return run


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """``file, pos, record``: the records of the CSV files at ``path``; ``pos`` grows within a file.

    Empty lines are no records; with ``header`` the first record of each file
    is left out. A quoted field that is never closed ends with its file.
    """
    lines = lines_of(spark, path)
    inside = ranges_inside_quotes(lines)
    whole = lines.mapInArrow(_cut(inside, True), _PIECES)
    pieces = lines.mapInArrow(_cut(inside, False), _PIECES)
    number = F.count_if(F.col("kind") == BEGIN).over(Window.partitionBy("file").orderBy("pos"))
    joined = pieces.withColumn("number", number).groupBy("file", "number").agg(
        F.min("pos").alias("pos"), F.max("header").alias("header"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "record"))), lambda x: x["record"]), "\n").alias("record"))
    rows = whole.select("file", "pos", "header", "record").unionAll(joined.select("file", "pos", "header", "record"))
    return (rows.where(~F.col("header")) if header else rows).select("file", "pos", F.regexp_replace("record", "\r$", "").alias("record"))
