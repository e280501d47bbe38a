"""CSV records with line breaks inside quotes, read in parallel.

A line break ends a record only outside quotes, and whether a place is inside
depends on every quote before it in the file.  So the text is read as physical
lines, split like any text file, and the state is found by a prefix scan:

1. a grouped sum counts the quotes of every split (one row per split reaches
   the driver: 24 bytes for each 128 MB of text);
2. the running parity over a file's splits says which of them start inside
   quotes;
3. every split joins its own lines into records, a batch at a time; lines that
   are records by themselves pass through untouched.  Spark's CSV parser then
   types the records;
4. a record that crosses a split's end leaves pieces in both (two per split at
   most); they are put together by a grouping of the pieces alone.

No text is shuffled.  Quotes inside quotes are doubled (RFC 4180), so they do
not change the parity.  Records end with a line feed or a carriage return and a
line feed; breaks inside quotes stay as they are.  Blank lines between records
are no records.  The first line of every file is its header; files may order
their columns differently.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..operators.sizing import staged_at
from ..session import remove_path, scratch_path

#: A quoted field left open swallows the rest of its file; a record longer than this is given up in pieces.
MAX_RECORD = 16 << 20
PARSER = {"mode": "PERMISSIVE", "nullValue": "", "emptyValue": "", "quote": '"', "escape": '"'}
_BAD = "_unread"
WHOLE, CLOSING, THROUGH, OPENING = 0, 1, 2, 3
_PIECE = "file_id long, split long, line long, kind int, text string"


class Records(NamedTuple):
    """``rows`` of the declared schema, and those of them that do not fit it, as they were written.

    ``quarantine`` has file, split (its first byte), line (counted in the split) and text.
    ``row_count`` and ``unread_count`` were observed while the rows were staged, in ``folders``.
    """

    rows: DataFrame
    quarantine: DataFrame
    row_count: int
    unread_count: int
    folders: tuple[str, ...] = ()

    def drop(self, spark: SparkSession) -> None:
        """Remove the staged rows: ``rows`` and ``quarantine`` cannot be read any more."""
        for path in self.folders:
            remove_path(spark, path)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines in file order within a split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.xxhash64("_metadata.file_path").alias("file_id"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"), "value")


def split_states(spark: SparkSession, path: str) -> list:
    """One row per split: file_id, file, split, whether it starts inside quotes, the file's first line."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    numbered = _lines(spark, path).withColumn("at", F.monotonically_increasing_id())
    splits = numbered.groupBy("file_id", "file", "split").agg(
        F.sum(quotes).alias("quotes"), F.min_by(F.when(F.col("split") == 0, F.col("value")), "at").alias("header"))
    before = Window.partitionBy("file_id").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    return splits.select("file_id", "file", "split", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2).alias("inside"),
                         "header").collect()


def _joiner(states: dict[tuple[int, int], int], longest: int):
    """Lines of a split -> records, and the pieces of those that cross its ends.

    Pickled whole, so that workers need not have this package.
    """
    whole, closing, through, opening = WHOLE, CLOSING, THROUGH, OPENING

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        names = ["file_id", "split", "line", "kind", "text"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string()]
        key, line, inside = None, 0, 0
        held: list[str] = []  # lines of the record that is open
        held_at = held_bytes = 0
        started_here = True

        def batch(rows: list[tuple]):
            columns = list(zip(*rows)) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        def let_go(last: bool, rows: list[tuple]) -> None:
            """Hand on the lines that are held: the record's end, or what there is of it."""
            nonlocal held, held_bytes, started_here
            if last:
                kind = whole if started_here else closing
            else:
                kind = opening if started_here else through
            rows.append((*key, held_at, kind, "\n".join(held)))
            held, held_bytes, started_here = [], 0, last

        for b in batches:
            files, splits, values = b.column(0).to_numpy(), b.column(1).to_numpy(), b.column(2)
            edges = np.flatnonzero((np.diff(files) != 0) | (np.diff(splits) != 0)) + 1
            for first, end in zip([0, *edges.tolist()], [*edges.tolist(), len(files)]):
                if first == end:
                    continue
                rows: list[tuple] = []
                now = (int(files[first]), int(splits[first]))
                if now != key:
                    if held:
                        let_go(False, rows)
                    if now not in states:
                        raise RuntimeError(f"split {now} was not there when the quotes were counted")
                    key, line, inside, started_here = now, 0, states[now], not states[now]
                part = values.slice(first, end - first)
                odd = pc.count_substring(part, '"').to_numpy(zero_copy_only=False) & 1
                after = (inside + np.cumsum(odd)) & 1
                before = np.concatenate(([inside], after[:-1]))
                alone = (before == 0) & (after == 0)
                numbers = line + np.arange(len(part))
                for i in np.flatnonzero(~alone).tolist():
                    if not held:
                        held_at = line + i
                    held.append(part[i].as_py())
                    held_bytes += len(held[-1]) + 1
                    if not after[i]:
                        let_go(True, rows)
                    elif held_bytes >= longest:
                        let_go(False, rows)
                inside, line = int(after[-1]), line + len(part)
                keep = np.flatnonzero(alone)
                n = len(keep)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, key[0])), pa.array(np.full(n, key[1])), pa.array(numbers[keep]),
                     pa.array(np.full(n, whole, dtype=np.int32)), part.take(pa.array(keep)).cast(pa.string())], names=names)
                if rows:
                    yield batch(rows)
        if held:
            rows = []
            let_go(False, rows)
            yield batch(rows)

    return run


def _header(line: str | None) -> list[str]:
    import csv

    line = (line or "").lstrip("﻿").removesuffix("\r")
    return [n.strip() for n in next(csv.reader([line]), [])]


def _layouts(states: list, schema: StructType) -> dict[tuple[str, ...], list[int]]:
    """Files by the columns of their headers.  A declared column that a header lacks is an error."""
    out: dict[tuple[str, ...], list[int]] = {}
    wanted = schema.fieldNames()
    for s in states:
        if s["split"] == 0 and (s["header"] or "").strip():
            if s["header"].count('"') % 2:
                raise ValueError(f"{s['file']}: a line break in the header")
            names = _header(s["header"])
            missing = [n for n in wanted if n not in names]
            if missing:
                raise ValueError(f"{s['file']}: the header lacks {missing}")
            out.setdefault(tuple(names), []).append(s["file_id"])
    return out


def _typed(pieces: DataFrame, layouts: dict[tuple[str, ...], list[int]], schema: StructType) -> DataFrame:
    """``pieces`` with the parsed record as ``r``: the declared fields, and the text where they were not read."""
    text = F.when(F.col("text").contains("\r"), F.regexp_replace("text", "\r$", "")).otherwise(F.col("text"))
    declared = {f.name: f for f in schema.fields}
    wanted = [*schema.fieldNames(), _BAD]
    parsed = None
    for names, files in sorted(layouts.items(), key=lambda x: len(x[1])):
        fields = [StructField(n, declared[n].dataType, True) if n in declared else StructField(f"_other_{i}", StringType())
                  for i, n in enumerate(names)]
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*fields, StructField(_BAD, StringType())])
        read = F.from_csv(text, ddl, {**PARSER, "columnNameOfCorruptRecord": _BAD})
        one = F.struct(*[read[n].alias(n) for n in wanted])
        parsed = one if parsed is None else F.when(F.col("file_id").isin(files), one).otherwise(parsed)
    return pieces.withColumn("r", parsed)


def _join_pieces(pieces: DataFrame, longest: int) -> DataFrame:
    """Records out of the pieces that crossed splits; pieces of over-long ones stay single."""
    order = [F.col("split"), F.col("line"), F.col("kind")]
    opened = F.sum(F.when(F.col("kind") == OPENING, 1).otherwise(0)).over(
        Window.partitionBy("file_id").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    chains = pieces.withColumn("chain", opened)
    whole = Window.partitionBy("file_id", "chain")
    chains = chains.withColumn("size", F.sum(F.length("text")).over(whole)).withColumn(
        "closed", F.max(F.col("kind") == CLOSING).over(whole))
    parts = F.sort_array(F.collect_list(F.struct("split", "line", "kind", "text")))
    good = chains.where((F.col("size") <= longest) & F.col("closed")).groupBy("file_id", "chain").agg(parts.alias("p"))
    good = good.select("file_id", F.col("p")[0]["split"].alias("split"), F.col("p")[0]["line"].alias("line"),
                       F.lit(WHOLE).alias("kind"), F.concat_ws("\n", F.col("p")["text"]).alias("text"))
    bad = chains.where(~((F.col("size") <= longest) & F.col("closed")))
    return good.unionByName(bad.select(*good.columns))


def read_records(spark: SparkSession, path: str, schema: StructType, max_record: int = MAX_RECORD,
                 tries: int = 3) -> Records:
    """Typed rows of a header CSV (a file or a folder of files) whose quoted fields may hold line breaks.

    Rows that do not fit the schema are kept with nulls in the unread fields,
    as a permissive reader keeps them, and listed in ``quarantine``.  What an
    unclosed quote swallows is listed there alone.  The rows are staged: the
    text is read twice (quotes, records) and never again.
    """
    for left in reversed(range(tries)):
        states = split_states(spark, path)
        layouts = _layouts(states, schema)
        if not layouts:
            empty = spark.createDataFrame([], schema)
            return Records(empty, spark.createDataFrame([], "file string, split long, line long, text string"), 0, 0)
        table = {(s["file_id"], s["split"]): int(s["inside"]) for s in states}
        pieces = _lines(spark, path).select("file_id", "split", "value").mapInArrow(_joiner(table, max_record), _PIECE)
        first = (F.col("split") == 0) & (F.col("line") == 0)
        blank = (F.col("kind") == WHOLE) & (F.btrim("text", F.lit(" \r\t")) == "")
        typed = _typed(pieces.where(~first & ~blank), layouts, schema)
        kept = F.when((F.col("kind") != WHOLE) | F.col(f"r.{_BAD}").isNotNull(), F.col("text"))
        seen = Observation()
        one = F.col("kind") == WHOLE
        counted = typed.select("file_id", "split", "line", "kind", kept.alias("text"), "r").observe(
            seen, F.count_if(one).alias("rows"), F.count_if(one & F.col(f"r.{_BAD}").isNotNull()).alias("unread"))
        # the line is told of rows with a text alone
        counted = counted.withColumn("line", F.when(F.col("text").isNotNull(), F.col("line")))
        folders = scratch_path(spark, "records"), scratch_path(spark, "crossing")
        try:
            parsed = staged_at(counted, folders[0], compression="zstd")
            break
        except Exception as error:
            if not left or "was not there when the quotes were counted" not in str(error):
                raise  # a cluster that grew between the passes splits small inputs anew: count again
    whole = parsed.where(F.col("kind") == WHOLE)
    crossing = parsed.where(F.col("kind") != WHOLE)
    n_rows, n_unread = seen.get["rows"], seen.get["unread"]
    joined = staged_at(_typed(_join_pieces(crossing.drop("r"), max_record), layouts, schema), folders[1])
    more = joined.agg(F.count_if(F.expr(f"kind = {WHOLE}")), F.count_if(F.expr(f"kind = {WHOLE} and r.{_BAD} is not null")), F.count("*")).first()
    n_rows, n_unread = n_rows + more[0], n_unread + more[1] + more[2] - more[0]
    if more[2]:
        whole = whole.unionByName(joined.where(F.col("kind") == WHOLE))
    lost = joined.where(F.col("kind") != WHOLE)
    names = spark.createDataFrame([(s["file_id"], s["file"]) for s in states if s["split"] == 0],
                                  "file_id long, file string")
    bad = whole.where(F.col(f"r.{_BAD}").isNotNull()).unionByName(lost)
    quarantine = bad.join(names, "file_id").select("file", "split", "line", F.regexp_replace("text", "\r$", "").alias("text"))
    return Records(whole.select(*[F.col("r")[n].alias(n) for n in schema.fieldNames()]), quarantine, n_rows, n_unread,
                   folders)
