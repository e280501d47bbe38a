"""A stored cube: summed components per cell, refreshed by new rows only.

Every earned-value ratio is derived from sums, and sums merge.  So the store
keeps, per cell (one value of every dimension), the sum and the number of known
values of each measure, and the number of rows.  A batch of new rows is
aggregated alone and added as a small table of cells; rows that a correction
takes back are added negatively.  A slice merges the cells of all batches and
never reads the fact.

A batch counts once: the log has one line per written table of cells, with the
batches it holds, and it is written after the cells.  A batch that a retry adds
again has two lines, of which one is read; cells without a line belong to a run
that failed.  ``compact`` merges what is live into one table whose line holds
all those batches.  Of lines that share a batch the one with more batches is
read, so a compaction that meets another one, or a late batch, loses nothing.

Integer measures are exact in any order.  Rows with null dimensions are cells of
their own.  A cell all of whose rows were taken back is not there.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .evm import AC, BAC, EV, PV, ratios_from_totals

LOG = "batches array<string>, folder string, ddl string, written_at double"
ROWS = "row_count"
EVM_TOTALS = {BAC: "total_budget", AC: "total_actual_cost", EV: "total_earned_value", PV: "total_planned_value"}


def _known(measure: str) -> str:
    return f"{measure}__known"


class CubeStore:
    """Cells of ``dims`` with the sums of ``measures``, below ``root`` (a folder that all executors see)."""

    def __init__(self, spark: SparkSession, root: str, dims: Sequence[str], measures: Sequence[str] = tuple(EVM_TOTALS)):
        self.spark, self.root = spark, root.rstrip("/")
        self.dims, self.measures = list(dims), list(measures)
        clash = {ROWS, *self.measures, *map(_known, self.measures)} & set(self.dims)
        if clash or len(set(self.dims)) < len(self.dims):
            raise ValueError(f"dimensions must differ from each other and from the measures: {sorted(clash) or self.dims}")

    # ------------------------------------------------------------ the log

    def _lines(self) -> list:
        """The live lines: one small row per table of cells, widest first, no batch twice."""
        try:
            lines = self.spark.read.schema(LOG).json(f"{self.root}/log").collect()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        live, taken = [], set()
        for line in sorted(lines, key=lambda r: (-len(r["batches"]), r["written_at"], r["folder"])):
            if taken.isdisjoint(line["batches"]):
                live.append(line)
                taken.update(line["batches"])
        return live

    def batches(self) -> list[str]:
        return sorted(b for line in self._lines() for b in line["batches"])

    def _add(self, cells: DataFrame, batches: Sequence[str]) -> None:
        folder = f"cells/{uuid.uuid4().hex}"
        cells.write.mode("errorifexists").parquet(f"{self.root}/{folder}")
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cells.schema.fields)
        self.spark.createDataFrame([(sorted(batches), folder, ddl, time.time())], LOG).coalesce(1).write.mode(
            "append").json(f"{self.root}/log")

    # ------------------------------------------------------------ writing

    def _signed(self, rows: DataFrame, sign: int) -> DataFrame:
        sums = [F.sum(m).alias(m) for m in self.measures]
        known = [F.count(m).alias(_known(m)) for m in self.measures]
        cells = rows.groupBy(*self.dims).agg(*sums, *known, F.count(F.lit(1)).alias(ROWS))
        if sign > 0:
            return cells
        return cells.withColumns({c: -F.col(c) for c in (*self.measures, *map(_known, self.measures), ROWS)})

    def append(self, batch: str, rows: DataFrame, taken_back: DataFrame | None = None) -> bool:
        """Add a batch of fact rows, and take back rows of earlier batches; False where the batch is in already.

        One partial and final aggregate of the batch: what moves is a row per
        cell and task, so a cell with a third of the rows is combined map-side.
        """
        if batch in self.batches():
            return False
        cells = self._signed(rows, 1)
        if taken_back is not None:
            cells = self._merged(cells.unionByName(self._signed(taken_back, -1)))
        self._add(cells, [batch])
        return True

    def compact(self) -> int:
        """Merge the live tables of cells into one; how many there were."""
        lines = self._lines()
        if len(lines) > 1:
            self._add(self._cells(lines), [b for line in lines for b in line["batches"]])
        return len(lines)

    # ------------------------------------------------------------ reading

    def _merged(self, cells: DataFrame) -> DataFrame:
        sums = [F.sum(c).alias(c) for m in self.measures for c in (m, _known(m))]
        return cells.groupBy(*self.dims).agg(*sums, F.sum(ROWS).alias(ROWS))

    def _cells(self, lines: list) -> DataFrame:
        if not lines:
            raise LookupError(f"{self.root}: no batch is stored")
        by_ddl: dict[str, list[str]] = {}
        for line in lines:
            by_ddl.setdefault(line["ddl"], []).append(f"{self.root}/{line['folder']}")
        out = None
        for ddl, paths in by_ddl.items():  # sums of a compaction may be wider than those of a batch
            part = self.spark.read.schema(ddl).parquet(*paths)
            out = part if out is None else out.unionByName(part)
        return self._merged(out)

    def cells(self) -> DataFrame:
        """Row count and sums of every cell; a measure without a known value is null."""
        cells = self._cells(self._lines()).where(F.col(ROWS) != 0)
        return cells.select(*self.dims, ROWS, *[F.when(F.col(_known(m)) != 0, F.col(m)).alias(m) for m in self.measures])

    def slices(self, sets: Sequence[Sequence[str]]) -> DataFrame:
        """Row count and sums at the chosen sets of dimensions, with ``grouping_level``.

        GROUPING SETS over the cells: n sets expand them n times, not 2 to the
        number of dimensions.  ``grouping_level`` has a bit per dimension, the
        first one highest, set where the dimension is summed over.
        """
        wanted = [tuple(d for d in self.dims if d in s) for s in sets]
        unknown = {d for s in sets for d in s} - set(self.dims)
        if unknown or not wanted or len(set(wanted)) < len(wanted):
            raise ValueError(f"sets must be different and made of {self.dims}: {list(sets)}")
        sums = [F.sum(m).alias(m) for m in (ROWS, *self.measures)]
        return self.cells().groupingSets(wanted, *self.dims).agg(*sums, F.grouping_id().cast("int").alias("grouping_level"))


def evm_slices(store: CubeStore, sets: Sequence[Sequence[str]]) -> DataFrame:
    """CPI / SPI / EAC / VAC at the chosen slices of a store of the earned-value components."""
    totals = store.slices(sets).withColumnsRenamed(EVM_TOTALS).drop(ROWS)
    return ratios_from_totals(totals)
