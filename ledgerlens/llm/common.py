"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.session import scratch_path

#: A word: a run of bytes that are neither a blank nor one of 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"

_BLANK = np.zeros(256, dtype=bool)
_BLANK[[0x20, 9, 10, 11, 12, 13]] = True
_MUL1, _MUL2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def ship(spark: SparkSession) -> None:
    """Send the package along where Python workers would not find it by themselves."""
    root = Path(__file__).resolve().parents[2]
    paths = [Path(p or ".").resolve() for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    sc = spark.sparkContext
    if root in paths or any(f.endswith("/ledgerlens.zip") for f in sc.listFiles):
        return
    whole = Path(tempfile.mkdtemp(prefix="ledgerlens-")) / "ledgerlens.zip"  # on the driver: Spark sends it on
    with zipfile.ZipFile(whole, "w") as out:
        for file in (root / "ledgerlens").rglob("*.py"):
            out.write(file, file.relative_to(root))
    sc.addPyFile(str(whole))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared checkpoint folder and read it again.

    Cuts the lineage at a table that every executor can read, so a lost
    executor never forces the work before it to run again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


_HELD: dict = {}


def held(key, make: Callable):
    """The one large object that a Python worker keeps from task to task.

    All operators share the workers, so what another one has left is dropped.
    """
    if key not in _HELD:
        if _HELD:
            _HELD.clear()
            give_back()
        _HELD[key] = make()
        give_back()  # what it was made from
    return _HELD[key]


def give_back() -> None:
    """Return freed memory to the machine: the worker lives on, beside the executor's heap."""
    _POWERS.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # where the C library has it
    if trim:
        trim(0)


def tidy(run: Callable, holds: bool = False) -> Callable:
    """A task over batches that returns its memory when it ends.

    Unless it ``holds`` a large object itself, it drops the one that another
    operator has left.
    """
    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not holds:
            _HELD.clear()
        yield from run(batches)
        give_back()

    return tidied


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Jobs started meanwhile hand Python at most ``rows`` rows at once.

    A batch is held by the executor and by the worker beside it, in memory
    that no heap limit covers: ten thousand texts are tens of MB in each.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if 0 < int(before) <= rows:
        yield
        return
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_bytes(df: DataFrame) -> int:
    """UTF-8 bytes of all texts: sizes the number of groups, never the result."""
    return df.select(F.sum(F.octet_length("text"))).first()[0] or 0


def groups_for(total_bytes: float, each: float) -> int:
    """How many groups hold ``total_bytes`` with about ``each`` bytes in a group."""
    return max(8, int(total_bytes // each) + 1)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of uint64 values."""
    x = (x ^ (x >> np.uint64(31))) * _MUL1
    x = (x ^ (x >> np.uint64(29))) * _MUL2
    return x ^ (x >> np.uint64(32))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_BASE = 0x5851F42D4C957F2D


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        inverse = pow(_BASE, -1, 1 << 64)
        both = []
        for base in (_BASE, inverse):
            run = np.full(size, base, dtype=np.uint64)
            run[0] = 1
            both.append(np.multiply.accumulate(run))
        _POWERS[size] = (both[0], both[1])
    return _POWERS[size]


_SEGMENT = 1 << 19


def chunked(batches: Iterator[pa.RecordBatch], limit: int = _SEGMENT) -> Iterator[tuple[list, list[bytes]]]:
    """(first column, texts) of rows whose texts have about ``limit`` bytes together.

    The second column holds the texts as binary.
    """
    keys: list = []
    texts: list[bytes] = []
    held = 0
    for b in batches:
        for key, text in zip(b.column(0).to_pylist(), b.column(1)):
            text = text.as_py() or b""
            keys.append(key)
            texts.append(text)
            held += len(text) + 1
            if held >= limit:
                yield keys, texts
                keys, texts, held = [], [], 0
    if keys:
        yield keys, texts


def text_rows(docs: DataFrame) -> DataFrame:
    """doc_id as long and the text's UTF-8 bytes."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"))


def blanks(data: np.ndarray) -> np.ndarray:
    """Whether each byte is a blank."""
    return _BLANK[data]


def _segment_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    blank = _BLANK[data]
    edge = np.diff(np.concatenate(([1], blank.view(np.int8), [1])))
    start, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    power, inverse = _powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=total[1:])
    value = (total[end] - total[start]) * inverse[start]
    return mix64(value ^ ((end - start).astype(np.uint64) << np.uint64(40))), start, end


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text index, start byte, end byte) of every word of a few texts.

    The 64-bit hash is a polynomial over the word's bytes, scrambled; start and
    end are offsets in the texts joined by one newline.  Long texts go through
    in segments cut at a blank, so the working memory is bounded by the
    longest word, not by the longest text.
    """
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    found, at = [], 0
    while at < len(data):
        stop = min(len(data), at + _SEGMENT)
        while stop < len(data):  # on to the next blank
            blanks = np.flatnonzero(_BLANK[data[stop:stop + _SEGMENT]])
            if len(blanks):
                stop += int(blanks[0])
                break
            stop = min(len(data), stop + _SEGMENT)
        value, start, end = _segment_words(data[at:stop])
        found.append((value, start + at, end + at))
        at = stop
    value, start, end = (np.concatenate([f[i] for f in found]) for i in range(3))
    ends = np.cumsum([len(t) + 1 for t in texts])
    return value, np.searchsorted(ends, start, side="right"), start, end


def runs_of(values: np.ndarray, k: int, salt: int = 0) -> np.ndarray:
    """64-bit hash of each run of ``k`` consecutive values."""
    n = len(values) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.full(n, np.uint64(salt * 2 + 1), dtype=np.uint64)
    for i in range(k):
        out = out * np.uint64(0xD1342543DE82EF95) + values[i:i + n]
        out ^= out >> np.uint64(32)
    return mix64(out)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every window of ``width`` values."""
    if len(values) < width:
        return values[:0]
    out, step = values, 1
    while step * 2 <= width:
        out = np.minimum(out[:-step], out[step:])
        step *= 2
    rest = width - step
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by windows of ``length`` at the sorted ``starts``."""
    if not len(starts):
        return starts, starts
    cut = np.flatnonzero(np.diff(starts) > length)
    first = np.concatenate(([0], cut + 1))
    last = np.concatenate((cut, [len(starts) - 1]))
    return starts[first], starts[last] + length


def stars(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(a, b), staged: b is the smallest id reachable from a in ``edges`` (a, b), of every other id a.

    Large-star and small-star steps (Kiveris et al. 2014) until every
    component is a star around its smallest id.  A step is one grouped minimum
    joined back; a hub's edges are combined before the shuffle and the join is
    split by AQE.  A step names its input twice and no more: the plan of a
    round names every mention's whole input again, and the driver holds,
    compiles and logs all of it.  One count per round reaches the driver.
    """
    def pairs(*two: tuple[str, str], to: tuple[str, str]) -> Column:
        return F.inline(F.array(*[F.struct(F.col(x).alias(to[0]), F.col(y).alias(to[1])) for x, y in two]))

    # a > b holds throughout
    def large(e: DataFrame) -> DataFrame:
        least = e.select(pairs(("a", "b"), ("b", "a"), to=("u", "v"))).groupBy("u").agg(
            F.least(F.col("u"), F.min("v")).alias("m"))
        return e.select("a", F.col("b").alias("u")).join(least, "u").select("a", F.col("m").alias("b")).distinct()

    def small(e: DataFrame) -> DataFrame:
        least = e.groupBy("a").agg(F.min("b").alias("m"))
        return e.join(least, "a").select(pairs(("a", "m"), ("b", "m"), to=("a", "b"))).where("a > b").distinct()

    def settled(e: DataFrame) -> bool:
        ends = e.select(F.inline(F.array(*[F.struct(F.col(x).alias("id"), F.lit(up).alias("up")) for x, up in (("a", 1), ("b", 0))])))
        ends = ends.groupBy("id").agg(F.sum("up").alias("ups"), F.min("up").alias("low"))
        return not ends.agg(F.count_if((F.col("ups") > 1) | (F.col("ups") > F.col("low")))).first()[0]

    now = stage(edges.where("a <> b").select(F.greatest("a", "b").alias("a"),
                                             F.least("a", "b").alias("b")).distinct(), name)
    for _ in range(max_rounds):
        if settled(now):
            return now
        now = stage(small(large(now)), name)
    raise RuntimeError("components did not settle")


def components(edges: DataFrame, name: str, max_rounds: int = 60) -> DataFrame:
    """(id, component_id) of every id in ``edges`` (a, b): smallest id reachable."""
    of = stars(edges, name, max_rounds)
    both = F.array(*[F.struct(F.col(x).alias("id"), F.col("b").alias("component_id")) for x in "ab"])
    return of.select(F.inline(both)).groupBy("id").agg(F.min("component_id").alias("component_id"))


def word_count(column: str) -> Column:
    """Number of words of a text column (null: 0), native."""
    return F.regexp_count(F.coalesce(F.col(column).cast("string"), F.lit("")), F.lit(WORD)).cast("long")
