"""Finding keys that occur more than once, for keys far too many to sort as rows.

A task gathers (key, id, pos) entries of a few million and sends them, packed
column by column, to groups by key.  What a task can tell by itself - a key
that it has met twice - needs one entry to speak for it; the task's other
entries of that key are answered on the spot and travel in groups by id.  So a
key that is everywhere sends one entry per task flush, never its rows, and a
group's size is bounded by the keys that are dealt to it.

Ids order the documents: ``row_id`` gives a null doc_id a number above all
others, the same for equal texts.  A doc_id that rows of different texts share
does not say whose places are meant: ``tag`` does.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stage

FLUSH = 1_000_000  # entries that a task gathers
GROUP_BYTES = 24 << 20  # text whose keys make up a group, about
ENTRIES = ("bucket int, key binary, more binary, id binary, pos binary, proven binary, "
           "a_key binary, a_id binary, a_pos binary")
_NAMES = [f.split()[0] for f in ENTRIES.split(", ")]


def row_id() -> Column:
    """doc_id, or for a null one a number above all others made from the text."""
    made = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit(""))), 3)
    return F.coalesce(F.col("doc_id").cast("long"), made)


def rows_of(docs: DataFrame) -> DataFrame:
    """(id, text as bytes, doc_id) of every row; id is never null."""
    return docs.select(row_id().alias("id"), F.col("text").cast("string").cast("binary").alias("text"),
                       F.col("doc_id").cast("long").alias("doc_id"))


def tagged(rows: DataFrame) -> DataFrame:
    """``rows_of`` and tag: 0, or a hash of the text where rows of different texts share the id.

    Equal texts of an id share the tag: what goes in one goes in the other.
    """
    text = F.coalesce(F.col("text"), F.lit(b""))
    shared = rows.groupBy("id").agg(F.min(F.xxhash64(text)).alias("lo"), F.max(F.xxhash64(text)).alias("hi"))
    shared = stage(shared.where("lo <> hi").select(F.col("id").alias("of_id")), "shared-ids")
    if shared.isEmpty():
        return rows.withColumn("tag", F.lit(0))
    tag = F.when(F.col("of_id").isNotNull(), F.xxhash64(text).bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")).otherwise(F.lit(0))
    return rows.join(shared, F.col("id") == F.col("of_id"), "left").withColumn("tag", tag).drop("of_id")


def planes(values: np.ndarray) -> bytes:
    """Bytes of equal significance together: zero planes then cost nothing once compressed."""
    values = np.ascontiguousarray(values)
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unplanes(data: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(size, -1).T).view(kind).ravel()


def _runs(key: np.ndarray, more: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first place, run number of each) of equal neighbours."""
    new = np.ones(len(key), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (more[1:] != more[:-1])
    return np.flatnonzero(new), np.cumsum(new) - 1


def _repeated(first: np.ndarray, run: np.ndarray, ids: np.ndarray, across: bool) -> np.ndarray:
    """For each run of entries: in two documents (``across``), or twice at all."""
    if not across:
        return np.diff(np.append(first, len(run))) > 1
    return np.minimum.reduceat(ids, first) != np.maximum.reduceat(ids, first)


def by_bucket(bucket: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """(order that brings equal buckets together, where each of the ``n_groups`` begins in it, and the end)."""
    small = bucket.astype(np.uint16) if n_groups <= 1 << 16 else bucket  # sorted by its digits
    return np.argsort(small, kind="stable"), np.concatenate(([0], np.cumsum(np.bincount(bucket, minlength=n_groups))))


def _key_order(key: np.ndarray, more: np.ndarray) -> np.ndarray:
    return np.lexsort((more, key)) if more.any() else np.argsort(key)


def deal(key: np.ndarray, more: np.ndarray, ids: np.ndarray, pos: np.ndarray, across: bool,
         n_groups: int) -> pa.RecordBatch:
    """One flush of entries as packed rows, one row a group."""
    order = _key_order(key, more)
    key, more, ids, pos = key[order], more[order], ids[order], pos[order]
    first, run = _runs(key, more)
    proven = _repeated(first, run, ids, across)[run] if len(run) else np.zeros(0, bool)
    speaks = ~proven
    speaks[first] = True
    by_key = (key[speaks] % np.uint64(n_groups)).astype(np.int32)
    by_id = (ids[~speaks] % n_groups).astype(np.int32)
    order, cut = by_bucket(by_key, n_groups)
    order_told, cut_told = by_bucket(by_id, n_groups)
    order, order_told = np.flatnonzero(speaks)[order], np.flatnonzero(~speaks)[order_told]
    sent, told = [a[order] for a in (key, more, ids, pos, proven)], [a[order_told] for a in (key, ids, pos)]
    columns: list[list] = [[] for _ in _NAMES]
    for g in range(n_groups):
        a, b, c, d = cut[g], cut[g + 1], cut_told[g], cut_told[g + 1]
        if a == b and c == d:
            continue
        for column, value in zip(columns, [g, *(planes(x[a:b]) for x in sent), *(planes(x[c:d]) for x in told)]):
            column.append(value)
    types = [pa.int32()] + [pa.binary()] * (len(_NAMES) - 1)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=_NAMES)


def deal_all(entries: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], across: bool,
             n_groups: int, flush: int = FLUSH) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    n = 0
    for some in entries:
        held.append(some)
        n += len(some[0])
        if n >= flush:
            yield deal(*(np.concatenate([h[i] for h in held]) for i in range(4)), across, n_groups)
            held, n = [], 0
    if n:
        yield deal(*(np.concatenate([h[i] for h in held]) for i in range(4)), across, n_groups)


def _answer(across: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        get = lambda c, kind: np.concatenate([unplanes(b, kind) for b in rows[c]])
        key, more, ids, pos = get("key", "u8"), get("more", "u4"), get("id", "i8"), get("pos", "i4")
        proven = get("proven", "u1").astype(bool)
        order = _key_order(key, more)
        key, more, ids, pos, proven = key[order], more[order], ids[order], pos[order], proven[order]
        first, run_of = _runs(key, more)
        if len(first):
            keep = (_repeated(first, run_of, ids, across) | np.logical_or.reduceat(proven, first))[run_of]
        else:
            keep = np.zeros(0, bool)
        return pd.DataFrame({"id": np.concatenate((ids[keep], get("a_id", "i8"))),
                             "pos": np.concatenate((pos[keep], get("a_pos", "i4"))),
                             "key": np.concatenate((key[keep], get("a_key", "u8"))).view(np.int64)})

    return run


def repeated(dealt: DataFrame, across: bool) -> DataFrame:
    """(id, pos, key) of the entries whose key occurs twice (``across``: in two documents)."""
    return dealt.groupBy("bucket").applyInPandas(_answer(across), "id long, pos int, key long")


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the (leftmost) minimum of every window of ``width`` values."""
    n = len(values)
    if n < width:
        return np.zeros(0, dtype=np.int64)
    least, at, step = values, np.arange(n), 1
    def meet(least, at, step):
        right = least[step:] < least[:-step]
        return np.where(right, least[step:], least[:-step]), np.where(right, at[step:], at[:-step])
    while step * 2 <= width:
        least, at = meet(least, at, step)
        step *= 2
    return meet(least, at, width - step)[1] if width > step else at


def anchors(values: np.ndarray, owner: np.ndarray, k: int, window: int) -> np.ndarray:
    """Places of the k-grams that are the least of some window of ``window`` symbols.

    ``values`` has the hash of the k-gram at each symbol, ``owner`` the text of
    each symbol.  Equal windows have their least k-gram at the same place, so
    whatever repeats over a window repeats an anchor.
    """
    at = sliding_argmin(values, window - k + 1)
    inside = owner[: len(at)] == owner[window - 1:window - 1 + len(at)]
    return np.unique(at[inside])
