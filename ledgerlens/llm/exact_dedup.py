"""Exact de-duplication against a minimal perfect hash of historical digests.

The distinct SHA-256 digests of the historical rows are dealt into buckets of
a few thousand; inside a bucket every digest gets a slot of its own out of
exactly as many slots as there are digests (hash, displace: a cell's pilot is
searched until all digests of the cell fall on free slots).  A slot holds the
full digest, the locator of its winner and the number of copies.

A lookup needs two equi-joins on short rows: cell -> pilot, then slot ->
digest.  Its answer counts only when the whole stored digest is equal, byte by
byte: any digest falls on some slot.  Digests that are not members group
among themselves.  Only (row, digest) pairs are shuffled, never texts.

Nulls: a null text is an empty text, a null doc_id is smaller than every other.
Rows that repeat doc_id and text are copies like others; exactly one row of a
class is kept.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import stage

CELLS = 1024  # cells of a bucket
BUCKET_KEYS = 4096  # digests of a bucket, on average

_SLOTS = ("bucket long, cell int, pilot long, n_slots int, slot int, digest string, "
          "winner struct<doc_id:long,row_id:long>, copies long")


def _hash(digest: str, pilot: object) -> int:
    """The non-negative 63 bits that ``_hash_sql`` gives."""
    return xxhash.xxh64_intdigest(f"{digest}:{pilot}", 42) >> 1


def _hash_sql(pilot: str) -> str:
    return f"shiftrightunsigned(xxhash64(concat(digest, ':', {pilot})), 1)"


def place(digests: list[str]) -> list[tuple[int, int, int]]:
    """(cell, pilot, slot) of each distinct digest; the slots are 0..n-1, each used once.

    Cells are placed from the largest to the smallest; the pilot of a cell of
    one digest names a free slot itself, as ``-1 - slot``.
    """
    n = len(digests)
    cells: dict[int, list[int]] = {}
    for i, d in enumerate(digests):
        cells.setdefault(_hash(d, "cell") % CELLS, []).append(i)
    free, out = set(range(n)), [(0, 0, 0)] * n
    single = []
    for cell, members in sorted(cells.items(), key=lambda c: (-len(c[1]), c[0])):
        if len(members) == 1:
            single.append((cell, members[0]))
            continue
        pilot = 0
        while True:
            slots = [_hash(digests[i], pilot) % n for i in members]
            if len(set(slots)) == len(slots) and free.issuperset(slots):
                break
            pilot += 1
        free.difference_update(slots)
        for i, slot in zip(members, slots):
            out[i] = (cell, pilot, slot)
    for (cell, i), slot in zip(single, sorted(free)):
        out[i] = (cell, -1 - slot, slot)
    return out


def _build(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("digest", ignore_index=True)
    placed = place(rows["digest"].tolist())
    return pd.DataFrame({"bucket": rows["bucket"], "cell": [p[0] for p in placed],
                         "pilot": [p[1] for p in placed], "n_slots": len(rows),
                         "slot": [p[2] for p in placed], "digest": rows["digest"],
                         "winner": rows["winner"], "copies": rows["copies"]})


def with_digest(docs: DataFrame) -> DataFrame:
    """(row_id, doc_id, digest) of every row, staged."""
    return stage(docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256).alias("digest")), "digests")


def _by_digest(rows: DataFrame) -> DataFrame:
    return rows.groupBy("digest").agg(F.max(F.struct("doc_id", "row_id")).alias("winner"),
                                      F.count("*").alias("copies"))


def _bucketed(rows: DataFrame, n_buckets: int) -> DataFrame:
    return rows.withColumn("bucket", F.expr(f"{_hash_sql("'bucket'")} % {n_buckets}"))


def build_index(history: DataFrame) -> tuple[DataFrame, int]:
    """The staged index over ``history`` (doc_id, row_id, digest) and its number of buckets."""
    distinct = stage(_by_digest(history), "history")
    n_buckets = distinct.count() // BUCKET_KEYS + 1
    index = _bucketed(distinct, n_buckets).groupBy("bucket").applyInPandas(_build, _SLOTS)
    return stage(index, "mph"), n_buckets


def look_up(digests: DataFrame, index: DataFrame, n_buckets: int) -> DataFrame:
    """``digests`` plus the slot's winner and copies; null where the digest is no member."""
    pilots = index.groupBy("bucket", "cell").agg(F.first("pilot").alias("pilot"),
                                                 F.first("n_slots").alias("n_slots"))
    found = _bucketed(digests, n_buckets).withColumn(
        "cell", F.expr(f"cast({_hash_sql("'cell'")} % {CELLS} as int)"))
    found = found.join(pilots, ["bucket", "cell"], "left").withColumn("slot", F.expr(
        f"cast(if(pilot < 0, -1 - pilot, {_hash_sql('cast(pilot as string)')} % n_slots) as int)"))
    held = index.select("bucket", "slot", F.col("digest").alias("held_digest"),
                        F.col("winner").alias("held_winner"), F.col("copies").alias("held_copies"))
    equal = F.col("digest") == F.col("held_digest")
    return found.join(held, ["bucket", "slot"], "left").select(
        *digests.columns, F.when(equal, F.col("held_winner")).alias("held_winner"),
        F.when(equal, F.col("held_copies")).alias("held_copies"))


def exact_dedup(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """One row per row of both: row_id, doc_id, digest, keep_id, group_size, kept, known.

    Both inputs are (row_id, doc_id, digest).  Of equal digests the row with
    the largest doc_id stays (then the largest row_id).  ``known`` tells that
    the digest is a member of the historical index.
    """
    index, n_buckets = build_index(history)
    looked = stage(look_up(_by_digest(incoming), index, n_buckets), "looked")
    # members and nonmembers of the index apart: each digest is in exactly one of the three
    members = looked.where("held_copies is not null").select(
        "digest", F.greatest("winner", "held_winner").alias("winner"),
        (F.col("copies") + F.col("held_copies")).alias("copies"), F.lit(True).alias("known"))
    news = looked.where("held_copies is null").select("digest", "winner", "copies",
                                                      F.lit(False).alias("known"))
    rest = index.join(members.select("digest"), "digest", "left_anti").select(
        "digest", "winner", "copies", F.lit(True).alias("known"))
    classes = members.unionByName(news).unionByName(rest)
    return history.unionByName(incoming).join(classes, "digest").select(
        "row_id", "doc_id", "digest", F.col("winner.doc_id").alias("keep_id"),
        F.col("copies").alias("group_size"),
        (F.col("row_id") == F.col("winner.row_id")).alias("kept"), "known")


def dedup_documents(docs: DataFrame, history_share: float = 0.5) -> DataFrame:
    """De-duplicate one table: its lower ``history_share`` of doc_ids is the history."""
    rows = with_digest(docs)
    edge = rows.select(F.percentile_approx("doc_id", history_share)).first()[0]
    old = F.coalesce(F.col("doc_id") <= F.lit(edge), F.lit(False))
    return exact_dedup(rows.where(old), rows.where(~old))


def keep_documents(docs: DataFrame, history_share: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    Rows that repeat doc_id and text leave one: they are few, so only they
    pass through a grouping with their texts.
    """
    verdict = stage(dedup_documents(docs, history_share).groupBy("doc_id", "digest").agg(
        F.max("kept").alias("kept"), F.count("*").alias("rows")), "verdict")
    own = "__digest"
    while own in map(str.lower, docs.columns):
        own += "_"
    keyed = docs.withColumn(own, F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256))
    keys = lambda d: keyed["doc_id"].cast("long").eqNullSafe(d["doc_id"]) & (keyed[own] == d["digest"])
    gone, again = stage(verdict.where("not kept or rows > 1"), "gone"), verdict.where("kept and rows > 1")
    once = keyed.join(gone, keys(gone), "left_anti")
    again = stage(again, "again")
    more = keyed.join(again, keys(again), "left_semi").dropDuplicates(["doc_id", own])
    return once.unionByName(more).select(*[F.col(f"`{c}`") for c in docs.columns])
