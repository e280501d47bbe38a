"""Substring de-duplication over words by compacted De Bruijn paths.

1. The nodes are token k-mers: of every window of ``length`` words the one with
   the least hash (a minimizer), so each repeated window repeats a node.  A
   node that occurs once anywhere is dropped at once.
2. An edge joins the nodes that follow each other in a document, at their
   distance.  Edges that occur twice or more make the graph.
3. Nonbranching paths are compacted by Spark joins: the runs that lie one
   after another in the nodes' first places need one window, the runs are then
   joined into paths by pointer doubling.
4. A path's occurrences are spans in the documents (source coordinates).  All
   windows of those spans are compared on 96-bit hashes of their words, over
   all documents, which decides exactly which of them repeat.

Removed is every word of a window whose word sequence starts anywhere else.
Nulls and texts without words have no window; short texts lose nothing.
Repeated rows repeat each other's windows, so all of their long texts go.  Rows
of different texts that share a doc_id are separate documents.
Rows with a null doc_id take part like others.  Empty tables give empty
results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import chunked, groups_for, runs_of, stage, text_bytes, words_of
from ledgerlens.llm.repeats import ENTRIES, GROUP_BYTES, anchors, deal_all, repeated, rows_of, tagged


def _node_entries(k: int, length: int, n_groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries():
            for ids, texts in chunked(batches):
                value, doc, _, _ = words_of(texts)
                node = runs_of(value, k)
                at = anchors(node, doc, k, length)
                first = np.searchsorted(doc, np.arange(len(ids)))
                key = node[at] >> np.uint64(8)
                yield (key, np.zeros(len(at), np.uint32), np.array(ids, np.int64)[doc[at]],
                       (at - first[doc[at]]).astype(np.int32))

        yield from deal_all(entries(), False, n_groups)

    return run


def _window_entries(k: int, length: int, n_groups: int):
    """Windows of the spans (first node, last node) that come with each text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries():
            for b in batches:
                for ident, text, firsts, lasts in zip(*(b.column(i) for i in range(4))):
                    value, _, _, _ = words_of([text.as_py() or b""])
                    n = len(value) - length + 1
                    if n <= 0:
                        continue
                    step = np.zeros(n + 1, dtype=np.int32)
                    first, last = firsts.values.to_numpy(), lasts.values.to_numpy()
                    # the windows that hold a k-mer at p start in [p + k - length, p]
                    np.add.at(step, np.maximum(0, first + k - length), 1)
                    np.add.at(step, np.minimum(n, last + 1), -1)
                    start = np.flatnonzero(np.cumsum(step[:-1]) > 0)
                    one, two = runs_of(value, length, 1), runs_of(value, length, 2)
                    yield one[start], two[start].astype(np.uint32), np.full(len(start), ident.as_py()), start.astype(np.int32)

        yield from deal_all(entries(), False, n_groups)

    return run


def paths(nodes: DataFrame, length: int, k: int, max_rounds: int = 64) -> DataFrame:
    """(node, path) of every node of the graph over ``nodes`` (id, pos, key)."""
    in_text = Window.partitionBy("id").orderBy("pos")
    follow = nodes.select("id", "pos", F.col("key").alias("u"), F.lead("key").over(in_text).alias("v"),
                          (F.lead("pos").over(in_text) - F.col("pos")).alias("gap"))
    # repeated rows give a place twice: no distance
    edges = follow.where(F.col("gap").between(1, length - k + 1)).groupBy("u", "v", "gap").agg(
        F.count("*").alias("times")).where("times > 1")
    edges = stage(edges, "edges")
    out = edges.groupBy("u").agg(F.count("*").alias("ways"), F.first("v").alias("v"), F.first("gap").alias("gap"))
    into = edges.groupBy("v").agg(F.count("*").alias("ways_in"))
    single = out.where("ways = 1").join(into.where("ways_in = 1"), "v").where("u <> v").select("u", "v", "gap")
    first = nodes.groupBy(F.col("key").alias("node")).agg(F.min(F.struct("id", "pos")).alias("at"))
    first = stage(first, "first-places")
    back = first.join(single, F.col("node") == F.col("v"), "left").select("node", "at", "u", "gap")
    back = back.join(first.select(F.col("node").alias("u"), F.col("at").alias("u_at")), "u", "left")
    same = (F.col("u_at.id") == F.col("at.id")) & (F.col("u_at.pos") + F.col("gap") == F.col("at.pos"))
    in_order = Window.partitionBy("at.id").orderBy("at.pos", "node").rowsBetween(Window.unboundedPreceding, 0)
    runs = back.withColumn("head", F.when(~F.coalesce(same, F.lit(False)), F.col("node"))).withColumn(
        "run", F.last("head", ignorenulls=True).over(in_order))
    runs = stage(runs.select("node", "run", F.when(F.col("head").isNotNull(), F.col("u")).alias("u")), "runs")
    # a run continues the one that its head's predecessor ends
    ends = runs.select(F.col("node").alias("u"), F.col("run").alias("up"))
    links = stage(runs.where("u is not null").join(ends, "u").where("up <> run").select("run", "up"), "run-links")
    before = links.count()
    for _ in range(max_rounds if before else 0):  # a cycle of runs never gets shorter: it stops below
        links = stage(links.alias("l").join(links.select(F.col("run").alias("up"), F.col("up").alias("top")), "up", "left")
                      .select("run", F.coalesce("top", "up").alias("up"), F.col("top").isNotNull().alias("moved")), "run-links")
        moved = links.where("moved and run <> up").count()
        links = links.select("run", "up")
        if not moved or moved == before:
            break
        before = moved
    return runs.join(links, "run", "left").select("node", F.coalesce("up", "run").alias("path"))


def path_spans(nodes: DataFrame, path: DataFrame, length: int, k: int) -> DataFrame:
    """(id, first, last): where each path's occurrences start and end, as places of their
    first and last node."""
    placed = nodes.join(path, F.col("key") == F.col("node")).select("id", "pos", "path")
    in_text = Window.partitionBy("id").orderBy("pos")
    new = (F.lag("path").over(in_text) != F.col("path")) | (
        F.col("pos") - F.lag("pos").over(in_text) > length - k + 1)
    placed = placed.withColumn("new", F.coalesce(new, F.lit(True)).cast("int")).withColumn(
        "span", F.sum("new").over(in_text))
    return placed.groupBy("id", "span").agg(F.min("pos").alias("first"), F.max("pos").alias("last"))


def _removed(length: int, with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], []]
            for text, starts in zip(b.column(1), b.column(2)):
                words = (text.as_py() or b"").split()
                gone = 0
                if starts.is_valid and len(words):
                    step = np.zeros(len(words) + 1, dtype=np.int32)
                    at = starts.values.to_numpy()
                    np.add.at(step, at, 1)
                    np.add.at(step, np.minimum(at + length, len(words)), -1)
                    keep = np.cumsum(step[:-1]) == 0
                    gone = int((~keep).sum())
                    kept = b" ".join(compress(words, keep.tolist()))
                else:
                    kept = b" ".join(words)
                for column, value in zip(out, (len(words), gone, hashlib.sha256(kept).hexdigest(), kept)):
                    column.append(value)
            arrays = [b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())]
            names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
            if with_text:
                arrays.append(pa.array(out[3], pa.binary()).cast(pa.string()))
                names.append("kept_text")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def repeated_windows(docs: DataFrame, length: int = 50, k: int = 16) -> tuple[DataFrame, DataFrame]:
    """(rows, (id, starts) of the windows that repeat)."""
    rows = tagged(rows_of(docs))
    # the order of the ids does not matter here: a text that shares its doc_id with another gets a number of its own
    own = F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64("id", "text"), 3)
    rows = rows.select(F.when(F.col("tag") == 0, F.col("id")).otherwise(own).alias("id"), "text", "doc_id")
    n_groups = groups_for(text_bytes(docs), GROUP_BYTES)
    nodes = stage(repeated(rows.select("id", "text").mapInArrow(
        _node_entries(k, length, n_groups), ENTRIES), False), "nodes")
    spans = path_spans(nodes, paths(nodes, length, k), length, k).groupBy("id").agg(
        F.collect_list("first").alias("firsts"), F.collect_list("last").alias("lasts"))
    # ordered inside a partition, so that a task that runs again flushes the same entries
    # doc_id goes along unread: the texts' exchange is then the same as at the end, and Spark uses it twice
    met = rows.join(spans, "id").select("id", "text", "firsts", "lasts", "doc_id").sortWithinPartitions("id", F.length("text"))
    windows = repeated(met.mapInArrow(_window_entries(k, length, n_groups), ENTRIES), False)
    return rows, windows.groupBy("id").agg(F.collect_set("pos").alias("starts"))


def remove_repeats(docs: DataFrame, length: int = 50, k: int = 16, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) of every document."""
    rows, starts = repeated_windows(docs, length, k)
    kind = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return rows.join(starts, "id", "left").select("doc_id", "text", "starts").mapInArrow(
        _removed(length, with_text), kind)
