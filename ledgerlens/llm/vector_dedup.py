"""Embedding near-duplicates by hierarchical navigable small-world graphs.

Vectors are compared inside their label.  Equal vectors are one from the start.
The distinct vectors of a label are dealt to shards of bounded size, each shard
builds a graph (Malkov and Yashunin 2016), and every vector queries every shard
of its label: blocks of queries are joined with the shards' graphs.

A search keeps a beam.  As long as the worst of the beam still reaches the
threshold the beam is doubled; past ``WIDEST`` the beam is the whole shard.  So
a large group of near copies is found whole.  When a graph has been built, an
audit compares the links of sampled members with brute force over the shard and
doubles the beam that all searches start with until the recall passes.

Every link is verified by cosine in double precision.  A block sends back its
queries' link counts and a spanning forest of the links it found, which has the
same components as the links: rows grow with the vectors, not with the pairs.

Vectors that are null, zero, of other length than the rest of their label, or
that hold null or non-finite parts link with nothing (another length: only with
their like).  So do rows with a null label or a null vec_id.  Repeated rows are
copies that link with each other.  Empty tables give empty results; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import components, stage

SHARD_ROWS = 16_384
BLOCK_ROWS = 1024  # queries that meet a shard in one row
DEGREE = 12
BUILD_BEAM = 64
BEAM = 32
WIDEST = 512
AUDIT = 128  # members whose links are compared with brute force
RECALL = 0.99


class Graph:
    """A navigable small-world graph over unit vectors (float32 rows)."""

    def __init__(self, unit: np.ndarray, seed: int = 1):
        self.unit, n = unit, len(unit)
        high = np.minimum((-np.log(1 - np.random.default_rng(seed).random(n)) / np.log(DEGREE)).astype(int), 8)
        self.top = int(high.max()) if n else 0
        # level 0 has room for twice the degree
        self.near = [dict() for _ in range(self.top + 1)]
        self.seen, self.tick = np.zeros(n, dtype=np.int64), 0
        self.entry = -1
        for i in range(n):
            self._insert(i, int(high[i]))
        del self.seen

    def _beam(self, q: np.ndarray, start: list[int], width: int, level: int) -> list[tuple[float, int]]:
        """The ``width`` nearest found from ``start``: (cosine, member), best first."""
        self.tick += 1
        seen, tick, near, unit = self.seen, self.tick, self.near[level], self.unit
        seen[start] = tick
        best = [(s, i) for s, i in zip((unit[start] @ q).tolist(), start)]
        heapq.heapify(best)
        todo = [(-s, i) for s, i in best]
        heapq.heapify(todo)
        while len(best) > width:
            heapq.heappop(best)
        while todo:
            s, i = heapq.heappop(todo)
            if len(best) >= width and -s < best[0][0]:
                break
            others = near[i]
            others = others[seen[others] != tick]
            if not len(others):
                continue
            seen[others] = tick
            sims = unit[others] @ q
            if len(best) >= width:
                good = sims > best[0][0]
                sims, others = sims[good], others[good]
            for s, j in zip(sims.tolist(), others.tolist()):
                if len(best) < width:
                    heapq.heappush(best, (s, j))
                elif s > best[0][0]:
                    heapq.heapreplace(best, (s, j))
                else:
                    continue
                heapq.heappush(todo, (-s, j))
        return sorted(best, reverse=True)

    def _choose(self, found: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Neighbours that are nearer to the point than to a neighbour chosen before; then the nearest rest."""
        if len(found) <= most:
            return found
        order = np.argsort(-sims, kind="stable")
        found, sims = found[order], sims[order]
        between = self.unit[found] @ self.unit[found].T
        chosen, nearest = [], np.full(len(found), -2.0, dtype=np.float32)
        for i in range(len(found)):
            if nearest[i] < sims[i]:
                chosen.append(i)
                if len(chosen) == most:
                    break
                np.maximum(nearest, between[i], out=nearest)
        if len(chosen) < most:
            taken = set(chosen)
            chosen += [i for i in range(len(found)) if i not in taken][:most - len(chosen)]
        return found[chosen]

    def _insert(self, i: int, high: int) -> None:
        for level in range(min(high, self.top) + 1):
            self.near[level][i] = np.zeros(0, dtype=np.int64)
        if self.entry < 0:
            self.entry, self.level = i, high
            return
        q, start = self.unit[i], [self.entry]
        for level in range(self.level, high, -1):
            start = [self._beam(q, start, 1, level)[0][1]]
        for level in range(min(high, self.level), -1, -1):
            found = self._beam(q, start, BUILD_BEAM, level)
            start = [j for _, j in found]
            most = DEGREE if level else 2 * DEGREE
            chosen = self._choose(np.array(start), np.array([s for s, _ in found], np.float32), DEGREE)
            near = self.near[level]
            near[i] = chosen
            for j in chosen.tolist():
                others = np.append(near[j], i)
                near[j] = self._choose(others, self.unit[others] @ self.unit[j], most) if len(others) > most else others
        if high > self.level:
            self.entry, self.level = i, high

    def within(self, q: np.ndarray, least: float, width: int) -> np.ndarray:
        """Members whose cosine with ``q`` reaches ``least``, as far as the beam finds them."""
        if not hasattr(self, "seen"):
            self.seen, self.tick = np.zeros(len(self.unit), dtype=np.int64), 0
        start = [self.entry]
        for level in range(self.level, 0, -1):
            start = [self._beam(q, start, 1, level)[0][1]]
        while width <= min(WIDEST, len(self.unit)):
            found = self._beam(q, start, width, 0)
            if len(found) < width or found[-1][0] < least:
                return np.array([j for s, j in found if s >= least], dtype=np.int64)
            width *= 2
        return np.flatnonzero(self.unit @ q >= least)  # the whole shard is the beam

    def audit(self, least: float, width: int = BEAM) -> tuple[int, float]:
        """(beam that passes, its recall) over sampled members, against brute force."""
        picked = np.unique(np.linspace(0, len(self.unit) - 1, AUDIT).astype(int))
        true = [np.flatnonzero(self.unit @ self.unit[i] >= least) for i in picked]
        total = sum(map(len, true))
        while True:
            hit = sum(len(np.intersect1d(t, self.within(self.unit[i], least, width))) for i, t in zip(picked, true))
            if hit >= RECALL * total or width > min(WIDEST, len(self.unit)):
                return width, hit / max(1, total)
            width *= 2


def _units(vectors: np.ndarray) -> np.ndarray:
    wide = vectors.astype(np.float64)
    return (wide / np.linalg.norm(wide, axis=1, keepdims=True)).astype(np.float32)


_GRAPHS = "label long, dim int, shard int, n int, beam int, recall double, graph binary"


def _build(least: float):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("rep")
        vectors = np.array(rows["vector"].tolist(), dtype=np.float32)
        graph = Graph(_units(vectors))
        beam, recall = graph.audit(least - 1e-4)
        graph.__dict__.pop("seen", None)
        graph.unit = None
        data = pickle.dumps((graph, vectors, rows["rep"].to_numpy(np.int64), rows["copies"].to_numpy(np.int64)), 5)
        head = rows.iloc[0]
        return pd.DataFrame([[head["label"], head["dim"], head["shard"], len(rows), beam, recall, data]],
                            columns=[f.split()[0] for f in _GRAPHS.split(", ")])

    return run


def _block(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("rep")
    data = pickle.dumps((np.array(rows["vector"].tolist(), dtype=np.float32), rows["rep"].to_numpy(np.int64)), 5)
    head = rows.iloc[0]
    return pd.DataFrame([[head["label"], head["dim"], head["block"], data]], columns=["label", "dim", "block", "queries"])


def _forest(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of the links those that join two trees when taken in turn."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up.setdefault(x, x) != x:
            up[x] = x = up[up[x]]
        return x

    out = []
    for a, b in pairs:
        x, y = root(a), root(b)
        if x != y:
            up[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def _search(least: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            for packed, beam, queries in zip(rows["graph"], rows["beam"], rows["queries"]):
                graph, members, ids, copies = pickle.loads(packed)
                graph.unit = _units(members)
                vectors, reps = pickle.loads(queries)
                unit, exact = _units(vectors), members.astype(np.float64)
                exact /= np.linalg.norm(exact, axis=1, keepdims=True)
                counts, links = [], []
                for rep, v, q in zip(reps.tolist(), vectors.astype(np.float64), unit):
                    found = graph.within(q, least - 1e-4, int(beam))
                    found = found[(exact[found] @ (v / np.linalg.norm(v)) >= least) & (ids[found] != rep)]
                    if len(found):
                        counts.append((rep, int(copies[found].sum())))
                        links += [(rep, x) for x in ids[found].tolist()]
                        if len(links) > 500_000:  # a forest is all that the components need
                            links = _forest(links)
                edges = _forest(links)
                none_a, none_b = [None] * len(counts), [None] * len(edges)
                out = {"rep": [c[0] for c in counts] + none_b, "links": [c[1] for c in counts] + none_b,
                       "a": none_a + [e[0] for e in edges], "b": none_a + [e[1] for e in edges]}
                yield pd.DataFrame({k: pd.array(v, dtype="Int64") for k, v in out.items()})  # never as floats

    return run


def shard_graphs(distinct: DataFrame, least: float, shard_rows: int) -> DataFrame:
    """One row per shard of the distinct vectors: its graph, its audited beam and recall."""
    sizes = distinct.groupBy("label", "dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("n_shards"))
    dealt = distinct.join(sizes, ["label", "dim"]).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit(3), "rep"), "n_shards").cast("int"))
    return stage(dealt.select("label", "dim", "shard", "rep", "copies", "vector").groupBy("label", "dim", "shard")
                 .applyInPandas(_build(least), _GRAPHS), "graphs")


def near_duplicates(vectors: DataFrame, least: float = 0.9, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of ``vectors``
    (vec_id, embedding, label); links have a cosine of at least ``least``."""
    part = F.col("embedding").cast("array<double>")
    fine = (F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()
            & F.forall(part, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists(part, lambda x: x != 0))
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
        F.col("embedding").cast("array<float>").alias("vector"), F.coalesce(fine, F.lit(False)).alias("fine"))
    # the digest of the exact parts: equal digests are equal vectors
    rows = rows.withColumns({"dim": F.size("vector"), "digest": F.when(F.col("fine"), F.md5(
        F.concat_ws(",", F.col("vector").cast("array<string>")).cast("binary")))})
    same = ["label", "digest"]
    distinct = stage(rows.where("fine").groupBy(*same).agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("dim").alias("dim"),
        F.first("vector").alias("vector")), "distinct-vectors")
    # a vec_id may hold several vectors; what links is the vector
    distinct = distinct.withColumn("rep_id", F.col("rep")).withColumn("rep", F.xxhash64("label", "digest"))
    graphs = shard_graphs(distinct, least, shard_rows)
    n_blocks = distinct.groupBy("label", "dim").agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("n_blocks"))
    blocks = distinct.join(n_blocks, ["label", "dim"]).withColumn(
        "block", F.pmod(F.xxhash64(F.lit(4), "rep"), "n_blocks").cast("int"))
    blocks = blocks.select("label", "dim", "block", "rep", "vector").groupBy("label", "dim", "block").applyInPandas(
        _block, "label long, dim int, block int, queries binary")
    met = graphs.join(blocks, ["label", "dim"]).repartition("label", "dim", "shard", "block")
    found = stage(met.select("graph", "beam", "queries").mapInPandas(
        _search(least), "rep long, links long, a long, b long"), "found")
    parts = components(found.where("a is not null").select("a", "b"), "vector-links")
    counts = found.where("rep is not null").groupBy("rep").agg(F.sum("links").alias("links"))
    placed = distinct.select(*same, "rep", "rep_id", "copies").join(counts, "rep", "left").join(
        parts.select(F.col("id").alias("rep"), F.col("component_id").alias("part")), "rep", "left").withColumn(
        "part", F.coalesce("part", "rep"))
    placed = stage(placed, "placed")
    least_id = placed.groupBy("part").agg(F.min("rep_id").alias("component_id"))
    placed = placed.join(least_id, "part").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    out = rows.select("vec_id", *same).join(placed, same, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
