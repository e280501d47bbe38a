"""N-gram Jaccard self-join by prefix filters under several global token orders.

A document is the set of its word shingles.  Two sets that reach the
similarity must share a token among the first few of *any* global order of
the tokens (the prefix has n - ceil(s * n) + 1 tokens).  Three orders are used:

* A, rare tokens first: its prefixes are joined on the token, which is what
  finds candidates.  Frequencies order the tokens, they decide nothing; a
  bounded list of the most frequent ones is enough.  A token carries its
  reach, the tokens of the set from it to the end: two sets share no more than
  the reach of their first common token, on either side.  A set whose first
  tokens are its own therefore meets nobody at its later, frequent ones.
* B and C, two keyed hash orders: a candidate must share prefix tokens under
  them too.  A token of one prefix that comes before the end of the other and
  is not in it is in no part of the other set; as soon as either set has too
  many such tokens, the overlap cannot be reached.  What passes all filters is
  verified on the whole sets.

Equal sets are one class from the start.  A token's group does not emit all
its pairs: first its members meet the leader of their size band, the set whose
tokens are the most frequent on average, which has least of its own; what
links is one component.  Other leaders follow while many pairs are left.  Then only
pairs in different components whose reaches allow a link meet, exactly.  So a
large group of near copies costs a few comparisons a member, and no link
between components is lost.

Texts without words have an empty set and link with nothing.  A row with a
null doc_id links with nothing and has a null component.  Rows with equal sets
share a component, repeated rows included.  Empty tables give empty results;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import chunked, mix64, runs_of, small_batches, stage, stars, text_rows, tidy, words_of

FREQUENT = 1 << 18  # tokens of the frequency list, at most
FLUSH = 1_500_000  # shingles whose local counts a task keeps at once
STARS = 3  # rounds with leaders before the exact round, at most
SPREAD = 64  # parts of a frequent token's group while equal sets collapse
CELLS = 24  # bits of a cell's number in the table of wanted documents: a table of 2 MB at any size
FEW = 1 << 13  # wanted documents that every executor is sent: 64 bytes each at most
HELD = 1 << 18  # keys of sets that a task remembers, so as to send a set once
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_SALTS = (np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344), np.uint64(0xA4093822299F31D0))


def shingles(texts: list[bytes], k: int, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, text index), ordered by text, then hash."""
    if lower:
        texts = [t.translate(_LOWER) for t in texts]
    word, doc, _, _ = words_of(texts)
    run = runs_of(word, k)
    inside = doc[: len(run)] == doc[k - 1:] if len(run) else np.zeros(0, bool)
    value, owner = [run[inside]], [doc[: len(run)][inside]]
    counts = np.bincount(doc, minlength=len(texts)) if len(doc) else np.zeros(len(texts), int)
    first = np.cumsum(counts) - counts
    for n in range(1, k):  # fewer words: the whole sequence is the one shingle
        short = np.flatnonzero(counts == n)
        if len(short):
            whole = runs_of(word, n, salt=n)
            value.append(whole[first[short]])
            owner.append(short)
    value, owner = np.concatenate(value), np.concatenate(owner)
    order = np.lexsort((value, owner))
    value, owner = value[order], owner[order]
    keep = np.ones(len(value), dtype=bool)
    keep[1:] = (value[1:] != value[:-1]) | (owner[1:] != owner[:-1])
    return value[keep], owner[keep]


def prefix_length(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def _prefix(value: np.ndarray, owner: np.ndarray, key: np.ndarray, take: np.ndarray,
            first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ``take`` tokens of each set that come first by ``key``: (hash, owner)."""
    order = np.lexsort((value, key, owner))
    rank = np.arange(len(value)) - first[owner]  # sets lie one after another in either order
    chosen = rank < take[owner]
    return value[order][chosen], owner[chosen]


def _lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _set_key(value: np.ndarray, owner: np.ndarray, n: np.ndarray) -> np.ndarray:
    """64-bit identity of each set."""
    total = np.zeros(len(n), dtype=np.uint64)
    np.add.at(total, owner, mix64(value ^ np.uint64(0x5BD1E995)))
    return mix64(total ^ n.astype(np.uint64)).view(np.int64)


def least_size(percent: int) -> int:
    """Smaller sets cannot reach the similarity with any other set."""
    return percent // (100 - percent) + (percent % (100 - percent) > 0)


_PROFILE = "doc_id long, n long, key long, token long, seen long"


def _profile(k: int, lower: bool):
    """Per document its set's size and identity; and the shingles that a task has met in
    at least two documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def frequent() -> pa.RecordBatch:
            token, seen = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            token, seen = token[seen > 1], seen[seen > 1]
            empty = [pa.nulls(len(token), pa.int64())] * 3
            return pa.RecordBatch.from_arrays([*empty, pa.array(token.view(np.int64)), pa.array(seen)], schema=schema)

        schema = pa.schema([(c, pa.int64()) for c in ("doc_id", "n", "key", "token", "seen")])
        for ids, texts in chunked(batches):
            value, owner = shingles(texts, k, lower)
            n = np.bincount(owner, minlength=len(ids))
            empty = [pa.nulls(len(ids), pa.int64())] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(n, pa.int64()),
                 pa.array(_set_key(value, owner, n), mask=n == 0), *empty], schema=schema)
            held.append(value)
            if sum(map(len, held)) >= FLUSH:
                yield frequent()
        if held:
            yield frequent()

    return run


def _prefixes(k: int, percent: int, lower: bool, tokens: np.ndarray, classes: np.ndarray):
    """(token, part, key, n, reach, rarity) of each set's prefix under the order A; the part of a
    token off the frequency list is 0, the others' groups are dealt to parts from 1 on; rarity
    is 16 times the mean of 255 less the token's class over the whole set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: set[int] = set()
        for ids, texts in chunked(batches):
            value, owner = shingles(texts, k, lower)
            n = np.bincount(owner, minlength=len(ids))
            key = _set_key(value, owner, n)
            at = np.searchsorted(tokens, value)
            at[at == len(tokens)] = 0
            known = tokens[at] == value if len(tokens) else np.zeros(len(value), bool)
            rank = np.where(known, classes[at] if len(tokens) else 0, 0).astype(np.uint64)
            order = rank << np.uint64(56) | mix64(value ^ _SALTS[0]) >> np.uint64(8)
            new = np.zeros(len(ids), dtype=bool)
            for i, name in enumerate(key.tolist()):
                if ids[i] is not None and name not in held:
                    new[i] = True
                    if len(held) < HELD:
                        held.add(name)
            take = np.where((n >= least_size(percent)) & new, prefix_length(n, percent), 0)
            token, of = _prefix(value, owner, order, take, np.cumsum(n) - n)
            place = np.arange(len(of)) - np.repeat(np.cumsum(take) - take, take)
            at = np.minimum(np.searchsorted(tokens, token), max(len(tokens) - 1, 0))
            frequent = tokens[at] == token if len(tokens) else np.zeros(len(token), bool)
            rarity = np.bincount(owner, weights=255.0 - rank, minlength=len(ids)) * 16 // np.maximum(n, 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(token.view(np.int64)), pa.array(np.where(frequent, 1 + key[of] % SPREAD, 0).astype(np.int32)),
                 pa.array(key[of]), pa.array(n[of].astype(np.int32)), pa.array((n[of] - place).astype(np.int32)),
                 pa.array(rarity[of].astype(np.int32))],
                names=["token", "part", "key", "n", "reach", "rarity"])

    return run


def _cells(ids: np.ndarray) -> np.ndarray:
    """The cell of each doc_id in the table of wanted documents."""
    return (mix64(ids.astype(np.int64).view(np.uint64)) >> np.uint64(64 - CELLS)).astype(np.int64)


def _cell_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        cell = np.unique(_cells(b.column(0).to_numpy(zero_copy_only=False)))
        yield pa.RecordBatch.from_arrays([pa.array(cell)], names=["cell"])


def _wanted(bits: np.ndarray):
    """The rows whose doc_id falls into a wanted cell: all that are looked for, and a few others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            b = b.filter(b.column(0).is_valid())
            cell = _cells(b.column(0).to_numpy(zero_copy_only=False))
            yield b.filter(pa.array((bits[cell >> 3] >> (cell & 7) & 1).astype(bool)))

    return run


def _sets(k: int, percent: int, lower: bool):
    """Of each text whose set is the expected one: key, size, prefixes under the orders B and C, and the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keyed = (pa.RecordBatch.from_arrays([b.column(2), b.column(1)], names=["key", "text"]) for b in batches)
        for expected, texts in chunked(keyed):
            value, owner = shingles(texts, k, lower)
            n = np.bincount(owner, minlength=len(texts))
            key = _set_key(value, owner, n)
            cut = np.concatenate(([0], np.cumsum(n)))
            take = np.where(n >= least_size(percent), prefix_length(n, percent), 0)
            marks = []
            for salt in _SALTS[1:]:
                got, _ = _prefix(value, owner, mix64(value ^ salt), take, cut[:-1])
                # the upper bits of the place in the order: whoever is less by them is less
                marks.append(_lists((mix64(got ^ salt) >> np.uint64(49)).astype(np.int16), take, pa.int16()))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n, pa.int64()), *marks, pa.array(texts, pa.binary())],
                                             names=["key", "n", "b", "c", "text"]).filter(
                pa.array(key == np.array(expected, np.int64)))

    return run


def _linked(k: int, percent: int, lower: bool):
    """The pairs (a, b) whose texts' whole sets link.  Texts travel, since they compress and hashes do not."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep: list[bool] = []
            sides = pa.RecordBatch.from_arrays(
                [pa.array(np.arange(2 * len(b)) // 2), pa.concat_arrays([b.column(2), b.column(3)]).take(
                    pa.array(np.arange(2 * len(b)).reshape(2, -1).T.ravel()))], names=["row", "text"])
            odd: list[np.ndarray] = []  # the first set of a pair whose second one comes with the next texts
            for rows, texts in chunked([sides]):
                value, owner = shingles(texts, k, lower)
                sets = odd + np.split(value, np.cumsum(np.bincount(owner, minlength=len(rows)))[:-1])
                for x, y in zip(sets[::2], sets[1::2]):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(100 * both >= percent * (len(x) + len(y) - both))
                odd = sets[-1:] if len(sets) % 2 else []
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _below(end: Column):
    """A test of one parameter: F.filter passes the index to a second one, defaults or not."""
    return lambda w: w < end


class Join:
    """One run of the self-join over ``docs`` (doc_id, text)."""

    def __init__(self, docs: DataFrame, k: int, percent: int, lower: bool):
        self.k, self.percent, self.lower = k, percent, lower
        self.rows = text_rows(docs)
        spark = docs.sparkSession
        profile = stage(self.rows.mapInArrow(tidy(_profile(k, lower)), _PROFILE), "profile")
        self.documents = profile.where("n is not null").select("doc_id", "n", "key")
        marks = profile.where("key is not null and doc_id is not null").groupBy("key").agg(
            F.min("doc_id").alias("least_id"), F.first("n").alias("n"))
        self.sets = stage(marks, "sets")
        counts = profile.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen"))
        counts = stage(counts, "counts")
        level = F.least(F.floor(F.log2("seen") * 8), F.lit(255)).cast("int")
        tally = {r.level: r.n for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()}
        least, total = 256, 0
        while least > 0 and total + tally.get(least - 1, 0) <= FREQUENT:
            least -= 1
            total += tally.get(least, 0)
        # FREQUENT rows at most, as Arrow: rows would be objects in the driver's heap and in its Python
        frequent = counts.where(level >= least).select("token", level.alias("level")).toArrow()
        token = frequent["token"].to_numpy().view(np.uint64)
        order = np.argsort(token)
        classes = frequent["level"].to_numpy()[order].astype(np.uint8)
        prefixes = self.rows.mapInArrow(tidy(_prefixes(k, percent, lower, token[order], classes)),
                                        "token long, part int, key long, n int, reach int, rarity int")
        # one exchange: equal sets collapse where they meet; a rare token of one set leads nowhere
        group = Window.partitionBy("token", "part")
        band = F.floor(F.log("n") / F.log(F.lit(100 / percent))).cast("int")
        self.groups = stage(prefixes.repartition("token", "part").groupBy("token", "part", "key").agg(
            F.first("n").alias("n"), F.first("reach").alias("reach"), F.first("rarity").alias("rarity")).withColumn(
            "members", F.count("*").over(group)).where("members > 1 or part > 0").select(
            "token", "key", "n", "reach", "rarity", band.alias("band")), "groups")
        self.full: DataFrame | None = None
        self.seen: DataFrame | None = None
        # not createDataFrame: that is read by Python workers of another kind, which stay beside these
        self.links = spark.range(0).select(F.col("id").alias("a"), F.col("id").alias("b"))

    def _reaches(self, reach: Column, n: Column, m: Column) -> Column:
        """Whether ``reach`` common tokens would link sets of ``n`` and ``m`` tokens."""
        return (100 + self.percent) * reach.cast("long") >= self.percent * (n.cast("long") + m)

    def fetch(self, pairs: DataFrame) -> None:
        """Add the sets of ``pairs`` (a, b) that were not met before to ``full``.

        One document of each set is looked for.  Few of them are sent to the
        scan.  For more, a table of bits tells there which texts may be meant,
        so the others never move; their exchange also keeps the two steps in
        Python apart, which in one task would take two workers a core.
        """
        met = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        if self.full is not None:
            met = met.join(self.full.select("key"), "key", "left_anti")
        met = stage(met.join(self.sets, "key").select(
            F.col("least_id").alias("doc_id"), F.col("key").alias("expected")), "to-fetch")
        if met.count() <= FEW:
            texts = self.rows.join(F.broadcast(met), "doc_id")
        else:
            cells = met.select("doc_id").mapInArrow(_cell_of, "cell long")
            places = cells.groupBy(F.expr("cast(cell div 64 as int)").alias("at")).agg(
                F.bit_or(F.expr("shiftleft(1L, cast(cell % 64 as int))")).alias("bits")).toArrow()  # 2^18 rows at most
            bits = np.zeros(1 << CELLS - 6, dtype="<i8")
            bits[places["at"].to_numpy()] = places["bits"].to_numpy()
            texts = self.rows.mapInArrow(tidy(_wanted(bits.view(np.uint8))), self.rows.schema).join(met.hint("merge"), "doc_id")
        texts = texts.select("doc_id", "text", "expected")
        fetched = stage(texts.mapInArrow(tidy(_sets(self.k, self.percent, self.lower)),
                                         "key long, n long, b array<smallint>, c array<smallint>, text binary"), "full-sets")
        self.full = fetched if self.full is None else self.full.unionByName(fetched)

    def verify(self, pairs: DataFrame) -> None:
        """Add the links among ``pairs`` (a, b) that were not compared before."""
        pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if self.seen is not None:
            pairs = pairs.join(self.seen, ["a", "b"], "left_anti")
        met = stage(pairs, "met")
        self.fetch(met)
        side = lambda s: self.full.select(
            F.col("key").alias(s), F.col("n").alias(f"{s}_n"), *[F.col(o).alias(f"{s}_{o}") for o in "bc"],
            *[F.array_max(o).alias(f"{s}_{o}_end") for o in "bc"])
        pairs = met.join(side("a"), "a").join(side("b"), "b")
        for o in "bc":
            pairs = pairs.where(F.arrays_overlap(f"a_{o}", f"b_{o}"))
            for s, t in ("ab", "ba"):  # tokens of s that t cannot have: the overlap is the rest at most
                absent = F.size(F.array_except(F.filter(f"{s}_{o}", _below(F.col(f"{t}_{o}_end"))), F.col(f"{t}_{o}")))
                pairs = pairs.where((100 + self.percent) * (F.col(f"{s}_n") - absent) >= self.percent * (F.col("a_n") + F.col("b_n")))
        pairs = stage(pairs.select("a", "b"), "candidates")
        text = lambda s: self.full.select(F.col("key").alias(s), F.col("text").alias(f"{s}_text"))
        found = pairs.join(text("a"), "a").join(text("b"), "b").select("a", "b", "a_text", "b_text")
        found = stage(found.mapInArrow(tidy(_linked(self.k, self.percent, self.lower)), "a long, b long"), "links")
        self.links = self.links.unionByName(found)
        self.seen = met if self.seen is None else self.seen.unionByName(met)

    def parts(self) -> DataFrame:
        """The groups' rows with the component that they are in so far."""
        self.links = stars(self.links, "parts")  # they link the same sets, and the next links meet stars
        done = self.links.select(F.col("a").alias("key"), F.col("b").alias("component_id"))
        return stage(self.groups.join(done, "key", "left").withColumn(
            "component_id", F.coalesce("component_id", "key")), "members")

    def star_pairs(self, rows: DataFrame, turn: int) -> DataFrame:
        """Every row with its band's leader: the set of the most frequent tokens at first, a random one later.

        Neither depends on the token, so the tokens that two sets share lead to one leader.
        """
        lot = F.xxhash64(F.lit(turn), "key")
        first = F.struct(F.lit(0) if turn else F.col("rarity"), lot)
        lead = rows.groupBy("token", "band").agg(
            F.min(F.struct(first.alias("first"), "key", "n", "reach", "component_id")).alias("lead"))
        return rows.join(lead, ["token", "band"]).where(
            (F.col("lead.component_id") != F.col("component_id"))
            & self._reaches(F.least("reach", "lead.reach"), F.col("n"), F.col("lead.n"))).select(
            F.col("key").alias("a"), F.col("lead.key").alias("b"))

    def open_pairs(self, rows: DataFrame) -> DataFrame:
        """Pairs of different components that a token's reaches allow to link.

        The smaller set of a pair (of equal ones the smaller key) has the reach
        to link with a set of its own size, so only such rows are looked up.
        """
        small = rows.where(self._reaches(F.col("reach"), F.col("n"), F.col("n")))
        met = small.groupBy("token").agg(F.min("n").alias("least_n"), F.min("component_id").alias("low"),
                                         F.max("component_id").alias("high"))
        large = rows.join(met, "token").where(
            ((F.col("low") != F.col("component_id")) | (F.col("high") != F.col("component_id")))
            & self._reaches(F.col("reach"), F.col("n"), F.col("least_n")))
        x, y = (side.select("token", F.col("key").alias(s), F.col("n").alias(f"n_{s}"), F.col("reach").alias(f"reach_{s}"),
                            F.col("component_id").alias(f"of_{s}")) for side, s in ((large, "a"), (small, "b")))
        order = (F.col("n_a") > F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("a") > F.col("b")))
        return x.join(y, "token").where(
            order & (F.col("of_a") != F.col("of_b"))
            & self._reaches(F.least("reach_a", "reach_b"), F.col("n_a"), F.col("n_b"))).select("a", "b")

    def run(self) -> DataFrame:
        """(key, component_id) of every set that links with a smaller key, the smallest one reachable."""
        rows = self.groups.withColumn("component_id", F.col("key"))
        n_rows = self.groups.count()
        for turn in range(STARS if n_rows else 0):
            self.verify(self.star_pairs(rows, turn))
            rows = self.parts()
            left = self.open_pairs(rows).count()
            if left <= 4 * n_rows:
                break
        if n_rows and left:
            self.verify(self.open_pairs(rows))
            self.links = stars(self.links, "linked")
        return self.links.select(F.col("a").alias("key"), F.col("b").alias("component_id"))


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, lower: bool = True) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable) of every document."""
    with small_batches(docs.sparkSession):  # every step with Python tasks is staged in here
        join = Join(docs, k, percent, lower)
        part = join.run()
    of = join.sets.select("key", "least_id").join(part, "key", "left").select(
        "key", "least_id", F.coalesce("component_id", "key").alias("part"))
    least = of.groupBy("part").agg(F.min("least_id").alias("component_id"))
    keyed = stage(of.join(least, "part").select("key", "component_id"), "component-of-set")
    return join.documents.join(keyed, "key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))


def keep_documents(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose component's smallest doc_id is their own.

    Rows without a doc_id stay.  Rows that repeat a kept doc_id stay together.
    """
    gone = stage(jaccard_components(docs, k, percent).where("doc_id <> component_id").select(
        F.col("doc_id").alias("gone_id")).distinct(), "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_id"], "left_anti")
