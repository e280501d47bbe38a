"""Mixing sources to target weights with an exact hypergeometric splitting tree.

Native Spark SQL throughout.  Sizes are words.  The documents of a source are
dealt by a keyed hash into blocks, and the hash permutes the blocks.  A source
whose target is p whole passes and a rest takes every block p times, and its
first permuted blocks once more, as many as come nearest to the rest; inside
the block at the edge the decision is made document by document.

The drawn blocks are dealt to output shards by a splitting tree.  A node holds
the exact block quota of every source; the left child's quotas are a
multivariate hypergeometric draw (selection sampling: a block goes left with
the chance that what is still to go left bears to what is left), the right
child gets the rest.  The leaves' quotas cut the permuted blocks of each
source into disjoint intervals, one per shard, and a shard shuffles locally.

Nulls: a null text has size 0 and a null source is a source of its own, after
all others.  Documents without words are in the mix as often as their source
has whole passes.  Repeated rows are separate documents.  Empty tables give
empty results.  Other columns pass through ``mix`` untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import stage, text_bytes, word_count

CYCLE = (1, 2, 3)  # weights of the sources in code point order
CAP = 3.0  # times a source's own size
BLOCKS = 1024  # blocks of a source, at least
SHARDS = 16  # output shards, at least; a power of two
SHARD_BYTES = 256 << 20  # text of a shard, about
SEED = 20240607


def _targets(sources: DataFrame) -> DataFrame:
    """(source_key, source_size, weight) -> target, by water-filling in closed form.

    Sources reach their cap in the order of size / weight.  With the sources
    up to some rank capped, the others share the rest by weight at one level;
    the true number of capped sources is the least one whose level is no
    more than the next source's own limit.  Running sums per source only.
    """
    ratio = F.when(F.col("source_size") > 0, CAP * F.col("source_size") / F.col("weight"))
    rows = sources.withColumn("limit_at", F.coalesce(ratio, F.lit(0.0)))
    order = Window.orderBy("limit_at", "source_key")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    rows = rows.withColumns({
        "all_size": F.sum("source_size").over(whole), "all_weight": F.sum("weight").over(whole),
        "capped": F.coalesce(F.sum(CAP * F.col("source_size")).over(before), F.lit(0.0)),
        "gone": F.coalesce(F.sum("weight").over(before), F.lit(0))})
    rows = rows.withColumn("level", (F.col("all_size") - F.col("capped"))
                           / (F.col("all_weight") - F.col("gone")))
    level = F.min(F.when(F.col("level") <= F.col("limit_at"), F.struct("limit_at", "level"))).over(whole)
    return rows.withColumn("level", level["level"]).withColumn(
        "target", F.least(CAP * F.col("source_size"),
                          F.coalesce(F.col("level") * F.col("weight"), CAP * F.col("source_size"))))


def plan(docs: DataFrame, weights: DataFrame | None = None) -> DataFrame:
    """Per source: source_key, source, source_size, weight, target, passes, rest.

    ``weights`` (source, weight) replaces the repeating 1, 2, 3.
    """
    sizes = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    # one row per source from here on; the order is by UTF-8 bytes, which is by code point
    place = Window.orderBy(F.col("source").asc_nulls_last())
    sizes = sizes.withColumn("source_key", F.row_number().over(place))
    if weights is None:
        cycle = F.array(*[F.lit(float(w)) for w in CYCLE])
        sizes = sizes.withColumn("weight", F.element_at(cycle, (F.col("source_key") - 1) % len(CYCLE) + 1))
    else:
        w = weights.select(F.col("source").alias("w_source"), F.col("weight").cast("double"))
        sizes = sizes.join(w, sizes["source"].eqNullSafe(w["w_source"])).drop("w_source")
    full = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0))
    return _targets(sizes).select(
        "source_key", "source", "source_size", "weight", "target", full.alias("passes"),
        (F.col("target") - full * F.col("source_size")).alias("rest"))


def _shards(n_bytes: int) -> int:
    return max(SHARDS, 1 << (n_bytes // SHARD_BYTES).bit_length())


def shards_for(docs: DataFrame) -> int:
    """A power of two that keeps a shard near SHARD_BYTES of text."""
    return _shards(text_bytes(docs))


def blocks_for(shards: int) -> int:
    return max(BLOCKS, 4 * shards)


def placed(rows: DataFrame, blocks: int) -> DataFrame:
    """``rows`` with their place in the permutation of their source."""
    return rows.withColumns({
        "block": F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(blocks)).cast("int"),
        "place": F.xxhash64(F.lit(SEED + 1), "doc_id")})


def draws(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """(source_key, block, passes, more): how often each block is taken; ``more`` is null
    at the edge, where the documents decide by ``edge_rest`` words."""
    blocks = rows.groupBy("source_key", "block").agg(F.sum("size").alias("words"))
    order = Window.partitionBy("source_key").orderBy("block")  # at most BLOCKS rows a source
    blocks = blocks.withColumn("upto", F.sum("words").over(order))
    met = blocks.join(sources.select("source_key", "passes", "rest"), "source_key")
    start = F.col("upto") - F.col("words")
    return met.select(
        "source_key", "block", "passes",
        F.when(F.col("upto") <= F.col("rest"), 1).when(start >= F.col("rest"), 0).alias("more"),
        (F.col("rest") - start).alias("edge_rest"))


def taken(docs: DataFrame, weights: DataFrame | None = None,
          blocks: int = BLOCKS) -> tuple[DataFrame, DataFrame]:
    """(rows with ``times`` each is taken, per-block draws)."""
    return _taken(placed(docs.withColumn("size", word_count("text")), blocks), weights)


def _taken(rows: DataFrame, weights: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    sources = stage(plan(rows.select("source", "size"), weights), "mix-plan")
    keyed = rows.join(sources.select(
        "source_key", F.col("source").alias("s_source"), "source_size", "target"),
        F.col("source").eqNullSafe(F.col("s_source"))).drop("s_source")
    drawn = stage(draws(keyed.select("source_key", "block", "size"), sources), "mix-draws")
    # one block per source at most is at the edge: its documents in permuted order
    edge = drawn.where("more is null").select("source_key", "block", "edge_rest")
    order = Window.partitionBy("source_key").orderBy("place", "doc_id")
    short = keyed.select("source_key", "block", "doc_id", "place", "size").join(
        edge, ["source_key", "block"]).withColumn("upto", F.sum("size").over(
            order.rowsBetween(Window.unboundedPreceding, 0)))
    # the document that crosses the edge goes in when that comes nearer to the rest
    near = F.col("upto") - F.col("size") / 2 <= F.col("edge_rest")
    inside = stage(short.groupBy("source_key", "block").agg(
        F.max(F.when(near, F.struct("place", "doc_id"))).alias("last")), "mix-edge")
    plan_of = stage(drawn.join(inside, ["source_key", "block"], "left").select(
        "source_key", "block", "passes", "more", "last"), "mix-plan-of")
    met = keyed.join(plan_of, ["source_key", "block"])
    again = F.coalesce(F.col("more"), F.when(F.struct("place", "doc_id") <= F.col("last"), 1), F.lit(0))
    return met.withColumn("times", (F.col("passes") + again).cast("long")), drawn


def split_tree(drawn: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(shard, source_key, first, quota): how many drawn blocks of a source a shard gets,
    and the place of the first of them among the source's permuted draws."""
    quota = drawn.groupBy("source_key").agg(
        F.sum(F.col("passes") + F.coalesce("more", F.lit(1))).cast("long").alias("quota"))
    # the root: one number per source, dealt down level by level
    node = quota.groupBy().agg(F.sort_array(F.collect_list(F.struct("source_key", "quota"))).alias("quotas"))
    node = node.select(F.lit(0).alias("shard"), "quotas")
    levels = shards.bit_length() - 1
    for level in range(levels):
        node = node.withColumn("total", F.expr("aggregate(quotas, 0L, (a, q) -> a + q.quota)"))
        # selection sampling: ``need`` of the ``have`` blocks still to be seen go left
        draw = f"""aggregate(quotas,
            named_struct('need', floor((total + pmod(shard, 2)) / 2), 'have', total, 'left', cast(array() as array<bigint>)),
            (acc, q) -> aggregate(sequence(0L, q.quota),
                named_struct('need', acc.need, 'have', acc.have, 'left', acc.left, 'got', 0L),
                (s, i) -> if(i = 0L, s, if(
                    pmod(xxhash64({SEED}, {level}, shard, q.source_key, i), 9007199254740992L) / 9007199254740992D
                        * s.have < s.need,
                    named_struct('need', s.need - 1L, 'have', s.have - 1L, 'left', s.left, 'got', s.got + 1L),
                    named_struct('need', s.need, 'have', s.have - 1L, 'left', s.left, 'got', s.got))),
                s -> named_struct('need', s.need, 'have', s.have, 'left', concat(s.left, array(s.got)))),
            acc -> acc.left)"""
        node = node.withColumn("went", F.expr(draw))
        side = "transform(quotas, (q, i) -> named_struct('source_key', q.source_key, 'quota', {}))"
        node = node.withColumn("child", F.explode(F.array(
            F.struct((F.col("shard") * 2).alias("shard"), F.expr(side.format("went[i]")).alias("quotas")),
            F.struct((F.col("shard") * 2 + 1).alias("shard"),
                     F.expr(side.format("q.quota - went[i]")).alias("quotas"))))).select("child.*")
        node = stage(node, "mix-tree")
    leaf = node.select("shard", F.explode("quotas").alias("q")).select("shard", "q.source_key", "q.quota")
    before = Window.partitionBy("source_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return leaf.withColumn("first", F.coalesce(F.sum("quota").over(before), F.lit(0)).cast("long"))


def dealt(rows: DataFrame, drawn: DataFrame, shards: int) -> DataFrame:
    """Every copy of the ``taken`` rows with its mix_shard, mix_copy and mix_place."""
    drawn_n = (F.col("passes") + F.coalesce("more", F.lit(1))).cast("int")
    turns = drawn.where(drawn_n > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), drawn_n)))
    turns = turns.withColumn("turn", F.row_number().over(
        Window.partitionBy("source_key").orderBy("copy", F.xxhash64(F.lit(SEED + 2), "block"))) - 1)
    owner = split_tree(drawn, shards).where("quota > 0").select(  # a shard's interval, turn by turn
        "source_key", F.col("shard").alias("mix_shard"), F.explode(F.sequence("first", F.expr("first + quota - 1"))).alias("turn"))
    owned = stage(turns.withColumn("turn", F.col("turn").cast("long")).join(owner, ["source_key", "turn"])
                  .select("source_key", "block", "copy", "mix_shard"), "mix-owned")
    copies = rows.where("times > 0").withColumn("mix_copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    out = copies.join(owned.withColumnRenamed("copy", "mix_copy"), ["source_key", "block", "mix_copy"])
    return out.withColumn("mix_place", F.xxhash64(F.lit(SEED + 3), "doc_id", "mix_copy"))


def shuffled(copies: DataFrame, shards: int) -> DataFrame:
    """The copies shard by shard, in the order of their places."""
    return copies.repartition(shards, "mix_shard").sortWithinPartitions("mix_shard", "mix_place", "mix_copy", "doc_id")


OWN = ("mix_shard", "mix_copy", "mix_place")


def _mixed(docs: DataFrame, weights: DataFrame | None, shards: int) -> DataFrame:
    """Every copy with its whole row as ``mix_row``: no column of ``docs`` meets one of the operator's."""
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row")
    rows = docs.select("doc_id", "source", word_count("text").alias("size"), whole)
    rows, drawn = _taken(placed(rows, blocks_for(shards)), weights)
    return dealt(rows, drawn, shards).select("doc_id", "mix_row", *OWN)


def mix(docs: DataFrame, weights: DataFrame | None = None, shards: int | None = None) -> DataFrame:
    """The mix: ``docs`` with every copy a row, plus mix_shard, mix_copy and mix_place.

    A copy's shard is that of its drawn block: the draws of a source are its
    blocks pass after pass in permuted order, and every shard owns an
    interval of them.  Rows are ordered inside a shard by a keyed hash.  A
    column of ``docs`` that is named like one of the three gives way to it.
    """
    kept = [F.col("mix_row")[c].alias(c) for c in docs.columns if c.lower() not in OWN]
    return _mixed(docs, weights, shards or shards_for(docs)).select(*kept, *OWN)


def mixed_documents(docs: DataFrame, shards: int | None = None) -> DataFrame:
    """The mix as rows of ``docs``, all their columns untouched, shard by shard, shuffled inside each shard."""
    shards = shards or shards_for(docs)
    return shuffled(_mixed(docs, None, shards), shards).select(*[F.col("mix_row")[c].alias(c) for c in docs.columns])


def mix_digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken per document.

    ``taken`` counts the document's copies in the shuffled shards.  A copy
    carries its row's number instead of the text, so that null and repeated
    doc_ids are told apart; the number holds because the rows are staged.
    """
    rows = stage(docs.select("doc_id", "source", word_count("text").alias("size"), F.octet_length("text").alias("n_bytes"),
                             F.monotonically_increasing_id().alias("row")), "mix-rows")
    shards = _shards(rows.agg(F.sum("n_bytes")).first()[0] or 0)
    rows, drawn = _taken(placed(rows, blocks_for(shards)), None)
    mixed = stage(shuffled(dealt(rows, drawn, shards), shards).select(
        "row", "mix_shard", "mix_place", "mix_copy"), "mix-shards")
    copies = mixed.groupBy(F.col("row").alias("of_row")).agg(F.count("*").alias("copies"))
    return rows.join(copies, F.col("row") == F.col("of_row"), "left").select(
        "doc_id", "size", "source_size", "target",
        (F.coalesce("copies", F.lit(0)) * F.col("size")).alias("taken"))
