"""Vendor-name standardisation: substring rules, then fuzzy matching.

``vendor_rule_map`` is a per-row ``CASE`` over upper-cased substring rules,
evaluated inside whole-stage codegen: for tens of rules this is far cheaper
than shuffling a fact table to join it against a mapping.

``vendor_fuzzy_match`` handles what the rules miss.  It works on the
*distinct* raw names only, and finds candidates without a cross product:
names are exploded into character bigrams and equi-joined with the rarest
bigrams of the canonical keys (keys shorter than two characters act as one
marked token).  ``k`` edits destroy at most ``2 k`` bigrams, so ``2 k + 1`` of
them are enough to miss no pair that could pass; thresholds too low for
short names are refused.  Pairs of similar length are scored with
``levenshtein`` and the best canonical per name is kept (``max_by``), then the
small name map joins back to the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import as_col
from ..functions.text import bigrams, max_edits, similarity, token_sort_key
from .sizing import staged

# The coded rule list of the source pipeline (upper-cased
# substring -> canonical vendor), in its order; when several rules match,
# the later one wins.
DEFAULT_VENDOR_RULES: tuple[tuple[str, str], ...] = (
    ("TURNER ELECTRIC", "Turner Electric Co."),
    ("TURNER ELEC", "Turner Electric Co."),
    ("BALFOUR BEATTY", "Balfour Beatty Construction"),
    ("SKANSKA", "Skanska USA Building"),
    ("GAYLOR", "Gaylor Electric"),
    ("ACCO", "ACCO Brands HVAC"),
    ("SOUTHLAND", "Southland Industries"),
    ("ROSENDIN", "Rosendin Electric"),
    ("SWINERTON", "Swinerton Builders"),
    ("DPR", "DPR Construction"),
    ("LIMBACH", "Limbach Holdings"),
    ("EMCOR", "EMCOR Group"),
    ("CUPERTINO", "Cupertino Electric"),
    ("POWER ENGINEERS", "Power Engineers Inc."),
    ("TELAMON", "Telamon Corporation"),
    ("WSP", "WSP Global"),
)

# Documented acceptance score for a fuzzy match (0-100 scale).
DEFAULT_FUZZY_THRESHOLD = 85.0


def rule_expr(col: Column | str, rules: Sequence[tuple[str, str]] = DEFAULT_VENDOR_RULES) -> Column:
    """Canonical name by the highest-priority matching rule, else the input."""
    c = as_col(col)
    up = F.upper(c)
    expr = None
    for pattern, canonical in reversed(list(rules)):  # later rule = higher priority
        hit = up.contains(F.lit(pattern))
        expr = F.when(hit, F.lit(canonical)) if expr is None else expr.when(hit, F.lit(canonical))
    return c if expr is None else expr.otherwise(c)


def vendor_rule_map(df: DataFrame, column: str, output: str | None = None,
                    rules: Sequence[tuple[str, str]] = DEFAULT_VENDOR_RULES) -> DataFrame:
    return df.withColumn(output or column, rule_expr(column, rules))


def canonical_table(spark, canonical: Sequence[str]) -> DataFrame:
    """(canon_id, canonical, canon_key, canon_len) for a canonical name list."""
    rows = [(i, name) for i, name in enumerate(dict.fromkeys(canonical))]
    df = spark.createDataFrame(rows, "canon_id int, canonical string")
    key = token_sort_key("canonical")
    return df.select("canon_id", "canonical", key.alias("canon_key")).withColumn(
        "canon_len", F.length("canon_key")
    )


def _check_threshold(threshold: float) -> None:
    """The bigram search is exact only while every passing pair must share a
    bigram: ``len - 1 - 2 * max_edits(len) > 0`` for every length >= 2.  Short
    names bind: that holds for thresholds above 66.67 (two edits of three
    letters leave no bigram); lower ones are refused rather than silently
    missing matches."""
    f = (100.0 - threshold) / 100.0
    if not 0.0 <= f < 0.5 or any(n - 1 - 2 * int(n * f + 1e-9) <= 0 for n in range(2, 4096)):
        raise ValueError(f"fuzzy threshold must be above 66.67 and at most 100; got {threshold}")


def _grams(key: Column) -> Column:
    """Bigrams of a key; a key too short for bigrams is its own (marked) token,
    so identical short keys still meet in the equi-join."""
    return F.when(F.length(key) >= 2, bigrams(key)).otherwise(F.array(F.concat(F.lit("\u0000"), key)))


def candidates(names: DataFrame, canon: DataFrame, threshold: float) -> DataFrame:
    """Pairs of a raw name and a canonical one that may reach the threshold.

    k edits destroy at most 2 k bigrams, so of any 2 k + 1 bigrams of the
    canonical name a passing raw name has one: only the canonical's 2 k + 1
    rarest bigrams are joined.  Lengths must be within k of each other.  A
    key without a letter or digit never meets anything.
    """
    share = (100.0 - threshold) / 100.0
    grams = canon.where("canon_len > 0").select("canon_id", "canonical", "canon_key", "canon_len",
                                                F.explode(F.array_distinct(_grams(F.col("canon_key")))).alias("gram"))
    common = grams.groupBy("gram").agg(F.count(F.lit(1)).alias("held"))
    rarest = Window.partitionBy("canon_id").orderBy("held", "gram")
    # the longest partner has canon_len / (1 - share) letters, and with it the most edits
    most = F.floor(F.floor(F.col("canon_len") / F.lit(1.0 - share) + F.lit(1e-9)) * F.lit(share) + F.lit(1e-9))
    probe = grams.join(common, "gram").withColumn("nth", F.row_number().over(rarest)).where(
        F.col("nth") <= 2 * most + 1)
    own = names.select("raw_name", token_sort_key("raw_name").alias("name_key")).withColumn(
        "name_len", F.length("name_key")).where("name_len > 0")
    own = own.select("raw_name", "name_key", "name_len", F.explode(F.array_distinct(_grams(F.col("name_key")))).alias("gram"))
    longest = F.greatest("name_len", "canon_len")
    near = F.abs(F.col("name_len") - F.col("canon_len")) <= max_edits(threshold, longest)
    return own.join(probe.drop("held", "nth"), "gram").where(near).select(
        "raw_name", "name_key", "canon_id", "canonical", "canon_key").distinct()


def fuzzy_name_map(names: DataFrame, canon: DataFrame, threshold: float = DEFAULT_FUZZY_THRESHOLD) -> DataFrame:
    """Best canonical per distinct raw name: (raw_name, matched, score).

    ``names`` has one column ``raw_name`` (distinct).  Exact on the score: see
    module docstring.  Ties on score go to the earliest canonical entry.
    """
    _check_threshold(threshold)
    scored = candidates(names, canon, threshold).select(
        "raw_name", "canon_id", "canonical", similarity("name_key", "canon_key").alias("score")
    ).where(F.col("score") >= F.lit(threshold))
    best = scored.groupBy("raw_name").agg(
        F.max_by(F.struct("canonical", "score"), F.struct(F.col("score"), -F.col("canon_id"))).alias("b")
    )
    return best.select("raw_name", F.col("b.canonical").alias("matched"), F.col("b.score").alias("score"))


def rule_hit(col: Column | str, rules: Sequence[tuple[str, str]] = DEFAULT_VENDOR_RULES) -> Column:
    """True when at least one rule pattern occurs in the upper-cased name."""
    up = F.upper(as_col(col))
    hit = F.lit(False)
    for pattern, _ in rules:
        hit = hit | up.contains(F.lit(pattern))
    return hit


def vendor_name_map(df: DataFrame, column: str, canonical: Sequence[str], rules: Sequence[tuple[str, str]],
                    threshold: float = DEFAULT_FUZZY_THRESHOLD) -> DataFrame:
    """(raw_name, cleaned) of every distinct name that a rule hits or that is matched, staged."""
    names = staged(df.select(F.col(column).alias("raw_name")).where(F.col("raw_name").isNotNull()).distinct(), "names")
    by_rule = names.where(rule_hit("raw_name", rules)).select("raw_name", rule_expr("raw_name", rules).alias("cleaned"))
    missed = names.where(~rule_hit("raw_name", rules))
    fuzzy = fuzzy_name_map(missed, canonical_table(df.sparkSession, canonical), threshold)
    return staged(by_rule.unionByName(fuzzy.select("raw_name", F.col("matched").alias("cleaned"))), "name-map")


def vendor_fuzzy_match(df: DataFrame, column: str, output: str | None = None,
                       canonical: Sequence[str] | None = None,
                       rules: Sequence[tuple[str, str]] = DEFAULT_VENDOR_RULES,
                       threshold: float = DEFAULT_FUZZY_THRESHOLD) -> DataFrame:
    """Rules first; names no rule hits are fuzzy-matched to the canonical list.

    The canonical list defaults to the rule targets.  Names matched by neither
    keep their raw spelling.  Rules and scores run once per distinct name;
    the resulting map is a staged table, which Spark broadcasts by its size
    in bytes, or joins by shuffle when it is large (AQE splits a hot name).
    """
    out = output or column
    canonical = list(dict.fromkeys(canonical if canonical is not None else [c for _, c in rules]))
    name_map = vendor_name_map(df, column, canonical, rules, threshold).select(
        F.col("raw_name").alias("__raw"), F.col("cleaned").alias("__cleaned"))
    joined = df.join(name_map, df[column] == name_map["__raw"], "left")
    return joined.withColumn(out, F.coalesce(F.col("__cleaned"), F.col(column))).drop("__raw", "__cleaned")
