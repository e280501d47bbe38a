"""Substring rules kept as a table: thousands of them, without a CASE chain.

A rule (pattern, canonical, priority) applies to a name that contains the
pattern, both upper-cased; of several the highest priority wins, then the later
canonical name.  A chain tests every rule on every row.  Here a rule is looked
for only in names that hold its rarest gram:

* the distinct names are exploded into their grams (runs of ``GRAM`` letters;
  shorter runs only where a pattern is that short);
* every pattern is represented by that one of its grams that the fewest names
  hold, and patterns with a gram that no name holds drop out;
* names and patterns meet by an equi-join on the gram, the containment is
  checked, and ``max_by`` keeps the best rule per name (partial aggregation).

What is shuffled is grams of distinct names, never rows.  The name map joins
back to the rows as a staged table, by broadcast below Spark's byte limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .sizing import staged

GRAM = 3


def _grams(text: Column, size: Column | int) -> Column:
    """Runs of ``size`` letters, each once; none where the text is shorter."""
    size = F.lit(size) if isinstance(size, int) else size
    places = F.length(text) - size + 1
    runs = F.transform(F.sequence(F.lit(1), F.greatest(places, F.lit(1))), lambda i: F.substr(text, i, size))
    return F.when(places >= 1, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def clean_rules(rules: DataFrame) -> DataFrame:
    """Rules that can apply: (pattern upper-cased, canonical, priority), the best one per pattern."""
    upper = rules.select(F.upper("pattern").alias("pattern"), "canonical", F.col("priority").cast("long").alias("priority"))
    best = upper.where("pattern is not null and canonical is not null").groupBy("pattern").agg(
        F.max(F.struct(F.coalesce("priority", F.lit(-(1 << 63))).alias("priority"), "canonical")).alias("r"))
    return best.select("pattern", "r.canonical", "r.priority")


def rule_hits(names: DataFrame, rules: DataFrame) -> DataFrame:
    """(raw_name, canonical, pattern, priority) of every distinct name that a rule applies to.

    ``names`` has one column, ``raw_name``; null names match nothing.
    """
    rules = staged(clean_rules(rules), "rules")
    sizes = [r[0] for r in rules.select(F.least(F.length("pattern"), F.lit(GRAM)).alias("n")).distinct().collect()]
    own = names.where("raw_name is not null").select("raw_name", F.upper("raw_name").alias("up"))
    grams = F.concat(*[_grams(F.col("up"), n) for n in sizes if n], F.array().cast("array<string>"))
    if 0 in sizes:  # an empty pattern is in every name
        grams = F.concat(grams, F.array(F.lit("")))
    held = staged(own.select("raw_name", "up", F.explode(grams).alias("gram")), "name-grams")
    size = F.least(F.length("pattern"), F.lit(GRAM))
    wanted = rules.select("pattern", "canonical", "priority", F.explode(
        F.when(size == 0, F.array(F.lit(""))).otherwise(_grams(F.col("pattern"), size))).alias("gram"))
    common = held.join(wanted.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(
        F.count(F.lit(1)).alias("n_names"))
    # a pattern with a gram in no name cannot apply: the count of its found grams tells
    placed = wanted.join(common, "gram", "left").groupBy("pattern").agg(
        F.first("canonical").alias("canonical"), F.first("priority").alias("priority"),
        F.min_by("gram", F.struct("n_names", "gram")).alias("gram"), F.count_if(F.col("n_names").isNull()).alias("absent"))
    met = held.join(placed.where("absent = 0").drop("absent"), "gram").where(F.col("up").contains(F.col("pattern")))
    best = met.groupBy("raw_name").agg(F.max(F.struct("priority", "canonical", "pattern")).alias("b"))
    return best.select("raw_name", "b.canonical", "b.pattern", "b.priority")


def vendor_rule_table(df: DataFrame, column: str, rules: DataFrame, output: str | None = None) -> DataFrame:
    """``df`` with the canonical name of the best rule in ``output``; the name itself where none applies."""
    out = output or column
    names = staged(df.select(F.col(column).alias("raw_name")).distinct(), "names")
    found = staged(rule_hits(names, rules).select(F.col("raw_name").alias("__raw"), F.col("canonical").alias("__canonical")),
                   "rule-map")
    joined = df.join(found, df[column] == found["__raw"], "left")
    return joined.withColumn(out, F.coalesce("__canonical", F.col(column))).drop("__raw", "__canonical")
