"""Name normalisation and similarity expressions for vendor matching."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import as_col


# Accented Latin letters (lower case) and the letters they fold to.
ACCENTS = ("àáâãäåāăąçćčďèéêëēęěìíîïīłñńňòóôõöøōŕřśšťùúûüūůýÿźżž",
           "aaaaaaaaacccdeeeeeeeiiiiilnnnooooooorrsstuuuuuuyyzzz")


def token_sort_key(col: Column | str) -> Column:
    """Lower-case, in-word punctuation dropped, other separators to spaces,
    tokens sorted and re-joined.

    Letters and digits of every script stay, accents are folded.  Word order and punctuation stop mattering: ``"Steel Works, Harbor"`` and
    ``"harbor steel works"`` give the same key, and dotted initials collapse
    (``"W.S.P. Global"`` -> ``"global wsp"``) while hyphens still separate
    words (``"Granite-Civil"`` -> ``"civil granite"``).
    """
    folded = F.translate(F.lower(as_col(col)), *ACCENTS)
    joined = F.regexp_replace(folded, r"[.']", "")
    cleaned = F.trim(F.regexp_replace(joined, r"[^\p{L}\p{N}]+", " "))
    tokens = F.filter(F.split(cleaned, " "), lambda t: t != F.lit(""))
    return F.array_join(F.array_sort(tokens), " ")


def similarity(a: Column | str, b: Column | str) -> Column:
    """``100 * (1 - levenshtein(a, b) / max(len a, len b))`` as double.

    Two empty strings are identical (100).
    """
    a, b = as_col(a), as_col(b)
    longest = F.greatest(F.length(a), F.length(b))
    dist = F.levenshtein(a, b)
    return F.when(longest == 0, F.lit(100.0)).otherwise(
        F.lit(100.0) * (F.lit(1.0) - dist.cast("double") / longest.cast("double"))
    )


def max_edits(threshold: float, longest: Column) -> Column:
    """Largest edit distance that still scores >= ``threshold``."""
    return F.floor(longest.cast("double") * F.lit((100.0 - threshold) / 100.0) + F.lit(1e-9))


def bigrams(col: Column | str) -> Column:
    """Array of the overlapping 2-character substrings of a string."""
    s = as_col(col)
    n = F.length(s)
    return F.when(n >= 2, F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.substring(s, i, 2))).otherwise(
        F.array().cast("array<string>")
    )
