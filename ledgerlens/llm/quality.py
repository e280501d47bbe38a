"""Quality by co-training a text view and a page-metadata view.

The text view sees counts taken from the text (letters, case, marks, repeated
words and lines); the metadata view sees language, source and stored length.
Each round either view is fitted on the labelled pool and on what the other
has pseudo-labelled so far, and hands over its most confident rows of each
class, if they are confident enough.  At the end both views' log-odds are
calibrated on labelled rows by a logistic fit (Platt) that weighs them, and
that combination scores all documents as one native expression.

The pool is a bounded sample: at most ``SAMPLE`` labelled rows (none held out)
and as many unlabelled ones, 30-odd numbers each, on the driver.  All
documents are scored.

Null texts count as empty, null metadata as values of their own; a table
without usable labels scores 0.5.  Rows are scored one by one, so ties and
repeated rows score alike.  Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.toxicity import held_out

SAMPLE = 12_000
ROUNDS = 5
HAND_OVER = 400  # rows of a class that a view hands over in a round, at most
CONFIDENT = 0.95
TOP_VALUES = 50  # most frequent sources and languages of the pool that get a weight


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def text_view() -> dict[str, Column]:
    """Numbers of one text, all native."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    count = lambda pattern: F.regexp_count(text, F.lit(pattern))  # noqa: E731  lists what it finds: for rare patterns
    n, words = F.length(text), F.split(F.lower(text), r"[\x09-\x0D ]+")
    of = lambda chars: n - F.length(F.translate(text, chars, ""))
    kept = lambda other: F.length(F.regexp_replace(text, other, ""))
    lines = F.split(text, "\n")
    n_words = F.size(words)
    return {
        "t_log_chars": F.log1p(n.cast("double")) / 10,
        "t_upper": _share(kept(r"[^\p{Lu}]+"), n), "t_letters": _share(kept(r"[^\p{L}]+"), n),
        "t_digits": _share(of("0123456789"), n), "t_marks": _share(of("!#$%&*@^~=<>{}[]\\|/_"), n),
        "t_stops": _share(of(".,;:?"), n), "t_blanks": _share(of(" \t\r\n"), n),
        "t_word_chars": _share(n, n_words) / 20,
        "t_distinct": _share(F.size(F.array_distinct(words)), n_words),
        "t_lines": _share(F.size(lines), n_words), "t_distinct_lines": _share(F.size(F.array_distinct(lines)), F.size(lines)),
        "t_bars": F.log1p(of("|").cast("double")) / 5,
        "t_tags": F.log1p(count(r"<[a-zA-Z/]|https?:|\{|\}").cast("double")) / 5,
        "t_odd": _share(count(r"\w[!#$%&*]{2,}|!!|\?\?|\.\.\."), n_words),
    }


def meta_view() -> dict[str, Column]:
    size = F.coalesce(F.col("n_chars").cast("double"), F.lit(0.0))
    return {"m_log_chars": F.log1p(F.greatest(size, F.lit(0.0))) / 10,
            "m_log_chars_2": F.pow(F.log1p(F.greatest(size, F.lit(0.0))) / 10, 2),
            "m_no_chars": F.col("n_chars").isNull().cast("double")}


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> np.ndarray:
    """Weights (bias last) of a ridge logistic fit by Newton steps."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    pull = np.full(len(w), ridge * weight.sum())
    pull[-1] = 1e-9
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + pull * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(pull)
        step = np.linalg.solve(curve, grad)
        w -= step * min(1.0, 5 / max(1e-12, np.abs(step).max()))
        if np.abs(step).max() < 1e-6:
            break
    return w


def _odds(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def co_train(views: list[np.ndarray], y: np.ndarray, rounds: int = ROUNDS) -> tuple[list[np.ndarray], np.ndarray]:
    """(weights of each view, weights of the combination); y is 0, 1 or nan for unlabelled.

    A view learns from the labels and from the rows that the *other* view has
    handed over; classes weigh alike.  A fifth of the labelled rows is kept
    from the views' fits and calibrates them.
    """
    known = np.flatnonzero(~np.isnan(y))
    calibrate, learn = known[::5], np.delete(known, slice(None, None, 5))
    given: list[dict[int, float]] = [{}, {}]
    fits: list[np.ndarray] = []
    for _ in range(rounds):
        fits = []
        for v, x in enumerate(views):
            rows = np.concatenate([learn, np.fromiter(given[v], int, len(given[v]))])
            labels = np.concatenate([y[learn], np.fromiter(given[v].values(), float, len(given[v]))])
            share = max(1e-9, min(1 - 1e-9, labels.mean()))
            fits.append(logistic(x[rows], labels, np.where(labels > 0, 0.5 / share, 0.5 / (1 - share))))
        for v, x in enumerate(views):
            p = 1 / (1 + np.exp(-_odds(x, fits[v])))
            free = np.array([i for i in np.flatnonzero(np.isnan(y)) if i not in given[1 - v]], int)
            for c in (0, 1):
                sure = p[free] if c else 1 - p[free]
                best = np.argsort(-sure, kind="stable")[:HAND_OVER]
                given[1 - v].update((int(free[i]), float(c)) for i in best if sure[i] >= CONFIDENT)
    both = np.column_stack([_odds(x[calibrate], f) for x, f in zip(views, fits)]) / 10
    return fits, logistic(both, y[calibrate], np.ones(len(calibrate)))


def _linear(parts: dict[str, Column], weights: np.ndarray) -> Column:
    out = F.lit(float(weights[-1]))
    for column, w in zip(parts.values(), weights):
        out = out + column * F.lit(float(w))
    return F.greatest(F.lit(-30.0), F.least(F.lit(30.0), out))


def _one_hot(column: str, values: list) -> dict[str, Column]:
    return {f"m_{column}_{i}": F.coalesce(F.col(column).cast("string").eqNullSafe(F.lit(v)), F.lit(False)).cast("double")
            for i, v in enumerate(values)}


def quality(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher is better), text_score, meta_score, predicted."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", "n_chars")
    marked = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(
        F.max("quality").cast("double").alias("y"))
    picked = None
    for c in (0, 1):
        part = marked.where(~held_out()).where(F.col("y") == c).orderBy(
            F.xxhash64(F.lit(5), "doc_id"), "doc_id").limit(sample // 2)
        picked = part if picked is None else picked.unionByName(part)
    # at most ``sample`` rows: a proven bound for the broadcast
    seen = docs.join(F.broadcast(picked), "doc_id")
    # the unlabelled part of the pool: a hash threshold that lets ``sample`` rows pass, about
    n_docs = max(1, docs.count())
    lot = F.pmod(F.xxhash64(F.lit(6), "doc_id"), F.lit(1 << 30)) < F.lit(int(min(1.0, sample / n_docs) * (1 << 30)))
    rest = docs.where(lot).join(marked.select("doc_id"), "doc_id", "left_anti").withColumn(
        "y", F.lit(None).cast("double")).limit(2 * sample)
    parts = {**text_view(), **meta_view()}
    pool = seen.unionByName(rest.select(*seen.columns)).select(
        "doc_id", "y", F.col("lang").cast("string").alias("lang"), F.col("source").cast("string").alias("source"),
        *[c.cast("double").alias(k) for k, c in parts.items()]).toPandas().sort_values("doc_id", ignore_index=True)
    known = pool["y"].dropna()
    base = docs.withColumn("held_out", held_out())
    if known.nunique() < 2 or len(known) < 20:
        return base.select("doc_id", "held_out", *[F.lit(0.5).alias(c) for c in ("score", "text_score", "meta_score")],
                           F.lit(1).alias("predicted"))
    hot: dict[str, Column] = {}
    for column in ("lang", "source"):
        values = pool[column].value_counts(dropna=False).index[:TOP_VALUES].tolist()
        values = [None if v != v else v for v in values]
        hot |= _one_hot(column, values)
        for i, v in enumerate(values):
            pool[f"m_{column}_{i}"] = (pool[column].isna() if v is None else pool[column] == v).astype(float)
    text, meta = text_view(), {**meta_view(), **hot}
    fits, combine = co_train([pool[list(v)].to_numpy(float) for v in (text, meta)], pool["y"].to_numpy(float))
    p = lambda odds: 1 / (1 + F.exp(-odds))
    # the features once, as columns; then the two linear forms over the columns
    wide = base.select("doc_id", "held_out", *[c.cast("double").alias(k) for k, c in {**text, **meta}.items()])
    ready = wide.select("doc_id", "held_out", _linear({k: F.col(k) for k in text}, fits[0]).alias("a"),
                        _linear({k: F.col(k) for k in meta}, fits[1]).alias("b"))
    odds = F.lit(float(combine[2])) + F.col("a") * float(combine[0] / 10) + F.col("b") * float(combine[1] / 10)
    return ready.select("doc_id", "held_out", p(odds).alias("score"), p(F.col("a")).alias("text_score"),
                        p(F.col("b")).alias("meta_score"), (p(odds) >= 0.5).cast("int").alias("predicted"))
