"""Shared doc_ids, long clean documents and clashing column names; plain versions of PII and toxicity scores."""

import hashlib
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from ledgerlens.llm import common, debruijn, exact_dedup, mixing, pii, suffix_dedup, toxicity

PLAIN = "doc_id long, text string"


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(n))


def shared_ids():
    rng = random.Random(8)
    shared, other = prose(rng, 60), prose(rng, 60)
    return [(1, prose(rng, 40) + " " + shared), (2, shared + " " + prose(rng, 40)), (2, prose(rng, 100)),
            (2, prose(rng, 30) + " " + other), (3, other), (3, prose(rng, 70)), (4, other + " " + shared),
            (2, shared + " " + prose(rng, 3)), (None, shared), (None, other + " x"), (5, shared), (5, shared)]


def test_suffix_dedup_of_texts_that_share_a_doc_id(spark):
    rows = shared_ids()
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, PLAIN).repartition(3), 50)
    want = []
    for d, t in rows:
        data, gone = t.encode(), set()
        smaller = [u.encode() for e, u in rows if e is not None and (d is None or e < d)]
        if d is None:  # a null doc_id counts as larger than all others; among nulls the texts decide
            continue
        for i in range(len(data) - 49):
            if any(data[i:i + 50] in u for u in smaller):
                gone.update(range(i, i + 50))
        kept = bytes(x for i, x in enumerate(data) if i not in gone)
        want.append((d, len(data), len(gone), hashlib.sha256(kept).hexdigest()))
    found = [tuple(r) for r in got.where("doc_id is not null").select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()]
    assert sorted(found) == sorted(want)
    assert sum(r[2] == 0 for r in found) >= 3  # texts that repeat nothing lose nothing


def test_word_dedup_of_texts_that_share_a_doc_id(spark):
    rows = shared_ids()
    got = debruijn.remove_repeats(spark.createDataFrame(rows, PLAIN).repartition(3), 35, 16)
    count = {}
    for _, t in rows:
        w = t.split()
        for i in range(len(w) - 34):
            count[tuple(w[i:i + 35])] = count.get(tuple(w[i:i + 35]), 0) + 1
    want = []
    for d, t in rows:
        w, gone = t.split(), set()
        for i in range(len(w) - 34):
            if count[tuple(w[i:i + 35])] > 1:
                gone.update(range(i, i + 35))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    found = [tuple(r) for r in got.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()]
    assert sorted(found, key=repr) == sorted(want, key=repr)


def plain_score(text, bias, weights):
    """The noisy-or written out: 1 - (1 - calm) * prod(1 - what each sentence has above calm)."""
    sigmoid = lambda z: 1 / (1 + math.exp(-z))
    if not re.search(r"[^\W\d_]", text or ""):
        return 0.0
    quiet = 1 - sigmoid(bias)
    for sentence in re.findall(r"[^.!?\n]+", text or ""):
        words = set(re.findall(r"[^\W\d_]+", sentence.lower()))
        z = bias + sum(weights.get(f, 0) for w in words for f in [w, *(w[:n] + "-" for n in (4, 5, 6) if len(w) > n)])
        if z > bias:
            quiet *= (1 - sigmoid(z)) / (1 - sigmoid(bias))
    return 1 - quiet


def test_toxicity_scores_are_the_noisy_or(spark):
    docs = common.table(spark, SF_MID, "documents")
    labels = common.table(spark, SF_MID, "labels")
    model = toxicity.train(docs, labels)
    assert len(model[1]) > 5
    want = {r["doc_id"]: plain_score(r["text"], *model) for r in docs.select("doc_id", "text").collect()}
    got = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert set(got) == set(want) and all(abs(got[d] - want[d]) < 1e-9 for d in want)
    kept = {r["doc_id"] for r in toxicity.clean_documents(docs, labels).collect()}
    assert kept == {d for d, s in want.items() if s < toxicity.THRESHOLD}


def test_a_long_clean_document_is_not_toxic(spark):
    docs, labels = common.table(spark, SF_MID, "documents"), common.table(spark, SF_MID, "labels")
    model = toxicity.train(docs, labels)
    calm = [r["text"] for r in docs.select("text").collect() if r["text"] and plain_score(r["text"], *model) <= 0.0051]
    assert len(calm) > 20
    long = "\n".join(calm * (10_000 // len(calm) + 1))  # thousands of documents in one
    offence = max(docs.select("text").collect(), key=lambda r: plain_score(r["text"], *model))["text"]
    rows = spark.createDataFrame([(1, long), (2, "No known word at all. " * 10_000), (3, long + "\n" + offence), (4, None)], PLAIN)
    got = {r["doc_id"]: r["score"] for r in toxicity.score(rows, model).collect()}
    assert got[1] < 0.01 and got[2] < 0.01 and got[4] < 0.01
    assert got[3] >= toxicity.THRESHOLD or plain_score(offence, *model) < toxicity.THRESHOLD


@pytest.mark.parametrize("label", [0, 1])
def test_labels_of_one_class_give_their_share(spark, label):
    docs = spark.createDataFrame([(i, "some words. and more") for i in range(40)], PLAIN)
    labels = spark.createDataFrame([(i, label) for i in range(40)], "doc_id long, toxic int")
    scores = {r["score"] for r in toxicity.score(docs, toxicity.train(docs, labels)).collect()}
    assert len(scores) == 1 and (scores.pop() > 0.9) == bool(label)


CLASHES = ("size", "block", "place", "times", "target", "source_key", "source_size", "passes", "more", "last", "mix_shard",
           "mix_copy", "mix_place", "mix_row", "__digest", "turn", "rest", "upto", "a.b")


def clashing(spark):
    docs = common.table(spark, SF_SMALL, "documents").select("doc_id", "text", "source")
    return docs.withColumns({c: F.concat(F.lit(f"{c} of "), F.col("doc_id").cast("string")) for c in CLASHES})


def test_mixing_leaves_all_columns_alone(spark):
    docs = common.stage(clashing(spark), "clashing")
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) > 100 and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in CLASHES)
    plain = mixing.mixed_documents(docs.select("doc_id", "text", "source"))
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in plain.collect())
    three = mixing.mix(docs)
    assert three.columns[-3:] == list(mixing.OWN) and three.where("target <> concat('target of ', doc_id)").count() == 0


def test_exact_dedup_leaves_all_columns_alone(spark):
    docs = common.stage(clashing(spark), "clashing")
    docs = docs.unionByName(docs.limit(20))
    out = exact_dedup.keep_documents(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    assert all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in CLASHES)
    assert len(rows) == docs.select("text").distinct().count()


def test_pii_of_a_table(spark):
    """Values of each kind written into texts: replaced, formats kept, equal values linked, the rest untouched."""
    rng, rows, cards = random.Random(4), [], ["4111111111111111", "5555555555554444", "378282246310005"]
    for i in range(60):
        rows.append((i, f"{prose(rng, 5)} card {cards[i % 3]} and iban DE89370400440532013000 on 2024-03-05, {prose(rng, 5)}"))
    rows.append((99, "nothing here 1234567890123456"))
    got = {r["doc_id"]: r for r in pii.pseudonymise_documents(spark.createDataFrame(rows, PLAIN), b"key").collect()}
    text = {d: r["text"] for d, r in got.items()}
    assert text[99] == rows[-1][1]
    seen = {}
    for i, was in rows[:-1]:
        m = re.fullmatch(r"(.*) card (\d+) and iban (DE\d{20}) on (\d{4}-\d\d-\d\d), (.*)", text[i])
        assert m and was.startswith(m[1] + " card ") and was.endswith(m[5])
        assert len(m[2]) == len(cards[i % 3]) and m[2] != cards[i % 3] and m[3] != "DE89370400440532013000"
        assert sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(m[2]))) % 10 == 0
        assert int("".join(str(int(c, 36)) for c in m[3][4:] + m[3][:4])) % 97 == 1
        seen.setdefault(i % 3, set()).add((m[2], m[3], m[4]))
    assert all(len(v) == 1 for v in seen.values()) and len({next(iter(v))[0] for v in seen.values()}) == 3
