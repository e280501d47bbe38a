"""The steps of the byte-substring de-duplication, run without Spark."""

import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from llm import brute
from ledgerlens.llm import repeats, suffix_dedup

GROUPS = 8


def surroundings(texts, length):
    """Packed surroundings of the anchors that ``texts`` (doc_id -> text) share."""
    ids = list(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts.values(), pa.binary())], names=["id", "text"])
    dealt = pa.Table.from_batches(suffix_dedup._anchor_entries(length, GROUPS)(iter([batch]))).to_pandas()
    shared = pd.concat([repeats._answer(True)(rows) for _, rows in dealt.groupby("bucket")])
    places = {i: rows["pos"].tolist() for i, rows in shared.groupby("id")}
    met = [i for i in ids if i in places]
    if not met:
        return None
    batch = pa.RecordBatch.from_arrays(
        [pa.array(met, pa.int64()), pa.array([texts[i] for i in met], pa.binary()),
         pa.array([places[i] * 2 for i in met], pa.list_(pa.int32())), pa.array([0] * len(met), pa.int32())],
        names=["id", "text", "places", "tag"])
    return pa.Table.from_batches(suffix_dedup._around(length, GROUPS)(iter([batch]))).to_pandas()


def removed(texts, length):
    """doc_id -> whether each byte goes."""
    gone = {i: np.zeros(len(t), dtype=bool) for i, t in texts.items()}
    dealt = surroundings(texts, length)
    for _, rows in dealt.groupby("bucket") if dealt is not None else ():
        for r in suffix_dedup._ranges(length)(rows).itertuples():
            assert 0 <= r.first < r.past <= len(texts[r.id])
            gone[r.id][r.first:r.past] = True
    return gone


def expected(texts, length):
    gone = {i: np.zeros(len(t), dtype=bool) for i, t in texts.items()}
    for i, t in texts.items():
        smaller = {u[k:k + length] for j, u in texts.items() if j < i for k in range(len(u) - length + 1)}
        for k in range(len(t) - length + 1):
            if t[k:k + length] in smaller:
                gone[i][k:k + length] = True
    return gone


def awkward_texts(seed, length):
    """Pieces of a few passages in random order, short and long ones, equal ones, runs of one byte."""
    rng = random.Random(seed)
    passages = [bytes(rng.choice(b"ab c") for _ in range(rng.randint(10, 3 * length))) for _ in range(8)] + [b"-" * 2 * length]
    texts = {}
    for i in rng.sample(range(1000), 40):
        pieces = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            a = rng.randint(0, len(p))
            pieces += [p[a:rng.randint(a, len(p))], bytes(rng.choice(b"xyz") for _ in range(rng.randint(0, 20)))]
        texts[i] = b"".join(pieces)
    texts[2000], texts[2001] = b"".join(passages[:4]), b"".join(passages[:4])
    return texts


@pytest.mark.parametrize("length,segment", [(50, None), (50, 64), (20, 17), (17, None), (40, 5)])
def test_ranges_match_brute_force(length, segment, monkeypatch):
    if segment:
        monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
        monkeypatch.setattr(suffix_dedup, "TEXT_BYTES", 100)
        monkeypatch.setattr(suffix_dedup, "FLUSH", 7)
    for seed in range(4):
        texts = awkward_texts(seed, length)
        got, want = removed(texts, length), expected(texts, length)
        assert {i: g.tolist() for i, g in got.items()} == {i: w.tolist() for i, w in want.items()}


def test_every_window_has_the_same_anchor_in_every_text(monkeypatch):
    rng = random.Random(5)
    texts = [bytes(rng.choice(b"ab") for _ in range(n)) for n in (0, 16, 17, 49, 50, 51, 300, 7, 700)] + [b"-" * 200]
    want = []
    for of, text in enumerate(texts):
        places = set()
        for at in range(len(text) - 50 + 1):
            keys = suffix_dedup.gram_hashes(np.frombuffer(text[at:at + 50], np.uint8)) >> np.uint64(16)
            places.add(at + int(np.argmin(keys)))  # the first of equal ones
        want += [(of, p) for p in sorted(places)]
    for segment in (10, 64, 48 << 10):
        monkeypatch.setattr(suffix_dedup, "SEGMENT", segment)
        _, of, place = suffix_dedup.anchors_of(texts, 50)
        assert list(zip(of.tolist(), place.tolist())) == want


def test_surroundings_that_share_no_window_are_not_ordered(monkeypatch):
    """A common gram between different neighbours made every group order all that have it."""
    rng = random.Random(7)
    noise = lambda n: bytes(rng.randrange(256) for _ in range(n))
    texts = {i: noise(60) + b"the common phrase, of 30 bytes" + noise(60) for i in range(300)}
    dealt = surroundings(texts, 50)
    ordered = []
    monkeypatch.setattr(suffix_dedup, "suffix_array", lambda symbols: ordered.append(len(symbols)))
    for _, rows in dealt.groupby("bucket"):
        assert not len(suffix_dedup._ranges(50)(rows))
    assert not ordered


def test_rows_are_compared_whole_where_hashes_meet(monkeypatch):
    monkeypatch.setattr(suffix_dedup, "mix64", lambda x: x & np.uint64(0))
    rows = np.random.default_rng(1).integers(0, 3, (500, 4)).astype(np.uint64)
    order, first = suffix_dedup.equal_rows(rows, np.zeros(500, np.uint64))
    sets = np.split(order, first[1:])
    assert sorted(order.tolist()) == list(range(500))
    assert all((rows[s] == rows[s[0]]).all() for s in sets)
    assert len(sets) == len({tuple(r) for r in rows.tolist()})


def test_the_query_s_plain_version_agrees():
    texts = awkward_texts(9, 50)
    got = {i: int(g.sum()) for i, g in removed(texts, 50).items()}
    rows = [(i, t.decode()) for i, t in texts.items()]
    assert got == {r[0]: r[2] for r in brute.byte_repeats(rows, 50)}
