"""Frames, token shards and vector codes against plain versions, over awkward tables."""

import hashlib
import math
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from ledgerlens.llm import common, fim, queries, token_store, vector_codes
from llm.test_operators import SCHEMA, awkward, rows_of, table

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TOKENS = queries.tokenizer_path("word_bpe_49k.json")


def more_awkward():
    return [*awkward(), (50, "holds <P> a mark"), (51, "<S>"), (52, "x <M"), (53, "<" * 40 + " <P <S <M " * 9),
            (54, "日本 é x y" * 50), (55, " lead and trail \n"), (56, "\x1c \x85 \x0b"), (57, "é" * 400),
            (58, "a\0b c\0"), (59, "İstanbul ΣΑΣ ﬁ é <|endoftext|>x it's don't")]


@pytest.fixture(scope="module")
def docs(spark):
    return common.stage(table(spark, more_awkward()).repartition(3), "more-awkward")


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_fim(doc_id, text, seed=42, fim_rate=50, spm_rate=80):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    h = sha(f"{seed}:{'' if doc_id is None else doc_id}")
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= fim_rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm_rate:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@pytest.mark.parametrize("frame", [7, 64, fim.FRAME])
@pytest.mark.parametrize("fim_rate", [50, 100])
def test_fim(docs, frame, fim_rate):
    got = fim.transform(common.stage(fim.frame_store(docs, frame), "frames"), fim_rate=fim_rate, spm_rate=50, frame=frame)
    want = [brute_fim(d, t, fim_rate=fim_rate, spm_rate=50) for d, t in more_awkward()]
    assert rows_of(fim.output_texts(got), "doc_id", "form", "output") == sorted(
        ((w[0], w[2], w[5]) for w in want), key=repr)
    texts = {(d, sha(t or "")) for d, t in more_awkward()}
    found = rows_of(fim.with_restored(got), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256",
                    "restored_sha256")
    assert [f[:6] for f in found] == sorted(((*w[:5], sha(w[5])) for w in want), key=repr)
    assert {(f[0], f[6]) for f in found} == texts and len(found) == len(want)


def test_fim_query_on_awkward_rows(docs, empty):
    found = rows_of(fim.fim_digest(docs), "doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256")
    assert found == sorted(((*w[:5], sha(w[5])) for w in (brute_fim(d, t) for d, t in more_awkward())), key=repr)
    assert fim.fim_digest(empty).collect() == []


def test_a_cut_decompresses_one_frame_and_the_store_is_seekable():
    text = " ".join(f"wörd{i}" for i in range(20_000)).encode()
    units, chars, ends, frames = fim.build(text, zstandard.ZstdCompressor(), 1000)
    assert units[-1] == 20_000 and chars[-1] == len(text.decode()) and ends[-1] == len(text)
    assert all(zstandard.ZstdDecompressor().decompress(f).decode() for f in frames)  # cut between code points
    opened = []

    class Counted:
        def decompress(self, frame):
            opened.append(frame)
            return zstandard.ZstdDecompressor().decompress(frame)

    held = fim.Frames(ends, frames, Counted())
    for k in (0, 1, 777, 19_999, 20_000):
        before = len(opened)
        at, n_chars = held.cut(k, units, chars)
        assert text[:at].decode() == " ".join(f"wörd{i}" for i in range(k)) and n_chars == len(text[:at].decode())
        assert len(opened) - before <= 1
    assert b"".join(held.read(995, 4021)) == text[995:4021] and list(held.read(5, 5)) == []


def brute_tokens(rows, docs):
    """(doc_id, n_tokens, crc) of each row, encoded as a whole by the library."""
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(TOKENS)
    out = []
    for d, t in docs:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((d, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    return out


@pytest.mark.parametrize("shard_bytes", [200, token_store.SHARD_BYTES])
def test_token_store(spark, docs, shard_bytes, monkeypatch):
    monkeypatch.setattr(token_store, "groups_for", lambda total, each: max(1, int(total // each)))
    path = common.scratch_path(spark, "token-test")
    manifest = common.stage(token_store.write(docs, path, TOKENS, shard_bytes=shard_bytes), "kept-manifest")
    assert (manifest.count() > 5) == (shard_bytes == 200)
    got = token_store.read(manifest, path, with_ids=True).collect()
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) \
        == sorted(brute_tokens(None, more_awkward()), key=repr)
    got.sort(key=lambda r: r["start"])  # gapless, in ascending doc_id order, nulls first
    keys = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in got]
    assert keys == sorted(keys)
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:i]) for i in range(len(got))]
    assert all(zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["n_tokens"] for r in got)
    wanted = [1, 2, 9, 37, 1000]  # short-document access
    few = sorted(map(tuple, token_store.fetch(manifest, path, wanted).collect()))
    assert few == sorted(tuple(r) for r in got if r["doc_id"] in wanted)


def test_token_store_of_no_rows(spark, empty):
    assert token_store.token_digest(spark, empty, TOKENS).collect() == []


def test_token_query_against_the_library(spark):
    from conftest import SF_SMALL

    docs = common.table(spark, SF_SMALL, "documents").select("doc_id", "text").collect()
    want, start = [], 0
    for d, n, crc in brute_tokens(None, sorted(docs)):
        want.append((d, start, n, crc))
        start += n
    assert rows_of(queries.op12_token_store(spark, SF_SMALL), "doc_id", "start", "n_tokens", "ids_crc32") == sorted(want, key=repr)


def test_shard_refuses_another_dictionary_and_damage(tmp_path):
    samples = [np.arange(i, i + 40, dtype="<u2").tobytes() for i in range(300)]
    made = token_store.train(samples, 1024)
    files, root = token_store.file_system(f"file:{tmp_path}")
    writer = token_store.ShardWriter(files.open_output_stream(f"{root}/s"), made, 2, 2)
    press = token_store.compressor(made)
    for i, s in enumerate(samples):
        writer.add(i, 40, press.compress(s))
    size = writer.close()
    assert size == (tmp_path / "s").stat().st_size
    shard = token_store.Shard(files.open_input_file(f"{root}/s"), made)
    assert shard.document(17).tolist() == list(range(17, 57)) and list(shard.find(17)) == [17]
    assert [(d, s, ids[0]) for d, s, ids in shard][:2] == [(0, 0, 0), (1, 40, 1)]
    with pytest.raises(ValueError, match="another dictionary"):
        token_store.Shard(files.open_input_file(f"{root}/s"), made + b"x")
    whole = bytearray(Path(tmp_path / "s").read_bytes())
    whole[-40] ^= 1
    Path(tmp_path / "t").write_bytes(whole)
    with pytest.raises(ValueError, match="not a whole shard"):
        token_store.Shard(files.open_input_file(f"{root}/t"), made)


def test_dictionary_shrinks_short_documents():
    rng = random.Random(1)
    words = [np.array([rng.randrange(49_000) for _ in range(6)], dtype="<u2").tobytes() for _ in range(200)]
    texts = [b"".join(rng.choice(words) for _ in range(12)) for _ in range(800)]
    made = token_store.train(texts[:400], 8192)
    with_it = sum(len(token_store.compressor(made).compress(t)) for t in texts[400:])
    assert with_it < 0.6 * sum(len(token_store.compressor(b"").compress(t)) for t in texts[400:])
    assert token_store.train([]) == b"" and token_store.train([b"ab"]) == b"ab"  # too few to train on


def test_pieces_are_the_tokenizers_ids(monkeypatch):
    rng = random.Random(3)
    letters = "abcdefghijklmnopqrstuvwxyzABCÉéèñüßÀ0123'.,-<|>́ 日\0"
    texts = [" ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 12))) for _ in range(40))
             for _ in range(200)] + ["", " ", "x" * 300, "\n".join(["to be"] * 500)]
    ids = token_store.WordIds(TOKENS)
    assert ids.fast is not None
    want = ids.whole(texts)
    assert [i.tolist() for i in ids(texts)] == want
    monkeypatch.setattr(token_store, "ENCODED", 64)  # texts cut at blanks
    assert [i.tolist() for i in ids(texts)] == want
    ids.fast = None  # another vocabulary: every piece by the library
    assert [i.tolist() for i in ids(texts)] == want


VECTORS = "vec_id long, embedding array<double>, label int, error long, code string, v string, `of` int"


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(x * 4096) if abs(x) < 2**60 else int(x) * 4096 for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(range(len(kept)), key=lambda r: (kept[r][0] is None, kept[r][0] or 0, kept[r][1]))
    dims = -(-max((len(k[1]) for k in kept), default=0) // parts) * parts
    width = dims // parts
    full = [k[1] + [0] * (dims - len(k[1])) for k in kept]
    book = [[full[r][p * width:(p + 1) * width] for r in order[:entries]] for p in range(parts)]

    def near(p, v):
        return min((sum((a - b) ** 2 for a, b in zip(v[p * width:(p + 1) * width], e)), k) for k, e in enumerate(book[p]))

    for _ in range(rounds):
        took = [[near(p, v)[1] for v in full] for p in range(parts)]
        for p in range(parts):
            for k in range(len(book[p])):
                mine = [v[p * width:(p + 1) * width] for v, t in zip(full, took[p]) if t == k]
                if mine:
                    book[p][k] = [sum(c) // len(mine) for c in zip(*mine)]
    found = [[near(p, v) for p in range(parts)] for v in full]
    error = [sum(d for d, _ in f) for f in found]
    by = {}
    for k, e in zip(kept, error):
        by[k[2]] = by.get(k[2], 0) + e
    most = 2**63 - 1
    digest = sha(",".join(str(x) for p in book for e in p for x in e))
    return sorted(((k[0], "".join(f"{i:02x}" for _, i in f), min(e, most), by[k[2]] if by[k[2]] < most else most, digest)
                   for k, f, e in zip(kept, found, error)), key=repr)


def vector_rows(n, dims, seed=2):
    rng = random.Random(seed)
    near = [[rng.gauss(0, 0.2) for _ in range(dims)] for _ in range(12)]
    rows = [(i, [round(x + rng.gauss(0, 0.05), 3) for x in rng.choice(near)], rng.choice([None, 0, 1, 1, 1, 2])) for i in range(n)]
    rows += [(3, rows[5][1], 0), (7, rows[7][1], rows[7][2]), (None, rows[9][1], 1), (None, None, 1), (900, None, 2),
             (901, [None] * dims, 0), (902, [math.nan] * dims, 0), (903, [math.inf] * dims, 0), (904, [0.0] * dims, None),
             (905, [-0.0001] * dims, None), (906, [], 2), (907, [0.5] * (dims - 3), 2)]
    return rows


def vectors(spark, rows):
    return spark.createDataFrame([(*r, 1, "c", "v", 2) for r in rows], VECTORS).repartition(3)


COLUMNS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


@pytest.mark.parametrize("n, dims, block", [(150, 16, 40), (150, 20, 16_384), (10, 8, 3), (1, 5, 2)])
def test_vector_codes(spark, monkeypatch, n, dims, block):
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", block)
    rows = vector_rows(max(n, 10), dims)[-(n + 12):] if n > 1 else [(4, [0.1, -0.2, 0.3, 9.9, 0.0], None)]
    assert rows_of(vector_codes.code_digest(vectors(spark, rows)), *COLUMNS) == brute_codes(rows)


def test_vector_codes_of_enormous_components(spark):
    rows = vector_rows(40, 8) + [(950, [1e300, -1e300] * 4, 1), (951, [1e17] * 8, 1), (952, [-3e38] * 8, 5)]
    assert rows_of(vector_codes.code_digest(vectors(spark, rows)), *COLUMNS) == brute_codes(rows)


def test_vector_codes_of_no_rows(spark):
    assert vector_codes.code_digest(vectors(spark, [])).collect() == []
    assert vector_codes.code_digest(vectors(spark, [(1, None, 1), (2, [None], 1)])).collect() == []
    only_empty = vector_codes.code_digest(vectors(spark, [(1, [], 1), (2, [], 1)]))
    assert rows_of(only_empty, *COLUMNS) == brute_codes([(1, [], 1), (2, [], 1)])


def test_codes_decode_to_their_entries(spark):
    rows = vector_rows(60, 16)
    coded, book = vector_codes.compress(vectors(spark, rows))
    decode = vector_codes.decoder(book)
    by_id = {r[0]: r[1] for r in rows}
    for r in coded.where(F.col("vec_id").between(10, 40)).collect():
        ints = [math.floor(4096 * x) for x in by_id[r["vec_id"]]]
        assert sum((a - b) ** 2 for a, b in zip(ints, decode(r["code"]))) == r["error"]


def test_dictionary_squares_are_those_of_the_vectors():
    rng = np.random.default_rng(4)
    matrix = rng.integers(-50, 50, (500, 6))
    block = vector_codes.Block.of(matrix)
    assert all(len(v) <= 100 for v in block.values)
    block = vector_codes.Block.unpack(block.rows, *block.pack())
    book = rng.integers(-50, 50, (16, 3))
    nearest, least = vector_codes.assign(block, book, 2)
    full = ((matrix[:, None, 2:5] - book[None]) ** 2).sum(2)
    assert (nearest == full.argmin(1)).all() and (least == full.min(1)).all()
    sums = vector_codes.entry_sums(block, nearest, 16, 2, 3)
    assert all((matrix[nearest == e, 2:5].sum(0) == sums[e]).all() for e in range(16))
    for x in (0, 5, -5, 2**200 + 3, -(2**200) - 3, 2**60, -(2**60)):
        assert sum(d << 60 * p for p, d in vector_codes.limbs(x)) == x
