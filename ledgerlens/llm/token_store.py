"""Token ids in binary shards, each document a zstandard frame under a shared dictionary.

Writing has four steps.  A dictionary is trained on the serialised ids of a
sample of short documents.  All documents are encoded and compressed one by
one under it, and staged.  The frames (not the texts) are range-partitioned by
doc_id and sorted; each task writes its range as a shard: a header with the id
width and the dictionary's hash, the frames, and an index of offsets.  The rows
that the tasks return are the manifest: a file of a lost or repeated attempt is
in no manifest, and no file is ever changed.

A shard is read either in order, a stretch at a time, or one document at a
time: the manifest names the shard, its index the frame's place, and the
dictionary, checked against the hash in the header, makes the short frame
readable without its neighbours.

Layout of a shard (little-endian): ``IDZ1``, length of the header, the header
as JSON (``width`` bytes an id, ``dictionary`` SHA-256, ``end_id``); the
frames; per document a flag byte for a null id, the doc_id, and the end of its
frame and of its ids (each counted from the shard's first); then the index's
place, the number of documents, the index's CRC-32, and ``IDZ1`` again.

Nulls and empty texts are documents of one id (the end mark).  Null doc_ids
come first; rows of equal doc_id keep one order, repeated rows included.  An
empty table gives no shard and an empty result; columns other than doc_id and
text are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.llm.common import groups_for, stage
from ledgerlens.session import scratch_path

END_ID = 2
LEVEL = 3
SAMPLE_ROWS = 4096  # documents that the dictionary is trained on, at most
SAMPLE_BYTES = 8192  # longest text among them
DICTIONARY_BYTES = 64 << 10
SHARD_BYTES = 32 << 20  # of frames, on average
STRETCH = 4 << 20  # bytes read, or handed on, at a time
ENCODED = 16 << 20  # letters encoded at a time: the more, the fewer pieces are met again
MAGIC = b"IDZ1"

FRAMES = "doc_id long, n_tokens long, frame binary"
MANIFEST = "shard int, file string, first_doc long, last_doc long, docs long, tokens long, bytes long"
_INDEX = np.dtype([("null", "u1"), ("doc_id", "<i8"), ("end", "<u8"), ("ids", "<u8")])
_FOOTER = struct.Struct("<QQI4s")

# fixed values: the steps around this vocabulary, as its file describes them
NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Visible ASCII and the letters of Latin-1: composed already, and lower-cased one by one.
_PLAIN = r"^[!-~À-ÖØ-öø-ÿ]{1,200}$"


class WordIds:
    """Ids of texts, as ``tokenizers`` gives them, many texts at a time.

    The tokenizer drops white space and never looks across it, so the distinct
    blank-separated pieces of a stretch of texts are encoded once and their ids
    gathered for all places.  Where the vocabulary numbers its merges in order,
    ``tiktoken`` merges the pieces of plain letters by the same ranks: the end
    of a word is a zero byte, whose pairs come before all merges.  The first
    texts of a task are compared with ``tokenizers``.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.width = 2 if max(self.tokenizer.get_vocab(True).values(), default=0) < 1 << 16 else 4
        with open(path, encoding="utf-8") as file:
            whole = json.load(file)
        self.fast = self._ranks(whole)
        self.to_compare = 3

    def _ranks(self, whole: dict):
        model = whole["model"]
        split, byte_level = (whole["pre_tokenizer"] or {}).get("pretokenizers", [{}, {}])[:2]
        if (model.get("type") != "BPE" or model.get("end_of_word_suffix") != "</w>"
                or (whole["normalizer"] or {}).get("normalizers") != NORMALIZER
                or split.get("pattern") != {"Regex": PRE_TOKEN} or byte_level.get("type") != "ByteLevel"):
            return None
        vocab = model["vocab"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
        if [vocab.get(m) for m in merged] != list(range(512, 512 + len(merged))):
            return None
        import regex
        import tiktoken

        from ledgerlens.llm.packing import _byte_of

        byte_of, ranks = _byte_of(), {}
        for token, i in vocab.items():
            if token not in self.added:
                end = token.endswith("</w>")
                ranks[bytes(byte_of[c] for c in token[:len(token) - 4 * end]) + b"\0" * end] = i
        self.newline = ranks[b"\n"]
        self.words = regex.compile(PRE_TOKEN)
        return tiktoken.Encoding("ranks", pat_str=r"[^\x00\n]*\x00|\n", mergeable_ranks=ranks, special_tokens={})

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _pieces(self, pieces: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each piece) of distinct pieces."""
        plain = pc.match_substring_regex(pieces, _PLAIN)
        for token in self.added:
            plain = pc.and_not(plain, pc.match_substring(pieces, token))
        plain = plain.to_numpy(zero_copy_only=False)
        if self.fast is None:
            plain[:] = False
        counts = np.zeros(len(pieces), dtype=np.int64)
        lines = "\n".join(pieces.filter(pa.array(plain)).to_pylist()).lower()
        ids = np.zeros(0, dtype=np.uint32)
        if lines:
            ids = np.array(self.fast.encode_ordinary(self.words.sub("\\g<0>\0", lines)), dtype=np.uint32)
            ends = np.append(np.flatnonzero(ids == self.newline), len(ids))
            counts[plain] = np.diff(ends, prepend=-1) - 1
            ids = ids[ids != self.newline]
        if plain.all():
            return ids, counts
        other = self.whole(pieces.filter(pa.array(~plain)).to_pylist())
        counts[~plain] = [len(o) for o in other]
        flat = np.empty(int(counts.sum()), dtype=np.uint32)
        from_plain = np.repeat(plain, counts)
        flat[from_plain] = ids
        flat[~from_plain] = np.fromiter((i for o in other for i in o), dtype=np.uint32)
        return flat, counts

    def _stretch(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, number of ids of each text) of texts of a bounded size."""
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        coded = split.flatten().dictionary_encode()
        ids, counts = self._pieces(coded.dictionary)
        at = coded.indices.to_numpy()
        lengths = counts[at]
        total = np.concatenate(([0], np.cumsum(lengths)))
        begin = (np.cumsum(counts) - counts)[at]
        places = np.repeat(begin - total[:-1], lengths) + np.arange(total[-1])
        return ids[places], np.diff(total[split.offsets.to_numpy()])

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        parts, owner, held, out = [], [], 0, []

        def flush() -> None:
            nonlocal parts, owner, held
            ids, counts = self._stretch(parts)
            for i, some in zip(owner, np.split(ids, np.cumsum(counts)[:-1])):
                while len(out) <= i:
                    out.append([])
                out[i].append(some)
            parts, owner, held = [], [], 0

        for i, text in enumerate(texts):
            at = 0
            while at < len(text) or not at:
                stop = min(len(text), at + ENCODED)
                while 0 < stop < len(text) and text[stop] not in " \t\n\v\f\r":  # to the end of the piece
                    stop += 1
                parts.append(text[at:stop])
                owner.append(i)
                held += stop - at
                at = max(stop, 1)
                if held >= ENCODED:
                    flush()
        if parts:
            flush()
        whole = [o[0] if len(o) == 1 else np.concatenate(o) for o in out]
        if self.to_compare and texts:
            n = min(self.to_compare, len(texts))
            self.to_compare -= n
            if self.whole(texts[:n]) != [w.tolist() for w in whole[:n]]:
                raise ValueError("the pieces' ids are not those of the tokenizer")
        return whole


_LOADED: dict[str, WordIds] = {}


def ids_of(path: str) -> WordIds:
    """One per Python worker."""
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


def _encoded(path: str, batches: Iterator[pa.RecordBatch], end_id: int) -> Iterator[tuple]:
    """(doc_id, number of ids, serialised ids) of each row, in order."""
    encode = ids_of(path)
    end = np.array([end_id], dtype=f"<u{encode.width}").tobytes()
    for b in batches:
        keys, texts, held = [], [], 0
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
            keys.append(doc_id)
            texts.append(text.as_py() or "")
            held += len(texts[-1])
            if held >= ENCODED:
                yield from _serialised(encode, keys, texts, end)
                keys, texts, held = [], [], 0
        if keys:
            yield from _serialised(encode, keys, texts, end)


def _serialised(encode: WordIds, keys: list, texts: list[str], end: bytes) -> Iterator[tuple]:
    for key, ids in zip(keys, encode(texts)):
        yield key, len(ids) + 1, ids.astype(f"<u{encode.width}").tobytes() + end


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


# --- the dictionary


def train(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A zstandard dictionary; where the samples are too few to train on, the samples themselves."""
    if not samples:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def dictionary(docs: DataFrame, path: str, end_id: int = END_ID) -> bytes:
    """Trained in one task on at most ``SAMPLE_ROWS`` short documents, those of the lowest hashes.

    The sample decides how small the frames get, never what they hold.
    """
    rows = _rows(docs).where(f"octet_length(text) between 1 and {SAMPLE_BYTES}").withColumn(
        "h", F.xxhash64("doc_id", "text"))
    share = min(1.0, 1.25 * SAMPLE_ROWS / max(1, rows.count()))
    edge = int(-(1 << 63) + share * ((1 << 64) - 1))
    few = rows.where(F.col("h") <= F.lit(min(edge, (1 << 63) - 1))).orderBy("h").limit(SAMPLE_ROWS)

    def run(batches):
        made = train([ids for _, _, ids in _encoded(path, batches, end_id)])
        yield pa.RecordBatch.from_pydict({"dictionary": pa.array([made], pa.binary())})

    found = few.select("doc_id", "text").coalesce(1).mapInArrow(run, "dictionary binary").first()
    return bytes(found[0]) if found else b""


def _shared(made: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(made) if made else None


def compressor(made: bytes) -> zstandard.ZstdCompressor:
    shared = _shared(made)
    if shared is None:
        return zstandard.ZstdCompressor(level=LEVEL)
    shared.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=shared)


def decompressor(made: bytes) -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor(dict_data=_shared(made))


# --- shards


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path in it; a path without a scheme is on a mounted folder."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


class ShardWriter:
    def __init__(self, out, made: bytes, width: int, end_id: int):
        self.out, self.width = out, width
        header = json.dumps({"width": width, "dictionary": hashlib.sha256(made).hexdigest(), "end_id": end_id}).encode()
        self.at = out.write(MAGIC + struct.pack("<I", len(header)) + header)
        self.index: list[tuple] = []
        self.end = self.tokens = 0

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes) -> None:
        self.out.write(frame)
        self.end += len(frame)
        self.tokens += n_tokens
        self.index.append((doc_id is None, doc_id or 0, self.end, self.tokens))

    def close(self) -> int:
        index = np.array(self.index, dtype=_INDEX).tobytes()
        place = self.at + self.end
        self.out.write(index)
        self.out.write(_FOOTER.pack(place, len(self.index), zlib.crc32(index), MAGIC))
        self.out.close()
        return place + len(index) + _FOOTER.size


class Shard:
    """Reads a shard in order or document by document."""

    def __init__(self, file, made: bytes):
        self.file = file
        size = file.size()
        file.seek(size - _FOOTER.size)
        place, n, crc, magic = _FOOTER.unpack(file.read(_FOOTER.size))
        file.seek(place)
        index = file.read(n * _INDEX.itemsize)
        file.seek(0)
        first, length = struct.unpack("<4sI", file.read(8))
        if first != MAGIC or magic != MAGIC or zlib.crc32(index) != crc:
            raise ValueError("not a whole shard")
        header = json.loads(file.read(length))
        if header["dictionary"] != hashlib.sha256(made).hexdigest():
            raise ValueError("the shard was written under another dictionary")
        self.at, self.width = 8 + length, header["width"]
        self.index = np.frombuffer(index, dtype=_INDEX)
        self.ends = np.concatenate(([0], self.index["end"])).astype(np.int64)
        self.starts = np.concatenate(([0], self.index["ids"])).astype(np.int64)
        self.expand = decompressor(made)

    def doc_id(self, i: int) -> int | None:
        return None if self.index["null"][i] else int(self.index["doc_id"][i])

    def _ids(self, frame: bytes) -> np.ndarray:
        return np.frombuffer(self.expand.decompress(frame), dtype=f"<u{self.width}").astype("<u4")

    def document(self, i: int) -> np.ndarray:
        """The ids of the ``i``-th document: one short read."""
        self.file.seek(self.at + int(self.ends[i]))
        return self._ids(self.file.read(int(self.ends[i + 1] - self.ends[i])))

    def find(self, doc_id: int) -> range:
        """The places of ``doc_id``; the nulls come before all ids."""
        nulls = int(self.index["null"].sum())
        keys = self.index["doc_id"][nulls:]
        return range(nulls + int(np.searchsorted(keys, doc_id)), nulls + int(np.searchsorted(keys, doc_id, "right")))

    def __iter__(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(doc_id, ids before it in the shard, its ids) of all documents, a stretch of the file at a time."""
        i, n = 0, len(self.index)
        while i < n:
            j = max(i + 1, int(np.searchsorted(self.ends, self.ends[i] + STRETCH, "right")) - 1)
            self.file.seek(self.at + int(self.ends[i]))
            some = self.file.read(int(self.ends[j] - self.ends[i]))
            for k in range(i, j):
                ids = self._ids(some[self.ends[k] - self.ends[i]:self.ends[k + 1] - self.ends[i]])
                if len(ids) != self.starts[k + 1] - self.starts[k]:
                    raise ValueError("a document has not the ids that the index counts")
                yield self.doc_id(k), int(self.starts[k]), ids
            i = j


def write(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = END_ID,
          shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write the shards of ``docs`` below ``path``; the manifest, staged, with the ids before each shard."""
    made = dictionary(docs, tokenizer_path, end_id)
    files, root = file_system(path)
    files.create_dir(root, recursive=True)
    with files.open_output_stream(f"{root}/dictionary.zdict") as out:
        out.write(made)

    def compress(batches):
        press, rows, held = compressor(made), [], 0

        def batch():
            columns = list(zip(*rows)) or [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary()))],
                                              names=["doc_id", "n_tokens", "frame"])

        for doc_id, n, ids in _encoded(tokenizer_path, batches, end_id):
            rows.append((doc_id, n, press.compress(ids)))
            held += len(rows[-1][2])
            if held >= STRETCH:
                yield batch()
                rows, held = [], 0
        yield batch()

    frames = stage(_rows(docs).mapInArrow(compress, FRAMES).withColumn("row", F.monotonically_increasing_id()), "frames")
    total = frames.select(F.sum(F.octet_length("frame"))).first()[0] or 0
    shards = groups_for(total, shard_bytes)

    def write_shard(batches):
        writer = name = first = last = None
        for b in batches:
            for doc_id, n, frame in zip(*(b.column(i).to_pylist() for i in range(3))):
                if writer is None:
                    shard, first = TaskContext.get().partitionId(), doc_id
                    name = f"shard-{shard:06d}-{uuid.uuid4().hex}.ids"
                    here, below = file_system(path)
                    writer = ShardWriter(here.open_output_stream(f"{below}/{name}"), made, ids_of(tokenizer_path).width,
                                         end_id)
                writer.add(doc_id, n, frame)
                last = doc_id
        if writer is not None:
            size = writer.close()
            yield pa.RecordBatch.from_pylist(
                [{"shard": shard, "file": name, "first_doc": first, "last_doc": last, "docs": len(writer.index),
                  "tokens": writer.tokens, "bytes": size}],
                pa.schema([("shard", pa.int32()), ("file", pa.string()), *((n, pa.int64()) for n in (
                    "first_doc", "last_doc", "docs", "tokens", "bytes"))]))

    manifest = stage(frames.repartitionByRange(shards, "doc_id", "row").sortWithinPartitions("doc_id", "row")
                     .select("doc_id", "n_tokens", "frame").mapInArrow(write_shard, MANIFEST), "manifest")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row a shard
    return manifest.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def _open(path: str, name: str, kept: dict[str, bytes]) -> Shard:
    files, root = file_system(path)
    if path not in kept:
        with files.open_input_stream(f"{root}/dictionary.zdict") as file:
            kept[path] = file.read()
    return Shard(files.open_input_file(f"{root}/{name}"), kept[path])


_OUT = [("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()),
        ("ids", pa.binary())]
_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _answers(found: Iterator[tuple], with_ids: bool) -> Iterator[pa.RecordBatch]:
    rows, held = [], 0
    fields = _OUT if with_ids else _OUT[:4]

    def batch():
        columns = list(zip(*rows)) or [[]] * len(fields)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)], names=[n for n, _ in fields])

    for doc_id, start, ids in found:
        raw = ids.tobytes()
        rows.append((doc_id, start, len(ids), zlib.crc32(raw), raw)[:len(fields)])
        held += len(raw) if with_ids else 32
        if held >= STRETCH:
            yield batch()
            rows, held = [], 0
    yield batch()


def read(manifest: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and the ids, unsigned 32-bit) of every document, from the files."""

    def run(batches):
        kept: dict[str, bytes] = {}
        for b in batches:
            for name, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard = _open(path, name, kept)
                yield from _answers(((d, before + s, ids) for d, s, ids in shard), with_ids)

    schema = _SCHEMA + ", ids binary" * with_ids
    shards = max(1, manifest.count())
    return manifest.repartitionByRange(shards, "shard").select("file", "before").mapInArrow(run, schema)


def fetch(manifest: DataFrame, path: str, doc_ids: list[int]) -> DataFrame:
    """The same columns and the ids, for a few documents: only their shards' indexes and frames are read."""
    wanted = sorted(set(doc_ids))

    def run(batches):
        kept: dict[str, bytes] = {}
        for b in batches:
            for name, before in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                shard = _open(path, name, kept)
                yield from _answers(((d, before + int(shard.starts[i]), shard.document(i))
                                     for d in wanted for i in shard.find(d)), True)

    holds = F.lit(False)
    for d in wanted:
        holds = holds | ((F.coalesce(F.col("first_doc"), F.lit(-(1 << 63))) <= d) & (F.col("last_doc") >= d))
    return manifest.where(holds).select("file", "before").mapInArrow(run, _SCHEMA + ", ids binary")


def token_digest(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    path = scratch_path(spark, "token-shards")
    return read(write(docs, path, tokenizer_path), path)
