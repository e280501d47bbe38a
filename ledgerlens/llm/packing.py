"""Packing tokenized documents into sequences by bounded-space online best fit.

One pass over each partition tokenizes and packs: a document's full windows
are sequences at once; its rest goes to the open window that it fills best.
A fixed number of windows is open; when none has room and no more may be
opened, the fullest is emitted.  The windows that are left at the end of the
partitions are merged over a few rounds: up to ``FAN`` partitions' leftovers
are laid end to end and cut at the sequence length, what remains of less than
one sequence goes on to the next round.  So padding is what best fit leaves,
and one sequence at the end.

The pieces of the first pass are written once, and the merge reads only the
pieces of open windows, which alone carry their ids along.

Nulls and empty texts are documents of one id (the end mark).  Documents
longer than a sequence are cut.  Repeated rows are packed as separate
documents.  An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import held, small_batches, stage, tidy

LENGTH = 2048
OPEN = 64
FAN = 32
END_ID = 1
CACHE = 50_000  # pieces whose ids a Python worker keeps: most texts' words, in some 10 MB
BLANK = "\u0120"  # how a byte-level vocabulary writes 0x20
# fixed value: the published pre-token pattern of byte-level BPE
_AHEAD = r"|\s+(?!\S)"  # tells where a run of blanks ends: without such runs it changes nothing, and costs a third
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_RUN, _AFTER_BLANK = re.compile(r"\s\s"), re.compile(r" \s")

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, open boolean, part long, ids binary")
_NAMES = [f.split()[0] for f in PIECES.split(", ")]
_TYPES = [pa.int64()] * 7 + [pa.bool_(), pa.int64(), pa.binary()]


def _byte_of() -> dict[str, int]:
    """Byte of each letter of a byte-level vocabulary: printable Latin-1 stands for itself, the
    other bytes are numbered from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Ids:
    """Little-endian unsigned 32-bit ids of a text, as ``tokenizers`` gives them.

    A byte-level BPE never merges across a blank that a visible character
    follows, so the text is cut there, and the pieces that are not kept from
    earlier texts are encoded together.  Where the vocabulary numbers its merges in order, ``tiktoken``
    encodes the new pieces by the same ranks, several times as fast; the first
    texts of a task are compared with ``tokenizers``.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, merges = model["vocab"], model["merges"]
        merged = ["".join(m if isinstance(m, list) else m.split(" ")) for m in merges]
        self.fast = None
        if [vocab.get(m) for m in merged] == list(range(256, 256 + len(merged))):
            byte_of = _byte_of()
            ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in self.added}
            self.fast, self.plain = (tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens={})
                                     for p in (PRE_TOKEN, PRE_TOKEN.replace(_AHEAD, "")))
        self.opens = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, dtype=bool)
        self.opens[[i for t, i in vocab.items() if t[:1] == BLANK]] = True
        self.known: dict[str, bytes] = {}
        self.to_compare = 3

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None:
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")
        bpe = self.fast if _RUN.search(text) else self.plain
        return np.array(bpe.encode_ordinary(text), dtype="<u4")

    def new(self, pieces: list[str]) -> list[bytes]:
        """Ids of a blank and each of ``pieces``, in one call, kept as long as there is room.

        No piece starts with a blank, so where none holds one, an id that
        starts with a blank begins a piece.
        """
        ids = self.ids(" " + " ".join(pieces))
        at = np.flatnonzero(self.opens[ids])
        if len(at) == len(pieces):
            whole, cut = ids.tobytes(), [*(4 * at).tolist(), 4 * len(ids)]
            out = [whole[i:j] for i, j in zip(cut, cut[1:])]
        else:
            out = [self.ids(" " + p).tobytes() for p in pieces]
        if len(self.known) < CACHE:
            short = ((p, i) for p, i in zip(pieces, out) if len(p) < 40)
            self.known.update(islice(short, CACHE - len(self.known)))
        return out

    def pieces(self, text: str) -> list[str]:
        """The text cut before each blank that something visible follows; the cut blanks are left out."""
        parts = text.split(" ")
        out = parts[:1]
        for p in parts[1:]:
            if not p or p[0].isspace():
                out[-1] += " " + p
            else:
                out.append(p)
        return out

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        if any(a in text for a in self.added):  # cut out before pieces are found
            return self.whole(text)
        first, *rest = text.split(" ")
        ids = list(map(self.known.get, rest))
        if None in ids:  # new pieces, or blanks in a row: no kept piece is empty or starts with one
            new = [p for i, p in zip(ids, rest) if i is None]
            if _AFTER_BLANK.search(" ".join(["", *new, ""])):
                first, *rest = self.pieces(text)
                ids = list(map(self.known.get, rest))
                new = [p for i, p in zip(ids, rest) if i is None]
            found = iter(self.new(new) if new else ())
            ids = [next(found) if i is None else i for i in ids]
        found = self.ids(first).tobytes() + b"".join(ids)
        if self.to_compare:
            self.to_compare -= 1
            if found != self.whole(text):
                raise ValueError("the pieces' ids are not those of the tokenizer")
        return found


def ids_of(path: str) -> Ids:
    """One per Python worker, so that its tasks share what it has encoded."""
    return held(("packing", path), lambda: Ids(path))


class Windows:
    """The open windows of one partition."""

    def __init__(self, length: int = LENGTH, most: int = OPEN):
        self.length, self.most = length, most
        self.free: list[int] = []
        self.held: list[list] = []

    def put(self, size: int, item) -> list | None:
        """Place ``item``; the items of the window that had to be emitted, if any."""
        best = -1
        for i, room in enumerate(self.free):
            if room >= size and (best < 0 or room < self.free[best]):
                best = i
        out = None
        if best < 0:
            if len(self.free) >= self.most:
                fullest = min(range(len(self.free)), key=self.free.__getitem__)
                out = self.held.pop(fullest)
                self.free.pop(fullest)
            self.free.append(self.length)
            self.held.append([])
            best = len(self.free) - 1
        self.free[best] -= size
        self.held[best].append(item)
        if not self.free[best] and out is None:
            self.free.pop(best)
            out = self.held.pop(best)
        return out


def _pack_partition(path: str, length: int, most: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, windows = ids_of(path), Windows(length, most)
        part = TaskContext.get().partitionId()
        end = np.array([END_ID], dtype="<u4").tobytes()
        rows: list[tuple] = []
        n_sequences = 0

        def emit(pieces: list[tuple], is_open: bool) -> None:
            nonlocal n_sequences
            offset = 0
            for doc_id, start, ids, doc_tokens in pieces:
                n = len(ids) // 4
                rows.append((doc_id, start, n, zlib.crc32(ids), doc_tokens, part << 28 | n_sequences,
                             offset, is_open, part, ids if is_open or with_ids else None))
                offset += n
            n_sequences += 1

        def batch() -> pa.RecordBatch:
            columns = list(zip(*rows)) or [[]] * len(_NAMES)
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], names=_NAMES)
            rows.clear()
            return out

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                cut = total - total % length
                for start in range(0, cut, length):
                    emit([(doc_id, start, ids[4 * start:4 * (start + length)], total)], False)
                if total > cut:
                    full = windows.put(total - cut, (doc_id, cut, ids[4 * cut:], total))
                    if full:
                        emit(full, False)
            yield batch()
        for held in windows.held:
            emit(held, True)
        yield batch()

    return run


def _merge_group(length: int, turn: int, with_ids: bool):
    def run(key: tuple, pieces: pa.Table) -> pa.Table:
        group, out = key[0].as_py(), []
        sequence, offset = 0, 0
        for p in pieces.sort_by([("sequence_id", "ascending"), ("offset", "ascending")]).to_pylist():
            at, ids = p["start"], p["ids"]
            while ids:
                take = min(len(ids) // 4, length - offset)
                out.append([p["doc_id"], at, take, zlib.crc32(ids[:4 * take]), p["doc_tokens"],
                            turn << 56 | group << 28 | sequence, offset, False, group, ids[:4 * take]])
                ids, at, offset = ids[4 * take:], at + take, offset + take
                if offset == length:
                    sequence, offset = sequence + 1, 0
        for row in out:  # the last, partly filled sequence stays open
            row[7] = bool(offset) and row[5] & (1 << 28) - 1 == sequence
            if not (row[7] or with_ids):
                row[9] = None
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _TYPES)], names=_NAMES)

    return run


def pack(docs: DataFrame, tokenizer_path: str, length: int = LENGTH, most_open: int = OPEN,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``with_ids`` adds the piece's ids (little-endian unsigned 32-bit).
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    run = tidy(_pack_partition(tokenizer_path, length, most_open, with_ids), holds=True)
    with small_batches(docs.sparkSession):
        first = stage(rows.mapInArrow(run, PIECES), "packed")
    done, left = first.where("not open"), first.where("open")
    turn, parts = 0, (left.agg(F.max("part")).first()[0] or 0) + 1
    while turn == 0 or parts > 1:  # FAN partitions' leftovers at a time
        turn, parts = turn + 1, -(-parts // FAN)
        merged = stage(left.groupBy(F.expr(f"part div {FAN}").alias("g")).applyInArrow(
            _merge_group(length, turn, with_ids), PIECES), "merged")
        done, left = done.unionByName(merged.where("not open")), merged.where("open")
    columns = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    return done.unionByName(left).select(*columns, *["ids"] * with_ids)
