"""Fill-in-the-middle transformation over a store of seekable compressed frames.

A document's text is stored as independent zstandard frames of at most
``FRAME`` bytes, cut between code points, with the cumulative number of units,
code points and bytes at the end of each frame.  The cumulative counts say in
which frame a unit ends, so the two cuts of a document cost one decompressed
frame each, however long it is.  The transformed text is streamed frame by
frame in its new order into its digest and into frames of its own; the text is
rebuilt from those frames by looking for the marks in the stream.  A document
is never decompressed as a whole, and nothing is shuffled: a row of the store
is a document's frames and counts.

A unit is a run of blanks with the run of visible bytes after it; blanks at the
end are a unit of their own.  Where a document is cut, and into which form, is
read from the SHA-256 of ``seed:doc_id``.

Nulls and empty texts have no unit and stay plain; a null doc_id hashes as an
empty id.  Texts that contain a mark stay plain.  Repeated rows are transformed
one by one, and alike where doc_id and text are equal.  An empty table gives
an empty result; columns other than doc_id and text are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import blanks, stage

FRAME = 1 << 15  # bytes of text in a frame
LEVEL = 3
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SHOWN = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}  # order of the parts in the output
FORMS = ("plain", *SHOWN)

STORE = ("doc_id long, n long, marked boolean, units array<long>, chars array<long>, bytes array<long>, "
         "frames array<binary>")
OUTPUT = ("doc_id long, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, "
          "output_bytes array<long>, output_frames array<binary>")
_LONGS, _BLOBS = pa.list_(pa.int64()), pa.list_(pa.binary())
_STORE_TYPES = [pa.int64(), pa.int64(), pa.bool_(), _LONGS, _LONGS, _LONGS, _BLOBS]
_OUTPUT_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), _LONGS, _BLOBS]


def _starts(data: np.ndarray) -> np.ndarray:
    """Whether a byte starts a code point."""
    return (data & 0xC0) != 0x80


def _inner_ends(data: np.ndarray) -> np.ndarray:
    """Offsets at which a visible byte is followed by a blank."""
    blank = blanks(data)
    return np.flatnonzero(~blank[:-1] & blank[1:]) + 1


def build(text: bytes, press: zstandard.ZstdCompressor, size: int = FRAME) -> tuple:
    """(units, chars, bytes, frames): the counts are cumulative at the end of each frame."""
    if len(text) <= size:
        if not text:
            return [], [], [], []
        data = np.frombuffer(text, dtype=np.uint8)
        return ([len(_inner_ends(data)) + 1], [int(np.count_nonzero(_starts(data)))], [len(text)],
                [press.compress(text)])
    units, chars, ends, frames = [], [], [], []
    at = n_units = n_chars = 0
    while at < len(text):
        stop = min(len(text), at + size)
        while stop < len(text) and stop > at + 1 and text[stop] & 0xC0 == 0x80:
            stop -= 1
        data = np.frombuffer(text, dtype=np.uint8, count=min(stop + 1, len(text)) - at, offset=at)
        n_units += len(_inner_ends(data)) + (stop == len(text))  # an end at ``stop`` belongs to this frame
        n_chars += int(np.count_nonzero(_starts(data[:stop - at])))
        units.append(n_units)
        chars.append(n_chars)
        ends.append(stop)
        frames.append(press.compress(text[at:stop]))
        at = stop
    return units, chars, ends, frames


class Frames:
    """Reads ranges of a text out of its frames."""

    def __init__(self, ends: list[int], frames: list[bytes], expand: zstandard.ZstdDecompressor):
        self.ends, self.frames, self.expand = ends, frames, expand
        self.kept: dict[int, bytes] = {}  # frames that were decompressed to place the cuts

    def frame(self, i: int) -> bytes:
        return self.kept.get(i) or self.expand.decompress(self.frames[i])

    def cut(self, k: int, units: list[int], chars: list[int]) -> tuple[int, int]:
        """(bytes, code points) before the end of the ``k``-th unit."""
        if k == 0:
            return 0, 0
        i = int(np.searchsorted(units, k))
        begin, seen, before = (self.ends[i - 1], units[i - 1], chars[i - 1]) if i else (0, 0, 0)
        if i not in self.kept:
            self.kept[i] = self.frame(i)
        data = np.frombuffer(self.kept[i], dtype=np.uint8)
        inner = _inner_ends(data)
        at = int(inner[k - seen - 1]) if k - seen <= len(inner) else len(data)
        return begin + at, before + int(np.count_nonzero(_starts(data[:at])))

    def read(self, start: int, stop: int) -> Iterator[bytes]:
        """The bytes from ``start`` to ``stop``, frame by frame."""
        i = int(np.searchsorted(self.ends, start, side="right"))
        while start < stop:
            begin = self.ends[i - 1] if i else 0
            yield self.frame(i)[start - begin:stop - begin]
            start, i = self.ends[i], i + 1


class Writer:
    """Cuts a stream of bytes into frames, and digests it."""

    def __init__(self, press: zstandard.ZstdCompressor, size: int):
        self.press, self.size = press, size
        self.digest = hashlib.sha256()
        self.held = bytearray()
        self.ends: list[int] = []
        self.frames: list[bytes] = []

    def add(self, some: bytes) -> None:
        self.digest.update(some)
        self.held += some
        while len(self.held) >= self.size:
            self._frame(self.size)

    def _frame(self, n: int) -> None:
        self.frames.append(self.press.compress(bytes(self.held[:n])))
        self.ends.append((self.ends[-1] if self.ends else 0) + n)
        del self.held[:n]

    def close(self) -> None:
        if self.held:
            self._frame(len(self.held))


def choice(doc_id: int | None, n: int, marked: bool, seed: int, fim_rate: int, spm_rate: int) -> tuple[str, int, int]:
    """(form, units before the first cut, units before the second)."""
    text = f"{seed}:{'' if doc_id is None else doc_id}"
    hexed = hashlib.sha256(text.encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[i:i + 8], 16) for i in range(0, 32, 8))
    if n == 0 or marked or h3 % 100 >= fim_rate:
        return "plain", 0, 0
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    return ("spm" if h4 % 100 < spm_rate else "psm"), a, b


def transform_one(row: tuple, press, expand, seed: int, fim_rate: int, spm_rate: int, size: int) -> tuple:
    doc_id, n, marked, units, chars, ends, frames = row
    form, a, b = choice(doc_id, n, marked, seed, fim_rate, spm_rate)
    text, out = Frames(ends, frames, expand), Writer(press, size)
    total = ends[-1] if ends else 0
    prefix_chars = middle_chars = None
    if form == "plain":
        parts = [(b"", 0, total)]
    else:
        first, prefix_chars = text.cut(a, units, chars)
        second, both = text.cut(b, units, chars)
        middle_chars = both - prefix_chars
        ranges = {PREFIX: (0, first), MIDDLE: (first, second), SUFFIX: (second, total)}
        parts = [(mark, *ranges[mark]) for mark in SHOWN[form]]
    for mark, start, stop in parts:
        out.add(mark)
        for some in text.read(start, stop):
            out.add(some)
    out.close()
    return doc_id, n, form, prefix_chars, middle_chars, out.digest.hexdigest(), out.ends, out.frames


def part_ranges(form: str, out: Frames) -> dict[bytes, tuple[int, int]]:
    """Where the parts are in the output: found from the marks in the stream, in the form's order."""
    order, total = SHOWN[form], out.ends[-1]
    found, carry, base = [], b"", 0
    for some in out.read(0, total):
        window = carry + some
        at = 0
        while len(found) < 3 and (i := window.find(order[len(found)], at)) >= 0:
            found.append(base - len(carry) + i)
            at = i + 3
        carry, base = window[max(at, len(window) - 2):], base + len(some)
    if len(found) < 3:
        raise ValueError(f"the output does not hold the marks of {form}")
    return {mark: (at + 3, end) for mark, at, end in zip(order, found, [*found[1:], total])}


def restore(form: str, ends: list[int], frames: list[bytes], expand) -> Iterator[bytes]:
    """The original text, in pieces, from the output's frames and the form."""
    out = Frames(ends, frames, expand)
    if form == "plain":
        yield from out.read(0, ends[-1] if ends else 0)
        return
    ranges = part_ranges(form, out)
    for mark in (PREFIX, MIDDLE, SUFFIX):
        yield from out.read(*ranges[mark])


def _by_row(types: list[pa.DataType], names: list[str], flush: int = 8 << 20) -> Callable:
    """Batches out of the rows that ``each`` makes of the input rows, cut by the bytes they hold."""

    def wrap(each: Callable[[tuple], tuple], size: Callable[[tuple], int]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            rows, held = [], 0

            def batch() -> pa.RecordBatch:
                columns = list(zip(*rows)) or [[]] * len(types)
                return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

            for b in batches:
                for i in range(b.num_rows):
                    rows.append(each(tuple(c[i].as_py() for c in b.columns)))
                    held += size(rows[-1])
                    if held >= flush:
                        yield batch()
                        rows, held = [], 0
            yield batch()

        return run

    return wrap


def _names(schema: str) -> list[str]:
    return [f.split()[0] for f in schema.split(", ")]


def frame_store(docs: DataFrame, frame: int = FRAME) -> DataFrame:
    """One row per document: its frames and their cumulative counts (``STORE``)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("string").cast("binary").alias("text"))

    def run(batches):
        press = zstandard.ZstdCompressor(level=LEVEL)

        def each(row):
            doc_id, text = row[0], row[1] or b""
            units, chars, ends, frames = build(text, press, frame)
            marked = any(m in text for m in (PREFIX, SUFFIX, MIDDLE))
            return doc_id, (units[-1] if units else 0), marked, units, chars, ends, frames

        yield from _by_row(_STORE_TYPES, _names(STORE))(each, lambda r: sum(map(len, r[6])))(batches)

    return rows.mapInArrow(run, STORE)


def transform(store: DataFrame, seed: int = 42, fim_rate: int = 50, spm_rate: int = 80,
              frame: int = FRAME) -> DataFrame:
    """The transformed documents (``OUTPUT``): their texts are in ``output_frames``.

    ``fim_rate`` percent of the documents are cut, ``spm_rate`` percent of those
    show the suffix first.
    """

    def run(batches):
        press, expand = zstandard.ZstdCompressor(level=LEVEL), zstandard.ZstdDecompressor()

        def each(row):
            return transform_one(row, press, expand, seed, fim_rate, spm_rate, frame)

        yield from _by_row(_OUTPUT_TYPES, _names(OUTPUT))(each, lambda r: sum(map(len, r[7])))(batches)

    return store.select(*_names(STORE)).mapInArrow(run, OUTPUT)


def output_texts(transformed: DataFrame) -> DataFrame:
    """doc_id, form and the whole transformed text."""

    def run(batches):
        expand = zstandard.ZstdDecompressor()

        def each(row):
            return row[0], row[1], b"".join(map(expand.decompress, row[2])).decode("utf-8", "replace")

        yield from _by_row([pa.int64(), pa.string(), pa.string()], ["doc_id", "form", "output"])(
            each, lambda r: len(r[2]))(batches)

    return transformed.select("doc_id", "form", "output_frames").mapInArrow(
        run, "doc_id long, form string, output string")


def with_restored(transformed: DataFrame) -> DataFrame:
    """The digest columns, and the digest of the text rebuilt from output and form."""
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256"]

    def run(batches):
        expand = zstandard.ZstdDecompressor()

        def each(row):
            digest = hashlib.sha256()
            for some in restore(row[2], row[6], row[7], expand):
                digest.update(some)
            return (*row[:6], digest.hexdigest())

        yield from _by_row([*_OUTPUT_TYPES[:6], pa.string()], [*names, "restored_sha256"])(each, lambda r: 200)(batches)

    return transformed.select(*_names(OUTPUT)).mapInArrow(
        run, OUTPUT.split(", output_bytes")[0] + ", restored_sha256 string")


def fim_digest(docs: DataFrame) -> DataFrame:
    return with_restored(transform(stage(frame_store(docs), "frames")))
