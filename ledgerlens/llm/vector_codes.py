"""Product codes of integer vectors, computed over per-dimension value dictionaries.

Components become integers, ``floor(scale * x)``.  A block of vectors is stored
dimension by dimension: the sorted distinct integers of the dimension, and one
small code per vector.  Blocks are written once; every round reads them.  For a
codebook entry only the *distinct* integers are subtracted and squared; the
distance of a vector's part is then a gather of those squares by its codes, and
an add per dimension.  The new codebook needs, per entry and dimension, how
often each code occurs: a histogram, multiplied by the dictionary.

A round sends one row per task, part, entry and dimension into a grouped sum;
the driver holds the codebooks alone (entries times dimensions).  All
arithmetic is exact: 64-bit integers where no sum can leave them, Python's
integers otherwise.

Rows whose vector is null or holds a null, NaN or infinite component are
dropped.  Null vec_ids are coded, and come last among the first entries; rows
of equal vec_id are ordered by their vectors.  Shorter vectors count as filled
up with zeros to the longest kept one, and all of them to a multiple of the
number of parts.  With fewer vectors than entries there are as many entries as
vectors.  An error above 2^63 - 1 is given as that.  An empty table gives an
empty result; columns other than vec_id, embedding and label are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.llm.common import stage

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
BLOCK_ROWS = 16_384  # vectors of a block, at most: codes fit in 16 bits
BLOCK_VALUES = 1 << 22  # components of a block, at most
_SAFE = 1 << 25  # magnitudes up to here: products and sums of a block stay in 64 bits
_MOST = (1 << 63) - 1
_LIMB = 1 << 60


def floors(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite doubles, as 64-bit integers or, where they may not fit, Python's."""
    if not len(values) or np.abs(values).max() < _SAFE / scale:
        return np.floor(values * float(scale)).astype(np.int64)
    return np.array([big_floor(x, scale) for x in values.tolist()], dtype=object)


def big_floor(x: float, scale: int) -> int:
    over, under = x.as_integer_ratio()
    return over * scale // under


class Block:
    """Vectors by dimension: the distinct integers, and one code per vector."""

    def __init__(self, values: list[np.ndarray], codes: np.ndarray):
        self.values, self.codes = values, codes  # codes: dimensions x vectors
        self.rows = codes.shape[1]

    @classmethod
    def of(cls, matrix: np.ndarray) -> Block:
        values, codes = [], np.zeros((matrix.shape[1], matrix.shape[0]), dtype=np.uint16)
        for j in range(matrix.shape[1]):
            distinct, codes[j] = np.unique(matrix[:, j], return_inverse=True)
            values.append(distinct)
        return cls(values, codes)

    def pack(self) -> tuple[list[int], list[str] | None, bytes, bytes]:
        """(dictionary sizes, big dictionaries in decimal, small ones, codes)."""
        sizes = [len(v) for v in self.values]
        if any(v.dtype == object for v in self.values):
            return sizes, [str(x) for v in self.values for x in v], b"", self.codes.tobytes()
        flat = np.concatenate(self.values) if self.values else np.zeros(0)
        return sizes, None, flat.astype("<i8").tobytes(), self.codes.tobytes()

    @classmethod
    def unpack(cls, rows: int, sizes: list[int], big: list[str] | None, small: bytes, codes: bytes) -> Block:
        flat = np.array([int(x) for x in big], dtype=object) if big else np.frombuffer(small, dtype="<i8")
        values = np.split(flat, np.cumsum(sizes)[:-1]) if sizes else []
        return cls(values, np.frombuffer(codes, dtype=np.uint16).reshape(len(sizes), rows))

    def dimension(self, j: int) -> tuple[np.ndarray, np.ndarray]:
        if j < len(self.values):
            return self.values[j], self.codes[j]
        return np.zeros(1, dtype=np.int64), np.zeros(self.rows, dtype=np.uint16)  # filled up with zeros


def squares(values: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared difference of every distinct integer (rows) to every entry (columns)."""
    if values.dtype == object or max((abs(int(e)) for e in entries), default=0) > _SAFE:
        values, entries = values.astype(object), entries.astype(object)
    return (values[:, None] - entries[None, :]) ** 2


def assign(block: Block, codebook: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray]:
    """(nearest entry, squared distance) of each vector's part; its codebook is entries x dimensions."""
    total = np.zeros((block.rows, codebook.shape[0]), dtype=np.int64)
    for j in range(codebook.shape[1]):
        values, codes = block.dimension(at + j)
        total = total + squares(values, codebook[:, j])[codes]
    nearest = total.argmin(axis=1)
    return nearest, total[np.arange(block.rows), nearest]


def entry_sums(block: Block, nearest: np.ndarray, n: int, at: int, width: int) -> np.ndarray:
    """Sum of the vectors' parts by entry: entries x dimensions."""
    out = np.zeros((n, width), dtype=object)
    for j in range(width):
        values, codes = block.dimension(at + j)
        counts = np.bincount(nearest * len(values) + codes, minlength=n * len(values)).reshape(n, len(values))
        out[:, j] = (counts.astype(values.dtype) @ values).tolist()
    return out


def limbs(x: int) -> Iterator[tuple[int, int]]:
    """(place, digit) of an integer of any size in base 2^60, the digits of its sign."""
    place, sign, x = 0, (-1 if x < 0 else 1), abs(x)
    while x or not place:
        yield place, sign * (x % _LIMB)
        place, x = place + 1, x // _LIMB


def kept_rows(vectors: DataFrame) -> DataFrame:
    """vec_id, label and the vector in doubles, of the rows whose vector can be coded."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"),
                          F.col("label"))
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    return rows.where(F.col("v").isNotNull() & F.forall("v", finite))


_BLOCK = "rows int, dims int, sizes array<int>, big array<string>, small binary, codes binary, vec_ids array<long>"
_COLUMNS = ["rows", "dims", "sizes", "big", "small", "codes"]


def _matrix(vectors: pa.ListArray, scale: int) -> np.ndarray:
    lengths = np.diff(vectors.offsets.to_numpy())
    flat = floors(vectors.flatten().to_numpy(zero_copy_only=False), scale)
    most = int(lengths.max(initial=0))
    if len(lengths) and (lengths == most).all():
        return flat.reshape(len(lengths), most)
    out = np.zeros((len(lengths), most), dtype=flat.dtype)
    out[np.arange(most)[None, :] < lengths[:, None]] = flat
    return out


def block_store(kept: DataFrame, scale: int = SCALE) -> DataFrame:
    """The vectors in blocks (``_BLOCK`` and the labels), each with its own dictionaries."""
    label = kept.schema["label"].dataType
    schema = T.StructType.fromDDL(_BLOCK).add("labels", T.ArrayType(label))

    def run(batches):
        for b in batches:
            vectors = b.column(1)
            most = max(1, int(np.diff(vectors.offsets.to_numpy()).max(initial=0)))
            step = max(1, min(BLOCK_ROWS, BLOCK_VALUES // most))
            for at in range(0, b.num_rows, step):
                part = b.slice(at, step)
                block = Block.of(_matrix(pa.array(part.column(1)), scale))
                sizes, big, small, codes = block.pack()
                whole = pa.array([0, part.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part.num_rows], pa.int32()), pa.array([len(sizes)], pa.int32()),
                     pa.array([sizes], pa.list_(pa.int32())), pa.array([big], pa.list_(pa.string())),
                     pa.array([small], pa.binary()), pa.array([codes], pa.binary()),
                     pa.ListArray.from_arrays(whole, part.column(0)), pa.ListArray.from_arrays(whole, part.column(2))],
                    names=schema.names)

    return kept.select("vec_id", "v", "label").mapInArrow(run, schema)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Block, pa.RecordBatch, int]]:
    for b in batches:
        for i in range(b.num_rows):
            rows, _, sizes, big, small, codes = (b.column(k)[i].as_py() for k in range(len(_COLUMNS)))
            yield Block.unpack(rows, sizes, big, small, codes), b, i


def first_codebooks(kept: DataFrame, dims: int, scale: int, n: int) -> np.ndarray:
    """entries x dimensions: the vectors of the smallest vec_ids."""
    rows = kept.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(n).collect()
    out = np.zeros((len(rows), dims), dtype=object)
    for i, row in enumerate(rows):
        out[i, :len(row["v"])] = [big_floor(x, scale) for x in row["v"]]
    return out


def _narrow(codebook: np.ndarray) -> np.ndarray:
    most = max((abs(x) for x in codebook.ravel().tolist()), default=0)
    return codebook.astype(np.int64) if most <= _SAFE else codebook


def update(store: DataFrame, codebook: np.ndarray, parts: int) -> np.ndarray:
    """One round: every part to its nearest entry, every used entry to its parts' mean."""
    n, dims = codebook.shape
    width = dims // parts
    now = _narrow(codebook)

    def run(batches):
        sums, counts = np.zeros((n, dims), dtype=object), np.zeros((parts, n), dtype=np.int64)
        for block, _, _ in _blocks(batches):
            for p in range(parts):
                at = p * width
                nearest, _ = assign(block, now[:, at:at + width], at)
                counts[p] += np.bincount(nearest, minlength=n)
                sums[:, at:at + width] += entry_sums(block, nearest, n, at, width)
        rows = [(e, j, place, digit, int(counts[j // width, e])) for e in range(n) for j in range(dims)
                if counts[j // width, e] for place, digit in limbs(sums[e, j])]
        columns = list(zip(*rows)) or [[]] * 5
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
            pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64()))], names=["entry", "dim", "place", "digit", "n"])

    sent = store.select(*_COLUMNS).mapInArrow(run, "entry int, dim int, place int, digit long, n long")
    found = sent.groupBy("entry", "dim", "place").agg(F.sum(F.col("digit").cast("decimal(38,0)")).alias("digit"),
                                                      F.sum("n").alias("n")).collect()
    totals: dict[tuple[int, int], list[int]] = {}
    for r in found:
        both = totals.setdefault((r["entry"], r["dim"]), [0, 0])
        both[0] += int(r["digit"]) * _LIMB ** r["place"]
        both[1] = max(both[1], r["n"])  # the lowest place has a row of every task
    out = codebook.copy()
    for (e, j), (total, count) in totals.items():
        out[e, j] = total // count
    return out


def train(store: DataFrame, codebook: np.ndarray, rounds: int = ROUNDS, parts: int = PARTS) -> np.ndarray:
    for _ in range(rounds):
        codebook = update(store, codebook, parts)
    return codebook


def encode(store: DataFrame, codebook: np.ndarray, parts: int = PARTS) -> DataFrame:
    """vec_id, label, code (two hex digits a part) and error of every vector."""
    width, now = codebook.shape[1] // parts, _narrow(codebook)
    label = store.schema["labels"].dataType.elementType
    schema = T.StructType().add("vec_id", "long").add("label", label).add("code", "string").add("error", "long")

    def run(batches):
        for block, b, i in _blocks(batches):
            hexed, error = np.zeros((block.rows, parts), dtype=np.uint8), np.zeros(block.rows, dtype=object)
            for p in range(parts):
                nearest, distance = assign(block, now[:, p * width:(p + 1) * width], p * width)
                hexed[:, p] = nearest
                error += distance
            flat = hexed.tobytes().hex()
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_ids")[i].values, b.column("labels")[i].values,
                 pa.array([flat[k:k + 2 * parts] for k in range(0, len(flat), 2 * parts)], pa.string()),
                 pa.array([min(int(e), _MOST) for e in error], pa.int64())], names=schema.names)

    return store.select(*_COLUMNS, "vec_ids", "labels").mapInArrow(run, schema)


def decoder(codebook: np.ndarray, parts: int = PARTS) -> Callable[[str], list[int]]:
    """The integers that a code stands for."""
    width = codebook.shape[1] // parts
    return lambda code: [int(x) for p in range(parts)
                         for x in codebook[int(code[2 * p:2 * p + 2], 16), p * width:(p + 1) * width]]


def codebooks_sha256(codebook: np.ndarray, parts: int = PARTS) -> str:
    """All entries' components by part, entry and position, in decimal."""
    width = codebook.shape[1] // parts
    numbers = [str(int(x)) for p in range(parts) for e in range(codebook.shape[0])
               for x in codebook[e, p * width:(p + 1) * width]]
    return hashlib.sha256(",".join(numbers).encode()).hexdigest()


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
             scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code and error of every kept vector; the codebooks, entries x dimensions)."""
    if not 1 <= entries <= 256:
        raise ValueError("an entry's index has two hex digits")
    kept = kept_rows(vectors)
    store = stage(block_store(kept, scale), "blocks")
    longest = store.agg(F.max("dims")).first()[0] or 0
    codebook = first_codebooks(kept, -(-longest // parts) * parts, scale, entries)
    if not len(codebook):
        return encode(store.limit(0), codebook, parts), codebook
    codebook = train(store, codebook, rounds, parts)
    return encode(store, codebook, parts), codebook


def code_digest(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, the errors' sum over the vector's label, and the codebooks' digest."""
    coded, codebook = compress(vectors)
    coded = stage(coded, "codes")
    sums = coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("s")).select(
        F.col("label").alias("of"), F.least("s", F.lit(_MOST).cast("decimal(38,0)")).cast("long").alias("label_error"))
    return coded.join(stage(sums, "label-errors"), F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks_sha256(codebook)).alias("codebooks_sha256"))
