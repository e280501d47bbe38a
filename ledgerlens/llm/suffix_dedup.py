"""Byte-substring de-duplication across documents with suffix arrays.

The suffix arrays are built by linear grouping construction (Baier 2016):
suffixes are grouped by their Lyndon prefix, the groups are processed in
descending order through previous-smaller pointers, and one more pass emits
the order inside the groups; no symbol is ever renamed recursively.

1. Every window of ``length`` bytes has an anchor, its 16-byte gram of least
   hash.  Anchors that are in one document only are dropped.
2. The surroundings of each shared anchor, as far as a window around it can
   reach, are dealt to groups by anchor.  A task sends equal surroundings once,
   for the smallest document that has them: its other documents' windows
   repeat that one's.
3. A group sorts the distinct surroundings twice, to the right of the anchor and
   to the left, by suffix arrays over 17-byte symbols; the common prefixes of
   neighbours cut the orders into classes at every depth.  Two windows are equal
   when they are in the same class on both sides, and the smallest document
   of each class pair decides who keeps the bytes.  Where an anchor has one
   surrounding only, there is nothing to order.

Judged is the input: byte ranges are gathered per document and cut in the end.

A null text has no bytes.  A null doc_id counts as larger than all others.
Rows that share a doc_id never remove each other's bytes; each keeps its own
ranges, whether their texts are equal or not.
Empty tables give empty results; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import chunked, groups_for, mix64, sliding_min, text_bytes
from ledgerlens.llm.repeats import ENTRIES, by_bucket, deal_all, planes, repeated, rows_of, tagged, unplanes

GRAM = 16
BLOCK = 17  # bytes of a symbol
FLUSH = 200_000  # surroundings that a task gathers
ANCHORS = 400_000  # anchors that a task gathers
GROUP_BYTES = 12 << 20  # text whose anchors make up a group, about
SEGMENT = 48 << 10  # windows looked at together: their hashes stay in a processor's cache, their places in 16 bits
TEXT_BYTES = 1 << 20  # text whose surroundings are taken together
_MUL, _MUL2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1342543DE82EF95)


def suffix_array(symbols: list[int]) -> list[int]:
    """Places of the suffixes of ``symbols`` in ascending order.

    The last symbol must be smaller than all others.  Groups are ranges of
    the array under construction; a group's number is where it starts.
    """
    n = len(symbols)
    values = np.asarray(symbols)
    by_value = np.argsort(values, kind="stable")
    at, starts = np.arange(n), np.flatnonzero(np.append(True, np.diff(values[by_value]) != 0))[:n]
    sizes = np.diff(np.append(starts, n))
    place, group, end = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n + 1, np.int64)
    place[by_value], group[by_value], end[starts] = at, np.repeat(starts, sizes), starts + sizes
    order, place, group, end = by_value.tolist(), place.tolist(), group.tolist(), end.tolist()
    smaller = [-1] * n  # place of the previous suffix that is in a smaller group
    high = n
    while high > 0:
        low = group[order[high - 1]]
        if high - low == 1:
            i = order[low]
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                g = group[j]
                top = end[g] - 1
                if top > g:  # to the upper end of its group, as a group of its own
                    other, at = order[top], place[j]
                    order[at], place[other] = other, at
                    order[top], place[j] = j, top
                    group[j], end[top], end[g] = top, top + 1, top
            high = low
            continue
        times: dict[int, int] = {}
        for i in sorted(order[low:high]):
            j = i - 1
            while j >= 0 and group[j] >= low:
                j = smaller[j]
            smaller[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        by_times: dict[int, list[int]] = {}
        for j, count in times.items():
            by_times.setdefault(count, []).append(j)
        for count in sorted(by_times, reverse=True):
            by_group: dict[int, list[int]] = {}
            for j in by_times[count]:
                by_group.setdefault(group[j], []).append(j)
            for g, moved in by_group.items():
                stop = end[g]
                new = stop - len(moved)
                if new == g:
                    continue
                top = stop
                for j in moved:
                    top -= 1
                    other, at = order[top], place[j]
                    order[at], place[other] = other, at
                    order[top], place[j] = j, top
                    group[j] = new
                end[new], end[g] = stop, new
        high = low
    free, done, out = list(range(n)), bytearray(n), [-1] * n
    if n:
        out[0] = n - 1
        free[0], done[n - 1] = 1, 1
    for at in range(n):
        j = out[at] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            out[free[g]] = j
            free[g] += 1
            done[j] = 1
            j = smaller[j]
    return out


def ordered(rows: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Order of byte rows (after their class numbers) by the suffix array of them all, end to end.

    A row is its class and its blocks; a block's symbol is its rank among all
    blocks, so symbols compare as the bytes do.  Classes are smaller than all
    blocks and descend, so that a Lyndon prefix never leaves its class.
    """
    n, width = rows.shape
    n_blocks = -(-width // BLOCK)
    laid = np.argsort(-classes, kind="stable")
    padded = np.zeros((n, n_blocks * BLOCK), dtype=np.uint8)
    padded[:, :width] = rows[laid]
    blocks = padded.reshape(-1, BLOCK).view(f"V{BLOCK}").ravel()
    symbols = np.empty((n, n_blocks + 1), dtype=np.int64)
    symbols[:, 0] = classes[laid] + 1
    symbols[:, 1:] = np.unique(blocks, return_inverse=True)[1].reshape(n, n_blocks) + classes.max() + 2
    found = np.array(suffix_array([*symbols.ravel().tolist(), 0]), dtype=np.int64)
    heads = found[found % (n_blocks + 1) == 0] // (n_blocks + 1)
    return laid[heads[heads < n]]


def common(rows: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Bytes that each row has in common with the one before it in ``order`` (the first: 0)."""
    equal = rows[order[1:]] == rows[order[:-1]]
    return np.concatenate(([0], np.where(equal.all(axis=1), rows.shape[1], equal.argmin(axis=1))))


def told_windows(left: np.ndarray, right: np.ndarray, n_left: np.ndarray, n_right: np.ndarray,
                 classes: np.ndarray, owner: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For each surrounding, the least and the largest offset j of the anchor in a window that a
    smaller owner's equal window removes; ``length`` and -1 where there is none.

    ``left`` holds the bytes before the anchor, nearest first; ``right`` those
    after it (the anchor itself is the class).
    """
    n, reach = len(owner), length - GRAM
    low, high = np.full(n, length), np.full(n, -1)
    sides = []
    for rows in (left, right):
        order = ordered(rows, classes)
        same = np.concatenate(([0], np.where(np.diff(classes[order]) == 0, common(rows, order)[1:], -1)))
        sides.append((order, same))
    for j in range(reach + 1):
        number = []
        some = (n_left >= j) & (n_right >= length - j)
        for (order, same), depth in zip(sides, (j, reach - j)):
            new = same < depth
            of = np.empty(n, dtype=np.int64)
            of[order] = np.cumsum(new)
            number.append(of)
            new[0] = True
            some[order[new & np.append(new[1:], True)]] = False  # equal to no other on this side
        some = np.flatnonzero(some)
        if not len(some):
            continue
        pair = number[0][some] * (n + 2) + number[1][some]
        by_pair = np.argsort(pair)
        some, pair = some[by_pair], pair[by_pair]
        first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1]))
        smallest = np.repeat(np.minimum.reduceat(owner[some], first), np.diff(np.append(first, len(some))))
        hit = some[smallest < owner[some]]
        low[hit], high[hit] = np.minimum(low[hit], j), j
    return low, high


def met_elsewhere(words: np.ndarray, classes: np.ndarray, length: int) -> np.ndarray:
    """Whether a surrounding may have a window in common with another one of its class.

    ``words`` has its bytes, four at a time.  Windows that start near each other
    share the bytes in their midst; a surrounding that is alone with these,
    wherever they are, has no window that another has.
    """
    found = np.zeros(len(words), dtype=bool)
    for start in range(0, length - GRAM + 1, 9):
        last = min(start + 8, length - GRAM)
        key = mix64(classes.astype(np.uint64))
        for i in range(-(-last // 4), (start + length) // 4):
            key = (key ^ words[:, i]) * _MUL
            key ^= key >> np.uint64(29)
        by_key = np.argsort(key)
        again = key[by_key][1:] == key[by_key][:-1]
        found[by_key[1:][again]] = True
        found[by_key[:-1][again]] = True
    return found


def equal_rows(rows: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order that brings equal rows of 64-bit words together, where each set of equal ones begins in it).

    Rows with the same ``near`` are neighbours, but for a few.  Rows are ordered
    by a hash and compared whole; where two that differ share the hash, by their words.
    """
    key = mix64(rows[:, 0] * _MUL)
    for i in range(1, rows.shape[1]):
        key = (key ^ rows[:, i]) * _MUL
        key ^= key >> np.uint64(32)
    key = (near & np.uint64(0xFFFFFF << 40)) | (mix64(key) >> np.uint64(24))
    order = np.argsort(key)
    key, rows = key[order], rows[order]
    new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
    if (new[1:] & (key[1:] == key[:-1])).any():
        by_words = np.lexsort(rows.T)
        order, rows = order[by_words], rows[by_words]
        new = np.append(True, (rows[1:] != rows[:-1]).any(axis=1))
    return order, np.flatnonzero(new[:len(rows)])


def whole_words(around: np.ndarray, n_left: np.ndarray, n_right: np.ndarray) -> np.ndarray:
    """Surroundings and where their texts end, as 64-bit words."""
    width = around.shape[1]
    out = np.zeros((len(around), -(-(width + 2) // 8) * 8), dtype=np.uint8)
    out[:, :width], out[:, width], out[:, width + 1] = around, n_left, n_right
    return out.view("<u8")


def anchor_words(around: np.ndarray, length: int) -> np.ndarray:
    """The anchor's 16 bytes of each surrounding, as two 64-bit words."""
    return np.ascontiguousarray(around[:, length - GRAM:length]).view("<u8")


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hash of the 16 bytes from each place."""
    words = np.empty(len(data) - 7, dtype=np.uint64)
    for i in range(8):
        words[i::8] = data[i:i + (len(data) - i) // 8 * 8].view("<u8")
    out = words[:-8] * _MUL
    out ^= out >> np.uint64(32)
    out += words[8:]
    out *= _MUL2
    out ^= out >> np.uint64(29)
    out *= _MUL
    out ^= out >> np.uint64(32)
    return out


def anchors_of(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(48-bit hash, text index, place) of the anchors of a few texts.

    A window's anchor is its gram of least hash, the first of equal ones; the
    places of the windows' anchors ascend with the windows.
    """
    held = np.array([i for i, t in enumerate(texts) if len(t) >= length], dtype=np.int64)
    data = np.frombuffer(b"".join(texts[i] for i in held), np.uint8)
    ends = np.cumsum([len(texts[i]) for i in held], dtype=np.int64)
    low = np.uint64(0xFFFF)
    keys, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for at in range(0, len(data) - length + 1, SEGMENT):
        grams = gram_hashes(data[at:at + SEGMENT + length - 1])
        grams &= ~low
        grams |= np.arange(len(grams), dtype=np.uint64)
        least = sliding_min(grams, length - GRAM + 1)
        inside = np.ones(len(least), dtype=bool)  # windows of one text
        first, past = np.searchsorted(ends, (at, at + len(least) + length))
        for end in (ends[first:past] - at).tolist():
            inside[max(0, end - length + 1):max(0, end)] = False
        least = least[inside]
        least = least[np.append(True, least[1:] != least[:-1])[:len(least)]]
        keys.append(least >> np.uint64(16))
        places.append((least & low).astype(np.int64) + at)
    key, place = np.concatenate(keys), np.concatenate(places)
    new = np.append(True, place[1:] != place[:-1])[:len(place)]
    key, place = key[new], place[new]
    of = np.searchsorted(ends, place, side="right")
    return key, held[of], place - np.append(0, ends)[of]


def _anchor_entries(length: int, n_groups: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def entries():
            for ids, texts in chunked(batches):
                key, of, place = anchors_of(texts, length)
                yield key, np.zeros(len(key), np.uint32), np.array(ids, dtype=np.int64)[of], place.astype(np.int32)

        yield from deal_all(entries(), True, n_groups, ANCHORS)

    return run


_AROUND = ("bucket int, around binary, n_left binary, n_right binary, id binary, pos binary, t_id binary, t_from binary, "
           "t_to binary, tag binary, t_tag binary")


def _around(length: int, n_groups: int):
    """Surroundings of the anchors that come with each text, packed by anchor."""
    reach, width = length - GRAM, 2 * length - GRAM

    def flush(held: list) -> pa.RecordBatch:
        around, n_left, n_right, ids, pos, tags = (np.concatenate([h[i] for h in held]) for i in range(6))
        grams = anchor_words(around, length)
        near = mix64(grams[:, 0] ^ mix64(grams[:, 1]))
        order, first = equal_rows(whole_words(around, n_left, n_right), near)
        least = np.empty(len(ids), dtype=np.int64)
        least[order] = np.repeat(np.minimum.reduceat(ids[order], first), np.diff(np.append(first, len(ids))))
        sent = order[ids[order] == least[order]]  # of the others a smaller document of this task has the same bytes
        t_from = pos - np.minimum(n_left, reach)
        t_to = pos + np.minimum(n_right, length)
        told = np.flatnonzero((ids > least) & (t_to - t_from >= length))
        by_anchor, cut = by_bucket((near[sent] % np.uint64(n_groups)).astype(np.int32), n_groups)
        by_id, cut_told = by_bucket((ids[told] % n_groups).astype(np.int32), n_groups)
        sent, told = sent[by_anchor], told[by_id]
        sent_arrays = [x[sent] for x in (n_left, n_right, ids, pos)]
        told_arrays = [ids[told], t_from[told].astype(np.int32), t_to[told].astype(np.int32)]
        around, tags, t_tags = around[sent], tags[sent], tags[told]
        columns: list[list] = [[] for _ in range(11)]
        pack = zstandard.ZstdCompressor(level=3).compress  # neighbours are alike: they are in order
        for g in np.flatnonzero((np.diff(cut) > 0) | (np.diff(cut_told) > 0)).tolist():
            a, b = slice(cut[g], cut[g + 1]), slice(cut_told[g], cut_told[g + 1])
            values = [g, pack(around[a].tobytes()), *(planes(x[a]) for x in sent_arrays), *(planes(x[b]) for x in told_arrays),
                      planes(tags[a]), planes(t_tags[b])]
            for column, value in zip(columns, values):
                column.append(value)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, [pa.int32()] + [pa.binary()] * 10)],
            names=[f.split()[0] for f in _AROUND.split(", ")])

    def taken(texts: list[bytes], of: np.ndarray, pos: np.ndarray, ids: np.ndarray, tags: np.ndarray) -> tuple:
        """Surroundings of places in a few texts; zeros where a text has no more bytes."""
        data = np.frombuffer(b"".join([bytes(reach), *texts, bytes(width)]), np.uint8)
        size = np.array([len(t) for t in texts], dtype=np.int64)
        start = np.cumsum(size) - size
        around = np.lib.stride_tricks.sliding_window_view(data, width)[start[of] + pos]
        n_left, n_right = np.minimum(pos, reach), np.minimum(size[of] - pos, length)
        edge = np.flatnonzero((n_left < reach) | (n_right < length))
        at = np.arange(width)
        around[edge] *= (at >= (reach - n_left[edge])[:, None]) & (at < (reach + n_right[edge])[:, None])
        return around, n_left.astype(np.uint8), n_right.astype(np.uint8), ids[of], pos.astype(np.int32), tags[of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            sizes = pc.binary_length(b.column(1)).fill_null(0).to_numpy().astype(np.int64)
            ids, tags = b.column(0).to_numpy(), b.column(3).to_numpy().astype(np.int32)
            edges = np.flatnonzero(np.diff(np.cumsum(sizes) // TEXT_BYTES)) + 1
            for lo, hi in zip([0, *edges.tolist()], [*edges.tolist(), len(sizes)]):
                places = b.column(2).slice(lo, hi - lo)
                of = np.repeat(np.arange(hi - lo), places.value_lengths().to_numpy())
                there = np.sort(of << 32 | places.flatten().to_numpy())
                there = there[np.append(True, there[1:] != there[:-1])[:len(there)]]
                of, pos = there >> 32, there & 0xFFFFFFFF
                inside = pos + GRAM <= sizes[lo:hi][of]
                of, pos = of[inside], pos[inside]
                texts = [x.as_py() or b"" for x in b.column(1).slice(lo, hi - lo)]
                for some in np.array_split(np.arange(len(pos)), -(-len(pos) // FLUSH) or 1):
                    if not len(some):
                        continue
                    held.append(taken(texts, of[some], pos[some], ids[lo:hi], tags[lo:hi]))
                    n += len(some)
                    if n >= FLUSH:
                        yield flush(held)
                        held, n = [], 0
        if held:
            yield flush(held)

    return run


def _ranges(length: int):
    """Byte ranges to remove, from one group of surroundings."""
    reach, width = length - GRAM, 2 * length - GRAM

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        get = lambda c, kind: np.concatenate([unplanes(b, kind) for b in rows[c]])
        unpack = zstandard.ZstdDecompressor().decompress
        around = np.concatenate([np.frombuffer(unpack(b), np.uint8).reshape(-1, width) for b in rows["around"]])
        n_left, n_right = get("n_left", "u1").astype(np.int64), get("n_right", "u1").astype(np.int64)
        ids, pos = get("id", "i8"), get("pos", "i4")
        tags = get("tag", "i4")
        told = [(get("t_id", "i8"), get("t_from", "i4"), get("t_to", "i4"), get("t_tag", "i4"))]
        if len(ids):
            # equal surroundings are one, owned by their smallest document
            words = whole_words(around, n_left, n_right)
            around = words.view(np.uint8)[:, :width]
            order, first = equal_rows(words, mix64(anchor_words(around, length)[:, 0]))
            sizes = np.diff(np.append(first, len(ids)))
            owner = np.minimum.reduceat(ids[order], first)
            n_left, n_right, pos, ids, tags = (x[order] for x in (n_left, n_right, pos, ids, tags))
            # of the others every window goes; an anchor's windows hold the anchor, so they cover one range
            other = (ids > np.repeat(owner, sizes)) & (n_left + n_right >= length)
            told.append((ids[other], (pos - n_left)[other], (pos + n_right)[other], tags[other]))
            one = order[first]
            grams = anchor_words(around[one], length)
            by_gram = np.lexsort(grams.T)
            classes = np.empty(len(one), dtype=np.int64)
            classes[by_gram] = np.cumsum(np.append(True, (grams[by_gram][1:] != grams[by_gram][:-1]).any(axis=1)))
            several = np.flatnonzero(np.bincount(classes)[classes] > 1)
            several = several[met_elsewhere(words[one[several]].view("<u4"), classes[several], length)]
            if len(several):
                at, edge = around[one[several]], first[several]
                low, high = told_windows(np.ascontiguousarray(at[:, :reach][:, ::-1]), at[:, length:], n_left[edge],
                                         n_right[edge], np.unique(classes[several], return_inverse=True)[1],
                                         owner[several], length)
                # of its owner's places those windows go that a smaller document has as well
                of = np.full(len(one), -1)
                of[several[high >= 0]] = np.flatnonzero(high >= 0)
                of = np.repeat(of, sizes)
                hit = np.flatnonzero((of >= 0) & (ids == np.repeat(owner, sizes)))
                of = of[hit]
                told.append((ids[hit], pos[hit] - high[of], pos[hit] - low[of] + length, tags[hit]))
        ident, start, stop, tag = (np.concatenate([t[i] for t in told]) for i in range(4))
        return pd.DataFrame({"id": ident, "first": start.astype(np.int32), "past": stop.astype(np.int32),
                             "tag": tag.astype(np.int32)})

    return run


def _cut(with_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for text, firsts, pasts in zip(*(b.column(i) for i in (1, 2, 3))):
                text, n_spans, kept = text.as_py() or b"", 0, []
                at = 0
                if firsts.is_valid:
                    first, past = firsts.values.to_numpy(), pasts.values.to_numpy()
                    order = np.argsort(first, kind="stable")
                    first, past = first[order], np.maximum.accumulate(past[order])
                    new = np.concatenate(([True], first[1:] > past[:-1]))  # touching ranges are one run
                    ends = past[np.append(np.flatnonzero(new)[1:] - 1, len(past) - 1)]
                    n_spans = int(new.sum())
                    for x, y in zip(first[new].tolist(), ends.tolist()):
                        kept.append(text[at:x])
                        at = y
                kept.append(text[at:])
                whole = b"".join(kept)
                for column, value in zip(out, (len(text), len(text) - len(whole), n_spans,
                                               hashlib.sha256(whole).hexdigest(), whole)):
                    column.append(value)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_bytes"][:5 + with_text]
            types = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, t) for c, t in zip(out, types))][:len(names)], names=names)

    return run


def remove_repeats(docs: DataFrame, length: int = 50, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept_bytes) of every document.

    Removed is every byte covered by ``length`` bytes that also start in a
    document with a smaller doc_id.  ``length`` is 17 to 255.
    """
    rows = tagged(rows_of(docs))
    n_groups = groups_for(text_bytes(docs), GROUP_BYTES)
    shared = repeated(rows.select("id", "text").mapInArrow(_anchor_entries(length, n_groups), ENTRIES), True)
    places = shared.groupBy("id").agg(F.collect_list("pos").alias("places"))
    # ordered inside a partition, so that a task that runs again flushes the same entries
    # doc_id goes along unread: the texts' exchange is then the same as at the end, and Spark uses it twice
    met = rows.join(places, "id").select("id", "text", "places", "tag", "doc_id").sortWithinPartitions("id", F.length("text"))
    ranges = met.mapInArrow(_around(length, n_groups), _AROUND).groupBy("bucket").applyInPandas(
        _ranges(length), "id long, first int, past int, tag int")
    ranges = ranges.groupBy("id", "tag").agg(F.collect_list("first").alias("firsts"), F.collect_list("past").alias("pasts"))
    kind = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_bytes binary" * with_bytes
    return rows.join(ranges, ["id", "tag"], "left").select("doc_id", "text", "firsts", "pasts").mapInArrow(_cut(with_bytes), kind)
