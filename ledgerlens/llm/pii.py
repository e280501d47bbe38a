"""Format-preserving pseudonyms for personal numbers, addresses and dates.

A match counts only when it is valid (Luhn check, mod-97 check, number plan,
octet range, calendar); cards and IBANs are found among further digits and
words as well, between separators.  Valid values of a format are numbered 0..N-1, a keyed
Feistel network permutes the numbers (cycle-walking back into the range), and
the permuted number is written in the same layout: separators, letter case and
check digits are kept right.  The permutation depends on the key and the
format alone, so equal values get equal pseudonyms in all documents, however
they are punctuated, and no table of values exists anywhere.

The text changes only inside matches.  A null text stays null with no finds;
empty texts, ties and repeated rows need no care: every row is on its own.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import re
import string
from collections.abc import Iterator
from datetime import date
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ("email", "card", "iban", "ssn", "phone", "ip", "date")


class Feistel:
    """Keyed permutation of 0..n-1 by an alternating Feistel network."""

    def __init__(self, key: bytes):
        self.key = key

    def __call__(self, n: int, value: int, tweak: str) -> int:
        if n < 2:
            return value
        a = math.isqrt(n - 1) + 1
        b = -(-n // a)
        while True:  # the walk stays on the value's own cycle, so it ends inside
            left, right = divmod(value, b)
            size_l, size_r = a, b
            for i in range(ROUNDS):
                seen = hashlib.blake2b(f"{tweak}|{n}|{i}|{right}".encode(), key=self.key, digest_size=16 + (a.bit_length() + 7) // 8)
                left, right = right, (left + int.from_bytes(seen.digest())) % size_l
                size_l, size_r = size_r, size_l
            value = left * size_r + right
            if value < n:
                return value


def luhn_digit(payload: str) -> str:
    total = 0
    for i, c in enumerate(reversed(payload)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _lay(layout: str, chars: str) -> str:
    """``chars`` in the places that hold letters or digits in ``layout``."""
    it = iter(chars)
    return "".join(next(it) if c.isalnum() else c for c in layout)


def _digits(permute: Feistel, digits: str, tweak: str) -> str:
    return str(permute(10 ** len(digits), int(digits), tweak)).zfill(len(digits))


def _card(permute: Feistel, text: str) -> str | None:
    d = re.sub(r"\D", "", text)
    if not 13 <= len(d) <= 19 or luhn_digit(d[:-1]) != d[-1] or len(set(d)) == 1:
        return None
    body = d[0] + _digits(permute, d[1:-1], f"card{d[0]}")
    return _lay(text, body + luhn_digit(body))


def _iban(permute: Feistel, text: str) -> str | None:
    v = text.replace(" ", "")
    if not 15 <= len(v) <= 34 or int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 != 1:
        return None
    body = _mixed(permute, v[4:], "iban" + v[:2])
    check = 98 - int("".join(str(int(c, 36)) for c in body + v[:2] + "00")) % 97
    return _lay(text, f"{v[:2]}{check:02d}{body}")


#: Length of an IBAN by country.
_IBAN_LENGTH = {c: int(n) for n, some in (x.split(":") for x in (
    "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV 22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA "
    "23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST 26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM "
    "28:AL,AZ,BY,CY,DO,EG,GT,HU,LB,NI,PL,SV 29:BR,PS,QA,UA 30:JO,KW,YE 31:MT,SC 32:LC 33:RU").split()) for c in some.split(",")}


def _card_ends(groups: list[str], whole: bool) -> list[int]:
    """How many of the groups may be a card: 13 to 19 digits, the most first."""
    ends = list(accumulate(map(len, groups[:19])))
    return [i + 1 for i, n in reversed(list(enumerate(ends))) if 13 <= n <= 19 and (whole or i + 1 < len(groups))]


def _card_like(groups: list[str], whole: bool) -> list[int]:
    """Those in which cards are written: one group, or groups of 3 to 12 digits."""
    return [n for n in _card_ends(groups, whole) if n == 1 or all(3 <= len(g) <= 12 for g in groups[:n])]


def _iban_ends(groups: list[str], whole: bool) -> list[int]:
    """How many of the groups may be an IBAN: the country's length first, then the most
    of up to 34 characters; all of them where the country is not known."""
    if not re.match(r"[A-Z]{2}\d{2}", groups[0]):
        return []
    ends = list(accumulate(map(len, groups[:34])))
    fit = [i + 1 for i, n in reversed(list(enumerate(ends))) if 15 <= n <= 34]
    length = _IBAN_LENGTH.get(groups[0][:2])
    return [i for i in fit if ends[i - 1] == length] + fit[:1] if length else fit


def _in_run(permute: Feistel, run: str, whole: bool, change) -> list[tuple[int, int, str]]:
    """(start, end, pseudonym) of the valid values in a run of groups.

    A value begins and ends with a group; what fails its check is tried
    shorter, then from the next group on.  What no card was found in is tried
    once more in layouts that cards seldom have, but there the longest extent
    alone: among small numbers some shorter one would nearly always pass.
    ``whole``: a value may end the run.
    """
    at = [(m.start(), m.end()) for m in re.finditer(r"[A-Z0-9]+", run)]
    groups = [run[a:b] for a, b in at]
    found: list[tuple[int, int, str]] = []

    def search(i: int, stop: int, ends, retry: bool) -> None:
        while i < stop:
            tries = ends(groups[i:min(stop, i + 35)], whole or min(stop, i + 35) < len(at))
            for n in tries if retry else tries[:1]:
                new = change(permute, run[at[i][0]:at[i + n - 1][1]])
                if new is not None:
                    found.append((i, i + n, new))
                    i += n
                    break
            else:
                i += 1 if retry or not tries else tries[0]

    search(0, len(at), _iban_ends if change is _iban else _card_like, True)
    if change is _card:
        edges = [0, *(x for i, j, _ in found for x in (i, j)), len(at)]
        for i, stop in zip(edges[::2], edges[1::2]):
            search(i, stop, _card_ends, False)
    return [(at[i][0], at[j - 1][1], new) for i, j, new in sorted(found)]


def _mixed(permute: Feistel, text: str, tweak: str) -> str:
    """Letters stay letters of their case, digits digits, everything else itself."""
    sets = [next((s for s in (string.digits, string.ascii_lowercase, string.ascii_uppercase) if c in s), c)
            for c in text]
    value = 0
    for c, s in zip(text, sets):
        value = value * len(s) + s.index(c)
    n = math.prod(len(s) for s in sets)
    shape = "".join(s[0] for s in sets)
    value, out = permute(n, value, f"{tweak}|{shape}"), []
    for s in reversed(sets):
        value, i = divmod(value, len(s))
        out.append(s[i])
    return "".join(reversed(out))


def _email(permute: Feistel, m: re.Match) -> str | None:
    local, at, host = m[0].rpartition("@")
    return _mixed(permute, local, "email@" + host.lower()) + at + host


def _ssn(permute: Feistel, m: re.Match) -> str | None:
    area, group, serial = int(m["sa"]), int(m["sg"]), int(m["ss"])
    if not 0 < area < 900 or area == 666 or not group or not serial:
        return None
    areas = area - 1 - (area > 666)  # 898 areas, 99 groups, 9,999 serials
    value = permute(898 * 99 * 9999, (areas * 99 + group - 1) * 9999 + serial - 1, "ssn")
    value, serial = divmod(value, 9999)
    areas, group = divmod(value, 99)
    return f"{areas + 1 + (areas >= 665):03d}-{group + 1:02d}-{serial + 1:04d}"


#: Country codes (E.164) of one and two digits; all others have three.
_CODES = {"1", "7", *"20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 63 64 65 66 "
          "81 82 84 86 90 91 92 93 94 95 98".split()}


def _in_plan(d: str) -> bool:
    """Number plan of country code 1: area, exchange, line."""
    return len(d) == 10 and d[0] in "23456789" and d[3] in "23456789"


def _phone(permute: Feistel, m: re.Match) -> str | None:
    """Digits alone make the value: the country code and the rest, however they are laid out."""
    d = re.sub(r"\D", "", m[0])
    if not m["pc"] and (m["pn"].isdigit() or not _in_plan(d)):
        return None  # bare digits are no phone number
    code = next(d[:n] for n in (1, 2, 3) if n == 3 or d[:n] in _CODES) if m["pc"] else "1"
    rest = d[len(code):] if m["pc"] else d
    if code == "1" and _in_plan(rest):
        value = ((int(rest[:3]) - 200) * 800 + int(rest[3:6]) - 200) * 10_000 + int(rest[6:])
        value, line = divmod(permute(800 * 800 * 10_000, value, "phone"), 10_000)
        area, exchange = divmod(value, 800)
        new = f"{area + 200}{exchange + 200}{line:04d}"
    elif 8 <= len(d) <= 17:
        new = _digits(permute, rest, "phone+" + code)
        while code == "1" and _in_plan(new):  # the walk stays outside the plan
            new = _digits(permute, new, "phone+" + code)
    else:
        return None
    return _lay(m[0], code + new if m["pc"] else new)


def _ip(permute: Feistel, m: re.Match) -> str | None:
    octets = [int(x) for x in m[0].split(".")]
    if max(octets) > 255 or not octets[0]:
        return None
    value = int.from_bytes(bytes(octets)) - (1 << 24)
    value = permute((255 << 24), value, "ip") + (1 << 24)
    return ".".join(map(str, value.to_bytes(4)))


_FIRST = date(1900, 1, 1).toordinal()
_DAYS = date(2100, 1, 1).toordinal() - _FIRST


def _date(permute: Feistel, m: re.Match) -> str | None:
    a, b, c = m["da"], m["db"], m["dc"]
    ymd = len(a) == 4
    orders = [(a, b, c)] if ymd else [(c, b, a)] if m["ds"] == "." else [(c, a, b), (c, b, a)]
    for i, (y, mo, d) in enumerate(orders):  # with a slash month first, else day first
        try:
            at = date(int(y), int(mo), int(d)).toordinal() - _FIRST
        except ValueError:
            continue
        if not 0 <= at < _DAYS:
            continue
        new = date.fromordinal(_FIRST + permute(_DAYS, at, "date"))
        y, mo, d = f"{new.year:04d}", f"{new.month:02d}", f"{new.day:02d}"
        if ymd:
            return m["ds"].join((y, mo, d))
        if m["ds"] == "." or i:
            if m["ds"] == "/" and new.day <= 12:  # would read as month first
                d, mo = mo, d
            return m["ds"].join((d, mo, y))
        return m["ds"].join((mo, d, y))
    return None


_FOUND = {
    "email": (r"(?<![\w.%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,63})@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}", _email),
    "card": (r"(?<![\d.-])\d(?:[ -]?\d){12,}", _card),
    "iban": (r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,}(?![A-Za-z0-9])", _iban),
    "ssn": (r"(?<![\d-])(?P<sa>\d{3})-(?P<sg>\d{2})-(?P<ss>\d{4})(?![\d-])", _ssn),
    "phone": (r"(?<![\w+])(?:(?P<pc>\+1[ .-]?(?=(?:\([2-9]\d\d\)|[2-9]\d\d)[ .-]?[2-9]\d\d[ .-]?\d{4}(?![\w-]))"
              r"|\+\d{1,3}[ .-]?)?(?P<pn>(?<=\+1)[2-9]\d\d[ .-]?[2-9]\d\d[ .-]?\d{4}(?![\w-])"
              r"|\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}"
              r"|\d{3}[ .-]\d{3}[ .-]\d{4}|(?<=[ .-])\d{2,4}(?:[ .-]?\d{2,4}){2,4}|(?<=\d)\d{6,12}"
              r"|(?<=\d)\d{1,4}(?:[ .-]?\d{2,4}){2,4}))(?![\w-])", _phone),
    "ip": (r"(?<![\d.])\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}(?![\d]|\.\d)", _ip),
    "date": (r"(?<![\d./-])(?:(?P<da>\d{4})(?P<ds>[-./])(?P<db>\d{2})(?P=ds)(?P<dc>\d{2})"
             r"|(?P<ea>\d{2})(?P<es>[-./])(?P<eb>\d{2})(?P=es)(?P<ec>\d{4}))(?![\d/-])", _date),
}


class _Either(dict):
    """The groups of a date, whichever of its two layouts matched."""

    def __init__(self, m: re.Match):
        self.m = m

    def __getitem__(self, name: str) -> str:
        return self.m[name] or self.m["e" + name[1:]]


def pseudonymise(text: str, permute: Feistel) -> tuple[str, dict[str, int]]:
    """The text with every valid value replaced, and the number of finds by kind.

    Kinds are searched one after another; what one kind has replaced is set
    aside, so that no later kind reads a pseudonym.
    """
    counts = dict.fromkeys(KINDS, 0)
    if "@" not in text and not _NUMBER(text):
        return text, counts
    parts = [text]  # even: open text, odd: pseudonyms
    for kind in KINDS:
        find, change = _COMPILED[kind]
        out: list[str] = []
        for i, part in enumerate(parts):
            if i % 2:
                out.append(part)
                continue
            at = 0
            for m in find(part):
                if kind in ("card", "iban"):
                    found = _in_run(permute, m[0], kind == "iban" or part[m.end():m.end() + 1] != "-", change)
                else:
                    new = change(permute, _Either(m) if kind == "date" else m)
                    found = [(0, m.end() - m.start(), new)] if new is not None else []
                for start, end, new in found:
                    out += [part[at:m.start() + start], new]
                    at = m.start() + end
                    counts[kind] += 1
            out.append(part[at:])
        parts = out
    return "".join(parts), counts


_NUMBER = re.compile(r"\d[\d ().+/-]{5}|[A-Z]{2}\d\d").search
_COMPILED = {k: (re.compile(p, re.ASCII).finditer, f) for k, (p, f) in _FOUND.items()}


def pseudonymise_documents(docs: DataFrame, key: bytes) -> DataFrame:
    """doc_id, text, n_found and n_<kind> of every document.

    ``key`` (up to 64 bytes) selects the permutation; keep it secret.
    """
    names = ["doc_id", "text", "n_found", *(f"n_{k}" for k in KINDS)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        permute = Feistel(key)
        for b in batches:
            done = [(t, dict.fromkeys(KINDS, 0)) if t is None else pseudonymise(t, permute)
                    for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([t for t, _ in done], pa.string()),
                 pa.array([sum(c.values()) for _, c in done], pa.int32()),
                 *(pa.array([c[k] for _, c in done], pa.int32()) for k in KINDS)], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, n_found int, " + ", ".join(f"n_{k} int" for k in KINDS))
