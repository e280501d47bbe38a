"""Date and period cleaning as native Column expressions.

Each function builds one codegen'd expression: a ``coalesce`` over the
attempts, so an unparseable value yields null instead of failing the job under
ANSI mode, and the first layout that parses wins.  A layout of fixed width is
recognised by length and separators and read by rearranging it into ISO text
for ``try_cast``: no regular expression and no formatter per row.  Others are
guarded by a regular expression and read by ``try_to_date``.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import as_col

# The day-level layouts accepted by the source exports, in the
# order they are tried (month-first for the numeric layouts; month-only
# layouts resolve to the first day of the month).
DATE_LAYOUTS: tuple[str, ...] = (
    "yyyy-MM-dd",
    "MM/dd/yyyy",
    "dd-MMM-yyyy",
    "MM-dd-yyyy",
    "MMM-yyyy",
    "yyyy-MM",
)

# Billing / ledger period layouts (``yyyy-MM``, ``MMM-yyyy``, ``MMMM yyyy``).
PERIOD_LAYOUTS: tuple[str, ...] = ("yyyy-MM", "MMM-yyyy", "MMMM yyyy")

SENTINEL_DATE = "9999-12-31"


def layout_guard(layout: str) -> str:
    """Regex a text must match before ``layout`` is worth trying.

    Built from the pattern letters: year runs of 4+ -> 4+ digits, other
    numeric fields -> 1-2 digits, month / day names -> letters, everything
    else literal.  It accepts a superset of what the parser accepts, so it
    never hides a parseable value; it only skips attempts that would fail
    (a failed ``try_to_date`` costs a caught parse exception per row).
    """
    parts = []
    for ch, run in itertools.groupby(layout):
        n = len(list(run))
        if ch == "y":
            parts.append(r"\d{4,}" if n >= 4 else r"\d{%d}" % n)
        elif ch in "Md" and not (ch == "M" and n >= 3):
            parts.append(r"\d{1,2}")
        elif ch in "ME":
            parts.append("[A-Za-z]+")
        else:
            parts.append(re.escape(ch * n))
    return "^" + "".join(parts) + "$"


_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"


def _runs(layout: str) -> list[tuple[str, int, int]]:
    """(letters, 0-based place, length) of the layout's parts."""
    out, at = [], 0
    for _, run in itertools.groupby(layout):
        run = "".join(run)
        out.append((run, at, len(run)))
        at += len(run)
    return out


def _fixed_width(c: Column, layout: str) -> tuple[Column, Column] | None:
    """(whether a text has the shape, its ISO text) for a layout of four-digit years, two-digit months
    and days, short month names and separators; None for other layouts."""
    fields, shape = {}, F.length(c) == len(layout)
    for run, at, n in _runs(layout):
        if run in ("yyyy", "MM", "dd", "MMM") and run[0] not in fields:
            fields[run[0]] = (run, F.substring(c, at + 1, n))
        elif any(ch.isalnum() or ch == "'" for ch in run):
            return None
        else:
            shape = shape & (F.substring(c, at + 1, n) == run)
    if not {"y", "M"} <= set(fields):
        return None
    kind, month = fields["M"]
    if kind == "MMM":
        place = F.instr(F.lit(_MONTHS), F.lower(month))
        month = F.when(place % 3 == 1, F.lpad(F.floor((place + 2) / 3).cast("string"), 2, "0"))
    day = fields["d"][1] if "d" in fields else F.lit("01")
    return shape, F.concat(fields["y"][1], F.lit("-"), month, F.lit("-"), day)


def _signature(layout: str) -> tuple:
    return len(layout), tuple((run, at) for run, at, _ in _runs(layout) if not run[0].isalpha())


def _attempts(c: Column, layouts: Sequence[str]) -> list[tuple[Column, Column]]:
    """(date, 0-based index of the layout) in turn.

    Layouts of fixed width that follow each other share one cast: their
    separators lie at different places, so a text is valid in one at most.
    Those with the separators of an earlier one begin another attempt.
    """
    out, run, seen = [], [], set()

    def close() -> None:
        if run:
            iso, index = F.when(run[0][0], run[0][1]), F.when(run[0][0], F.lit(run[0][2]))
            for shape, text, i in run[1:]:
                iso, index = iso.when(shape, text), index.when(shape, F.lit(i))
            out.append((iso.try_cast("date"), index))
            run.clear()
            seen.clear()

    for i, layout in enumerate(layouts):
        fixed = _fixed_width(c, layout)
        if fixed is None or _signature(layout) in seen:
            close()
        if fixed is None:
            out.append((F.when(c.rlike(layout_guard(layout)), F.try_to_date(c, layout)), F.lit(i)))
        else:
            run.append((*fixed, i))
            seen.add(_signature(layout))
    close()
    return out


def normalize_date(col: Column | str, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """Text in any of ``layouts`` -> DATE; blanks and junk -> null."""
    return trimmed_date(F.trim(as_col(col)), layouts)


def trimmed_date(text: Column, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """``normalize_date`` of a text without outer blanks."""
    return F.coalesce(*[date for date, _ in _attempts(text, layouts)])


def layout_index(col: Column | str, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """0-based index of the first layout that parses the text (null if none)."""
    return trimmed_layout(F.trim(as_col(col)), layouts)


def trimmed_layout(text: Column, layouts: Sequence[str] = DATE_LAYOUTS) -> Column:
    """``layout_index`` of a text without outer blanks."""
    return F.coalesce(*[F.when(date.isNotNull(), i) for date, i in _attempts(text, layouts)])


def normalize_period(col: Column | str, layouts: Sequence[str] = PERIOD_LAYOUTS) -> Column:
    """Period text -> first day of that month (DATE)."""
    return F.trunc(normalize_date(col, layouts), "month")


def period_label(col: Column | str, layouts: Sequence[str] = PERIOD_LAYOUTS) -> Column:
    """Period text -> canonical ``yyyy-MM`` label."""
    return F.date_format(normalize_period(col, layouts), "yyyy-MM")


def sentinel_date(col: Column | str, sentinel: str = SENTINEL_DATE) -> Column:
    """Null date -> sentinel date (open items stay joinable and filterable)."""
    return F.coalesce(as_col(col), F.lit(sentinel).cast("date"))


def lag_days(decided: Column | str, submitted: Column | str,
             sentinel: str = SENTINEL_DATE) -> Column:
    """Days from submission to decision; null while the decision is the sentinel."""
    d = as_col(decided)
    return F.when(d < F.lit(sentinel).cast("date"), F.datediff(d, as_col(submitted)))
