"""Column expressions of the customer-confirmation job (phone, notes, message text)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.constants import (
    CONFIRM_COUNTRY_CODE,
    CONFIRM_MAX_LOCAL_DIGITS,
    CONFIRM_NOTE_BULLET,
)
from ledgerlens.functions._util import as_col

# Code points above the Basic Multilingual Plane, and C0 controls other than
# tab (9), line feed (10) and carriage return (13).
_UNSENDABLE = r"[\x{10000}-\x{10FFFF}\x{0}-\x{8}\x{B}\x{C}\x{E}-\x{1F}]"

# White space at either end: Unicode's, and the four separators U+001C to U+001F.
_ENDS = r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$"


def strip_text(c) -> Column:
    """Leading and trailing white space removed, Unicode's included."""
    return F.regexp_replace(as_col(c), _ENDS, "")


def confirm_phone(c) -> Column:
    """Keep ASCII digits; no digits -> NULL; add the country code 55 unless the number
    already starts with 55 or has more than 11 digits."""
    digits = F.regexp_replace(F.coalesce(as_col(c).cast("string"), F.lit("")), "[^0-9]", "")
    return (
        F.when(digits == "", F.lit(None).cast("string"))
        .when(digits.startswith(CONFIRM_COUNTRY_CODE), digits)
        .when(F.length(digits) <= CONFIRM_MAX_LOCAL_DIGITS, F.concat(F.lit(CONFIRM_COUNTRY_CODE), digits))
        .otherwise(digits)
    )


def confirm_notes(c) -> Column:
    """Comma-separated notes -> stripped, non-empty ``array<string>``; NULL -> empty array."""
    parts = F.transform(F.split(F.coalesce(as_col(c), F.lit("")), ","), strip_text)
    return F.filter(parts, lambda x: x != "")


def confirm_notes_text(notes) -> Column:
    """Array of notes re-joined with ``,``."""
    return F.array_join(as_col(notes), ",")


def confirm_note_lines(notes) -> Column:
    """One bullet line per note, newline-joined."""
    return F.array_join(F.transform(as_col(notes), lambda n: F.concat(F.lit(CONFIRM_NOTE_BULLET), n)), "\n")


def confirm_message(name, notes, *, company: str, template: str) -> Column:
    """Fill ``template`` placeholders ``{nome_cliente}``, ``{empresa}`` and ``{notas}``.

    ``notes`` is an ``array<string>`` column (see :func:`confirm_notes`).
    """
    msg = F.lit(template)
    msg = F.replace(msg, F.lit("{empresa}"), F.lit(company))
    msg = F.replace(msg, F.lit("{notas}"), confirm_note_lines(notes))
    return F.replace(msg, F.lit("{nome_cliente}"), F.coalesce(as_col(name).cast("string"), F.lit("")))


def confirm_sanitize(c) -> Column:
    """Drop code points above U+FFFF and control characters except tab, LF and CR; NULL -> ''."""
    return F.regexp_replace(F.coalesce(as_col(c), F.lit("")), _UNSENDABLE, "")


def confirm_removed_count(c) -> Column:
    """How many characters :func:`confirm_sanitize` removes (lengths count code points)."""
    raw = F.coalesce(as_col(c), F.lit(""))
    return F.length(raw) - F.length(confirm_sanitize(raw))
