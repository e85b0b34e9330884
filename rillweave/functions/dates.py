"""Dates in many layouts, without exceptions and without session time zone."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from rillweave.config import DateRule
from rillweave.functions.text import quote

_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"

MICROS_PER_DAY = 86_400_000_000
# Range of a 64-bit nanosecond timestamp; dates outside it are unreadable, not flagged.
EARLIEST, LATEST = "1677-09-22", "2262-04-11"


def timestamp(text: date | str) -> str:
    return f"timestamp_ntz'{text}'"


def layout_number(s: str, rules: Sequence[DateRule]) -> str:
    """Position (from 1) of the first layout that fits the stripped text."""
    cases = (f"WHEN {s} RLIKE {quote(r.shape)} THEN {i}" for i, r in enumerate(rules, 1))
    return f"CASE {' '.join(cases)} END"


def iso_order(s: str, number: str, rules: Sequence[DateRule]) -> str:
    """The text brought into year-month-day order, given the number of its layout."""
    plain = ", ".join(str(i) for i, r in enumerate(rules, 1) if not r.iso)
    shapes = ", ".join(quote(r.shape) for r in rules)
    orders = ", ".join(quote(r.iso or "$0") for r in rules)
    reordered = f"regexp_replace({s}, array({shapes})[{number} - 1], array({orders})[{number} - 1])"
    return f"CASE WHEN {number} IN ({plain}) THEN {s} WHEN {number} IS NOT NULL THEN {reordered} END"


def from_iso_order(x: str) -> str:
    """Timestamp without zone, time of day kept; no such date gives null."""
    part = [f"split_part({x}, '-', {i})" for i in (1, 2, 3)]
    number = f"cast((instr('{_MONTHS}', lower(left({part[1]}, 3))) + 2) div 3 AS string)"
    numbered = f"CASE WHEN {x} RLIKE '^[0-9]+-[A-Za-z]' THEN concat({part[0]}, '-', {number}, '-', {part[2]}) ELSE {x} END"
    return f"try_cast({numbered} AS timestamp_ntz)"


def readable(x: str) -> str:
    """Null for dates outside the representable range."""
    return f"CASE WHEN {x} BETWEEN {timestamp(EARLIEST)} AND {timestamp(LATEST)} THEN {x} END"


def out_of_range_flag(x: str, name: str, earliest: str, as_of: date | str) -> str:
    return f"""CASE
        WHEN {x} < {timestamp(earliest)} THEN {quote(f'{name} before {earliest}')}
        WHEN {x} > {timestamp(as_of)} THEN {quote(f'{name} after {as_of}')} END"""


def epoch_micros(x: str) -> str:
    """Microseconds since 1970 of a zone-less timestamp, independent of the session zone."""
    return f"""(cast(date_diff(cast({x} AS date), date'1970-01-01') AS bigint) * {MICROS_PER_DAY}
        + cast(hour({x}) AS bigint) * 3600000000 + cast(minute({x}) AS bigint) * 60000000
        + cast(extract(SECOND FROM {x}) * 1000000 AS bigint))"""
