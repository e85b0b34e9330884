"""Namespaced identifiers."""

from __future__ import annotations

from collections.abc import Mapping

from rillweave.config import API, EMPLOYEE_ID_PATTERN, PAYROLL
from rillweave.functions.taxonomy import map_lookup
from rillweave.functions.text import quote

_INTEGER = quote(r"^[+-]?[0-9]+$")
_ACQUIRED = "(startswith(upper({0}), 'ACQ_'))"


def zero_padded(x: str, width: int = 6) -> str:
    """An integer text at a fixed width; longer numbers keep all digits, any length works."""
    digits = f"trim(LEADING '0' FROM trim(LEADING '+-' FROM {x}))"
    minus = f"CASE WHEN startswith({x}, '-') AND {digits} <> '' THEN '-' ELSE '' END"
    return f"concat({minus}, lpad({digits}, greatest({width} - length({minus}), length({digits})), '0'))"


def id_number(s: str) -> str:
    """The part of a stripped id that should be its number."""
    return f"CASE WHEN {_ACQUIRED.format(s)} THEN substr({s}, 5) ELSE {s} END"


def id_prefix(s: str, source: str, company_hint: str, namespaces: Mapping[str, str]) -> str:
    """Company of a stripped id. An ``ACQ_`` id is the acquired company's, whatever its source."""
    return f"""CASE WHEN {_ACQUIRED.format(s)} OR {source} = {quote(API)} THEN 'AC'
        WHEN {source} = {quote(PAYROLL)} THEN
            CASE WHEN contains(lower(coalesce({company_hint}, '')), 'acquired') THEN 'AC' ELSE 'GT' END
        ELSE coalesce({map_lookup(source, namespaces)}, 'GT') END"""


def namespaced(s: str, prefix: str, number: str) -> str:
    """Prefix and number, six digits wide. An id already in that form is kept, and so is text
    without a number."""
    return f"""CASE
        WHEN {number} RLIKE {_INTEGER} THEN concat({prefix}, '-', {zero_padded(number)})
        WHEN {s} RLIKE {quote(EMPLOYEE_ID_PATTERN)} THEN {s}
        WHEN {_ACQUIRED.format(s)} THEN concat('AC-', CASE {number} WHEN '' THEN '000000' ELSE {number} END)
        ELSE {s} END"""
