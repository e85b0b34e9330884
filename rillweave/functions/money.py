"""Amounts, currencies and pay periods."""

from __future__ import annotations

from collections.abc import Mapping

from rillweave.functions.taxonomy import map_lookup
from rillweave.functions.text import WHITESPACE_CLASS, quote, strip

_SYMBOLS = rf"[£€$,]|{WHITESPACE_CLASS}"
_NUMBER = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf(?:inity)?)$"
# From here on a double no longer resolves a hundredth.
_CENTS_LIMIT = "9.0e13D"


def to_double(x: str) -> str:
    """Number written as text; "nan", suffixes such as 1.0d and other text give null."""
    return f"CASE WHEN {x} RLIKE {quote(_NUMBER)} THEN try_cast({x} AS double) END"


def without_symbols(x: str) -> str:
    """Text without currency symbols, separators and blanks."""
    return f"regexp_replace({x}, {quote(_SYMBOLS)}, '')"


def positive(x: str) -> str:
    return f"CASE WHEN {x} > 0 THEN {x} END"


def round_cents(x: str) -> str:
    """Round to the cent by the exact binary value, as IEEE doubles are rounded elsewhere.

    Splitting off the whole part keeps the scaled fraction exact, so 107950.635 (which is
    stored just below the tie) becomes .63 and not .64.
    """
    exact = f"(cast(floor({x}) AS double) * 100 + rint(({x} - floor({x})) * 100)) / 100"
    return f"CASE WHEN abs({x}) < {_CENTS_LIMIT} THEN {exact} ELSE {x} END"


def annual_usd(
    amount: str, currency: str, frequency: str, fx: Mapping[str, float], periods: Mapping[str, int]
) -> str:
    """Amount × exchange rate × periods, not rounded; an unknown currency or period counts as 1."""
    rate = f"coalesce({map_lookup(f'upper({strip(currency)})', fx)}, 1.0D)"
    times = f"coalesce({map_lookup(strip(frequency), periods)}, 1)"
    return f"{amount} * {rate} * cast({times} AS double)"
