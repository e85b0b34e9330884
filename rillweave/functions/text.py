"""Text expressions."""

from __future__ import annotations

from collections.abc import Iterable


def quote(s: str) -> str:
    """A SQL string literal."""
    escaped = "".join(
        f"\\u{ord(c):04x}" if not c.isprintable() and ord(c) < 0x10000 else c
        for c in s.replace("\\", "\\\\").replace("'", "\\'")
    )
    return f"'{escaped}'"


# Everything str.strip() removes, which is more than the blank that trim() knows.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
WHITESPACE_CLASS = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"

# Ranges without combining marks or decomposable characters: text made of these only
# is in NFC already. tests/test_functions.py proves the ranges against unicodedata.
NFC_SAFE_RANGES = ((0x0, 0x2FF), (0x400, 0x482), (0x48A, 0x52F), (0x4E00, 0x9FFF))
_NFC_UNSAFE = "[^" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in NFC_SAFE_RANGES) + "]"

_UNCASED = r"([^\p{IsLowercase}\p{IsUppercase}\p{Lt}])"

# A noncharacter which stands in for a real blank while initcap() works on inserted ones.
_HELD_BLANK = "﷐"


def strip(x: str) -> str:
    return f"btrim({x}, {quote(WHITESPACE)})"


def is_blank(x: str) -> str:
    return f"{strip(x)} = ''"


def nfc(x: str) -> str:
    """Unicode NFC. Only text outside the safe ranges reaches the (bundled ICU) normalizer."""
    composed = f"java_method('com.ibm.icu.text.Normalizer', 'compose', {x}, false)"
    return f"CASE WHEN {x} RLIKE {quote(_NFC_UNSAFE)} THEN {composed} ELSE {x} END"


def _hold_blanks(x: str) -> str:
    return f"translate({x}, ' ', {quote(_HELD_BLANK)})"


def _release_blanks(x: str) -> str:
    """Drop the inserted blanks, then bring the held ones back."""
    return f"translate({x}, {quote(_HELD_BLANK + ' ')}, ' ')"


def name_case(x: str) -> str:
    """Capitalise every part between hyphens and apostrophes: van-der-berg, o'brien, mary ann.

    A blank does not start a new part ("Mary ann").
    """
    parts = f"replace(replace({_hold_blanks(x)}, '-', '- '), {quote(chr(39))}, {quote(chr(39) + ' ')})"
    return _release_blanks(f"initcap({parts})")


def title_case(x: str) -> str:
    """Upper-case each letter that follows a non-letter, lower-case the others: Full-Time, 3Rd."""
    parts = f"regexp_replace({_hold_blanks(x)}, {quote(_UNCASED)}, '$1 ')"
    return _release_blanks(f"initcap({parts})")


def clean_name(x: str) -> str:
    return name_case(strip(nfc(x)))


def full_name(first: str, last: str) -> str:
    return strip(f"concat(coalesce({first}, ''), ' ', coalesce({last}, ''))")


def one_of(x: str, values: Iterable[str]) -> str:
    return f"{x} IN ({', '.join(quote(v) for v in values)})"


def nullify(x: str, sentinels: Iterable[str]) -> str:
    return f"CASE WHEN NOT {one_of(x, sentinels)} THEN {x} END"
