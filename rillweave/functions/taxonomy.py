"""Dictionary lookups for small, configured vocabularies."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from rillweave.functions.text import quote, strip


def _literal(value: str | int | float) -> str:
    if isinstance(value, str):
        return quote(value)
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def map_lookup(x: str, mapping: Mapping[str, str | int | float]) -> str:
    """Value of ``x`` in ``mapping``, null when absent (the map is folded to a literal)."""
    entries = ", ".join(_literal(v) for item in mapping.items() for v in item)
    return f"try_element_at(map({entries}), {x})"


def category(raw: str, titled: str, mapping: Mapping[str, str]) -> str:
    """Stripped text by exact spelling, else by its title-cased form, else that form itself;
    blank gives null."""
    known = f"coalesce({map_lookup(raw, mapping)}, {map_lookup(titled, mapping)}, {titled})"
    return f"CASE WHEN {raw} <> '' THEN {known} END"


def known_department(raw: str, exact: Mapping[str, str], standards: Iterable[str]) -> str:
    """Standard name for a code, an alias or any capitalisation of a standard name."""
    folded = {name.lower(): name for name in standards}
    return f"coalesce({map_lookup(raw, exact)}, {map_lookup(f'lower({raw})', folded)})"


def source_priority(x: str, priority: Mapping[str, int], unknown: int) -> str:
    """Smallest priority among comma-separated source names."""

    def rank(name: str) -> str:
        return f"coalesce({map_lookup(strip(name), priority)}, {unknown})"

    several = f"array_min(transform(split({x}, ','), s -> {rank('s')}))"
    return f"CASE WHEN contains({x}, ',') THEN {several} ELSE {rank(x)} END"
