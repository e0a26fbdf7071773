"""Column-name rules, resolved once on the driver against a schema.

Field lookup ignores case and surrounding spaces; ignore lists are exact-case.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence


def norm(name: str) -> str:
    return name.strip().lower()


def name_in(name: str, names: Iterable[str] | None) -> bool:
    """Trimmed, case-insensitive membership test."""
    key = norm(name)
    return any(norm(n) == key for n in (names or ()))


def resolve(name: str, available: Sequence[str], on_duplicate: str = "first") -> str | None:
    """The field of ``available`` that ``name`` refers to, ignoring case.

    ``on_duplicate`` picks among fields differing only by case: ``first`` (typed
    records) or ``last`` (map records, where a later key overwrites).
    """
    hits = [a for a in available if norm(a) == norm(name)]
    if not hits:
        return None
    return hits[0] if on_duplicate == "first" else hits[-1]


def distinct(names: Iterable[str]) -> list[str]:
    """Order-preserving de-duplication."""
    return list(dict.fromkeys(names))


def remove_exact(names: Iterable[str], ignore: Iterable[str] | None) -> list[str]:
    """Drop names found in ``ignore``, comparing exactly (case-sensitive)."""
    drop = set(ignore or ())
    return [n for n in names if n not in drop]
