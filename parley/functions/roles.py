"""Speaker names to chat roles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from parley.constants import ROLE_ALIASES, ROLE_KEYWORDS, USER
from parley.functions.text import let, normalize_text

Keywords = Sequence[tuple[str, Sequence[str]]]


def _looked_up(name: Column, lower: Column, aliases: Mapping[str, str]) -> list[Column]:
    """The forms of a name to look up; as written only if an alias is, as others are found lower-cased."""
    return [lower] if all(a == a.lower() for a in aliases) else [lower, name]


def is_alias(name: Column, aliases: Mapping[str, str] = ROLE_ALIASES) -> Column:
    """True if the (normalised) name is listed in the alias table."""
    return reduce(Column.__or__, (f.isin(*aliases) for f in _looked_up(name, F.lower(name), aliases)))


def role_of(
    name: Column,
    aliases: Mapping[str, str] = ROLE_ALIASES,
    keywords: Keywords = ROLE_KEYWORDS,
) -> Column:
    """Role of an already normalised name: alias table, then keywords, then user.

    The name is lower-cased once, and rules at the end that lead to the default are left out.
    """
    by_role: dict[str, list[str]] = {}
    for alias, role in aliases.items():
        by_role.setdefault(role, []).append(alias)

    def decide(lower: Column) -> Column:
        forms = _looked_up(name, lower, aliases)
        rules = [(form.isin(*names), role) for form in forms for role, names in by_role.items()]
        rules += [(F.contains(name, F.lit(word)), role) for role, words in keywords for word in words]
        while rules and rules[-1][1] == USER:
            rules.pop()
        role = F.lit(USER)
        for test, value in reversed(rules):
            role = F.when(test, F.lit(value)).otherwise(role)
        return role

    return let(F.lower(name), decide)


def normalize_role(
    col: Column,
    aliases: Mapping[str, str] = ROLE_ALIASES,
    keywords: Keywords = ROLE_KEYWORDS,
) -> Column:
    """Role of a raw speaker name; null and unknown names are users."""
    return let(normalize_text(col), lambda name: role_of(name, aliases, keywords))
