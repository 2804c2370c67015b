"""Small dictionaries as plan literals.

A token set becomes an ``IN`` list, which Catalyst turns into a hash-set probe. A mapping becomes one
two-level map literal (first character -> key -> value), because looking a key up in a Spark map scans
its entries: two short scans replace a long one. Both stay row-local, so they need no shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping


def quoted(text: str) -> str:
    """``text`` as a Spark SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def in_set(item: str, members: Iterable[str]) -> str:
    """SQL predicate: the expression ``item`` is one of ``members``."""
    listed = ", ".join(quoted(m) for m in sorted(set(members)))
    return f"({item} IN ({listed}))" if listed else "false"


def map_literal(mapping: Mapping[str, str]) -> str:
    nested: dict[str, dict[str, str]] = {}
    for key in sorted(mapping):
        nested.setdefault(key[:1], {})[key] = mapping[key]
    text = json.dumps(nested, ensure_ascii=False)
    return f"from_json({quoted(text)}, 'map<string,map<string,string>>')"


def map_value(item: str, mapping: Mapping[str, str]) -> str:
    """SQL expression: the value stored for ``item``, null when there is none."""
    return f"try_element_at(try_element_at({map_literal(mapping)}, substr({item}, 1, 1)), {item})"
