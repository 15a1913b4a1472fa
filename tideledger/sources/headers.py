"""Header handling: synonyms and choice of the fact table a file belongs to.

Works on column names only, never on data.
"""

from __future__ import annotations

from tideledger import config


def alias_map(table: str) -> dict[str, str]:
    """Lower-case synonym to canonical name; the table's own synonyms win over shared ones."""
    names: dict[str, str] = {}
    for group in ("common", table):
        for canonical, variants in config.ALIASES.get(group, {}).items():
            names.update({v.lower().strip(): canonical for v in variants})
    return names


def canonical_names(columns: list[str], table: str) -> list[str]:
    names = alias_map(table)
    return [names.get(c.lower().strip(), c) for c in columns]


def detect_table(columns: list[str]) -> str:
    """The fact whose required columns the header covers best.

    A tie for the best, or less than half of the required columns, is an error.
    """
    scores = {}
    for table, contract in config.CONTRACTS.items():
        names = alias_map(table)
        found = {names.get(c.lower().strip(), c.lower().strip()) for c in columns}
        scores[table] = len(found & set(contract.required)) / len(contract.required)
    best = max(scores.values())
    tables = sorted(t for t, s in scores.items() if s == best)
    if len(tables) > 1:
        raise ValueError(f"Header fits {tables} equally well ({best:.2f})")
    if best < 0.5:
        raise ValueError(f"No table fits the header; best is {tables[0]} with {best:.2f}")
    return tables[0]
