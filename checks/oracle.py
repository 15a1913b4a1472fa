"""Assembles oracle SQL: WITH the CTEs a query needs, in dependency order."""

from __future__ import annotations

import re

from checks.facts_sql import FACTS
from checks.marts_sql import MARTS

CTES = {**FACTS, **MARTS}


def _needs(sql: str) -> list[str]:
    words = set(re.findall(r"[a-z_][a-z_0-9]*", sql))
    return [name for name in CTES if name in words]


def with_ctes(sql: str) -> str:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for dep in _needs(CTES[name]):
            if dep != name and dep not in ordered:
                visit(dep)
        if name not in ordered:
            ordered.append(name)

    for name in _needs(sql):
        visit(name)
    if not ordered:
        return sql
    own = sql.lstrip()
    if own.startswith("WITH "):
        ordered_sql = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in ordered)
        return "WITH " + ordered_sql + ",\n" + own[len("WITH "):]
    parts = [f"{name} AS MATERIALIZED ({CTES[name]})" for name in ordered]
    return "WITH " + ",\n".join(parts) + "\n" + sql
