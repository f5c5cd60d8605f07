"""Small helpers to write the statements: named sub-queries, exact percentages, typed columns."""

from __future__ import annotations

import re


def with_parts(parts: dict[str, str], final: str) -> str:
    """Put the named sub-queries a statement mentions, directly or not, in front of it."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in parts:
            if name not in order and re.search(rf"\b{name}\b", text):
                visit(parts[name])
                order.append(name)

    visit(final)
    head = ",\n".join(f"{name} AS ({parts[name].strip()})" for name in order)
    return f"WITH {head}\n{final.strip()}" if head else final.strip()


def pick(source: str, columns: str, where: str = "") -> str:
    """Select columns; ``:d`` casts to DOUBLE, ``:i`` to BIGINT, ``a=b`` renames b to a."""
    out = []
    for item in columns.split():
        name, _, kind = item.partition(":")
        alias, _, column = name.partition("=")
        column = column or alias
        sql = {"d": f"CAST({column} AS DOUBLE)", "i": f"CAST({column} AS BIGINT)"}.get(kind, column)
        out.append(f"{sql} AS {alias}")
    return f"SELECT {', '.join(out)} FROM {source}" + (f" WHERE {where}" if where else "")


def usd(amount: str, currency: str = "currency") -> str:
    return f"({amount}) * coalesce(MAP {{'GBP': 1.27, 'EUR': 1.08}}[{currency}], 1.0)"


def gbp(amount: str, currency: str = "currency") -> str:
    return f"({amount}) * coalesce(MAP {{'GBP': 1.27}}[{currency}], 1.0)"


def ratio(num: str, den: str, digits: int = 2) -> str:
    """Exact percentage of integers, half rounded up; NULL for a zero denominator."""
    scale = 10 ** (digits + 2)
    return (
        f"CASE WHEN ({den}) <> 0 THEN CAST((2 * CAST({num} AS HUGEINT) * {scale} + ({den})) // (2 * CAST({den} AS HUGEINT)) "
        f"AS DOUBLE) / {10 ** digits} END"
    )


def _units(money: str) -> str:
    """Money with four decimals as a whole number of its smallest unit."""
    return f"CAST(replace(CAST(CAST({money} AS DECIMAL(30,4)) AS VARCHAR), '.', '') AS HUGEINT)"


def money_ratio(num: str, den: str, digits: int = 2) -> str:
    """Exact percentage of two money amounts, half rounded away from zero."""
    scale = 10 ** (digits + 2)
    n, d = _units(num), _units(den)
    return (
        f"CASE WHEN ({den}) <> 0 THEN sign({n}) * CAST((2 * abs({n}) * {scale} + {d}) // (2 * {d}) AS DOUBLE) / {10 ** digits} END"
    )
