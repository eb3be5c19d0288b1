"""Assemble a complete DuckDB statement for one registered query.

Every stage is a named common table expression; ``statement`` pulls in the
stages a query depends on, in dependency order, ahead of its final SELECT.
"""

from __future__ import annotations

from partsflow.oracle import sql as S

_SILVER_SRC = {name: src for name, (src, _) in S.SILVER_SQL.items()}


def _stage_sql(name: str) -> tuple[str, list[str]]:
    """SQL text and direct dependencies of a stage."""
    if name.startswith("feed_"):
        return S.FEED_SQL[name[len("feed_"):]](), []
    if name.startswith("typed_"):
        folder = name[len("typed_"):]
        return S.typed_sql(folder), [f"feed_{folder}"]
    if name in S.SILVER_SQL:
        src, body = S.SILVER_SQL[name]
        return body, [f"typed_{src}"]
    if name in S.DIM_SQL:
        src, body = S.DIM_SQL[name]
        return body, [src]
    if name in S.FACT_SQL:
        deps, body = S.FACT_SQL[name]
        return body, list(deps)
    raise KeyError(name)


def _closure(needs: list[str]) -> list[str]:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _stage_sql(n)[1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    return order


def statement(final_sql: str, needs: list[str]) -> str:
    ctes = ",\n".join(f"{n} AS (\n{_stage_sql(n)[0].strip()}\n)" for n in _closure(needs))
    return f"WITH {ctes}\n{final_sql.strip()}"


def stage(name: str) -> str:
    """Statement returning a whole stage table."""
    return statement(f"SELECT * FROM {name}", [name])
