"""Registry of demo queries and of the DuckDB text that must give the same rows."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cohortloom import fixtures
from cohortloom.session import configure

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: extra named SQL blocks an oracle may use; value is (text, names it needs)
BLOCKS: dict[str, tuple[str, tuple[str, ...]]] = {}


def block(name: str, text: str, needs: tuple[str, ...] = ()) -> None:
    BLOCKS[name] = (text, needs)


def _collect(name: str, out: list[str]) -> None:
    if name in out:
        return
    for need in BLOCKS[name][1] if name in BLOCKS else ():
        _collect(need, out)
    out.append(name)


def with_blocks(sql: str, needs: tuple[str, ...]) -> str:
    names: list[str] = []
    for need in needs:
        _collect(need, names)
    parts = [
        fixtures.duckdb_cte(n) if n in fixtures.VIEWS else f"{n} AS ({BLOCKS[n][0]})" for n in names
    ]
    sql = sql.strip()
    if not parts:
        return sql
    if sql[:5].upper() == "WITH ":
        return "WITH " + ", ".join(parts) + ", " + sql[5:]
    return "WITH " + ", ".join(parts) + " " + sql


def query(name: str, oracle: str | None = None, needs: tuple[str, ...] = ()):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(configure(spark), sf_dir)
        if oracle is not None:
            ORACLES[name] = with_blocks(oracle, needs)
        return fn

    return register


def r(expr: str, digits: int = 6) -> str:
    """DuckDB text of functions.numeric.round_half_up."""
    unit = f"{float(10 ** digits):.1f}"
    return f"(floor(({expr}) * {unit} + 0.5001) / {unit})"


def q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'
