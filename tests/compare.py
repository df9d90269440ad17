"""Order-free comparison of a Spark result with a DuckDB one."""

from __future__ import annotations

import math


def cell(x) -> str:
    if x is None or isinstance(x, float) and math.isnan(x):
        return "null"
    return repr(float(x)) if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def rows_of(columns: list[str], rows) -> list[tuple[str, ...]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def assert_same(df, con, sql: str) -> None:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    want = rows_of(names, got.fetchall())
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == want
