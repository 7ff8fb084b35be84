"""SQL-text twins of :mod:`shelflife.functions.money` for the DuckDB oracle.

DuckDB turns ``/`` into DOUBLE and ``avg`` of decimals into DOUBLE, so the
oracle rounds on HUGEINT unscaled values with ``//``.
"""

from __future__ import annotations

from decimal import Decimal


def _unscaled(e: str, scale: int) -> str:
    return f"CAST(({e}) * {10 ** scale} AS HUGEINT)" if scale else f"CAST(({e}) AS HUGEINT)"


def ratio(num: str, den: str, *, num_scale: int, den_scale: int, scale: int = 2,
          factor: int = 1, out: str = "DECIMAL(10,2)") -> str:
    n, d = _unscaled(num, num_scale), _unscaled(den, den_scale)
    exp = den_scale - num_scale + scale
    a = f"({n} * CAST({factor * 10 ** exp} AS HUGEINT))" if exp >= 0 else f"({n} * {factor})"
    b = d if exp >= 0 else f"({d} * CAST({10 ** (-exp)} AS HUGEINT))"
    q = f"((2 * abs({a}) + abs({b})) // (2 * abs({b})))"
    signed = f"(CASE WHEN ({a} < 0) <> ({b} < 0) THEN -{q} ELSE {q} END)"
    val = f"CAST({signed} AS DECIMAL(30,0))"
    if scale:
        val += f" * CAST({Decimal(1).scaleb(-scale)} AS DECIMAL({scale},{scale}))"
    return f"CAST(CASE WHEN {b} = 0 THEN NULL ELSE {val} END AS {out})"


def avg(col: str, in_scale: int, scale: int = 2, out: str = "DECIMAL(10,2)") -> str:
    return ratio(f"sum({col})", f"count({col})", num_scale=in_scale, den_scale=0,
                 scale=scale, out=out)


def pct(num: str, den: str, *, num_scale: int, den_scale: int) -> str:
    return ratio(num, den, num_scale=num_scale, den_scale=den_scale, scale=2, factor=100)
