"""Small column-expression helpers shared by every operator.

All helpers return ``Column`` objects built from ``pyspark.sql.functions``,
so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def label_case(c: str | Column, table: Sequence[tuple[Any, Sequence[str] | None]]) -> Column:
    """First-match CASE over a (label, codes) table; ``None`` codes = ELSE."""
    c = col_of(c)
    expr = None
    default = None
    for label, codes in table:
        if codes is None:
            default = F.lit(label)
            continue
        cond = c == codes[0] if len(codes) == 1 else c.isin(*codes)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return default if default is not None else F.lit(None)
    return expr.otherwise(default) if default is not None else expr


def lookup(c: str | Column, mapping: dict[str, float], default: float) -> Column:
    """Value of ``mapping[c]`` as a CASE expression, ``default`` when absent."""
    c = col_of(c)
    expr = None
    for key, value in mapping.items():
        expr = F.when(c == key, F.lit(value)) if expr is None else expr.when(c == key, F.lit(value))
    return expr.otherwise(F.lit(default))


def round_half_up(c: str | Column, digits: int) -> Column:
    """Round a double half-up on its decimal value and return a double.

    Going through DECIMAL(30,10) makes the result independent of the binary
    representation of the input (so 1.005 rounds to 1.01 in every engine).
    """
    return F.round(col_of(c).cast("decimal(30,10)"), digits).cast("double")


def pct(numerator: str | Column, denominator: str | Column) -> Column:
    """``numerator * 100 / denominator`` as double; NULL when the denominator is 0."""
    return F.try_divide(col_of(numerator).cast("double") * F.lit(100), col_of(denominator))


def flag(cond: Column) -> Column:
    """1 if the condition holds, else 0 (NULL condition -> 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` holds (bigint; 0 on empty input, NULL conditions
    not counted).  A plain COUNT, so it aggregates partially map-side."""
    return F.count(F.when(cond, F.lit(1)))
