"""Column expressions on plain text. Null is null inside the engine; '' only where noted."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of value, with value worked out once however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space at either end, white space as Unicode has it."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def clean(c: Column) -> Column:
    """White space collapsed to single spaces and stripped; '' for null."""
    return F.coalesce(F.trim(F.regexp_replace(c, r"(?U)\s+", " ")), F.lit(""))


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def words(c: Column) -> Column:
    """Non-empty pieces between white space."""
    return F.filter(F.split(c, r"(?U)\s+"), lambda x: x != "")


def any_of(c: Column, keys: Sequence[str]) -> Column:
    """Whether c contains one of the keys."""
    return reduce(Column.__or__, [F.contains(c, F.lit(k)) for k in keys])


def ends_with_any(c: Column, ends: Sequence[str]) -> Column:
    return reduce(Column.__or__, [F.endswith(c, F.lit(k)) for k in ends])


def strings(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values])


def first_hit(cases: Sequence[tuple[Column, Column]], otherwise: Column) -> Column:
    """An ordered CASE: the first condition that holds decides."""
    condition, value = cases[0]
    out = F.when(condition, value)
    for condition, value in cases[1:]:
        out = out.when(condition, value)
    return out.otherwise(otherwise)


def any_of_sql(c: str, keys: Sequence[str]) -> str:
    """any_of for SQL text."""
    return "(" + " OR ".join(f"contains({c}, '{k.replace(chr(39), chr(39) * 2)}')" for k in keys) + ")"


def first_hit_sql(cases: Sequence[tuple[str, str]], otherwise: str) -> str:
    return "CASE " + " ".join(f"WHEN {a} THEN {b}" for a, b in cases) + f" ELSE {otherwise} END"
