"""Number functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from sparkloom.functions.text import as_col


def cents(col: str | Column) -> Column:
    """Money as whole cents: sums of longs are exact in any order and stay in fast codegen."""
    return F.round(as_col(col) * 100).cast("long")


def from_cents(col: str | Column) -> Column:
    return as_col(col) / F.lit(100.0)


def round_half_up(col: str | Column, digits: int = 2) -> Column:
    return F.round(as_col(col), digits)


def is_even(col: str | Column) -> Column:
    return as_col(col) % 2 == 0


def money_product(count: str | Column, price: str | Column) -> Column:
    """count x price as exact decimals."""
    return as_col(count).cast("decimal(10,0)") * as_col(price).cast("decimal(18,2)")


def to_number(col: str | Column, kind: str = "long", strict: bool = True) -> Column:
    """Text to number; bad text is an error, or missing when not ``strict``."""
    return as_col(col).cast(kind) if strict else as_col(col).try_cast(kind)


def larger(a: str | Column, b: str | Column) -> Column:
    return F.greatest(as_col(a), as_col(b))


def pick(values: list, seed: Column) -> Column:
    """An element of a fixed list chosen by a hash: repeatable, unlike a random draw."""
    options = F.array(*[F.lit(v) for v in values])
    return F.element_at(options, (F.pmod(F.xxhash64(seed), F.lit(len(values))) + 1).cast("int"))
