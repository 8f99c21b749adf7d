"""Draws that depend only on the data, so a retried task repeats them exactly."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

WORDS = 4  # 32-bit words in a digest


def digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws(":", *[part.cast("string") for part in parts]))


def leading(hex_digest: Column, digits: int) -> Column:
    """The first hexadecimal digits of a digest as a whole number; 15 at most fit."""
    return F.conv(F.substring(hex_digest, 1, digits), 16, 10).cast("bigint")


def uniform(hex_digits: Column, word: Column) -> Column:
    """The 32-bit word at a 0-based place of a hexadecimal text as a number strictly between 0 and 1."""
    bits = F.conv(F.substring(hex_digits, word * 8 + 1, F.lit(8)), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(2**32))


def deal(number: Column, sizes: Sequence[int]) -> list[Column]:
    """Several independent draws from one large number: whole numbers in [0, size) for each size."""
    rest, drawn = number, []
    for size in sizes:
        drawn.append(rest % size)
        rest = F.call_function("div", rest, F.lit(size))
    return drawn
