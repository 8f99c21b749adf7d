"""Delimited text: a fixed list of positions and types, everything else on the line is ignored."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.functions.numbers import parse_float, parse_int
from kerbside.operators.cleaning import drop_invalid
from kerbside.operators.staging import compute_once

PARSERS = {"str": lambda text: text, "int": parse_int, "float": parse_float}
BLANKS = " \t\n\x0b\f\r"


@dataclass(frozen=True)
class LineFormat:
    """``fields`` maps a column name to its 0-based position and its type (str, int or float)."""

    delimiter: str
    fields: Mapping[str, tuple[int, str]]


# The two input formats.
TRIP_LINES = LineFormat(
    ",",
    {"datetime": (1, "str"), "passengers": (3, "int"), "longitude": (5, "float"), "latitude": (6, "float")},
)
POSITION_LINES = LineFormat(
    "\t",
    {"latitude": (0, "float"), "longitude": (1, "float"), "datetime": (2, "str"), "vehicle_id": (3, "str")},
)


def read_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Text files, by path or glob, as one row per line in column ``value``."""
    return spark.read.text(paths)


def parse_delimited(lines: DataFrame, line_format: LineFormat, strip: bool = False) -> DataFrame:
    """Lines to typed columns. A line on which any field is missing or unreadable is dropped, and
    with it every header. ``strip`` removes white space around the line first."""
    value = F.btrim(F.col("value"), F.lit(BLANKS)) if strip else F.col("value")
    needed = max(at for at, _ in line_format.fields.values()) + 1
    # One part more than needed: the unused end of a line is not taken apart.
    parts = F.split(value, _literal(line_format.delimiter), needed + 1)
    split = compute_once(lines.select("value"), {"parts": parts}).select("parts")
    typed = {name: PARSERS[kind](F.get("parts", at)) for name, (at, kind) in line_format.fields.items()}
    return drop_invalid(compute_once(split, typed).select(*typed), *typed)


def _literal(delimiter: str) -> str:
    return "".join("\\" + char if char in r"\.[]{}()*+-?^$|/" else char for char in delimiter)


def trips_from_lines(lines: DataFrame) -> DataFrame:
    return parse_delimited(lines, TRIP_LINES)


def positions_from_lines(lines: DataFrame) -> DataFrame:
    return parse_delimited(lines, POSITION_LINES, strip=True)
