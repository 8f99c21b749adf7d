"""Tracking: from requested vehicle ids to the frames and map tiles of one playback."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kerbside.functions import clock
from kerbside.operators.tracking import known_vehicles, playback, resolve_ids, viewport_tiles
from kerbside.params import PLAYBACK_END, PLAYBACK_START


def track(suggestions: DataFrame, requested: DataFrame, tracked: DataFrame, seed: int = 0) -> DataFrame:
    """The ids to show for a request, added to those already tracked."""
    resolved = resolve_ids(requested, known_vehicles(suggestions), tracked, seed)
    return tracked.select("vehicle_id").union(resolved.select(F.col("resolved_id").alias("vehicle_id"))).distinct()


def frames(
    suggestions: DataFrame,
    ids: DataFrame,
    start: int = PLAYBACK_START,
    end: int = PLAYBACK_END,
    ticks_per_minute: int = 2,
    order: Sequence[str] = ("datetime",),
    month: str | None = None,
) -> DataFrame:
    """Position, spots and clock label of each vehicle at each tick, of one month or of each."""
    shown = playback(suggestions, start, end, ticks_per_minute, ids, order, month)
    minutes = F.col("tick") / F.lit(float(ticks_per_minute))
    return shown.withColumns(
        {"label": clock.clock_label(minutes), "longitude": F.get("vehicle_pos", 0), "latitude": F.get("vehicle_pos", 1)}
    )


def tiles(shown: DataFrame) -> DataFrame:
    """The nine map tiles of every frame."""
    return viewport_tiles(shown)
