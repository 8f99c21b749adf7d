"""A small weighted choice of spots for every vehicle, the same each time it is computed.

Weighted sampling without replacement by inversion: a uniform number times the weight that is left falls into the
stretch of one spot on the running totals of the weights; the stretches of spots drawn before are stepped over.
The totals come with the hotspot row (``matching.draw_columns``), so they are computed once a row of hotspots and not once a
position. The uniform numbers are 32-bit words of a digest of the vehicle's seed, one a draw. The draw happens inside the
row: no exchange, no window, and it runs unchanged on a stream.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.functions import hashing
from kerbside.functions.numbers import parse_int
from kerbside.operators.matching import draw_columns, match_spots
from kerbside.operators.staging import compute_once
from kerbside.params import MAX_SEED, PICKS, SEED_BASE


def vehicle_seed(vehicle_id: Column) -> Column:
    """Seed of a vehicle; null if its id is no integer or the seed would be out of range."""
    number = parse_int(vehicle_id)
    in_range = number.between(-SEED_BASE, MAX_SEED - SEED_BASE)
    return F.when(in_range, number + SEED_BASE)


def random_digits(seed: Column, words: Column) -> Column:
    """At least ``words`` random 32-bit words of a seed, as one long hexadecimal text."""
    blocks = F.sequence(F.lit(0), F.floor((words - 1) / F.lit(float(hashing.WORDS))).cast("int"))
    return F.array_join(F.transform(blocks, lambda block: hashing.digest(seed, block)), "")


STEPS = ("left_at", "before", "at", "place")  # of a draw; the next one replaces them


def add_draw(df: DataFrame, nth: int) -> DataFrame:
    """Adds the struct ``drawn_<nth>`` of the spot that the nth draw falls on: where its stretch begins, its weight and its place.

    Null if nothing is left to draw. The whole numbers of the totals are exact as doubles.
    """
    drawn = [F.col(f"drawn_{before}") for before in range(nth)]
    left = F.try_element_at("totals", F.lit(-1))
    for spot in drawn:
        left = left - spot["weight"]
    at = hashing.uniform(F.col("digits"), F.lit(nth)) * left
    # Each step is a projection of its own: what later steps use more than once is not computed again.
    df = df.withColumns({"left_at": at, "before": F.sort_array(F.array(*drawn))} if nth else {"left_at": at})
    # On the totals of what is left, every stretch before has been taken out; this puts those below back in.
    skipped, at = F.lit(0.0), F.col("left_at")
    for rank in range(nth):
        spot = F.get("before", F.lit(rank))
        at = at + F.when(F.col("left_at") > spot["begins"] - skipped, spot["weight"]).otherwise(F.lit(0.0))
        skipped = skipped + spot["weight"]
    df = df.withColumn("at", at)
    # The place among the sorted totals, the first of which is 0: those of weight 0 are as long as a point and never met.
    place = (F.array_position(F.sort_array(F.concat("totals", F.array("at"))), F.col("at")) - 2).cast("int")
    df = df.withColumn("place", place)
    begins, ends = F.get("totals", F.col("place")), F.get("totals", F.col("place") + 1)
    spot = F.struct(begins.alias("begins"), (ends - begins).alias("weight"), F.col("place").alias("place"))
    return df.withColumn(f"drawn_{nth}", F.when(F.col("place") >= 0, spot))


def suggest(matched: DataFrame, k: int = PICKS) -> DataFrame:
    """Replaces the spots and weights of a matched position by at most k spots drawn for its vehicle.

    No draw is possible, and both arrays stay empty, if the vehicle has no seed, a weight is negative,
    or fewer spots than are asked for can be drawn. Weight 0 is never drawn.
    """
    if "totals" not in matched.columns:
        matched = compute_once(matched, draw_columns(F.col("weights")))
    seeded = compute_once(matched, {"seed": vehicle_seed(F.col("vehicle_id"))})
    enough = F.col("drawable") >= F.least(F.lit(k), F.size("offer_lon"))
    possible = F.col("seed").isNotNull() & F.col("totals").isNotNull() & enough
    drawn = compute_once(seeded, {"digits": F.when(possible, random_digits(F.col("seed"), F.lit(k)))})
    names = [f"drawn_{nth}" for nth in range(k)]
    for nth in range(k):
        drawn = add_draw(drawn, nth)
    places = F.filter(F.array(*[F.col(name)["place"] for name in names]), lambda place: place.isNotNull())
    chosen = compute_once(drawn, {"places": places})
    lon = F.transform("places", lambda place: F.get("offer_lon", place))
    lat = F.transform("places", lambda place: F.get("offer_lat", place))
    answered = chosen.withColumns({"spot_lon": lon, "spot_lat": lat})
    return answered.drop("seed", "digits", "offer_lon", "offer_lat", "weights", "totals", "drawable", "places", *STEPS, *names)


def suggestions(
    positions: DataFrame,
    hotspots: DataFrame,
    k: int = PICKS,
    keep: tuple[str, ...] = (),
    broadcast: str | None = None,
    salt: int = 1,
    heavy: int | None = None,
) -> DataFrame:
    """Cleaned positions to the rows of the suggestions table; ``keep`` names columns to carry along."""
    answered = suggest(match_spots(positions, hotspots, broadcast, salt, heavy), k)
    return answered.select("vehicle_id", "vehicle_pos", "spot_lon", "spot_lat", "datetime", *keep)


def explode_picks(answers: DataFrame) -> DataFrame:
    """Suggestions as one row per suggested spot, numbered by ``pick_no``, for sinks without arrays.

    An answer without spots stays as one row with nulls.
    """
    kept = [name for name in answers.columns if name not in ("spot_lon", "spot_lat", "vehicle_pos")]
    place = [F.get("vehicle_pos", at).alias(name) for at, name in enumerate(("vehicle_lon", "vehicle_lat"))]
    picks = F.posexplode_outer(F.arrays_zip("spot_lon", "spot_lat")).alias("at", "pick")
    return answers.select(*kept, *place, picks).select(
        *kept, "vehicle_lon", "vehicle_lat", (F.col("at") + 1).alias("pick_no"), "pick.spot_lon", "pick.spot_lat"
    )
