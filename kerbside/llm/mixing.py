"""Mixing sources to target weights, by hash-threshold histograms.

Every document has a fixed place on a line of 60-bit hashes. A source's budget takes the documents
below a threshold on that line, so a larger budget takes a superset of a smaller one. The threshold is
found without sorting: sizes are summed by source and hash bucket, the bucket in which the budget ends is
split again, and again, until a bucket is a single hash value. Each pass reads only the boundary buckets.

Defined results: a null text has size 0; a null source is a source of its own, the last in order; rows
with equal ids lie on the same place and are taken together; an empty table gives an empty result;
further columns are neither read nor returned, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kerbside.llm.common import WORD, order_key, ranked, staged

HASH_BITS = 60
STEP_BITS = 12  # 4096 buckets a pass: 5 passes reach single hash values
WEIGHTS = (5, 2, 1)
SHARE = 1.5  # of all words
MOST = 2  # times its source's size that a target may reach


def sizes(documents: DataFrame) -> DataFrame:
    """doc_id, source, size (words) and place of every document, stored so that texts are read once."""
    words = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    return staged(
        documents.select("doc_id", "source", words.alias("size"), order_key("doc_id").alias("place")), "mix-sizes"
    )


def targets(sized: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """source, source_size and target.

    The budget is dealt by weight; sources that would pass ``most`` times their size stop there and the
    excess is dealt again, until none is above. Each round is one aggregation that returns three numbers.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = ranked(sized, "source", "nth")
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    weight = F.element_at(cycle, (F.col("nth") % len(weights) + 1).cast("int")).cast("bigint")
    joined = totals.join(
        placed.select(F.col("source").alias("_source"), weight.alias("weight")),
        F.col("source").eqNullSafe(F.col("_source")),
    ).drop("_source")
    sources = staged(joined, "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    limit = (F.col("source_size") * most).cast("double")
    level, stopped = 0.0, None
    while True:
        over = F.lit(False) if stopped is None else F.lit(level) * F.col("weight") > limit
        count, full, left = sources.agg(
            F.sum(over.cast("int")),
            F.sum(F.when(over, F.col("source_size") * most).otherwise(0)),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))),
        ).first()
        if not left or count == stopped:
            break
        stopped = count
        level = (share * total - full) / left
    return sources.select("source", "source_size", F.least(F.lit(level) * F.col("weight"), limit).alias("target"))


def thresholds(sized: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each source the copies that every document gets, and the threshold below which one more is taken.

    ``budgets`` has source and target. Returned: source, copies, bound. Of the two thresholds around the
    budget (with and without the documents of the boundary hash) the nearer one is chosen, the lower if
    both are as near.
    """
    size, source_size = F.col("size"), F.col("source_size")
    per_source = budgets.select(
        F.col("source").alias("source_"),
        F.when(source_size > 0, F.floor(F.col("target") / source_size)).otherwise(0).cast("bigint").alias("copies"),
        F.col("target"),
        source_size,
    ).withColumn("rest", F.col("target") - F.col("copies") * source_size)
    bounds = per_source.select(
        "source_", "copies", "rest", F.lit(0).cast("bigint").alias("low"), F.lit(0).cast("bigint").alias("before")
    )
    width = HASH_BITS
    while width > 0:
        step = min(STEP_BITS, width)
        rest_bits = width - step
        inside = sized.join(bounds, F.col("source").eqNullSafe(F.col("source_"))).filter(
            F.expr(f"shiftright(place, {width}) = shiftright(low, {width})")
        )
        bucket = F.expr(f"shiftright(place, {rest_bits})")
        histogram = inside.groupBy("source", bucket.alias("bucket")).agg(F.sum(size).alias("words"))
        summed = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        running = histogram.withColumn("sum_before", F.coalesce(F.sum("words").over(summed), F.lit(0)))
        state = bounds.select(
            F.col("source_").alias("s"), "copies", "rest", F.col("before").alias("outer"),
        )
        found = running.join(state, F.col("source").eqNullSafe(F.col("s"))).filter(
            F.col("outer") + F.col("sum_before") + F.col("words") > F.col("rest")
        )
        # The first bucket that passes the budget; a source without one is taken whole or has no words.
        first = found.groupBy("s", "copies", "rest").agg(
            F.min(F.struct("bucket", (F.col("outer") + F.col("sum_before")).alias("before"), "words")).alias("at")
        )
        bounds = staged(
            first.select(
                F.col("s").alias("source_"),
                "copies",
                "rest",
                F.expr(f"shiftleft(at.bucket, {rest_bits})").alias("low"),
                F.col("at.before").alias("before"),
                F.col("at.words").alias("words"),
            ),
            "mix-bounds",
        )
        width = rest_bits
    beyond = F.col("before") + F.col("words") - F.col("rest") < F.col("rest") - F.col("before")
    refined = bounds.select(
        F.col("source_").alias("s"), (F.col("low") + beyond.cast("bigint")).alias("found")
    )
    everything = F.lit(2**HASH_BITS).cast("bigint")
    bound = F.when(F.col("rest") <= 0, F.lit(0).cast("bigint")).otherwise(F.coalesce("found", everything))
    return per_source.join(refined, F.col("source_").eqNullSafe(F.col("s")), "left").select(
        F.col("source_").alias("source"), "copies", bound.alias("bound")
    )


def plan_mix(sized: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """One row per source: source_, source_size, target, base (copies of every document) and bound."""
    budgets = staged(targets(sized, weights, share, most), "mix-targets")
    cuts = thresholds(sized, budgets).select(F.col("source").alias("s"), F.col("copies").alias("base"), "bound")
    plan = budgets.join(cuts, F.col("source").eqNullSafe(F.col("s")))
    return staged(plan.select(F.col("source").alias("source_"), "source_size", "target", "base", "bound"), "mix-plan")


def taken(place, most: int):
    """How often a document at a place is taken, next to its source's row of the plan."""
    return F.least(F.col("base") + (place < F.col("bound")).cast("bigint"), F.lit(most).cast("bigint"))


def mix(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """doc_id, source, size, source_size, target and copies (how often the mix takes the document)."""
    sized = sizes(documents)
    plan = plan_mix(sized, weights, share, most)
    return sized.join(plan, F.col("source").eqNullSafe(F.col("source_"))).select(
        "doc_id", "source", "size", "source_size", "target", taken(F.col("place"), most).alias("copies")
    )


def mixed_documents(
    documents: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST
) -> DataFrame:
    """The documents of the mix with their own columns, each as often as it is taken.

    A document's place is computed again beside its text; only the sources' thresholds are joined.
    """
    plan = plan_mix(sizes(documents), weights, share, most)
    packed = documents.select(
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("doc"),
        F.col("source").alias("of"),
        order_key("doc_id").alias("place"),
    )
    copies = packed.join(plan, F.col("of").eqNullSafe(F.col("source_"))).withColumn("n", taken(F.col("place"), most))
    again = copies.filter(F.col("n") > 0).withColumn("copy", F.explode(F.expr("sequence(1, n)")))
    return again.select("doc.*")
