"""Exact quantiles of groups of any size.

An approximate pass brackets every wanted quantile. An exact pass then counts, for each group and
probability, the values below, inside and above the bracket: those inside value by value, the others
as one row. While more distinct values than RANKED lie in some bracket, it is divided into equal
steps, the steps are counted, and the bracket shrinks to the steps that hold the wanted ranks. What is
ranked in the end is at most RANKED rows per group and probability, however large the group. The
approximation steers the work and never the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from trafficcast.session import discard, staged

# The approximate pass misses a rank by at most 1/accuracy of the group.
_ACCURACY = 10_000
_MARGIN = 2.0 / _ACCURACY
#: Distinct values of a bracket that one task may rank, and steps a larger bracket is divided into.
RANKED = 100_000
STEPS = 1024

_BELOW, _INSIDE, _ABOVE = -1, 0, 1


def exact_quantiles(
    df: DataFrame, groups: Sequence[str], value: str, probs: Sequence[float]
) -> DataFrame:
    """One row per group and probability, interpolated linearly: groups..., prob, quantile.

    The brackets are computed when this is called and written down, so that their
    size is known: a few groups are broadcast to the values, which then are not
    shuffled by group at all, and very many groups are joined by shuffle.
    """
    groups = list(groups)
    whole = not groups
    if whole:
        df, groups = df.withColumn("_all", F.lit(0)), ["_all"]
    probs = sorted(probs)
    values = df.select(*groups, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")

    edges = [max(p - _MARGIN, 0.0) for p in probs] + [min(p + _MARGIN, 1.0) for p in probs]
    brackets = values.groupBy(*groups).agg(
        F.percentile_approx("_v", edges, _ACCURACY).alias("_edges"), F.count("_v").alias("_n")
    )
    probe = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(float(p)).alias("prob"),
                    F.col("_edges")[i].alias("_lo"),
                    F.col("_edges")[len(probs) + i].alias("_hi"),
                )
                for i, p in enumerate(probs)
            ]
        )
    )
    bounds = staged(brackets.select(*groups, "_n", probe), "brackets")
    lists = bounds.groupBy(*groups).agg(F.collect_list(F.struct("prob", "_lo", "_hi")).alias("_probes"))
    every = values.join(lists, groups).select(*groups, "_v", F.inline("_probes"))
    ends = every.withColumns({"_c": F.lit(1).cast("long"), "_from": F.col("_v"), "_to": F.col("_v")})
    cells = staged(_cells(ends, groups), "cells")
    while _most(cells, groups) > RANKED:
        wide = cells
        cells = staged(_cells(wide.join(_narrowed(wide, bounds, groups), [*groups, "prob"]), groups), "cells")
        discard(wide)

    per_probe = Window.partitionBy(*groups, "prob").orderBy("_part", "_from")
    ranked = (
        cells.withColumn("_end", F.sum("_c").over(per_probe))
        .withColumn("_start", F.col("_end") - F.col("_c"))
        .join(bounds.select(*groups, "prob", "_n"), [*groups, "prob"])
        .withColumn("_at", F.col("prob") * (F.col("_n") - 1))
    )
    low_value, high_value = _value_at(F.floor("_at")), _value_at(F.ceil("_at"))
    share = F.first("_at") - F.floor(F.first("_at"))
    out = ranked.groupBy(*groups, "prob").agg(
        (F.max(low_value) + (F.max(high_value) - F.max(low_value)) * share).alias("quantile")
    )
    return out.drop("_all") if whole else out


def _cells(rows: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Counts per group and probability: each value inside [_lo, _hi], and all below and all above."""
    part = F.when(F.col("_to") < F.col("_lo"), _BELOW).when(F.col("_from") > F.col("_hi"), _ABOVE).otherwise(_INSIDE)
    value = F.when(part == _INSIDE, F.col("_from"))
    return rows.groupBy(*groups, "prob", part.alias("_part"), value.alias("_value")).agg(
        F.sum("_c").alias("_c"), F.min("_from").alias("_from"), F.max("_to").alias("_to")
    )


def _most(cells: DataFrame, groups: Sequence[str]) -> int:
    inside = cells.filter(F.col("_part") == _INSIDE).groupBy(*groups, "prob").agg(F.count("*").alias("n"))
    return inside.agg(F.max("n").alias("n")).first()["n"] or 0


def _narrowed(cells: DataFrame, bounds: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Brackets around the step that holds the wanted rank: groups..., prob, _lo, _hi.

    Steps divide the range of the values inside, and its upper end is a step of its own, so that every
    round leaves out a value at least. Of two ranks to interpolate between the lower one counts: the
    value after it is inside as well, or is the first one above, which is kept.
    """
    keys = [*groups, "prob"]
    inside = cells.filter(F.col("_part") == _INSIDE)
    ends = inside.groupBy(*keys).agg(F.min("_from").alias("_lo"), F.max("_to").alias("_hi"))
    width = F.col("_hi") / STEPS - F.col("_lo") / STEPS
    place = F.when(width > 0, F.least(F.floor((F.col("_from") - F.col("_lo")) / width), F.lit(STEPS - 1))).otherwise(0)
    steps = (
        inside.join(ends, keys)
        .groupBy(*keys, F.when(F.col("_from") == F.col("_hi"), STEPS).otherwise(place).alias("_step"))
        .agg(F.sum("_c").alias("_c"), F.min("_from").alias("_from"), F.max("_to").alias("_to"))
    )
    below = cells.filter(F.col("_part") == _BELOW).groupBy(*keys).agg(F.sum("_c").alias("_below"))
    rank = F.floor(F.col("prob") * (F.col("_n") - 1))
    counted = (
        steps.withColumn("_end", F.sum("_c").over(Window.partitionBy(*keys).orderBy("_step")))
        .join(below, keys, "left")
        .join(bounds.select(*keys, "_n"), keys)
        .withColumn("_end", F.col("_end") + F.coalesce("_below", F.lit(0)))
    )
    holds = (F.col("_end") > rank) & (F.col("_end") - F.col("_c") <= rank)
    found = counted.filter(holds).groupBy(*keys).agg(F.min("_from").alias("_lo"), F.max("_to").alias("_hi"))
    # The rank may lie just outside, as the last value below or the first above: one value stays inside then.
    under = bounds.select(*keys, rank.alias("_rank")).join(below, keys).filter(F.col("_rank") < F.col("_below"))
    edge = ends.join(under.select(*keys, F.lit(True).alias("_under")), keys, "left").select(
        *keys, F.when(F.col("_under"), F.col("_lo")).otherwise(F.col("_hi")).alias("_edge")
    )
    return edge.join(found, keys, "left").select(
        *keys, F.coalesce("_lo", "_edge").alias("_lo"), F.coalesce("_hi", "_edge").alias("_hi")
    )


def _value_at(rank: Column) -> Column:
    """Value at a rank in this cell; below and above only the ends are known, and needed."""
    known = F.coalesce(
        "_value",
        F.when(rank == F.col("_start"), F.col("_from")),
        F.when(rank == F.col("_end") - 1, F.col("_to")),
        F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double"),
    )
    return F.when((rank >= F.col("_start")) & (rank < F.col("_end")), known)
