"""Exact ranks and quantiles per group without gathering a group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.operators.joins import few_groups, join_keys


def group_ranks(df: DataFrame, by: Sequence[str], value: str, bins: int = 64, few: bool | None = None) -> DataFrame:
    """Distinct values per group with their count ``k``, the count ``below`` of smaller values and the size ``n``.

    Values are cut into about equal bins by sketched quantiles; bins are counted, and only inside a bin are
    values ordered.  The cuts steer the work only, ranks are exact.  ``few`` tells whether there are few groups, which may
    each be large: their cuts and counts then travel to the values.  Without it the groups are counted.
    """
    by = list(by)
    few = bool(by) and few_groups(df, by) if few is None else few
    small = F.broadcast if few else lambda t: t
    values = df.filter(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("k"))
    probs = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    cuts = values.groupBy(*by).agg(F.percentile_approx(value, probs, F.lit(10 * bins)).alias("__cuts"))
    binned = join_keys(values, small(cuts), by) if by else values.withColumn("__cuts", cuts.select("__cuts").scalar())
    binned = binned.withColumn("__bin", F.size(F.filter("__cuts", lambda c: c < F.col(value)))).drop("__cuts")
    counts = binned.groupBy(*by, "__bin").agg(F.sum("k").alias("__kb"))
    # at most ``bins`` rows per group reach this window
    over = Window.partitionBy(*by).orderBy("__bin")
    whole = Window.partitionBy(*by)
    counts = counts.select(*by, "__bin", (F.sum("__kb").over(over) - F.col("__kb")).alias("__before"), F.sum("__kb").over(whole).alias("n"))
    inside = Window.partitionBy(*by, "__bin").orderBy(value)
    ranked = binned.withColumn("__in", F.sum("k").over(inside) - F.col("k"))
    out = join_keys(ranked, small(counts), [*by, "__bin"])
    return out.select(*by, value, "k", (F.col("__before") + F.col("__in")).alias("below"), "n")


def pick_quantiles(ranks: DataFrame, by: Sequence[str], value: str, probs: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles from :func:`group_ranks`, one column per name."""
    aggs = []
    for name, q in probs.items():
        pos = F.lit(float(q)) * (F.col("n") - 1)
        lo, hi = F.floor(pos), F.ceil(pos)

        def at(r: Column) -> Column:
            return F.max(F.when((F.col("below") <= r) & (r < F.col("below") + F.col("k")), F.col(value)))

        frac = F.max(pos - lo)
        aggs.append((at(lo) + frac * (at(hi) - at(lo))).alias(name))
    return ranks.groupBy(*by).agg(*aggs)


def group_quantiles(df: DataFrame, by: Sequence[str], value: str, probs: dict[str, float], bins: int = 64) -> DataFrame:
    return pick_quantiles(group_ranks(df, by, value, bins), by, value, probs)
