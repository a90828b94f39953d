"""Joins on area and cell keys.

No join of two tables is forced to broadcast: Catalyst and adaptive execution broadcast a side when its measured size is
under the session's threshold, and split skewed partitions otherwise.  Only totals of few groups are sent to their rows,
see :func:`few_groups`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_keys(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys where null equals null; the key columns come from the left (either side if full)."""
    r = right.select(*[F.col(k).alias(f"__r_{k}") for k in keys], *[c for c in right.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in keys])
    out = left.join(r, cond, how)
    if how in ("full", "right"):
        out = out.withColumns({k: F.coalesce(F.col(k), F.col(f"__r_{k}")) for k in keys})
    return out if how in ("left_semi", "left_anti") else out.drop(*[f"__r_{k}" for k in keys])


def few_groups(df: DataFrame, by: Sequence[str], limit: int = 1000) -> bool:
    """Whether the keys have at most ``limit`` combinations, so that totals per group may be broadcast to the rows.

    A join by the keys would put each of a few large groups in one task, and sizes guessed before a run may make the rows
    themselves the side that is gathered on the driver.
    """
    return df.select(*by).distinct().limit(limit + 1).count() <= limit


def join_all_inner(tables: Sequence[DataFrame], key: str | Sequence[str]) -> DataFrame:
    """Inner join of many per-area tables on a shared key."""
    return reduce(lambda a, b: a.join(b, key, "inner"), tables)


def with_covariates(cells: DataFrame, covariates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Attach area covariates; cells without them are dropped."""
    return cells.join(covariates, key, "inner")


def with_covariates_keep(cells: DataFrame, covariates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Attach area covariates; cells without them stay with nulls."""
    return cells.join(covariates, key, "left")


def full_join(a: DataFrame, b: DataFrame, key: str | Sequence[str]) -> DataFrame:
    return a.join(b, key, "full")


def unobserved(areas: DataFrame, observed: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Areas with no usable direct estimate."""
    keys = [key] if isinstance(key, str) else list(key)
    return areas.join(observed.select(*keys), keys, "left_anti")


def flag_observed(df: DataFrame, estimate: str, covariate: str, exclude: Column | None = None, out: str = "observed") -> DataFrame:
    """Mark areas usable for fitting: estimate and covariate present and estimate above zero."""
    ok = F.col(estimate).isNotNull() & F.col(covariate).isNotNull() & (F.col(estimate) > 0)
    if exclude is not None:
        ok = ok & ~exclude
    return df.withColumn(out, F.coalesce(ok, F.lit(False)))


def split_observed(df: DataFrame, estimate: str, covariate: str) -> tuple[DataFrame, DataFrame]:
    """Observed areas, and the other areas that have the covariate."""
    flagged = flag_observed(df, estimate, covariate)
    seen = flagged.filter("observed").drop("observed")
    rest = flagged.filter(~F.col("observed") & F.col(covariate).isNotNull()).drop("observed")
    return seen, rest


def complete_grid(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All combinations of the levels of ``keys``, joined back to ``df``.

    The first key (the area) may have any number of levels, spread over tasks.  The others are classifications: the
    distinct levels of one of them travel as one array and are exploded onto the areas.
    """
    grid = df.select(keys[0]).distinct()
    for k in keys[1:]:
        grid = grid.withColumn(k, F.explode(df.agg(F.array_sort(F.collect_set(k))).scalar()))
    return grid.join(df, list(keys), "full")


def attach_to_zones(zones: DataFrame, result: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Zone layer with results; zones without a result stay."""
    return zones.join(result, key, "left")


def flatten_entities(levels: Sequence[tuple[DataFrame, str | None, str | None]], lowest: int | None = None) -> DataFrame:
    """Make a hierarchy of entity tables one table.

    ``levels`` runs from the top entity down; each item is (table, own key, key of its parent as stored in
    the table).  ``lowest`` is the index of the lowest entity needed: deeper tables are not read, so counts
    of that entity stay right and cheap.
    """
    last = len(levels) - 1 if lowest is None else lowest
    out, own, _ = levels[last]
    parent_ref = levels[last][2]
    for i in range(last - 1, -1, -1):
        table, key, up = levels[i]
        out = out.join(table, F.col(parent_ref) == F.col(key), "inner")
        parent_ref = up
    return out


def rename_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
