"""Design columns from explicit terms and fitted level lists."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Factor:
    """A categorical term; the first of its sorted training levels is the reference."""

    name: str
    levels: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Numeric:
    """A numeric term, optionally a transformed column expression."""

    name: str
    expr: Column | None = None


@dataclass(frozen=True)
class DesignSpec:
    """Fitted design: the same columns in the same order for any table it is applied to."""

    terms: tuple[Factor | Numeric, ...]
    intercept: bool
    columns: tuple[str, ...]

    def expressions(self) -> list[Column]:
        out: list[Column] = [F.lit(1.0).alias("(Intercept)")] if self.intercept else []
        full = not self.intercept
        for t in self.terms:
            if isinstance(t, Numeric):
                out.append((F.col(f"`{t.name}`") if t.expr is None else t.expr).cast("double").alias(t.name))
                continue
            levels = t.levels if full else t.levels[1:]
            full = False
            value = F.col(f"`{t.name}`").cast("string")
            out += [F.when(value == level, 1.0).when(value.isNull(), None).otherwise(0.0).alias(f"{t.name}{level}") for level in levels]
        return out

    def apply(self, df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
        """Design columns next to ``keep``; levels unknown at fitting time give zeros."""
        return df.select(*keep, *self.expressions())


def fit_design(df: DataFrame, terms: Sequence[Factor | Numeric], intercept: bool = True, max_levels: int | None = None) -> DesignSpec:
    """Learn the levels of all factors from the training table in one aggregate.

    Every level becomes a column of the plan.  A factor of thousands of levels belongs into ``operators.bordered``, which
    makes no columns; ``max_levels`` lets a caller insist on that.
    """
    open_factors = [t.name for t in terms if isinstance(t, Factor) and t.levels is None]
    found: dict[str, tuple[str, ...]] = {}
    if open_factors:
        row = df.agg(*[F.sort_array(F.collect_set(F.col(f"`{n}`").cast("string"))).alias(f"f{i}") for i, n in enumerate(open_factors)]).first()
        found = {n: tuple(row[f"f{i}"]) for i, n in enumerate(open_factors)}
        for name, levels in found.items():
            if max_levels is not None and len(levels) > max_levels:
                raise ValueError(f"{name} has more than {max_levels} levels; use it as the factor of a bordered model or as a grouping effect")
    fitted = tuple(Factor(t.name, found.get(t.name, t.levels)) if isinstance(t, Factor) else t for t in terms)
    spec = DesignSpec(fitted, intercept, ())
    names, full = (["(Intercept)"] if intercept else []), not intercept
    for t in fitted:
        if isinstance(t, Numeric):
            names.append(t.name)
        else:
            names += [f"{t.name}{v}" for v in (t.levels if full else t.levels[1:])]
            full = False
    return DesignSpec(spec.terms, intercept, tuple(names))


def align_columns(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Give ``df`` exactly the training columns in order: missing ones zero, extra ones dropped."""
    have = set(df.columns)
    return df.select(*keep, *[F.col(f"`{c}`") if c in have else F.lit(0.0).alias(c) for c in columns])


def missing_columns(train: Sequence[str], other: Sequence[str]) -> list[str]:
    return [c for c in train if c not in set(other)]


def warn_if_saturated(p: int, areas: int) -> None:
    if p >= areas:
        warnings.warn(f"{p} fixed-effect columns for {areas} areas: only the prior identifies the coefficients", stacklevel=2)


def group_column(group: str, out: str = "group") -> Column:
    """Random effects keep their group label as one column; per-group sums stand in for incidence columns."""
    return F.col(group).cast("string").alias(out)


def effective_counts(df: DataFrame, n_eff: str = "n_eff_FGV", p: str = "pobreza") -> DataFrame:
    """Rounded effective trials, successes and precision; halves go to the even number."""
    n = F.bround(F.col(n_eff), 0)
    out = df.withColumn("n_effec", n)
    return out.withColumns({"y_effect": F.bround(F.col(p) * F.col("n_effec"), 0), "phi": F.col("n_effec") - 1})
