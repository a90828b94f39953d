"""Recodes, keys and scalar transforms as column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NUMERIC_TYPES = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def as_column(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def pad_code(col: str | Column, width: int, pad: str = "0") -> Column:
    """Left-pad a code to ``width``; longer codes are kept whole."""
    s = as_column(col).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, pad)).otherwise(s)


def concat_key(*cols: str | Column, sep: str = "") -> Column:
    """Join columns into one key; a null part prints as ``NA``."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit("NA")) for c in cols]
    return F.concat_ws(sep, *parts)


def age_band(col: str | Column) -> Column:
    """Five age bands, upper limits 15/30/45/65; a null age falls in the last one."""
    age = as_column(col)
    expr = None
    for limit, code in ((15, "1"), (30, "2"), (45, "3"), (65, "4")):
        expr = F.when(age < limit, code) if expr is None else expr.when(age < limit, code)
    return expr.otherwise("5")


def schooling_band(
    years: str | Column, age: str | Column, variant: str = "strict", no_answer: Iterable[int] = (88, 99), min_age: int | None = None
) -> Column:
    """Schooling band 1..4, ``98`` not applicable, ``99`` no answer, ``Error`` otherwise.

    ``strict`` tests the no-answer codes first, so they never count as years; ``late`` tests them after the
    open upper band, so a 99 becomes ``4``.  The two differ also in what marks "not applicable": a null in
    ``strict``, -1 in ``late``.
    """
    y, a = as_column(years), as_column(age)
    if variant == "strict":
        limit = 4 if min_age is None else min_age
        return (
            F.when((a < limit) | y.isNull(), "98")
            .when(y.isin(*no_answer), "99")
            .when(y == 0, "1")
            .when(y.isin(*range(1, 7)), "2")
            .when(y.isin(*range(7, 13)), "3")
            .when(y > 12, "4")
            .otherwise("Error")
        )
    if variant == "late":
        limit = 5 if min_age is None else min_age
        return (
            F.when((a < limit) | (y == -1), "98")
            .when(y < 1, "1")
            .when(y <= 6, "2")
            .when(y <= 12, "3")
            .when(y > 12, "4")
            .otherwise("Error")
        )
    raise ValueError("variant must be 'strict' or 'late'")


def category_code(col: str | Column, mapping: dict[int, str], default: str) -> Column:
    """Small recode with a default that also takes nulls."""
    c = as_column(col)
    out = F.lit(default)
    for value, code in reversed(list(mapping.items())):
        out = F.when(c.eqNullSafe(F.lit(value)), code).otherwise(out)
    return out


def ethnicity_code(col: str | Column, indigenous: int = 1, afro: int = 2) -> Column:
    return category_code(col, {indigenous: "1", afro: "2"}, "3")


def area_code(col: str | Column, urban: int = 1) -> Column:
    return category_code(col, {urban: "1"}, "0")


def poverty_flag(income: str | Column, line: str | Column) -> Column:
    return (as_column(income) < as_column(line)).cast("int")


def log_income(income: str | Column, shift: float = 1.0, scale: float = 1.0) -> Column:
    """ln(income / scale + shift); null where the argument is not positive."""
    x = as_column(income) / F.lit(float(scale)) + F.lit(float(shift))
    return F.when(x > 0, F.log(x))


def floor_se(col: str | Column, floor: float = 1e-5) -> Column:
    c = as_column(col)
    return F.when(c < floor, floor).otherwise(c)


def floor_deff(col: str | Column, floor: float = 1e-5) -> Column:
    """Design effects that are tiny, NaN or undefined become 1."""
    c = as_column(col)
    return F.when((c < floor) | F.isnan(c) | c.isNull(), 1.0).otherwise(c)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by null in every floating column."""
    floats = {n for n, t in df.dtypes if t in ("double", "float")}
    return df.select(
        *[F.when(~F.isnan(F.col(f"`{n}`")), F.col(f"`{n}`")).alias(n) if n in floats else F.col(f"`{n}`") for n, _ in df.dtypes]
    )


def select_numeric(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    cols = [n for n, t in df.dtypes if n in keep or t.split("(")[0] in NUMERIC_TYPES]
    return df.select(*[f"`{c}`" for c in cols])


def matching_columns(df: DataFrame, pattern: str) -> list[str]:
    import re

    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def select_matching(df: DataFrame, pattern: str, keep: Sequence[str] = ()) -> DataFrame:
    hits = set(matching_columns(df, pattern))
    return df.select(*[f"`{c}`" for c in df.columns if c in hits or c in keep])


def filter_all(df: DataFrame, columns: Sequence[str], predicate: Callable[[Column], Column]) -> DataFrame:
    """Keep rows where ``predicate`` holds on every listed column."""
    return df.filter(reduce(lambda a, b: a & b, [predicate(F.col(f"`{c}`")) for c in columns]))


def rescale_columns(df: DataFrame, columns: Sequence[str], k: float) -> DataFrame:
    """Divide design columns by a constant; anything not listed (the intercept) is left alone."""
    return df.withColumns({c: F.col(f"`{c}`") / F.lit(float(k)) for c in columns})


def round_half_even(col: str | Column, digits: int = 0) -> Column:
    return F.bround(as_column(col), digits)


def arcsine(p: str | Column) -> Column:
    return F.asin(F.sqrt(as_column(p)))


def arcsine_inverse(z: str | Column) -> Column:
    return F.pow(F.sin(as_column(z)), 2)


def logit(p: str | Column) -> Column:
    """Null outside the open unit interval."""
    c = as_column(p)
    return F.when((c > 0) & (c < 1), F.log(c / (1 - c)))


def inv_logit(eta: str | Column) -> Column:
    """1 / (1 + exp(-eta)), written so that neither tail overflows."""
    e = as_column(eta)
    t = F.exp(-F.abs(e))
    return F.when(e >= 0, 1 / (1 + t)).otherwise(t / (1 + t))


def softmax_ref(*etas: str | Column) -> list[Column]:
    """Category probabilities for linear predictors of categories 2..P; category 1 is the reference."""
    cols = [as_column(e) for e in etas]
    top = F.greatest(F.lit(0.0), *cols)
    parts = [F.exp(-top)] + [F.exp(c - top) for c in cols]
    total = reduce(lambda a, b: a + b, parts)
    return [p / total for p in parts]


def clamp_negative(col: str | Column) -> Column:
    c = as_column(col)
    return F.when(c < 0, F.lit(0.0)).otherwise(c)


def nullif_zero(c: str | Column) -> Column:
    c = as_column(c)
    return F.when(c != 0, c)


def sum_na(col: str | Column, na_rm: bool = True) -> Column:
    """Sum that is null when any input is null unless ``na_rm``."""
    c = as_column(col)
    return F.sum(c) if na_rm else F.when(F.count_if(c.isNull()) == 0, F.sum(c))


def mean_na(col: str | Column, na_rm: bool = True) -> Column:
    c = as_column(col)
    return F.avg(c) if na_rm else F.when(F.count_if(c.isNull()) == 0, F.avg(c))


def per_poverty_line(df: DataFrame, value: str, line: str, lines: DataFrame, out: str | None = None) -> DataFrame:
    """Divide a value by the poverty line, which must be the same in every row of ``lines``."""
    spread = lines.agg(
        F.when(
            F.count_distinct(line) == 1,
            F.max(line),
        )
        .otherwise(F.raise_error(F.lit(f"poverty line {line} is not single-valued")).cast("double"))
        .alias("line")
    )
    return df.withColumn(out or value, F.col(value) / spread.scalar())
