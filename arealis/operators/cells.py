"""Cross-tabs, cells, rates, shares and comparisons."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arealis.functions.codelists import recode, relabel
from arealis.functions.recode import as_column, nullif_zero, sum_na
from arealis.operators.joins import join_keys

TOTAL, MISSING = "__tot__", "__na__"


def _count(n: str | None) -> Column:
    return F.count(F.lit(1)) if n is None else F.sum(n)


# ---------------------------------------------------------------- cross-tabs


def crosstab(
    df: DataFrame,
    variables: Sequence[str],
    n: str | None = None,
    margins: bool = True,
    labels: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Frequencies by several variables, with every margin.

    Rows are first collapsed to the finest cells, so the cube expands cells and not microdata.  Each
    variable gives ``<name>_value`` and ``<name>_label``; a margin is labelled ``__tot__`` and a missing
    value ``__na__``.  Without margins the plan is a plain group-by.
    """
    labels = labels or {}
    cells = df.groupBy(*variables).agg(_count(n).alias("value"))
    if margins:
        cells = cells.cube(*variables).agg(
            F.sum("value").alias("value"), *[F.grouping(v).alias(f"__g_{v}") for v in variables]
        )
    out = []
    for v in variables:
        text = recode(v, labels[v]) if v in labels else F.col(v).cast("string")
        label = F.coalesce(text, F.lit(MISSING))
        if margins:
            label = F.when(F.col(f"__g_{v}") == 1, TOTAL).otherwise(label)
        out += [F.col(v).alias(f"{v}_value"), label.alias(f"{v}_label")]
    return cells.select(*out, "value")


def drop_margins(xtab: DataFrame, also_missing: bool = False, also: Sequence[str] = ()) -> DataFrame:
    """Remove margin rows (and on request missing or other labels) of a cross-tab."""
    bad = [TOTAL, *([MISSING] if also_missing else []), *also]
    cols = [c for c in xtab.columns if c.endswith("_label")]
    return xtab.filter(reduce(lambda a, b: a & b, [~F.col(c).isin(*bad) for c in cols]))


def margin_check(cells: DataFrame, variables: Sequence[str], n: str) -> DataFrame:
    """Per variable and level: count, proportion and grand total, all from one aggregate."""
    total = cells.agg(F.sum(n)).scalar()
    long = _levels_long(cells.groupBy(*variables).agg(F.sum(n).alias(n)), variables, n)
    return (
        long.groupBy("variable", "level")
        .agg(F.sum(n).alias("n"))
        .withColumns({"prop": F.col("n") / nullif_zero(total), "total": total})
    )


def _levels_long(cells: DataFrame, variables: Sequence[str], n: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(v).alias("variable"), F.col(v).cast("string").alias("level")) for v in variables])
    return cells.select(F.explode(pairs).alias("p"), n).select("p.variable", "p.level", n)


# ---------------------------------------------------------------- collapse


def collapse(df: DataFrame, by: Sequence[str], n: str | None = None, out: str = "n") -> DataFrame:
    """Count rows, or sum counts, per cell."""
    return df.groupBy(*by).agg(_count(n).alias(out))


def collapse_mean(df: DataFrame, by: Sequence[str], y: str, na_rm: bool = False) -> DataFrame:
    mean = F.avg(y) if na_rm else F.when(F.count_if(F.col(y).isNull()) == 0, F.avg(y))
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), mean.alias(y))


def collapse_binomial(df: DataFrame, by: Sequence[str], indicators: Sequence[str], covariates: DataFrame | None = None, on: Sequence[str] | None = None) -> DataFrame:
    """Trials and successes of several 0/1 indicators per cell, one row per cell and indicator.

    One aggregate serves all indicators; area covariates join after the collapse.  ``yno`` counts the
    ones and ``ysi`` the rest.
    """
    wide = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.sum(i).cast("bigint").alias(i) for i in indicators])
    if covariates is not None:
        wide = wide.join(covariates, list(on), "inner")
    keep = [c for c in wide.columns if c not in indicators]
    long = wide.unpivot(keep, list(indicators), "indicator", "yno")
    return long.withColumn("ysi", F.col("n") - F.col("yno"))


def collapse_multinomial(df: DataFrame, by: Sequence[str], category: str, levels: Sequence[int | str], prefix: str | None = None) -> DataFrame:
    """Counts per category in columns ``<prefix>_<level>``, zero where a category is absent."""
    prefix = category if prefix is None else prefix
    return df.groupBy(*by).agg(*[F.count_if(F.col(category) == v).alias(f"{prefix}_{v}") for v in levels])


# ---------------------------------------------------------------- rates


def area_rates(df: DataFrame, by: Sequence[str], *families: Mapping[str, Column]) -> DataFrame:
    """All rates of an area in one aggregate.

    Families are the dictionaries given by the ``*_columns`` functions.  One scan replaces a table per rate
    and the joins between them.
    """
    return df.groupBy(*by).agg(*[c.alias(name) for family in families for name, c in family.items()])


def conditional_columns(numerator: Column, denominator: Column, value: str | None = None, out: str = "rate", na_rm: bool = False) -> dict[str, Column]:
    v = F.lit(1) if value is None else F.col(value)
    num = sum_na(F.when(numerator, v).when(~numerator, F.lit(0)), na_rm)
    den = sum_na(F.when(denominator, v).when(~denominator, F.lit(0)), na_rm)
    return {out: num / nullif_zero(den)}


def conditional_rate(
    df: DataFrame, by: Sequence[str], numerator: Column, denominator: Column, value: str | None = None, out: str = "rate", na_rm: bool = False
) -> DataFrame:
    """Sum of ``value`` where ``numerator`` holds over the sum where ``denominator`` holds.

    A row whose condition is unknown counts as missing: it makes the area's rate null unless ``na_rm``.
    """
    return area_rates(df, by, conditional_columns(numerator, denominator, value, out, na_rm))


def label_columns(specs: Mapping[str, tuple[str, str]], value: str | None = None, skip: Sequence[str] = (TOTAL, MISSING)) -> dict[str, Column]:
    v = F.lit(1) if value is None else F.col(value)
    out = {}
    for name, (var, label) in specs.items():
        c = F.col(var).cast("string")
        known = c.isNotNull() & ~c.isin(*skip)
        num = F.sum(F.when(known & (c == label), v).otherwise(0))
        den = F.sum(F.when(known, v).otherwise(0))
        out[name] = num / nullif_zero(den)
    return out


def label_rates(
    df: DataFrame, by: Sequence[str], specs: Mapping[str, tuple[str, str]], value: str | None = None, skip: Sequence[str] = (TOTAL, MISSING)
) -> DataFrame:
    """Shares of a label for many variables in one scan.

    ``specs`` maps an output name to (variable, label).  Rows whose variable is null or labelled as in
    ``skip`` leave both sums.
    """
    return area_rates(df, by, label_columns(specs, value, skip))


def label_rates_long(long: DataFrame, by: Sequence[str], specs: Mapping[str, tuple[str, str]], value: str, skip: Sequence[str] = (TOTAL, MISSING)) -> DataFrame:
    """As :func:`label_rates` on a table of (area, variable, label, value)."""
    ok = ~F.col("label").isin(*skip)
    aggs = []
    for out, (var, label) in specs.items():
        here = ok & (F.col("variable") == var)
        num = F.sum(F.when(here & (F.col("label") == label), F.col(value)).otherwise(0))
        den = F.sum(F.when(here, F.col(value)).otherwise(0))
        aggs.append((num / nullif_zero(den)).alias(out))
    return long.groupBy(*by).agg(*aggs)


def unemployment_columns(
    status: str, value: str | None = None, employed: Sequence[int] = (2,), unemployed: Sequence[int] = (3, 4), out: str = "tasa_desocupacion"
) -> dict[str, Column]:
    v = F.lit(1) if value is None else F.col(value)
    e = F.sum(F.when(F.col(status).isin(*employed), v))
    u = F.sum(F.when(F.col(status).isin(*unemployed), v))
    return {out: u / nullif_zero(u + e)}


def unemployment_rate(df: DataFrame, by: Sequence[str], status: str, **kw) -> DataFrame:
    """Unemployed over unemployed plus employed; null where either class is absent."""
    return area_rates(df, by, unemployment_columns(status, **kw))


def share_columns(var: str, names: Mapping[str, str], n: str | None = "n", fill: float | None = None, require_all: bool = False) -> dict[str, Column]:
    v = F.lit(1) if n is None else F.col(n)
    total = F.sum(v)
    parts = {out: F.sum(F.when(F.col(var) == code, v)) for code, out in names.items()}
    present = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts.values()])
    shares = {}
    for out, p in parts.items():
        share = p / nullif_zero(total)
        if require_all:
            share = F.when(present, share)
        shares[out] = share if fill is None else F.coalesce(share, F.lit(float(fill)))
    return shares


def share_profile(
    cells: DataFrame, by: Sequence[str], var: str, names: Mapping[str, str], n: str | None = "n", fill: float | None = None, require_all: bool = False
) -> DataFrame:
    """Category shares per area as columns.

    The denominator holds every category, also those without a name.  ``fill`` replaces the share of an
    absent category; ``require_all`` makes all shares null unless every named category is present.
    """
    return area_rates(cells, by, share_columns(var, names, n, fill, require_all))


def employment_rates_survey(df: DataFrame, by: Sequence[str] | None = None, status: str = "empleo", weight: str = "fep", na_rm: bool = False) -> DataFrame:
    """Weighted unemployment (TD), occupation (TO) and participation (TP) rates, in percent."""
    if by is None:
        df, by = df.withColumn("Nacional", F.lit("Nacional")), ["Nacional"]
    s, w = F.col(status), F.col(weight)

    def total(cond: Column) -> Column:
        return sum_na(cond.cast("double") * w, na_rm)

    active, every = total(s != 3), sum_na(w, na_rm)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_sample"),
        (total(s == 2) / nullif_zero(active) * 100).alias("TD"),
        (total(s == 1) / nullif_zero(every) * 100).alias("TO"),
        (active / nullif_zero(every) * 100).alias("TP"),
    )


def employment_rates_census(df: DataFrame, by: Sequence[str] | None = None, n: str | Column = "n", theta: Sequence[str] = ("theta_1", "theta_2"), na_rm: bool = False) -> DataFrame:
    """The same rates from cell probabilities of being employed and unemployed."""
    if by is None:
        df, by = df.withColumn("Nacional", F.lit("Nacional")), ["Nacional"]
    nn, e, u = as_column(n), F.col(theta[0]), F.col(theta[1])
    active, every = sum_na(nn * (e + u), na_rm), sum_na(nn, na_rm)
    return df.groupBy(*by).agg(
        (sum_na(nn * u, na_rm) / nullif_zero(active) * 100).alias("TD"),
        (sum_na(nn * e, na_rm) / nullif_zero(every) * 100).alias("TO"),
        (active / nullif_zero(every) * 100).alias("TP"),
    )


# ---------------------------------------------------------------- comparisons


def interaction_means(df: DataFrame, by: str, by2: str, y: str = "pobreza", out: str = "Pobreza") -> DataFrame:
    """Unweighted mean of ``y`` per pair of levels, with labels for line colour and axis."""
    means = df.groupBy(by, by2).agg(F.when(F.count_if(F.col(y).isNull()) == 0, F.avg(y)).alias(out))
    return means.withColumns({"by_Color": relabel(by), "by_x": relabel(by2)})


def compare_proportions(sample: DataFrame, census: DataFrame, by: str, n: str = "n") -> DataFrame:
    """Sample share against population share per level, labelled."""
    s = sample.groupBy(by).agg(F.count(F.lit(1)).alias("ns"))
    c = census.groupBy(by).agg(F.sum(n).alias("nc"))
    s = s.select(by, (F.col("ns") / s.agg(F.sum("ns")).scalar()).alias("Sample"))
    c = c.select(by, (F.col("nc") / c.agg(F.sum("nc")).scalar()).alias("Population"))
    return s.join(c, by, "full").select(relabel(by, missing="warn").alias(by), "Sample", "Population")


def melt(df: DataFrame, ids: Sequence[str], values: Sequence[str] | None = None, variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide to long; numeric columns meet as double."""
    values = [c for c in df.columns if c not in ids] if values is None else list(values)
    numeric = all(t != "string" for c, t in df.dtypes if c in values)
    cast = "double" if numeric else "string"
    return df.select(*ids, *[F.col(v).cast(cast).alias(v) for v in values]).unpivot(list(ids), values, variable, value)


def compare_estimates(
    direct: DataFrame | None, poststrat: DataFrame, by: Sequence[str], model: str, bench: str, n: str = "n", gk: str | None = None
) -> DataFrame:
    """Direct, model and benchmarked means side by side.

    ``direct`` holds ``directo``, ``directo_se`` and ``n_sample`` per group; None stands for a survey
    without these variables and gives nulls with ``n_sample`` 1.  With ``gk`` the model mean divides by the
    sum of ``n / gk``.
    """
    base = F.col(n) if gk is None else F.col(n) / nullif_zero(gk)
    census = poststrat.groupBy(*by).agg(
        (F.sum(F.col(n) * F.col(model)) / nullif_zero(F.sum(base))).alias("lmer"),
        (F.sum(F.col(n) * F.col(bench)) / nullif_zero(F.sum(n))).alias("bench"),
    )
    if direct is None:
        return census.withColumns(
            {"directo": F.lit(None).cast("double"), "directo_se": F.lit(None).cast("double"), "n_sample": F.lit(1).cast("bigint")}
        ).select(*by, "directo", "directo_se", "n_sample", "lmer", "bench")
    return direct.select(*by, "directo", "directo_se", "n_sample").join(census, list(by), "full")


def compare_estimates_long(table: DataFrame, by: Sequence[str]) -> DataFrame:
    return melt(table, [*by, "n_sample", "directo_se"], ["directo", "lmer", "bench"])


def compare_indicators(sample: DataFrame, poststrat: DataFrame, by: Sequence[str], indicator: str = "TD", gk: str = "gk", in_sample: bool = True) -> DataFrame:
    """Direct, model and benchmarked employment rates stacked, with the sample size of each group."""
    if in_sample:
        direct = employment_rates_survey(sample, by)
    else:
        direct = poststrat.select(*by).distinct().withColumn("n_sample", F.lit(1).cast("bigint"))
    parts = {
        "directo": direct.drop("n_sample"),
        "lmer": employment_rates_census(poststrat, by),
        "bench": employment_rates_census(poststrat, by, n=F.col("n") * F.col(gk)),
    }
    stacked = union_by_name(parts, id_column="variable")
    sizes = direct.select(*by, "n_sample")
    return stacked.join(sizes, list(by), "full").withColumn("value", F.col(indicator))


def axis_order(df: DataFrame, by: Sequence[str]) -> list[str]:
    """Grouping variables from most to fewest levels; one aggregate, at most a few names on the driver."""
    levels = df.groupBy(*by).agg(F.lit(1)).agg(*[F.count_distinct(b) + F.max(F.col(b).isNull().cast("int")) for b in by]).first()
    counts = dict(zip(by, levels))
    return sorted(by, key=lambda b: -(counts[b] or 0))


def level_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Distinct levels per grouping variable, most levels first."""
    distinct = df.groupBy(*by).agg(F.lit(1).alias("__one"))
    pairs = F.array(*[F.struct(F.lit(b).alias("variable"), F.col(b).cast("string").alias("level")) for b in by])
    return (
        distinct.select(F.explode(pairs).alias("p")).select("p.variable", "p.level").distinct()
        .groupBy("variable").agg(F.count(F.lit(1)).alias("levels")).orderBy(F.desc("levels"), "variable")
    )


def correlations(df: DataFrame, y: str, covariates: Mapping[str, Column]) -> DataFrame:
    """Pearson correlation of ``y`` with each (transformed) covariate, one row per covariate."""
    cols = {f"__x{i}": c for i, c in enumerate(covariates.values())}
    wide = df.select(F.col(y).alias("__y"), *[c.cast("double").alias(k) for k, c in cols.items()])
    one = wide.agg(*[F.corr("__y", k).alias(k) for k in cols])
    stack = F.explode(F.array(*[F.struct(F.lit(name).alias("covariate"), F.col(k).alias("r")) for name, k in zip(covariates, cols)]))
    return one.select(stack.alias("s")).select("s.covariate", "s.r")


def frequency_table(df: DataFrame, var: str) -> DataFrame:
    """Counts per value plus a total row; the total is not mistaken for a missing value."""
    cells = df.groupBy(var).agg(F.count(F.lit(1)).alias("n"))
    rolled = cells.rollup(var).agg(F.sum("n").alias("n"), F.grouping(var).alias("__g"))
    label = F.when(F.col("__g") == 1, TOTAL).otherwise(F.coalesce(F.col(var).cast("string"), F.lit(MISSING)))
    return rolled.select(label.alias(var), "n")


def histogram_table(df: DataFrame, col: str, bins: int, lo: float, hi: float, by: Sequence[str] = ()) -> DataFrame:
    """Counts and density over equal bins of [lo, hi]; the last bin is closed and outside values are left out."""
    width = (hi - lo) / bins
    x = F.col(col)
    b = F.least(F.floor((x - F.lit(lo)) / F.lit(width)), F.lit(bins - 1).cast("bigint"))
    counts = df.filter((x >= lo) & (x <= hi)).groupBy(*by, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    if by:
        totals = counts.groupBy(*by).agg(F.sum("n").alias("__t"))
        counts = counts.join(totals, list(by))
    else:
        counts = counts.withColumn("__t", counts.agg(F.sum("n")).scalar())
    return counts.select(
        *by, "bin", (F.lit(lo) + F.col("bin") * F.lit(width)).alias("lower"), "n", (F.col("n") / (F.col("__t") * F.lit(width))).alias("density")
    )


def share_where(df: DataFrame, predicate: Column, out: str = "share") -> DataFrame:
    return df.agg(F.avg(predicate.cast("double")).alias(out))


def flag_tally(df: DataFrame, flag: str = "Flag") -> DataFrame:
    return df.groupBy(flag).agg(F.count(F.lit(1)).alias("n")).orderBy("n", flag)


def row_shares(df: DataFrame, cols: Sequence[str], suffix: str = "_p") -> DataFrame:
    """Category counts over their row total."""
    total = reduce(lambda a, b: a + b, [F.col(c) for c in cols])
    return df.withColumns({f"{c}{suffix}": F.col(c) / nullif_zero(total) for c in cols})


# ---------------------------------------------------------------- shares and positions


def share_within(df: DataFrame, n: str, prefix: Sequence[str] = (), out: str = "share") -> DataFrame:
    """``n`` over its total in the groups of ``prefix`` (or overall).

    Totals come from an aggregate joined back, so a group that holds much of the table is not gathered in
    one task.
    """
    if not prefix:
        return df.withColumn(out, F.col(n) / nullif_zero(df.agg(F.sum(n)).scalar()))
    totals = df.groupBy(*prefix).agg(F.sum(n).alias("__total"))
    return join_keys(df, totals, prefix).withColumn(out, F.col(n) / nullif_zero("__total")).drop("__total")


def cell_id(*keys: str) -> Column:
    """Stable identifier of a cell: the md5 of its key values, nulls told apart from blanks."""
    parts = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("~")) for k in keys]
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def row_position(df: DataFrame, keys: Sequence[str], out: str = "position", digits: int = 3) -> DataFrame:
    """Number the cells 1..n in the order of their identifier.

    ``keys`` must identify a row.  The first hex digits of the identifier make ``16 ** digits`` even
    buckets; each bucket is numbered on its own and shifted by the sizes of the buckets before it, so no
    task sees the whole table.
    """
    tagged, sizes = _buckets(df, keys, digits)
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__b", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__offset"))
    inside = Window.partitionBy("__b").orderBy("__id")
    # every bucket has an offset; an inner join would filter one side alone, which could then not share its input with the sizes
    numbered = tagged.withColumn("__rn", F.row_number().over(inside)).join(offsets, "__b", "left")
    return numbered.withColumn(out, F.col("__rn") + F.col("__offset")).drop("__id", "__b", "__rn", "__offset")


def row_total(df: DataFrame, keys: Sequence[str], digits: int = 3) -> Column:
    """Number of rows as a scalar that a query with :func:`row_position` of the same rows takes from its bucket sizes."""
    return _buckets(df, keys, digits)[1].agg(F.coalesce(F.sum("__size"), F.lit(0)).alias("n")).select("n").scalar()


def _buckets(df: DataFrame, keys: Sequence[str], digits: int) -> tuple[DataFrame, DataFrame]:
    """Rows with identifier and bucket, and the size of every bucket.

    The sizes look at a hash of all columns, so that Spark reads the same columns for both and computes the rows before the
    last shuffle once.
    """
    tagged = df.withColumn("__id", cell_id(*keys)).withColumn("__b", F.substring("__id", 1, digits))
    counted = tagged.groupBy("__b").agg(F.count(F.lit(1)).alias("__n"), F.max(F.xxhash64(*df.columns)).alias("__seen"))
    return tagged, counted.select("__b", F.when(F.col("__seen").isNotNull(), F.col("__n")).alias("__size"))


def cluster_cells(cells: DataFrame, by: Sequence[str], cell: str, limit: int = 10_000) -> DataFrame:
    """Bring the cells of a group together before they are multiplied by draws.

    Cells of a group follow each other, so sums per group and draw combine before the shuffle, which would otherwise carry
    every draw of every cell.  A group with more than ``limit`` cells is dealt over as many tasks as it needs; there are at most ``1 / limit``
    as many such groups as cells, so their sizes go to the cells and cells move once.
    """
    sizes = cells.groupBy(*by).agg(F.count(F.lit(1)).alias("__size")).filter(F.col("__size") > limit)
    parts = F.coalesce(F.ceil(F.col("__size") / limit), F.lit(1))
    salted = join_keys(cells, F.broadcast(sizes), by, "left").withColumn("__salt", F.pmod(F.xxhash64(cell), parts))
    return spread_groups(salted, *by, "__salt").drop("__size", "__salt").sortWithinPartitions(*by)


def spread_groups(df: DataFrame, *by: str) -> DataFrame:
    """Deal rows over a fixed number of partitions before they grow by the number of draws.

    Rows are light now, and adaptive execution cannot foresee that growth when it merges small partitions.
    """
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *by)


# ---------------------------------------------------------------- order, samples, sets


def sort_desc(df: DataFrame, *desc: str, ties: Sequence[str] = ()) -> DataFrame:
    return df.orderBy(*[F.desc_nulls_last(c) for c in desc], *ties)


def top_k(df: DataFrame, k: int, *desc: str, ties: Sequence[str] = ()) -> DataFrame:
    return sort_desc(df, *desc, ties=ties).limit(k)


def sample_rows(df: DataFrame, k: int, key: str, seed: object = 1) -> DataFrame:
    """``k`` rows without replacement, chosen by a keyed uniform; the same rows on every run."""
    from arealis.functions.rng import uniform

    return df.withColumn("__u", uniform(seed, key)).orderBy("__u", key).limit(k).drop("__u")


def sample_with_replacement(df: DataFrame, k: int, position: str, total: int | Column, seed: object = 1) -> DataFrame:
    """``k`` rows with replacement from rows numbered 1..total in ``position``; ``pick`` numbers the picks."""
    from arealis.functions.rng import uniform

    picks = df.sparkSession.range(1, k + 1).withColumnRenamed("id", "pick")
    picks = picks.withColumn(position, (F.floor(uniform(seed, "pick") * total) + 1).cast("bigint"))
    return picks.join(df.withColumn(position, F.col(position).cast("bigint")), position)


def union_by_name(parts: Mapping[str, DataFrame] | Sequence[DataFrame], id_column: str | None = None) -> DataFrame:
    """Stack tables by column name, missing columns null, with an optional source id."""
    if isinstance(parts, Mapping):
        frames = [d.withColumn(id_column, F.lit(k)) if id_column else d for k, d in parts.items()]
    else:
        frames = list(parts)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_combinations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.select(*cols).distinct()
