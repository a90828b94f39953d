"""Design-based estimation for complex surveys.

All variances come from sums.  Microdata are aggregated once to (domain, stratum, PSU) totals, those to
(domain, stratum) and those to domains; no residual is ever computed per person, so the survey is scanned
once for the estimates and once, two columns wide, for the design.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.numeric import normal_quantile, t_quantile_column
from arealis.functions.recode import as_column, inv_logit, logit, nullif_zero
from arealis.operators.joins import join_keys
from arealis.session import materialise


@dataclass(frozen=True)
class SurveyDesign:
    """A survey with its strata, sampling units and weights.

    ``psu`` None means element sampling.  ``nest`` says that PSU labels repeat between strata, so the unit is
    the pair (stratum, PSU).  A stratum with a single PSU is centred at the grand mean (``adjust``), adds
    nothing (``remove``) or is an error (``fail``).
    """

    df: DataFrame
    weight: str
    strata: str | None = None
    psu: str | None = None
    nest: bool = True
    lonely_psu: str = "adjust"
    sizes: DataFrame | None = None
    totals: tuple[float, float] | None = None

    def __post_init__(self):
        if self.lonely_psu not in ("adjust", "remove", "fail"):
            raise ValueError("lonely_psu must be 'adjust', 'remove' or 'fail'")

    def with_df(self, df: DataFrame) -> SurveyDesign:
        return replace(self, df=df, sizes=None, totals=None)

    def prepare(self) -> SurveyDesign:
        """Scan the design columns once and keep the stratum sizes and overall totals.

        Worth it when several outcomes share a design: later estimates read neither again.
        """
        if self.sizes is not None:
            return self
        strata = materialise(_stratum_sizes(self))
        row = strata.agg(F.sum("__n").alias("n"), F.sum("__w").alias("w")).first()
        return replace(self, sizes=strata.select("__h", "__nh"), totals=(float(row["n"] or 0), float(row["w"] or 0.0)))

    def stratum(self) -> Column:
        return F.lit("1") if self.strata is None else F.coalesce(F.col(self.strata).cast("string"), F.lit("NA"))

    def unit(self) -> Column:
        return F.coalesce(F.col(self.psu).cast("string"), F.lit("NA"))


def _stratum_sizes(design: SurveyDesign) -> DataFrame:
    """Sampling units, rows and weight per stratum in the whole design."""
    w = F.col(design.weight).cast("double")
    counts = [F.count(F.lit(1)).alias("__n"), F.sum(w).alias("__w")]
    if design.psu is None:
        return design.df.groupBy(design.stratum().alias("__h")).agg(*counts, F.count(F.lit(1)).alias("__nh"))
    units = design.df.groupBy(design.stratum().alias("__h"), design.unit().alias("__i")).agg(*counts)
    sizes = units.groupBy("__h").agg(F.sum("__n").alias("__n"), F.sum("__w").alias("__w"), F.count(F.lit(1)).alias("__nh"))
    if not design.nest:
        # a unit seen in two strata would be split in two; refuse it instead of counting it twice
        clash = units.groupBy("__i").agg(F.count(F.lit(1)).alias("k")).agg(F.max("k")).scalar()
        sizes = sizes.withColumn(
            "__nh", F.when(clash > 1, F.raise_error(F.lit("PSU labels repeat between strata; use nest=True")).cast("bigint")).otherwise(F.col("__nh"))
        )
    return sizes


def _lonely(design: SurveyDesign):
    """What a stratum with a single PSU adds to a variance sum."""
    return {
        "adjust": lambda q: q,
        "remove": lambda q: F.lit(0.0),
        "fail": lambda q: F.raise_error(F.lit("a stratum has a single PSU")).cast("double"),
    }[design.lonely_psu]


def _domain_sums(design: SurveyDesign, y: str, by: Sequence[str]) -> DataFrame:
    """Per domain: counts, weighted sums and the three coefficients of the variance as a polynomial in the mean."""
    w, v = F.col(design.weight).cast("double"), F.col(y).cast("double")
    wv = F.when(v.isNotNull(), w)
    by = list(by)
    h = design.stratum().alias("__h")
    rows = [
        F.count(F.lit(1)).alias("n"),
        F.count(v).alias("m"),
        F.sum(w).alias("wall"),
        F.sum(wv).alias("W"),
        F.sum(w * v).alias("WY"),
        F.sum(w * v * v).alias("WYY"),
        F.sum(v).alias("Y"),
    ]
    if design.psu is None:
        strata = design.df.groupBy(*by, h).agg(
            *rows,
            F.count(F.lit(1)).alias("units"),
            F.sum(wv * wv).alias("q_ww"),
            F.sum(w * v * w).alias("q_wy"),
            F.sum(w * v * w * v).alias("q_yy"),
        )
    else:
        units = design.df.groupBy(*by, h, design.unit().alias("__i")).agg(*rows)
        W, WY = F.coalesce("W", F.lit(0.0)), F.coalesce("WY", F.lit(0.0))
        strata = units.groupBy(*by, "__h").agg(
            *[F.sum(c).alias(c) for c in ("n", "m", "wall", "W", "WY", "WYY", "Y")],
            F.count(F.lit(1)).alias("units"),
            F.sum(W * W).alias("q_ww"),
            F.sum(W * WY).alias("q_wy"),
            F.sum(WY * WY).alias("q_yy"),
        )
    sizes = _stratum_sizes(design).select("__h", "__nh") if design.sizes is None else design.sizes
    strata = strata.join(sizes, "__h")
    nh = F.col("__nh")
    f = nh / (nh - 1)
    lonely = _lonely(design)

    def part(q: str, a: str, b: str) -> Column:
        qq, sa, sb = (F.coalesce(c, F.lit(0.0)) for c in (q, a, b))
        return F.sum(F.when(nh > 1, f * (qq - sa * sb / nh)).otherwise(lonely(qq)))

    sums = [F.sum(c).alias(c) for c in ("n", "m", "wall", "W", "WY", "WYY", "Y", "units")]
    sums += [
        F.count(F.lit(1)).alias("strata"),
        part("q_yy", "WY", "WY").alias("A"),
        part("q_wy", "W", "WY").alias("B"),
        part("q_ww", "W", "W").alias("C"),
    ]
    return strata.groupBy(*by).agg(*sums)


def _estimates(sums: DataFrame, by: Sequence[str], na_rm: bool) -> DataFrame:
    p = F.col("WY") / nullif_zero("W")
    if not na_rm:
        p = F.when(F.col("m") == F.col("n"), p)
    out = sums.withColumn("p", p)
    p, W, n = F.col("p"), F.col("W"), F.col("m")
    var = F.greatest((F.col("A") - 2 * p * F.col("B") + p * p * F.col("C")) / (W * W), F.lit(0.0))
    spread = F.greatest(F.col("WYY") / W - p * p, F.lit(0.0))
    s2 = F.when(n > 1, n / (n - 1) * spread)
    srs = F.when(W > n, s2 * (W - n) / (W * n))
    # a missing mean keeps its variance missing: greatest() would skip the null
    return out.select(
        *by,
        "n",
        "m",
        "p",
        F.when(p.isNotNull(), var).alias("var"),
        F.when(p.isNotNull(), var / nullif_zero(srs)).alias("deff"),
        "W",
        "wall",
        "WYY",
        F.col("Y").alias("y"),
        "strata",
        "units",
    )


def survey_mean(design: SurveyDesign, y: str, by: Sequence[str] = (), na_rm: bool = True) -> DataFrame:
    """Hajek mean per domain with its linearised variance, standard error and design effect."""
    by = list(by)
    e = _estimates(_domain_sums(design, y, by), by, na_rm)
    return e.select(*by, "n", F.col("p").alias("mean"), "var", F.sqrt("var").alias("se"), "deff")


def design_counts(design: SurveyDesign, by: Sequence[str]) -> DataFrame:
    """Rows, strata, sampling units and degrees of freedom per domain."""
    if design.psu is None:
        s = design.df.groupBy(*by, design.stratum().alias("__h")).agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("u"))
    else:
        u = design.df.groupBy(*by, design.stratum().alias("__h"), design.unit().alias("__i")).agg(F.count(F.lit(1)).alias("n"))
        s = u.groupBy(*by, "__h").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("u"))
    out = s.groupBy(*by).agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("strata"), F.sum("u").alias("UPMs"))
    return out.withColumn("grados", F.col("UPMs") - F.col("strata"))


def unweighted_counts(df: DataFrame, y: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("y"))


def cv_percent(p: Column, se: Column) -> Column:
    return 100 * se / nullif_zero(p)


def cv_log(p: Column, se: Column) -> Column:
    """CV of the log-scale proportion, taken on the smaller side; null at 0 and 1."""
    inside = (p > 0) & (p < 1)
    low = 100 * se / nullif_zero(-p * F.log(F.when(inside, p)))
    high = 100 * se / nullif_zero(-(1 - p) * F.log(F.when(inside, 1 - p)))
    return F.when(p <= 0.5, low).otherwise(high)


def logit_interval(p: str | Column, se: str | Column, alpha: float = 0.05, df: str | Column | None = None) -> tuple[Column, Column]:
    """Interval built on the logit scale, normal or Student with ``df`` degrees of freedom; null at 0 and 1."""
    pc, sc = as_column(p), as_column(se)
    q = F.lit(normal_quantile(1 - alpha / 2)) if df is None else t_quantile_column(1 - alpha / 2, df)
    half = q * sc / nullif_zero(pc * (1 - pc))
    centre = logit(pc)
    return inv_logit(centre - half), inv_logit(centre + half)


def srs_reference_variance(design: SurveyDesign, y: str, by: Sequence[str]) -> DataFrame:
    """Reference variance of the quality criteria: simple random sampling from the whole survey."""
    w, v = F.col(design.weight).cast("double"), F.col(y).cast("double")
    design = design.prepare()
    d = design.df.groupBy(*by).agg(
        F.sum(w).alias("Nd"), F.sum(F.when(v.isNotNull(), w)).alias("W"), F.sum(w * v).alias("WY"), F.sum(w * v * v).alias("WYY")
    )
    return d.select(*by, _reference(design.totals).alias("vari"))


def _reference(totals: tuple[float, float], nd: str = "Nd", w: str = "W", wy: str = "WY", wyy: str = "WYY") -> Column:
    n, total = totals
    factor = (1 - n / total) * (total * total / n) / (total - 1) if n > 0 and total > 1 else float("nan")
    ss = F.greatest(F.col(wyy) - F.col(wy) * F.col(wy) / nullif_zero(w), F.lit(0.0)) / nullif_zero(F.col(nd) * F.col(nd))
    return F.lit(factor) * ss


def direct_estimates(
    design: SurveyDesign, y: str, by: Sequence[str], alpha: float = 0.05, interval: str = "student", strict: bool = False
) -> DataFrame:
    """Direct estimates with the quality criteria used to accept or suppress an area.

    The flag depends on the degrees of freedom only, as published; with ``strict`` any failed criterion
    suppresses the area.
    """
    by = list(by)
    design = design.prepare()
    e = _estimates(_domain_sums(design, y, by), by, True)
    e = e.withColumns(
        {
            "ee": F.sqrt("var"),
            "grados": F.col("units") - F.col("strata"),
            "__wy": F.col("p") * F.col("W"),
        }
    )
    e = e.withColumn("vari", _reference(design.totals, "wall", "W", "__wy", "WYY"))
    p, se = F.col("p"), F.col("ee")
    low, high = logit_interval(p, se, alpha, "grados" if interval == "student" else None)
    e = e.withColumns({"deff": F.col("var") / nullif_zero("vari"), "LI": low, "LS": high, "CV": cv_percent(p, se), "CVl": cv_log(p, se)})
    e = e.withColumns(
        {
            "n_eff": F.col("n") / nullif_zero("deff"),
            "UPMs": F.col("units"),
            "Inclusion_GL": (F.col("grados") >= 3).cast("int"),
            "Exclusion_n": (F.col("n") < 5).cast("int"),
            "Exclusion_DEFF": (F.col("deff") < 1).cast("int"),
            "Exclusion_GL": (F.col("grados") <= 2).cast("int"),
        }
    )
    fails = (F.col("Exclusion_n") == 1) | (F.col("Exclusion_DEFF") == 1) | (F.col("Exclusion_GL") == 1)
    e = e.withColumn("Exclusion", fails.cast("int"))
    keep = F.lit(False) if strict else F.col("Inclusion_GL") == 1
    flag = F.when(keep, "Incluir").when(F.col("Exclusion") == 1, "Excluir").when(F.col("Exclusion") == 0, "Incluir")
    cols = "p LI LS ee CV deff n n_eff grados y CVl UPMs Inclusion_GL Exclusion_n Exclusion_DEFF Exclusion_GL Exclusion".split()
    return e.select(*by, *cols, flag.alias("Flag"))


# ---------------------------------------------------------------- weight trimming


def potter_trim(df: DataFrame, weight: str, c: float, by: Sequence[str] = (), out: str = "weight_trim") -> DataFrame:
    """Cap weights at sqrt(c * mean squared weight) and rescale to the original total."""
    w = F.col(weight).cast("double")
    if not by:
        cap = F.sqrt(F.lit(float(c)) * df.agg(F.avg(w * w)).scalar())
        cut = df.withColumn(out, F.least(w, cap))
        sums = cut.agg(F.struct(F.sum(w).alias("w"), F.sum(out).alias("t")).alias("s")).scalar()
        return cut.withColumn(out, F.col(out) * sums.getField("w") / sums.getField("t"))
    caps = df.groupBy(*by).agg(F.sqrt(F.lit(float(c)) * F.avg(w * w)).alias("__cap"))
    cut = join_keys(df, caps, by).withColumn(out, F.least(w, F.col("__cap")))
    sums = cut.groupBy(*by).agg(F.sum(w).alias("__w"), F.sum(out).alias("__t"))
    return join_keys(cut, sums, by).withColumn(out, F.col(out) * F.col("__w") / F.col("__t")).drop("__cap", "__w", "__t")


def trim_grid(design: SurveyDesign, y: str, cs: Sequence[float]) -> DataFrame:
    """Mean squared error of the trimmed mean for each trimming constant, all in one job.

    Rows are first collapsed to distinct weights within sampling units; the constants multiply those cells.
    Rescaling the trimmed weights changes neither the mean nor its variance, so it is left out here.
    """
    w, v = F.col(design.weight).cast("double"), F.col(y).cast("double")
    squared = design.df.agg(F.avg(w * w)).scalar()
    unit = [] if design.psu is None else [design.unit().alias("__i")]
    cells = design.df.groupBy(design.stratum().alias("__h"), *unit, w.alias("__w")).agg(
        F.count(v).alias("k"), F.sum(v).alias("sy"), F.sum(v * v).alias("syy")
    )
    grid = F.array(F.lit(None).cast("double"), *[F.lit(float(c)) for c in cs])
    cells = cells.select("*", F.posexplode(grid).alias("__g", "C"))
    t = F.when(F.col("C").isNull(), F.col("__w")).otherwise(F.least("__w", F.sqrt(F.col("C") * squared)))
    cells = cells.withColumn("__t", t)
    W, WY = F.col("__t") * F.col("k"), F.col("__t") * F.col("sy")
    keys = ["__g", "C", "__h"]
    if design.psu is None:
        strata = cells.groupBy(*keys).agg(
            F.sum(W).alias("W"),
            F.sum(WY).alias("WY"),
            F.sum(F.col("__t") * W).alias("q_ww"),
            F.sum(F.col("__t") * WY).alias("q_wy"),
            F.sum(F.col("__t") * F.col("__t") * F.col("syy")).alias("q_yy"),
        )
    else:
        units = cells.groupBy(*keys, "__i").agg(F.sum(W).alias("W"), F.sum(WY).alias("WY"))
        strata = units.groupBy(*keys).agg(
            F.sum("W").alias("W"),
            F.sum("WY").alias("WY"),
            F.sum(F.col("W") * F.col("W")).alias("q_ww"),
            F.sum(F.col("W") * F.col("WY")).alias("q_wy"),
            F.sum(F.col("WY") * F.col("WY")).alias("q_yy"),
        )
    sizes = _stratum_sizes(design).select("__h", "__nh") if design.sizes is None else design.sizes
    strata = strata.join(sizes, "__h")
    nh = F.col("__nh")

    def part(q: str, a: str, b: str) -> Column:
        return F.sum(F.when(nh > 1, nh / (nh - 1) * (F.col(q) - F.col(a) * F.col(b) / nh)).otherwise(_lonely(design)(F.col(q))))

    tot = strata.groupBy("__g", "C").agg(
        F.sum("W").alias("W"), F.sum("WY").alias("WY"), part("q_yy", "WY", "WY").alias("A"), part("q_wy", "W", "WY").alias("B"), part("q_ww", "W", "W").alias("D")
    )
    p = F.col("WY") / F.col("W")
    tot = tot.select("__g", "C", p.alias("mean"), ((F.col("A") - 2 * p * F.col("B") + p * p * F.col("D")) / (F.col("W") * F.col("W"))).alias("var"))
    base = tot.filter("__g = 0").select("mean").scalar()
    return tot.filter("__g > 0").select("C", "mean", "var", (F.col("var") + F.pow(base - F.col("mean"), 2)).alias("mse"))


def trim_mse(design: SurveyDesign, y: str, c: float) -> DataFrame:
    return trim_grid(design, y, [c])


def best_trim(grid: DataFrame) -> DataFrame:
    """The constant with the smallest mean squared error."""
    return grid.agg(F.min_by("C", "mse").alias("C"), F.min("mse").alias("mse"))
