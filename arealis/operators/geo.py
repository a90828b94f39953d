"""Class tables for maps, point-in-polygon assignment and zonal sums."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arealis.functions.codelists import CODE_LISTS, FACET_TITLES, relabel
from arealis.functions.recode import as_column
from arealis.operators.joins import attach_to_zones, complete_grid

SALTS = 8


def classify(value: str | Column, breaks: Sequence[float]) -> Column:
    """Class interval of a value: closed below and open above, the last one closed; null outside and when missing."""
    v = as_column(value)
    out = None
    last = len(breaks) - 2
    for i, (a, b) in enumerate(zip(breaks, breaks[1:])):
        inside = (v >= a) & ((v <= b) if i == last else (v < b))
        label = f"[{a:g}, {b:g}{']' if i == last else ')'}"
        out = F.when(inside, label) if out is None else out.when(inside, label)
    return out


def map_table(zones: DataFrame, estimates: DataFrame, key: str, value: str, breaks: Sequence[float], out: str = "class") -> DataFrame:
    """Every zone with its estimate and class; zones without an estimate stay."""
    return attach_to_zones(zones, estimates, key).withColumn(out, classify(value, breaks))


def facet_table(zones: DataFrame, estimates: DataFrame, area: str, row: str, col: str, value: str, breaks: Sequence[float] | None = None) -> DataFrame:
    """Completed area x row x column grid on zones, with facet labels and titles.

    Both facet variables need a code list.
    """
    for v in (row, col):
        if v not in CODE_LISTS:
            raise KeyError(f"no code list for variable {v!r}")
    grid = complete_grid(estimates, [area, row, col])
    out = zones.join(grid, area, "left").withColumns(
        {
            "Fila": relabel(row),
            "Col": relabel(col),
            "title_row": F.lit(FACET_TITLES.get(row, row)),
            "title_col": F.lit(FACET_TITLES.get(col, col)),
        }
    )
    return out if breaks is None else out.withColumn("class", classify(value, breaks))


def polygon_edges(vertices: str = "vertices") -> Column:
    v = F.col(vertices)
    shifted = F.concat(F.slice(v, 2, F.size(v)), F.slice(v, 1, 1))
    return F.zip_with(v, shifted, lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def inside_polygon(x: Column, y: Column, edges: Column) -> Column:
    """Even-odd rule; a point on an edge belongs to the polygon on its upper or right side."""

    def crosses(e: Column) -> Column:
        spans = (e["y1"] > y) != (e["y2"] > y)
        at = (e["x2"] - e["x1"]) * (y - e["y1"]) / F.when(e["y2"] != e["y1"], e["y2"] - e["y1"]) + e["x1"]
        return F.when(spans & (x < at), 1).otherwise(0)

    return F.aggregate(edges, F.lit(0), lambda acc, e: acc + crosses(e)) % 2 == 1


def points_in_zones(points: DataFrame, zones: DataFrame, zone: str, cell: float, x: str = "x", y: str = "y", vertices: str = "vertices", salts: int = SALTS) -> DataFrame:
    """Points with the zone that holds them; points in no zone are dropped.

    Zones are listed under the grid squares that their boxes touch and points under their own square, so
    the join is on equal squares.  ``cell`` should be near the usual zone width.  Zones are repeated over
    ``salts`` so that a crowded square is shared by several tasks.
    """
    xs, ys = F.transform(vertices, lambda p: p["x"]), F.transform(vertices, lambda p: p["y"])
    z = zones.select(
        zone,
        polygon_edges(vertices).alias("__edges"),
        *[f(c).alias(n) for n, f, c in (("__x0", F.array_min, xs), ("__x1", F.array_max, xs), ("__y0", F.array_min, ys), ("__y1", F.array_max, ys))],
    )
    g = F.lit(float(cell))
    z = z.withColumn("__gx", F.explode(F.sequence(F.floor(F.col("__x0") / g), F.floor(F.col("__x1") / g))))
    z = z.withColumn("__gy", F.explode(F.sequence(F.floor(F.col("__y0") / g), F.floor(F.col("__y1") / g))))
    z = z.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    p = points.withColumns(
        {"__gx": F.floor(F.col(x) / g), "__gy": F.floor(F.col(y) / g), "__salt": F.pmod(F.xxhash64(*points.columns), F.lit(salts)).cast("int")}
    )
    px, py = F.col(x), F.col(y)
    box = (px >= F.col("__x0")) & (px <= F.col("__x1")) & (py >= F.col("__y0")) & (py <= F.col("__y1"))
    j = p.join(z, ["__gx", "__gy", "__salt"]).filter(box & inside_polygon(px, py, F.col("__edges")))
    return j.select(*points.columns, zone)


def zonal_sum(pixels: DataFrame, zones: DataFrame, zone: str, bands: Sequence[str], cell: float, x: str = "x", y: str = "y", band: str = "band", value: str = "value") -> DataFrame:
    """Sum per zone and band, one column per band; null where a zone has no pixel of a band.

    Pixels are summed over dates first, so each place joins once.
    """
    places = pixels.filter(F.col(band).isin(*bands)).groupBy(x, y).agg(*[F.sum(F.when(F.col(band) == b, F.col(value))).alias(b) for b in bands])
    hit = points_in_zones(places, zones, zone, cell, x, y)
    return hit.groupBy(zone).agg(*[F.sum(b).alias(b) for b in bands])


def zonal_join(first: DataFrame, second: DataFrame, zone: str) -> DataFrame:
    """Two zonal tables side by side."""
    return first.join(second, zone, "full")
