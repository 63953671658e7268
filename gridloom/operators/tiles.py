"""Extents, tiles and what belongs to them."""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


class Extent(NamedTuple):
    xmin: float
    ymin: float
    xmax: float
    ymax: float

    @property
    def width(self) -> float:
        return self.xmax - self.xmin

    @property
    def height(self) -> float:
        return self.ymax - self.ymin

    def buffered(self, by: float) -> Extent:
        return Extent(self.xmin - by, self.ymin - by, self.xmax + by, self.ymax + by)

    def clipped(self, to: Extent) -> Extent:
        return Extent(max(self.xmin, to.xmin), max(self.ymin, to.ymin), min(self.xmax, to.xmax), min(self.ymax, to.ymax))

    def overlaps(self, other: Extent, closed: bool = True) -> bool:
        cut = self.clipped(other)
        return (cut.width >= 0 and cut.height >= 0) if closed else (cut.width > 0 and cut.height > 0)


def check_extent(e: Extent) -> Extent:
    if not all(map(math.isfinite, e)) or e.width <= 0 or e.height <= 0:
        raise ValueError("an extent needs finite corners, and width and height")
    return e


def snap(extent: Extent, cell: float, origin: tuple[float, float] = (0.0, 0.0)) -> Extent:
    """The extent grown outward to whole cells."""
    if not (math.isfinite(cell) and cell > 0 and all(map(math.isfinite, origin))):
        raise ValueError("a cell needs a positive size and a finite origin")
    check_extent(extent)
    to = lambda v, o, how: o + how((v - o) / cell) * cell
    return Extent(to(extent.xmin, origin[0], math.floor), to(extent.ymin, origin[1], math.floor), to(extent.xmax, origin[0], math.ceil), to(extent.ymax, origin[1], math.ceil))


def check_grid(cell: float, other: float, cells: int, most: int, projected: bool, unit: str = "metre") -> None:
    """Guards of a raster run: a metric projection, one cell size, bounded cells."""
    if not projected or unit.lower() not in ("metre", "meter", "m"):
        raise ValueError("a projection in metres is needed")
    if not math.isclose(cell, other, rel_tol=1e-9):
        raise ValueError("cells must be square and of one size")
    if cells > most:
        raise ValueError(f"{cells} cells, of at most {most}")


TILES = "name string, row long, col long, xmin double, ymin double, xmax double, ymax double"


def tile_grid(spark: SparkSession, extent: Extent, size: float, overlap: float, cell: float = 0.5) -> DataFrame:
    """Cores that cover the snapped extent without overlap, clipped at its upper
    sides, each with a halo: name, row, col, core and buffered corners."""
    if not (math.isfinite(size) and size > 0 and math.isfinite(overlap) and 0 <= overlap < size / 2):
        raise ValueError("tiles need a positive size, and an overlap under half of it")
    for v in (size, overlap):
        if not math.isclose(v / cell, round(v / cell), abs_tol=1e-8):
            raise ValueError("size and overlap must be whole numbers of cells")
    g = snap(extent, cell)
    rows, cols = max(1, math.ceil(g.height / size)), max(1, math.ceil(g.width / size))
    at = spark.range(rows * cols).select(F.floor(F.col("id") / cols).alias("row"), (F.col("id") % cols).alias("col"))
    core = at.select(
        F.format_string("r%03dc%03d", "row", "col").alias("name"), "row", "col", (F.lit(g.xmin) + F.col("col") * size).alias("xmin"), (F.lit(g.ymin) + F.col("row") * size).alias("ymin"),
        F.least(F.lit(g.xmin) + (F.col("col") + 1) * size, F.lit(g.xmax)).alias("xmax"), F.least(F.lit(g.ymin) + (F.col("row") + 1) * size, F.lit(g.ymax)).alias("ymax"),
    ).where("xmin < xmax and ymin < ymax")
    return core.withColumns({"bxmin": F.col("xmin") - overlap, "bymin": F.col("ymin") - overlap, "bxmax": F.col("xmax") + overlap, "bymax": F.col("ymax") + overlap})


def owned(x: Column, y: Column) -> Column:
    """Whether a tile's core holds a place; upper sides belong to the neighbour."""
    return (x >= F.col("xmin")) & (x < F.col("xmax")) & (y >= F.col("ymin")) & (y < F.col("ymax"))


def owning_tile(points: DataFrame, tiles: DataFrame, size: float, how: str = "left") -> DataFrame:
    """Points (x, y) with the name of the tile that owns them, by an equi-join on
    bins of the tiles' size."""
    span = lambda low, high: F.sequence(F.floor(F.col(low) / size), F.floor(F.col(high) / size))
    spread = tiles.select("name", "xmin", "ymin", "xmax", "ymax", F.explode(span("xmin", "xmax")).alias("tx"))
    spread = spread.withColumn("ty", F.explode(span("ymin", "ymax")))
    placed = points.withColumns({"tx": F.floor(F.col("x") / size), "ty": F.floor(F.col("y") / size)})
    test = (placed["tx"] == spread["tx"]) & (placed["ty"] == spread["ty"]) & owned(F.col("x"), F.col("y"))
    return placed.join(spread, test, how).drop("tx", "ty", "xmin", "ymin", "xmax", "ymax")


def dedupe_by_core(detections: DataFrame, tiles: DataFrame) -> DataFrame:
    """Detections (name, x, y, ...) that lie in the core of the tile that made them."""
    return detections.join(tiles.select("name", "xmin", "ymin", "xmax", "ymax"), "name").where(owned(F.col("x"), F.col("y"))).select(*detections.columns)


def tile_neighbours(tiles: DataFrame, halo: float, size: float) -> DataFrame:
    """(name, neighbour) of tiles whose core touches another's core and halo."""
    span = lambda low, high, by: F.sequence(F.floor((F.col(low) - by) / size), F.floor((F.col(high) + by) / size))
    box = ["xmin", "ymin", "xmax", "ymax"]
    spread = lambda by: tiles.select("name", *box, F.explode(span("xmin", "xmax", by)).alias("tx")).withColumn("ty", F.explode(span("ymin", "ymax", by)))
    a, b = spread(halo).alias("a"), spread(0.0).alias("b")
    c = lambda n: F.col(n)
    touch = (c("b.xmin") <= c("a.xmax") + halo) & (c("b.xmax") >= c("a.xmin") - halo) & (c("b.ymin") <= c("a.ymax") + halo) & (c("b.ymax") >= c("a.ymin") - halo)
    met = a.join(b, (c("a.tx") == c("b.tx")) & (c("a.ty") == c("b.ty")) & touch & (c("a.name") != c("b.name")))
    return met.select(c("a.name").alias("name"), c("b.name").alias("neighbour")).distinct()


def edge_strip(points: DataFrame, extent: Extent, width: float) -> DataFrame:
    """Points within ``width`` of a tile's sides, which its neighbours need."""
    inner = extent.buffered(-width)
    x, y = F.col("x"), F.col("y")
    return points.where((x < inner.xmin) | (x > inner.xmax) | (y < inner.ymin) | (y > inner.ymax))


def scopes(rows: DataFrame, groups: dict[str, list[str]], tile: str = "tile") -> DataFrame:
    """Each row once per scope it counts in: its tile, and every group of it."""
    names = F.array(F.col(tile), *[F.when(F.col(tile).isin(*members), F.lit(g)) for g, members in groups.items()])
    return rows.withColumn("scope", F.explode(F.array_compact(names)))


def assert_training_extents(extents: list[Extent], holdout: Extent) -> None:
    """Refuses extents that are not ordered or reach into the holdout."""
    for e in extents:
        if check_extent(e).overlaps(holdout, closed=False):
            raise ValueError("a training extent reaches into the holdout")


def patch_status(points: DataFrame, extent: Extent, excluded: list[tuple[str, Extent]], distances: DataFrame, buffer: float, radius: float = 1.0) -> DataFrame:
    """(pid, reason): '' where a patch of the radius is allowed, else the reason; a
    later one overrules an earlier one, but for the buffer, which comes last.
    ``distances`` are (pid, distance) to evaluation features, null if far."""
    x, y = F.col("x"), F.col("y")
    outside = (x - radius < extent.xmin) | (x + radius > extent.xmax) | (y - radius < extent.ymin) | (y + radius > extent.ymax)
    reason = F.when(outside, F.lit("outside the training tile")).otherwise(F.lit(""))
    for name, e in excluded:
        dx = F.greatest(F.lit(e.xmin) - x, F.lit(0.0), x - e.xmax)
        dy = F.greatest(F.lit(e.ymin) - y, F.lit(0.0), y - e.ymax)
        reason = F.when(F.hypot(dx, dy) < radius, F.lit(f"inside excluded tile {name}")).otherwise(reason)
    joined = points.join(distances, "pid", "left")
    close = F.coalesce(F.col("distance") < buffer + radius, F.lit(False))
    return joined.withColumn("reason", reason).select("pid", F.when((F.col("reason") == "") & close, F.lit("near an evaluation feature")).otherwise(F.col("reason")).alias("reason"))
