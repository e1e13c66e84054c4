"""A smoothed congestion surface at several zoom levels.

Points are counted by cell of the finest grid: a partial aggregate, so a dense cell is a row per task.
A cell's Morton number interleaves the bits of its row and column; the cell that holds it at a
coarser level is the number without its last two bits a level.  One more aggregate over
(level, prefix) gives the whole pyramid from the counted cells.  A weighted stencil (binomial, a
discrete bell curve) then spreads every cell over its neighbours of the same level; weights are whole
numbers, so the surface is exact and independent of the order of addition.

Work after the first aggregate grows with the number of cells, not points.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanpulse.functions.columns import round_half_up

RESOLUTION = 0.01
LEVELS = 3
RADIUS = 2
BITS = 16  # 2 ** 16 cells of 0.01 degree span 655 degrees


def morton(x: Column, y: Column, bits: int = BITS) -> Column:
    """The bits of x and y interleaved (y's above x's)."""
    z = F.lit(0).cast("long")
    for b in range(bits):
        for j, v in ((0, x), (1, y)):
            z = z.bitwiseOR(F.shiftleft(F.shiftright(v.cast("long"), b).bitwiseAND(F.lit(1).cast("long")), 2 * b + j))
    return z


def unmorton(z: Column, which: int, bits: int = BITS) -> Column:
    """x (0) or y (1) of a Morton number."""
    v = F.lit(0).cast("long")
    for b in range(bits):
        v = v.bitwiseOR(F.shiftleft(F.shiftright(z, 2 * b + which).bitwiseAND(F.lit(1).cast("long")), b))
    return v


def pyramid(fact: DataFrame, levels: int = LEVELS, resolution: float = RESOLUTION) -> DataFrame:
    """(level, cell_x, cell_y, points, weight): cells of 2 ** level times the resolution, from one pass over the points.

    x counts from 180 degrees west, y from the south pole; points off the globe are left out.
    """
    res = F.lit(resolution)
    x, y = F.floor(F.col("longitude") / res), F.floor(F.col("latitude") / res)
    on_globe = F.col("longitude").between(-180, 180) & F.col("latitude").between(-90, 90)
    west, south = F.floor(F.lit(-180) / res), F.floor(F.lit(-90) / res)
    cells = (fact.where(on_globe).select((x - west).alias("x"), (y - south).alias("y"), "congestion_level")
             .groupBy("x", "y").agg(F.count(F.lit(1)).alias("points"), F.sum("congestion_level").cast("bigint").alias("weight")))
    coded = cells.select(morton(F.col("x"), F.col("y")).alias("z"), "points", F.coalesce("weight", F.lit(0)).alias("weight"),
                         F.explode(F.array(*(F.lit(k) for k in range(levels)))).alias("level"))
    up = coded.groupBy("level", F.expr("shiftright(z, 2 * level)").alias("prefix")).agg(
        F.sum("points").alias("points"), F.sum("weight").alias("weight"))
    return up.select("level", unmorton(F.col("prefix"), 0).alias("cell_x"), unmorton(F.col("prefix"), 1).alias("cell_y"),
                     "points", "weight")


def stencil(radius: int = RADIUS) -> list[tuple[int, int, int]]:
    """(dx, dy, weight) of a binomial bell; the weights of one side add up to 4 ** radius."""
    row = [comb(2 * radius, radius + d) for d in range(-radius, radius + 1)]
    return [(dx, dy, row[dx + radius] * row[dy + radius]) for dx in range(-radius, radius + 1) for dy in range(-radius, radius + 1)]


def heat_surface(fact: DataFrame, levels: int = LEVELS, resolution: float = RESOLUTION, radius: int = RADIUS) -> DataFrame:
    """(level, cell_x, cell_y, points, heat, cell_latitude, cell_longitude): smoothed congestion weight per cell.

    Cells without points that a neighbour's heat reaches are in the surface with no points.
    """
    moves = F.array(*(F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy"), F.lit(w).alias("w")) for dx, dy, w in stencil(radius)))
    spread = pyramid(fact, levels, resolution).select("level", "cell_x", "cell_y", "points", "weight", F.explode(moves).alias("m"))
    home = (F.col("m.dx") == 0) & (F.col("m.dy") == 0)
    heat = spread.groupBy("level", (F.col("cell_x") + F.col("m.dx")).alias("cell_x"), (F.col("cell_y") + F.col("m.dy")).alias("cell_y")).agg(
        F.sum(F.when(home, F.col("points")).otherwise(F.lit(0))).alias("points"),
        F.sum(F.col("weight") * F.col("m.w")).alias("raw"))
    side = F.lit(resolution) * F.expr("shiftleft(1, level)")
    total = 16 ** radius
    return heat.select("level", "cell_x", "cell_y", "points", round_half_up(F.col("raw") / F.lit(float(total)), 4).alias("heat"),
                       round_half_up((F.col("cell_y") + 0.5) * side - F.lit(90.0), 6).alias("cell_latitude"),
                       round_half_up((F.col("cell_x") + 0.5) * side - F.lit(180.0), 6).alias("cell_longitude"))
