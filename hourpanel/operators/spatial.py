"""Nearest block per sensor without comparing every pair.

A directory of cells is built over the blocks: the bounding square is cut into 4 by 4, and every cell with more than
``CELL_BLOCKS`` blocks is cut again, so that cells follow the population and no leaf is full, however many blocks
there are and however they cluster. A sensor goes down the directory with a list of cells. No block of a cell is nearer
than the near edge of its box, and every box holds a block no farther than its far corner: cells beyond the smallest
far corner known so far are dropped before the next level is opened. Only the blocks of the leaves that remain are compared.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourpanel.session import materialise

CELL_BLOCKS = 32  # points of a leaf at most
LEVELS = 15  # of 2 bits an axis: points that differ stand in different cells, down to 2**-30 of the square
ROOT = 1

_CELL = "struct<cell:bigint,near:double,leaf:boolean>"


def _square(value: Column) -> Column:
    return value * value


def _child(level: int) -> Column:
    """The cell of a point at a level, from its cell one level up."""
    shift = 2 * (LEVELS - level)
    digit = [F.shiftright(F.col(axis), shift).bitwiseAND(3) for axis in ("_y", "_x")]
    return F.col("cell") * 16 + 4 * digit[0] + digit[1]


def _boxes() -> tuple[Column, ...]:
    lat, lon = F.col("latitude"), F.col("longitude")
    return (
        F.min(lat).alias("south"), F.max(lat).alias("north"), F.min(lon).alias("west"), F.max(lon).alias("east"),
        F.count(F.lit(1)).alias("points"),
    )


def cell_directory(points: DataFrame, cell_blocks: int = CELL_BLOCKS) -> tuple[list[DataFrame], DataFrame]:
    """(nodes of every level, points with their leaf cell) over the columns latitude and longitude.

    A node has cell, parent, the box of its points, their number, and whether it is a leaf. Each level counts only the points of
    cells that are too full; counts are combined before they are shuffled.
    """
    whole = points.agg(*_boxes()).first()
    side = max(whole.north - whole.south, whole.east - whole.west) if whole.points else 0.0
    scale = (1 << (2 * LEVELS)) / side if side else 0.0

    def place(column: str, low: float) -> Column:
        return F.least(F.floor((F.col(column) - F.lit(low)) * F.lit(scale)), F.lit((1 << (2 * LEVELS)) - 1)).cast("long")

    active = points.withColumns({"cell": F.lit(ROOT).cast("long"), "_y": place("latitude", whole.south), "_x": place("longitude", whole.west)})
    if whole.points <= cell_blocks or not side:
        root = points.agg(*_boxes()).select(F.lit(ROOT).cast("long").alias("cell"), F.lit(0).cast("long").alias("parent"), "south", "north", "west", "east", "points", F.lit(True).alias("leaf"))
        return [root], active.drop("_y", "_x")
    nodes, leaves = [], []
    for level in range(1, LEVELS + 1):
        active = active.withColumn("cell", _child(level))
        leaf = F.col("points") <= cell_blocks if level < LEVELS else F.lit(True)
        found = active.groupBy("cell").agg(*_boxes()).select("cell", F.shiftright("cell", 4).alias("parent"), "south", "north", "west", "east", "points", leaf.alias("leaf"))
        nodes.append(materialise(found, "cells"))
        full = nodes[-1].filter(~F.col("leaf")).select("cell")
        leaves.append(active.join(nodes[-1].filter("leaf").select("cell"), "cell", "left_semi").drop("_y", "_x"))
        if full.isEmpty():
            break
        active = materialise(active.join(full, "cell", "left_semi"), "cell-points")
    return nodes, reduce(DataFrame.unionByName, leaves)


def _near() -> Column:
    lat, lon, zero = F.col("latitude"), F.col("longitude"), F.lit(0.0)
    dy = F.greatest(F.col("south") - lat, lat - F.col("north"), zero)
    dx = F.greatest(F.col("west") - lon, lon - F.col("east"), zero)
    return _square(dy) + _square(dx)


def _far() -> Column:
    lat, lon = F.col("latitude"), F.col("longitude")
    dy = F.greatest(F.abs(lat - F.col("south")), F.abs(lat - F.col("north")))
    dx = F.greatest(F.abs(lon - F.col("west")), F.abs(lon - F.col("east")))
    return _square(dy) + _square(dx)


def leaf_probes(sensors: DataFrame, nodes: list[DataFrame]) -> DataFrame:
    """(location_id, latitude, longitude, cell): the leaves that can hold a sensor's nearest block.

    A sensor is one row with the cells that are still open to it, a number that the geometry bounds.
    """
    where = ["location_id", "latitude", "longitude"]
    first = [r for r in nodes[0].collect() if r.points]  # 16 cells at most
    if not first:
        return sensors.select(*where, F.lit(ROOT).cast("long").alias("cell")).filter("false")
    boxes = ("cell", "south", "north", "west", "east", "leaf")
    top = F.array(*(F.struct(*(F.lit(r[n]).alias(n) for n in boxes)) for r in first))
    opened, kept = sensors.select(*where, F.lit(float("inf")).alias("reach"), F.explode(top).alias("b")).select(*where, "reach", "b.*"), None
    for depth, level in enumerate(nodes):
        met = (opened.join(level, "parent") if depth else opened).select(
            *where, F.least("reach", _far()).alias("reach"), F.struct("cell", _near().alias("near"), "leaf").cast(_CELL).alias("c")
        )
        both = met if kept is None else met.unionByName(kept)
        frontier = both.groupBy(*where).agg(F.min("reach").alias("reach"), F.collect_list("c").alias("cells"))
        frontier = frontier.withColumn("cells", F.filter("cells", lambda c: c["near"] <= F.col("reach")))
        if depth + 1 < len(nodes):
            spread = materialise(frontier, "frontier").select(*where, "reach", F.explode("cells").alias("c"))
            kept = spread.filter("c.leaf")
            opened = spread.filter("not c.leaf").select(*where, "reach", F.col("c.cell").alias("parent"))
    return frontier.select(*where, F.explode("cells").alias("c")).select(*where, "c.cell")


def block_candidates(sensors: DataFrame, blocks: DataFrame, cell_blocks: int = CELL_BLOCKS) -> DataFrame:
    """Sensor and block pairs that can be nearest, with their squared distance.

    Blocks at the same point lead with the smallest (block, area), so copies never multiply. The points are written once,
    as every level of the directory reads them.
    """
    located = sensors.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    points = materialise(
        blocks.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull()).groupBy("latitude", "longitude").agg(
            F.min(F.struct("block_id", "clue_small_area")).alias("_block")
        ),
        "block-points",
    )
    nodes, celled = cell_directory(points, cell_blocks)
    probes = leaf_probes(located.select("location_id", "latitude", "longitude"), nodes)
    targets = celled.select(
        "cell", "_block",
        F.col("latitude").alias("block_latitude"), F.col("longitude").alias("block_longitude"),
    )
    distance = _square(F.col("latitude") - F.col("block_latitude")) + _square(
        F.col("longitude") - F.col("block_longitude")
    )
    return probes.join(targets, "cell").select(
        "location_id",
        F.col("_block.block_id").alias("block_id"),
        F.col("_block.clue_small_area").alias("clue_small_area"),
        "block_latitude",
        "block_longitude",
        distance.alias("distance_sq"),
    )


MATCH_COLUMNS = ("block_id", "clue_small_area", "block_latitude", "block_longitude", "distance_sq")


def nearest_block(sensors: DataFrame, blocks: DataFrame, cell_blocks: int = CELL_BLOCKS) -> DataFrame:
    """The nearest block of every located sensor; ties go to the smallest (block, area).

    A minimum is combined before the shuffle, so no sensor's candidates meet in one place.
    """
    best = F.min(
        F.struct(
            "distance_sq", "block_id", "clue_small_area", "block_latitude", "block_longitude"
        )
    )
    found = block_candidates(sensors, blocks, cell_blocks).groupBy("location_id").agg(best.alias("_b"))
    return found.select("location_id", *(F.col(f"_b.{name}") for name in MATCH_COLUMNS))


def nearest_block_ranked(sensors: DataFrame, blocks: DataFrame, cell_blocks: int = CELL_BLOCKS) -> DataFrame:
    """Same result through a ranking window; the group limit is applied before the shuffle."""
    order = Window.partitionBy("location_id").orderBy("distance_sq", "block_id", "clue_small_area")
    return (
        block_candidates(sensors, blocks, cell_blocks)
        .withColumn("match_rank", F.row_number().over(order))
        .filter("match_rank = 1")
        .select("location_id", *MATCH_COLUMNS)
    )
