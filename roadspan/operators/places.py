"""Coordinates to places by bounding boxes of a gazetteer, found through a quadtree.

A cell that lists more boxes than CELL_BOXES is cut into four, again and again. A box that covers a cell beats all larger ones there, so these leave the
cell's list; what stays is only what a position in the cell has to be compared with. The cells
that are not cut any more do not overlap, so a position has one cell, whatever the gazetteer
holds: many boxes in one town, boxes inside boxes, boxes of all sizes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadspan.operators.scaling import BROADCAST_ROWS, materialise

UNKNOWN = "default"  # fixed value for a position outside all boxes
PLACE_FIELDS = ["town", "state", "country"]

CELL_BOXES = 32
# Cells are not cut below 2^-MAX_LEVEL degrees; only boxes that differ by less stay together there.
MAX_LEVEL = 24
# A gazetteer of no more boxes than this is cut in the driver, a larger one in tasks.
LOCAL_BOXES = 20_000
FARTHEST = 360  # degrees
TASK_LEVEL = -2  # cells of four degrees, each cut by a task of its own if the gazetteer is large
TOP_LEVEL = -9  # cells of 512 degrees: four of them hold all positions

EDGES = ["south", "north", "west", "east"]
BOX = ["area", *EDGES, *PLACE_FIELDS]
BOX_DDL = "struct<area: double, south: double, north: double, west: double, east: double, town: string, state: string, country: string>"
CELL_DDL = f"_level int, _y long, _x long, _boxes array<{BOX_DDL}>"


def cut_cell(level: int, y: int, x: int, boxes: pd.DataFrame, most: int = CELL_BOXES) -> Iterator[tuple]:
    """(level, y, x, boxes) of the cells below a cell, of 2^-level degrees, that list any box.

    Boxes are listed by area and the further fields, the smallest first; of boxes with equal
    edges only the first counts.
    """
    boxes = boxes.sort_values(BOX, kind="stable", na_position="first").drop_duplicates(EDGES).reset_index(drop=True)
    south, north, west, east = (boxes[c].to_numpy(dtype=float) for c in EDGES)
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in boxes[BOX].astype(object).itertuples(index=False)]
    open_cells = [(level, y, x, np.arange(len(boxes)))]
    while open_cells:
        level, y, x, held = open_cells.pop()
        size = 2.0**-level
        low, high, left, right = y * size, (y + 1) * size, x * size, (x + 1) * size
        held = held[(south[held] < high) & (north[held] > low) & (west[held] < right) & (east[held] > left)]
        covers = np.flatnonzero((south[held] <= low) & (north[held] >= high) & (west[held] <= left) & (east[held] >= right))
        if len(covers):
            held = held[: covers[0] + 1]
        if len(held) > most and level < MAX_LEVEL:
            open_cells += [(level + 1, 2 * y + i, 2 * x + j, held) for i in (0, 1) for j in (0, 1)]
        elif len(held):
            yield level, y, x, [rows[k] for k in held]


def _boxes(gazetteer: DataFrame) -> DataFrame:
    """Boxes with an inside, with their area."""
    area = (F.col("north") - F.col("south")) * (F.col("east") - F.col("west"))
    return gazetteer.filter("south < north and west < east").select(area.alias("area"), *EDGES, *PLACE_FIELDS)


def _roots(low, high):
    first, last = (
        F.floor(F.greatest(F.least(F.col(c), F.lit(FARTHEST)), F.lit(-FARTHEST)) * 2.0**TASK_LEVEL) for c in (low, high)
    )
    return F.explode(F.sequence(first, last))


def cells_in_tasks(boxes: DataFrame, most: int = CELL_BOXES) -> DataFrame:
    """The quadtree's cells, cells of four degrees cut in tasks of their own."""

    def cut(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        found = [(level, y, x, [dict(zip(BOX, b)) for b in held]) for level, y, x, held in cut_cell(TASK_LEVEL, int(key[0]), int(key[1]), rows, most)]
        return pd.DataFrame(found, columns=["_level", "_y", "_x", "_boxes"])

    place = F.min(F.struct(*PLACE_FIELDS)).alias("_place")
    boxes = boxes.groupBy("area", *EDGES).agg(place).select("area", *EDGES, "_place.*")
    rooted = boxes.withColumn("_ry", _roots("south", "north")).withColumn("_rx", _roots("west", "east"))
    return rooted.groupBy("_ry", "_rx").applyInPandas(cut, CELL_DDL)


def quadtree(gazetteer: DataFrame, most: int = CELL_BOXES) -> tuple[DataFrame, dict[int, int]]:
    """The cells of the tree, (_level, _y, _x, _boxes), and how many there are of each level.

    One job for a gazetteer of up to LOCAL_BOXES boxes.
    """
    spark = gazetteer.sparkSession
    boxes = _boxes(gazetteer)
    few = boxes.limit(LOCAL_BOXES + 1).collect()
    if len(few) <= LOCAL_BOXES:
        every = pd.DataFrame([tuple(b) for b in few], columns=BOX)
        cells = [c for y in (-1, 0) for x in (-1, 0) for c in cut_cell(TOP_LEVEL, y, x, every, most)]
        levels: dict[int, int] = {}
        for level, *_ in cells:
            levels[level] = levels.get(level, 0) + 1
        box = pa.struct([(c, pa.string() if c in PLACE_FIELDS else pa.float64()) for c in BOX])
        kinds = {"_level": pa.int32(), "_y": pa.int64(), "_x": pa.int64(), "_boxes": pa.list_(box)}
        columns = zip(*cells) if cells else [[]] * len(kinds)
        table = {
            name: pa.array([[dict(zip(BOX, b)) for b in held] for held in column] if name == "_boxes" else column, kind)
            for (name, kind), column in zip(kinds.items(), columns)
        }
        return spark.createDataFrame(pa.table(table)), levels
    cells = materialise(cells_in_tasks(boxes, most))
    # One row per level of the tree.
    return cells, {r["_level"]: r["count"] for r in cells.groupBy("_level").count().collect()}


def place_lookup(
    points: DataFrame,
    gazetteer: DataFrame,
    latitude: str = "latitude",
    longitude: str = "longitude",
    prefix: str = "",
    most: int = CELL_BOXES,
) -> DataFrame:
    """Add town, state and country of the smallest box that holds the position.

    Equal areas go by the edges, then the fields. A position outside all boxes, or without a
    coordinate, gets 'default'. Each point stays one row; there is one left join per level of
    the tree, and at most one of them meets. Levels with few cells go by broadcast, so that
    the points are not shuffled; a larger one is joined on the cell, where adaptive execution
    splits hot cells.
    """
    cells, levels = quadtree(gazetteer, most)
    lat, lon = F.col(latitude), F.col(longitude)
    found = []
    for level in sorted(levels):
        scale = 2.0**level
        side = cells.filter(F.col("_level") == level).select(
            F.col("_y").alias(f"_y{level}"),
            F.col("_x").alias(f"_x{level}"),
            F.col("_boxes").alias(f"_boxes{level}"),
        )
        if levels[level] * most <= BROADCAST_ROWS:
            side = F.broadcast(side)
        points = (
            points.withColumn(f"_y{level}", F.floor(lat * scale))
            .withColumn(f"_x{level}", F.floor(lon * scale))
            .join(side, [f"_y{level}", f"_x{level}"], "left")
        )
        found.append(level)
    if not found:
        return points.withColumns({prefix + f: F.lit(UNKNOWN) for f in PLACE_FIELDS})
    points = points.withColumn("_near", F.coalesce(*[F.col(f"_boxes{level}") for level in found]))
    holds = F.filter(
        "_near", lambda b: (lat >= b.south) & (lat < b.north) & (lon >= b.west) & (lon < b.east)
    )
    points = points.withColumn("_best", F.get(holds, 0)).withColumns(
        {prefix + f: F.coalesce(F.col(f"_best.{f}"), F.lit(UNKNOWN)) for f in PLACE_FIELDS}
    )
    helper = [c for level in found for c in (f"_y{level}", f"_x{level}", f"_boxes{level}")]
    return points.drop("_best", "_near", *helper)
