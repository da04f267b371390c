"""Implicit joins of the data model: labels, positions, boxes.

The dimension tables grow with the number of sensors, so no join here forces a broadcast; Catalyst and AQE
choose one when the measured size allows it and split skewed keys otherwise.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import geo
from gaugeworks.session import cut

#: Most tiles a side that cover a box.
COVER = 8


def with_label(df: DataFrame, sensors: DataFrame) -> DataFrame:
    return df.join(sensors.select("sensor", "label"), "sensor", "left")


def with_series_key(df: DataFrame, sensors: DataFrame) -> DataFrame:
    """Partition key of a row: its ``instance`` label, else the name of its sensor."""
    named = with_label(df, sensors)
    return named.withColumn(
        "instance", F.coalesce(F.try_element_at("labels", F.lit("instance")), F.col("label")))


def with_position(df: DataFrame, positions: DataFrame, how: str = "left") -> DataFrame:
    return df.join(positions, "sensor", how)


def sensors_in_box(positions: DataFrame, box: Sequence[float]) -> DataFrame:
    """Point sensors inside ``[lat1, lng1, lat2, lng2]``."""
    lat1, lng1, lat2, lng2 = box
    return positions.where(
        geo.point_in_box(F.col("lat1"), F.col("lng1"), lat1, lng1, lat2, lng2)).select("sensor")


def geo_box(df: DataFrame, positions: DataFrame, box: Sequence[float]) -> DataFrame:
    """Readings of the point sensors inside a box."""
    return df.join(sensors_in_box(positions, box), "sensor", "left_semi")


def geo_box_cells(df: DataFrame, positions: DataFrame, box: Sequence[float],
                  contained: bool = False) -> DataFrame:
    """Readings of the cell sensors that meet a box (or lie inside it)."""
    lat1, lng1, lat2, lng2 = box
    hit = geo.cell_meets_box(F.col("lat1"), F.col("lat2"), F.col("lng1"), F.col("lng2"),
                             lat1, lng1, lat2, lng2, contained)
    return df.join(positions.where(hit).select("sensor"), "sensor", "left_semi")


def box_table(spark, boxes: Sequence[Sequence[float]], lng_first: bool = False) -> DataFrame:
    """Boxes ``[lat1, lng1, lat2, lng2]`` as a table; ``lng_first`` accepts the swapped order."""
    rows = []
    for no, (a, b, c, d) in enumerate(boxes):
        rows.append((no, float(b), float(a), float(d), float(c)) if lng_first
                    else (no, float(a), float(b), float(c), float(d)))
    return spark.createDataFrame(rows, "box int, lat1 double, lng1 double, lat2 double, lng2 double")


def boxes_of_sensors(positions: DataFrame, boxes: DataFrame) -> DataFrame:
    """(box, sensor) pairs of a box × point-sensor range join, as an equi join on map tiles.

    Each box is covered at the finest zoom at which it spans at most ``COVER`` tiles a side; sensors look their tile up at the
    zooms that occur, of which there are at most ``geo.MAX_ZOOM + 1``. No nested loop, however many boxes there are, and a
    box of the whole world is spread over many tiles.
    """
    top = geo.MAX_ZOOM
    zooms = F.sequence(F.lit(0), F.lit(top))

    def at(tile: str, zoom):
        # Tiles nest: the tile at a lower zoom is the finest one without its last bits.
        return F.call_function("shiftright", F.col(tile), F.lit(top) - zoom)

    def fits(zoom):
        return (at("x2", zoom) - at("x1", zoom) < COVER) & (at("y2", zoom) - at("y1", zoom) < COVER)

    zoom = F.col("zoom")
    corners = boxes.withColumns({
        "x1": geo.tile_x(F.col("lng1"), top), "x2": geo.tile_x(F.col("lng2"), top),
        "y1": geo.tile_y(F.col("lat2"), top), "y2": geo.tile_y(F.col("lat1"), top)})
    tiles = (corners.withColumn("zoom", F.array_max(F.filter(zooms, fits)))
             .withColumn("x", F.explode(F.sequence(at("x1", zoom), at("x2", zoom))))
             .withColumn("y", F.explode(F.sequence(at("y1", zoom), at("y2", zoom))))
             .select("box", "zoom", "x", "y", F.struct("lat1", "lng1", "lat2", "lng2").alias("b")))
    used = sorted(r[0] for r in tiles.select("zoom").distinct().collect())
    points = (positions.select("sensor", "lat1", "lng1", geo.tile_x(F.col("lng1"), top).alias("x0"),
                               geo.tile_y(F.col("lat1"), top).alias("y0"))
              .withColumn("zoom", F.explode(F.lit(used).cast("array<int>")))
              .select("sensor", "lat1", "lng1", "zoom", at("x0", zoom).alias("x"), at("y0", zoom).alias("y")))
    exact = geo.point_in_box(F.col("lat1"), F.col("lng1"), F.col("b.lat1"), F.col("b.lng1"),
                             F.col("b.lat2"), F.col("b.lng2"))
    return points.join(tiles, ["zoom", "x", "y"]).where(exact).select("box", "sensor")


def box_sweep(df: DataFrame, positions: DataFrame, boxes: DataFrame) -> DataFrame:
    """``sum(value)`` by time for each of many boxes in one job.

    Sensors with the same set of boxes are summed together first, so overlapping boxes do not multiply
    the readings. Readings are shuffled by the number of their set, the least sensor in it.
    """
    sets = cut(boxes_of_sensors(positions, boxes).groupBy("sensor")
               .agg(F.sort_array(F.collect_list("box")).alias("boxes")))
    names = sets.groupBy("boxes").agg(F.min("sensor").alias("_set"))
    numbered = sets.join(names, "boxes").select("sensor", "_set")
    return (df.join(numbered, "sensor")
            .groupBy("_set", "ts").agg(F.sum("value").alias("_sum"))
            .join(names, "_set").select(F.explode("boxes").alias("box"), "ts", "_sum")
            .groupBy("box", "ts").agg(F.sum("_sum").alias("value")))


def with_tiles(df: DataFrame, zooms: Sequence[int], lat: str = "lat", lng: str = "lng") -> DataFrame:
    """Add ``tile_x_<z>`` and ``tile_y_<z>`` for the given zoom levels."""
    cols = {}
    for z in zooms:
        cols[f"tile_x_{z}"] = geo.tile_x(F.col(lng), z)
        cols[f"tile_y_{z}"] = geo.tile_y(F.col(lat), z)
    return df.withColumns(cols)


def tile_span(zoom: int, box: Sequence[float]) -> tuple[int, int, int, int]:
    """First and last column, first and last row of the tiles of a box (latitudes first), with one tile of slack on each side, which keeps a
    filter by tiles safe against rounding at their edges."""
    lat1, lng1, lat2, lng2 = box
    n = 1 << zoom

    def tx(lng: float) -> int:
        return min(max(math.floor((lng + 180.0) / 360.0 * n), 0), n - 1)

    def ty(lat: float) -> int:
        rad = math.radians(min(max(lat, -geo.MERCATOR_LAT), geo.MERCATOR_LAT))
        merc = math.log(math.tan(rad) + 1.0 / math.cos(rad))
        return min(max(math.floor((1.0 - merc / math.pi) / 2.0 * n), 0), n - 1)

    return tx(lng1) - 1, tx(lng2) + 1, ty(lat2) - 1, ty(lat1) + 1


def tile_prefilter(df: DataFrame, zoom: int, box: Sequence[float]) -> DataFrame:
    """Box filter on a table with stored tile columns: tile range first, then the exact test."""
    lat1, lng1, lat2, lng2 = box
    x1, x2, y1, y2 = tile_span(zoom, box)
    return df.where(F.col(f"tile_x_{zoom}").between(x1, x2) & F.col(f"tile_y_{zoom}").between(y1, y2)
                    & geo.point_in_box(F.col("lat"), F.col("lng"), lat1, lng1, lat2, lng2))
