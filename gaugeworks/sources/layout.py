"""Tables clustered by place or by sensor, so that a read touches few row groups.

The index aim says what a table is read by: ``all`` orders rows along a space-filling curve over map tiles, ``swimlane`` along the curve
within each swimlane, ``sensor`` by sensor and time. The order is range-partitioned and sorted within files, and the curve is a
stored column: a box becomes a few ranges of the curve, which reach the scan as filters on its row group statistics.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeworks.functions import geo
from gaugeworks.operators.lookup import tile_span

ZOOM = 14
AIMS = {"all": ["curve", "ts"], "swimlane": ["swimlane", "curve", "ts"], "sensor": ["sensor", "ts"]}
# The masks that spread the bits of a number over every second place.
_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _spread(x: Column) -> Column:
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask))
    return x


def curve(lat: Column, lng: Column, zoom: int = ZOOM) -> Column:
    """Place of a point on the curve: the bits of its tile's row and column in turn, so that a quarter of the map is a quarter of
    the curve, at every level."""
    x, y = geo.tile_x(lng, zoom).cast("long"), geo.tile_y(lat, zoom).cast("long")
    # Names of their own keep each of the two worked out once per step.
    pair = F.transform(F.array(F.struct(x.alias("x"), y.alias("y"))), lambda p: _spread(p["x"]).bitwiseOR(F.shiftleft(_spread(p["y"]), 1)))
    return pair[0]


def box_ranges(box: Sequence[float], zoom: int = ZOOM, most: int = 32) -> list[tuple[int, int]]:
    """Ranges of the curve, both ends included, that cover a box (latitudes first): squares wholly inside it, and at the finest level
    that ``most`` ranges allow those that touch it. Neighbouring ranges are one."""
    x1, x2, y1, y2 = tile_span(zoom, box)
    level = [(0, 0, 0)]
    inside: list[tuple[int, int]] = []
    for depth in range(zoom + 1):
        size = 1 << (zoom - depth)
        edge = []
        for code, cx, cy in level:
            left, top = cx * size, cy * size
            if left > x2 or left + size - 1 < x1 or top > y2 or top + size - 1 < y1:
                continue
            if left >= x1 and left + size - 1 <= x2 and top >= y1 and top + size - 1 <= y2:
                inside.append((code * size * size, (code + 1) * size * size - 1))
            else:
                edge.append((code, cx, cy))
        if depth == zoom or len(inside) + 4 * len(edge) > most:
            inside += [(code * size * size, (code + 1) * size * size - 1) for code, _, _ in edge]
            break
        level = [(4 * code + 2 * b + a, 2 * cx + a, 2 * cy + b) for code, cx, cy in edge for b in (0, 1) for a in (0, 1)]
    merged: list[tuple[int, int]] = []
    for lo, hi in sorted(inside):
        if merged and lo <= merged[-1][1] + 1:
            merged[-1] = (merged[-1][0], max(hi, merged[-1][1]))
        else:
            merged.append((lo, hi))
    return merged


def write_clustered(df: DataFrame, path: str, aim: str = "all", zoom: int = ZOOM, mode: str = "append", **options: str) -> None:
    """Write ``df`` (with ``lat, lng`` where the aim is a place) in the order of an index aim. ``options`` go to the Parquet writer."""
    if aim not in AIMS:
        raise ValueError(f"unknown index aim {aim!r}; one of {', '.join(AIMS)}")
    order = AIMS[aim]
    rows = df.withColumn("curve", curve(F.col("lat"), F.col("lng"), zoom)) if "curve" in order else df
    rows.repartitionByRange(*order).sortWithinPartitions(*order).write.options(**options).mode(mode).parquet(path)


def in_box(df: DataFrame, box: Sequence[float], zoom: int = ZOOM) -> DataFrame:
    """Rows of a table clustered by place that lie in a box, both edges included."""
    ranges = [F.col("curve").between(lo, hi) for lo, hi in box_ranges(box, zoom)]
    lat1, lng1, lat2, lng2 = box
    return df.where(reduce(Column.__or__, ranges)).where(geo.point_in_box(F.col("lat"), F.col("lng"), lat1, lng1, lat2, lng2))
