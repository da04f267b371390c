"""Geohash cells, altitude buckets, map tiles and boxes as Column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the public base-32 alphabet of geohash.
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"
HASH_CHARS = 6
_AXIS_BITS = HASH_CHARS * 5 // 2
_AXIS_CELLS = 1 << _AXIS_BITS

# Fixed value: latitude limit of the square Web-Mercator map.
MERCATOR_LAT = 85.05112878
MAX_ZOOM = 20


def _axis_cell(deg: Column, low: float, span: float) -> Column:
    cell = F.floor((deg - F.lit(low)) / F.lit(span) * F.lit(float(_AXIS_CELLS)))
    return F.least(F.greatest(cell, F.lit(0)), F.lit(_AXIS_CELLS - 1))


def _letters(wide_bits: int, narrow_bits: int) -> str:
    """Base-32 letters ordered by (bits of the wide axis, bits of the narrow one).

    The five bits of a letter alternate between the axes, three from one and two from the other, so one
    lookup replaces the interleaving.
    """
    out = []
    for wide in range(1 << wide_bits):
        for narrow in range(1 << narrow_bits):
            bits = [wide >> 2, narrow >> 1, (wide >> 1) & 1, narrow & 1, wide & 1]
            out.append(BASE32[sum(b << (4 - i) for i, b in enumerate(bits))])
    return "".join(out)


LETTERS = _letters(3, 2)


def geohash_encode(lat: Column, lng: Column) -> Column:
    """Six-character geohash: longitude bits on even positions, latitude bits on odd ones."""
    x, y = _axis_cell(lng, -180.0, 360.0), _axis_cell(lat, -90.0, 180.0)
    chars = []
    x_left, y_left = _AXIS_BITS, _AXIS_BITS
    for c in range(HASH_CHARS):
        x_bits, y_bits = (3, 2) if c % 2 == 0 else (2, 3)
        x_left, y_left = x_left - x_bits, y_left - y_bits
        xb = F.shiftright(x, x_left).bitwiseAND(F.lit((1 << x_bits) - 1))
        yb = F.shiftright(y, y_left).bitwiseAND(F.lit((1 << y_bits) - 1))
        wide, narrow = (xb, yb) if c % 2 == 0 else (yb, xb)
        place = (wide * F.lit(4) + narrow + F.lit(1)).cast("int")
        chars.append(F.substring(F.lit(LETTERS), place, F.lit(1)))
    return F.concat(*chars)


def geohash_decode(cell: Column) -> Column:
    """Bounds of a six-character geohash as struct ``lat1, lat2, lng1, lng2``.

    The one-element transforms give the hash and its cell numbers a name, so that they are worked out once.
    """
    cells = F.transform(F.array(cell), _axis_cells)
    return F.transform(cells, _bounds)[0]


def _axis_cells(cell: Column) -> Column:
    x, y = F.lit(0), F.lit(0)
    x_left, y_left = _AXIS_BITS, _AXIS_BITS
    for c in range(HASH_CHARS):
        x_bits, y_bits = (3, 2) if c % 2 == 0 else (2, 3)
        x_left, y_left = x_left - x_bits, y_left - y_bits
        place = F.instr(F.lit(LETTERS), F.substring(cell, c + 1, 1)) - F.lit(1)
        wide, narrow = F.shiftright(place, 2), place.bitwiseAND(F.lit(3))
        xb, yb = (wide, narrow) if c % 2 == 0 else (narrow, wide)
        x, y = x + F.shiftleft(xb, x_left), y + F.shiftleft(yb, y_left)
    return F.struct(x.alias("x"), y.alias("y"))


def _bounds(cell: Column) -> Column:
    dy, dx = 180.0 / _AXIS_CELLS, 360.0 / _AXIS_CELLS
    x, y = cell["x"], cell["y"]
    return F.struct(
        (y * F.lit(dy) - F.lit(90.0)).alias("lat1"),
        ((y + F.lit(1)) * F.lit(dy) - F.lit(90.0)).alias("lat2"),
        (x * F.lit(dx) - F.lit(180.0)).alias("lng1"),
        ((x + F.lit(1)) * F.lit(dx) - F.lit(180.0)).alias("lng2"),
    )


def altitude_bucket(alt: Column, step: int = 35) -> Column:
    """Altitude rounded and cut down to a multiple of ``step``."""
    whole = F.round(alt).cast("long")
    return ((whole - whole % F.lit(step))).cast("int")


def cell_label(lat: Column, lng: Column, alt: Column, step: int = 35) -> Column:
    """Name of a three-dimensional grid cell, ``C<geohash>Z<altitude>``."""
    return F.concat(F.lit("C"), geohash_encode(lat, lng),
                    F.lit("Z"), altitude_bucket(alt, step).cast("string"))


def parse_cell_label(label: Column) -> Column:
    """The parts of a cell name as struct ``hash, alt``."""
    pattern = "^C([0-9a-z]+)Z(-?[0-9]+)$"
    return F.struct(
        F.regexp_extract(label, pattern, 1).alias("hash"),
        F.regexp_extract(label, pattern, 2).cast("int").alias("alt"),
    )


def cell_bounds(label: Column) -> Column:
    """Bounds of a grid cell from its name."""
    return geohash_decode(F.substring(label, 2, HASH_CHARS))


def polygon_ring(lat1: Column, lat2: Column, lng1: Column, lng2: Column) -> Column:
    """Closed ring of a box, longitude first as in GeoJSON."""
    corners = [(lng1, lat1), (lng2, lat1), (lng2, lat2), (lng1, lat2), (lng1, lat1)]
    return F.array(*[F.array(x, y) for x, y in corners])


def tile_x(lng: Column, zoom: Column | int) -> Column:
    n = F.pow(F.lit(2.0), zoom if isinstance(zoom, Column) else F.lit(zoom))
    x = F.floor((lng + F.lit(180.0)) / F.lit(360.0) * n)
    return F.least(F.greatest(x, F.lit(0)), n.cast("long") - F.lit(1))


def tile_y(lat: Column, zoom: Column | int) -> Column:
    n = F.pow(F.lit(2.0), zoom if isinstance(zoom, Column) else F.lit(zoom))
    rad = F.radians(F.least(F.greatest(lat, F.lit(-MERCATOR_LAT)), F.lit(MERCATOR_LAT)))
    merc = F.log(F.tan(rad) + F.lit(1.0) / F.cos(rad))
    y = F.floor((F.lit(1.0) - merc / F.lit(math.pi)) / F.lit(2.0) * n)
    return F.least(F.greatest(y, F.lit(0)), n.cast("long") - F.lit(1))


def point_in_box(lat: Column, lng: Column, lat1, lng1, lat2, lng2) -> Column:
    """Box bounds come latitude first and are inclusive."""
    return lat.between(lat1, lat2) & lng.between(lng1, lng2)


def cell_meets_box(pos_lat1: Column, pos_lat2: Column, pos_lng1: Column, pos_lng2: Column,
                   lat1, lng1, lat2, lng2, contained: bool = False) -> Column:
    """Whether a cell overlaps a box or, with ``contained``, lies wholly inside it."""
    if contained:
        return ((pos_lat1 >= lat1) & (pos_lat2 <= lat2)
                & (pos_lng1 >= lng1) & (pos_lng2 <= lng2))
    return ((pos_lat1 <= lat2) & (pos_lat2 >= lat1)
            & (pos_lng1 <= lng2) & (pos_lng2 >= lng1))
