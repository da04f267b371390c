"""Oracle texts for geohash and map tiles."""

BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"


def sql_axis(deg: str, low: float, span: float) -> str:
    return f"CAST(least(greatest(floor(({deg} - ({low})) / {span} * 32768), 0), 32767) AS BIGINT)"


def sql_geohash(lat: str, lng: str) -> str:
    """Six characters from the bits of both axes, longitude first."""
    axes = (sql_axis(lng, -180.0, 360.0), sql_axis(lat, -90.0, 180.0))
    chars = []
    for c in range(6):
        bits = [f"((({axes[n % 2]}) // {1 << (14 - n // 2)}) % 2) * {1 << (4 - n % 5)}"
                for n in range(5 * c, 5 * c + 5)]
        chars.append(f"substr('{BASE32}', CAST({' + '.join(bits)} + 1 AS INTEGER), 1)")
    return " || ".join(chars)


def sql_bounds(deg: str, low: float, span: float) -> tuple[str, str]:
    """Lower and upper edge of the cell of a degree value on one axis."""
    cell, step = sql_axis(deg, low, span), span / 32768
    return (f"({cell} * CAST({step!r} AS DOUBLE) + CAST({low} AS DOUBLE))",
            f"(({cell} + 1) * CAST({step!r} AS DOUBLE) + CAST({low} AS DOUBLE))")


def sql_decode(lat: str, lng: str) -> str:
    a, b = sql_bounds(lat, -90.0, 180.0)
    c, d = sql_bounds(lng, -180.0, 360.0)
    return f"{a} AS lat1, {b} AS lat2, {c} AS lng1, {d} AS lng2"


def sql_tile_x(lng: str, z: int) -> str:
    return f"CAST(floor(({lng} + 180.0) / 360.0 * {1 << z}) AS BIGINT)"


def sql_tile_y(lat: str, z: int) -> str:
    rad = f"radians({lat})"
    return (f"CAST(floor((1.0 - ln(tan({rad}) + 1.0 / cos({rad})) / pi()) / 2.0 * {1 << z}) AS BIGINT)")
