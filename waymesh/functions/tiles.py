"""Web-mercator tiles of points, with the half-pixel shift of the 256-pixel grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Limits of the projection, pixels of a tile, and the deepest grid.
MAX_LAT, MAX_LON, TILE_PIXELS, MAX_ZOOM = 85.05112878, 180.0, 256, 22


def _clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def tile_xy(zoom: int, lon: Column, lat: Column) -> tuple[Column, Column]:
    """Tile column and row. Pixels are taken at x + 0.5; zooms above 22 use the grid of 22."""
    pixels = float(TILE_PIXELS << min(zoom, MAX_ZOOM))
    across = (_clip(lon.cast("double"), -MAX_LON, MAX_LON) + F.lit(180.0)) / F.lit(360.0)
    sine = F.sin(_clip(lat.cast("double"), -MAX_LAT, MAX_LAT) * F.lit(3.141592653589793) / F.lit(180.0))
    down = F.lit(0.5) - F.log((F.lit(1.0) + sine) / (F.lit(1.0) - sine)) / F.lit(4 * 3.141592653589793)
    pixel = lambda share: F.floor(_clip(share * F.lit(pixels) + F.lit(0.5), 0.0, pixels - 1)).cast("long")
    per = lambda share: F.floor(pixel(share) / F.lit(TILE_PIXELS)).cast("int")
    return per(across), per(down)


def tile_id(zoom: int, lon: Column, lat: Column) -> Column:
    x, y = tile_xy(zoom, lon, lat)
    return F.concat_ws("-", F.lit(zoom), x, y)


def tile_order(tile: Column) -> list[Column]:
    """Sort keys of tile ids: zoom ascending, column and row descending."""
    part = F.split(tile, "-")
    return [part[0].cast("int").asc(), part[1].cast("int").desc(), part[2].cast("int").desc()]
