"""Great-circle distance and 3-D grid cells (FN-19; building blocks of the radius join)."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from hydromart.functions.codes import ColumnOrName, _col

# Fixed value: mean Earth radius in metres of the spherical model used for distances.
EARTH_RADIUS_M = 6371008.8


def haversine_m(lat1: ColumnOrName, lon1: ColumnOrName, lat2: ColumnOrName, lon2: ColumnOrName) -> Column:
    """FN-19: great-circle distance in metres on a sphere (JVM expression, codegen-friendly)."""
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dp = p2 - p1
    dl = F.radians(_col(lon2)) - F.radians(_col(lon1))
    a = F.pow(F.sin(dp / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def unit_xyz(lat: ColumnOrName, lon: ColumnOrName) -> tuple[Column, Column, Column]:
    """Point on the unit sphere; straight-line (chord) distance is monotone in arc distance."""
    p, l = F.radians(_col(lat)), F.radians(_col(lon))
    return F.cos(p) * F.cos(l), F.cos(p) * F.sin(l), F.sin(p)


def chord_for_arc(radius_m: float) -> float:
    """Chord length on the unit sphere of an arc of ``radius_m`` metres."""
    return 2.0 * math.sin(min(math.pi, radius_m / EARTH_RADIUS_M) / 2.0)


def grid_cell(lat: ColumnOrName, lon: ColumnOrName, side: float | Column) -> Column:
    """Integer cube (ix, iy, iz) holding the point's unit vector, for cubes of ``side``.

    Two points within chord ``side`` of each other lie in the same or adjacent cubes, which
    makes a radius search an equi-join on cell ids (no polar or antimeridian special cases).
    ``side`` may be a column (one cube size per row).
    """
    x, y, z = unit_xyz(lat, lon)
    s = side if isinstance(side, Column) else F.lit(side)
    return F.struct(F.floor(x / s).alias("ix"), F.floor(y / s).alias("iy"), F.floor(z / s).alias("iz"))


def neighbour_cells(cell: ColumnOrName) -> Column:
    """The 27 cells (``cell`` and its neighbours) as an array of structs, for ``explode``."""
    c = _col(cell)
    offsets = F.array(F.lit(-1), F.lit(0), F.lit(1))
    return F.flatten(F.transform(offsets, lambda dx: F.flatten(F.transform(offsets, lambda dy: F.transform(
        offsets, lambda dz: F.struct((c["ix"] + dx).alias("ix"), (c["iy"] + dy).alias("iy"),
                                     (c["iz"] + dz).alias("iz")))))))
