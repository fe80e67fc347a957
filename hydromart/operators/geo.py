"""Radius and nearest-neighbour station selection without a cross join (JN-08..10, MD-13).

Points are mapped to unit vectors and bucketed in cubes. For a search radius r (chord c):

* **fine cubes** of side c/sqrt(3): two points in the same fine cube are always within r, so
  a station sharing a fine cube with any commune is near without computing a single distance;
* **coarse cubes** of side c: any pair within r lies in the same or adjacent cubes, so the
  remaining candidates are a semi-join on (cube id) against the 27 neighbour ids with the exact
  haversine test as its condition.

Only points not settled by the fine-cube test are paired, and only with neighbours. AQE's skew
join splits a hot cube across tasks. The nearest-station fallback descends through the bounding
boxes of a station tree (``nearest``), once per place: a place meets the few stations of the leaf
cubes that can hold its nearest one, however densely they stand, instead of all in a fixed cube.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hydromart.functions.spatial import chord_for_arc, grid_cell, haversine_m, neighbour_cells, unit_xyz
from hydromart.operators.nearest import nearest_in_tree, station_tree
from hydromart.session import checkpoint_dir

# Fixed value: search radius around a commune, metres.
RADIUS_M = 15000.0


def _points(df: DataFrame, id_col: str, lat: str, lon: str, prefix: str) -> DataFrame:
    return (df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull())
            .select(F.col(id_col).alias(f"{prefix}id"), F.col(lat).alias(f"{prefix}lat"),
                    F.col(lon).alias(f"{prefix}lon")))


def _on_sphere(points: DataFrame, prefix: str) -> DataFrame:
    """The points whose coordinates are finite numbers."""
    x, y, z = unit_xyz(f"{prefix}lat", f"{prefix}lon")
    return points.where(~F.isnan(x + y + z))


def _hit_within(a: DataFrame, b: DataFrame, side: float, radius_m: float) -> DataFrame:
    """Rows of ``a`` with a ``b`` point within the radius: a semi-join on the 27 cubes around ``b``
    that stops at the first hit, so candidate pairs are tested but never written out."""
    ac = a.withColumn("_cell", grid_cell("a_lat", "a_lon", side))
    bc = b.select("b_lat", "b_lon", F.explode(neighbour_cells(grid_cell("b_lat", "b_lon", side))).alias("_b_cell"))
    near = haversine_m("a_lat", "a_lon", "b_lat", "b_lon") <= radius_m
    return ac.join(bc, (F.col("_cell") == F.col("_b_cell")) & near, "left_semi").drop("_cell")


def _share_fine_cell(x: DataFrame, xp: str, y: DataFrame, yp: str, chord: float) -> DataFrame:
    """Rows of ``x`` whose fine cube also holds a point of ``y`` (within r by construction)."""
    fine = chord / math.sqrt(3.0) * (1 - 1e-12)
    yc = y.select(grid_cell(f"{yp}lat", f"{yp}lon", fine).alias("_fine")).distinct()
    return x.withColumn("_fine", grid_cell(f"{xp}lat", f"{xp}lon", fine)).join(yc, "_fine", "left_semi").drop("_fine")


def covered(targets: DataFrame, sources: DataFrame, radius_m: float = RADIUS_M) -> DataFrame:
    """Rows of ``targets`` (prefix ``a_``) with at least one ``sources`` point (prefix ``b_``) within r."""
    chord = chord_for_arc(radius_m)
    by_cell = _share_fine_cell(targets, "a_", sources, "b_", chord)
    rest = targets.join(by_cell.select("a_id"), "a_id", "left_anti")
    return by_cell.unionByName(_hit_within(rest, sources, chord, radius_m))


def stations_near(communes: DataFrame, stations: DataFrame, radius_m: float = RADIUS_M,
                  commune_id: str = "code_insee", station_id: str = "code_station",
                  commune_lat: str = "latitude", commune_lon: str = "longitude",
                  station_lat: str = "latitude_station", station_lon: str = "longitude_station") -> DataFrame:
    """JN-08: distinct stations (with coordinates) within ``radius_m`` of at least one commune."""
    st = _points(stations, station_id, station_lat, station_lon, "a_")
    # Only existence matters on the commune side: identical coordinates collapse first.
    co = _points(communes, commune_id, commune_lat, commune_lon, "b_").select("b_lat", "b_lon").distinct() \
        .withColumn("b_id", F.lit(None).cast("string"))
    return covered(st, co, radius_m).select(F.col("a_id").alias(station_id)).distinct()


def communes_without_station(communes: DataFrame, stations: DataFrame, radius_m: float = RADIUS_M,
                             commune_id: str = "code_insee", station_id: str = "code_station",
                             commune_lat: str = "latitude", commune_lon: str = "longitude",
                             station_lat: str = "latitude_station",
                             station_lon: str = "longitude_station") -> DataFrame:
    """JN-09: communes with no station within r (NULL codes never match, unlike ``NOT IN``)."""
    co = _points(communes, commune_id, commune_lat, commune_lon, "a_").where(F.col("a_id").isNotNull())
    st = _points(stations, station_id, station_lat, station_lon, "b_").select("b_lat", "b_lon").distinct() \
        .withColumn("b_id", F.lit(None).cast("string"))
    near = covered(co, st, radius_m).select("a_id")
    return co.join(near, "a_id", "left_anti").select(
        F.col("a_id").alias(commune_id), F.col("a_lat").alias(commune_lat), F.col("a_lon").alias(commune_lon))


def nearest_station(communes: DataFrame, stations: DataFrame, radius_m: float = RADIUS_M,
                    commune_id: str = "code_insee", station_id: str = "code_station",
                    commune_lat: str = "latitude", commune_lon: str = "longitude",
                    station_lat: str = "latitude_station", station_lon: str = "longitude_station",
                    start_level: int = 0) -> DataFrame:
    """JN-10: nearest station for each commune; ties broken by station code.

    Every distinct place of the communes descends once through the boxes of a tree of the stations
    (``nearest``), so neither many communes nor many stations in one neighbourhood make more pairs
    than places times a few leaves. ``radius_m`` and ``start_level`` say that nothing lies nearer;
    the descent needs no such hint, and the answer never depends on it.
    """
    checkpoint_dir(communes.sparkSession)
    # the communes often come from a search of their own: run once, read for the places and again for the codes
    co = _points(communes, commune_id, commune_lat, commune_lon, "b_").checkpoint(eager=True)
    # as a struct a NULL code counts as a code, the smallest one
    st = _points(stations, station_id, station_lat, station_lon, "a_").withColumn("a_id", F.struct("a_id"))
    places = co.select("b_lat", "b_lon").distinct().withColumn("place", F.struct("b_lat", "b_lon"))
    tree = station_tree(_on_sphere(st, "a_"), "a_id", "a_lat", "a_lon")
    found = nearest_in_tree(_on_sphere(places, "b_"), tree, "place", "b_lat", "b_lon", "a_id")
    # coordinates that are no numbers lie as far as can be from everything: there the smallest code wins
    least = st.agg(F.min("a_id").alias("_least")).where("_least IS NOT NULL")
    nowhere = F.lit(math.nan)
    out = (co.join(found.select("place.b_lat", "place.b_lon", "a_id", "distance_m"), ["b_lat", "b_lon"], "left")
           .crossJoin(F.broadcast(least))
           .select(F.col("b_id").alias(commune_id), F.coalesce("a_id", "_least")["a_id"].alias(station_id),
                   F.coalesce("distance_m", haversine_m(nowhere, nowhere, nowhere, nowhere)).alias("distance_m")))
    # a code with several coordinates keeps the nearest of its stations
    nearest = F.min_by(F.struct(station_id, "distance_m"), F.struct("distance_m", station_id)).alias("n")
    return out.groupBy(commune_id).agg(nearest).select(commune_id, f"n.{station_id}", "n.distance_m")


def relevant_stations(communes: DataFrame, stations: DataFrame, radius_m: float = RADIUS_M,
                      **cols) -> DataFrame:
    """MD-13: stations within r of a commune ∪ the nearest station of each commune without one.

    Distinct, NULL removed, sorted (ST-02).
    """
    station_id = cols.get("station_id", "code_station")
    near = stations_near(communes, stations, radius_m, **cols)
    lonely = communes_without_station(communes, stations, radius_m, **cols)
    fallback = nearest_station(lonely, stations, radius_m, start_level=1, **cols).select(station_id)
    return (near.unionByName(fallback).distinct().where(F.col(station_id).isNotNull())
            .orderBy(station_id))


def station_count_check(stations: DataFrame, low: int, high: int, expected: int | None = None,
                        station_id: str = "code_station") -> DataFrame:
    """DQ-08: one row (n, in_range, status); status 'error' out of range, 'warning' when n differs
    from the expected reference count, else 'ok'."""
    n = stations.agg(F.count_distinct(station_id).alias("n"))
    in_range = F.col("n").between(low, high)
    status = F.when(~in_range, F.lit("error"))
    if expected is not None:
        status = status.when(F.col("n") != expected, F.lit("warning"))
    return n.select("n", in_range.alias("in_range"), status.otherwise(F.lit("ok")).alias("status"))
