"""Nearest station by a descent through bounding boxes (JN-10): branch and bound instead of all candidates.

The stations form a tree of cubes on the unit sphere: every cube knows how many stations it holds
and their bounding box, and a cube of more than ``LEAF_POINTS`` distinct places is divided. A place
starts at the root. At every level it learns, from the boxes of the cubes that it still follows,
a distance within which a station certainly lies (the farthest corner of a box), and goes on only
into cubes whose box is not farther than that. Places meet stations only in the few leaf cubes that
remain, so a tight cluster holding a third of all stations, seen from afar, is entered at its near
side only.

Every level is one equi-join on the cube and one minimum per place. A cube that many places follow
has at most 512 children, and the tree is small beside the stations; AQE broadcasts a level or splits
the places of a hot cube. Results are exact: boxes only bound, distances are computed as elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hydromart.functions.spatial import haversine_m, unit_xyz
from hydromart.session import checkpoint_dir

BITS = 21  # finest cubes: 2 ** -20 of the Earth's radius, about 6 m
STEP = 3  # a cube has side 2 ** STEP times its children's
TOP = BITS // STEP
LEAF_POINTS = 16
_AXES = ("x", "y", "z")


def _placed(df: DataFrame, id_col: str, lat: str, lon: str) -> DataFrame:
    """(id, lat, lon, x, y, z) of the rows that have coordinates."""
    x, y, z = unit_xyz("lat", "lon")
    return (df.select(F.col(id_col).alias("id"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
            .where("lat IS NOT NULL AND lon IS NOT NULL").withColumns({"x": x, "y": y, "z": z}))


def _cube(axis: str, level: Column) -> Column:
    finest = F.least(F.floor((F.col(axis) + 1) * float(1 << (BITS - 1))), F.lit((1 << BITS) - 1))
    return F.call_function("shiftright", finest, (level * STEP).cast("int"))


def station_tree(stations: DataFrame, station_id: str = "code_station", lat: str = "latitude_station",
                 lon: str = "longitude_station") -> dict[str, DataFrame]:
    """``{"cubes": kept cubes with count, box and leaf flag, "leaves": stations by leaf cube}``.

    Stations at one place count once in the tree (the smallest code stands for them: it wins ties).
    """
    checkpoint_dir(stations.sparkSession)
    places = (_placed(stations, station_id, lat, lon).where("id IS NOT NULL")
              .groupBy("lat", "lon", *_AXES).agg(F.min("id").alias("id")))
    levels = F.explode(F.sequence(F.lit(0), F.lit(TOP))).alias("level")
    at = places.select("*", levels).withColumns({f"c{a}": _cube(a, F.col("level")) for a in _AXES}).checkpoint(eager=True)
    cube = ["level", *[f"c{a}" for a in _AXES]]
    boxes = [f(a).alias(f"{n}_{a}") for a in _AXES for n, f in (("low", F.min), ("high", F.max))]
    cubes = at.groupBy(*cube).agg(F.count(F.lit(1)).alias("n"), *boxes)
    cubes = cubes.withColumn("leaf", (F.col("n") <= LEAF_POINTS) | (F.col("level") == 0)).checkpoint(eager=True)
    divided = cubes.where("NOT leaf").select((F.col("level") - 1).alias("level"), *[F.col(f"c{a}").alias(f"up_{a}") for a in _AXES])
    children = cubes.withColumns({f"up_{a}": F.shiftright(f"c{a}", STEP) for a in _AXES})
    kept = children.join(divided, ["level", *[f"up_{a}" for a in _AXES]], "left_semi").unionByName(
        children.where(F.col("level") == TOP)).checkpoint(eager=True)
    leaves = at.join(kept.where("leaf").select(*cube), cube).select(*cube, "id", "lat", "lon").checkpoint(eager=True)
    return {"cubes": kept, "leaves": leaves}


def _near_and_far(prefix: str) -> tuple[Column, Column]:
    """Squared chords to the nearest and to the farthest point of a cube's box."""
    near, far = F.lit(0.0), F.lit(0.0)
    for a in _AXES:
        low, high, at = F.col(f"{prefix}low_{a}"), F.col(f"{prefix}high_{a}"), F.col(a)
        near = near + F.pow(F.greatest(low - at, at - high, F.lit(0.0)), 2)
        far = far + F.pow(F.greatest(F.abs(at - low), F.abs(at - high)), 2)
    return near, far


def nearest_in_tree(communes: DataFrame, tree: dict[str, DataFrame], commune_id: str = "code_insee", lat: str = "latitude",
                    lon: str = "longitude", station_id: str = "code_station") -> DataFrame:
    """(commune, station, distance_m, n_tested): the nearest station, ties by code, and how many were compared.

    A code with several places keeps the nearest of their stations; without any station there are no rows.
    """
    cube = ["level", *[f"c{a}" for a in _AXES]]
    place = ["id", "lat", "lon", *_AXES]
    follow = (_placed(communes, commune_id, lat, lon).distinct()
              .withColumns({"level": F.lit(TOP), **{f"c{a}": F.lit(0).cast("long") for a in _AXES},
                            "bound": F.lit(8.0), "open": F.lit(True)}))
    children = tree["cubes"].where(F.col("level") < TOP).select(
        (F.col("level") + 1).alias("u_level"), *[F.col(f"up_{a}").alias(f"u_c{a}") for a in _AXES],
        F.col("level").alias("k_level"), *[F.col(f"c{a}").alias(f"k_c{a}") for a in _AXES], F.col("leaf").alias("k_leaf"),
        *[F.col(f"{n}_{a}").alias(f"k_{n}_{a}") for a in _AXES for n in ("low", "high")])
    for level in range(TOP, 0, -1):
        here = children.where(F.col("u_level") == level)
        same = F.col("open") & (F.col("level") == F.col("u_level"))
        for a in _AXES:
            same = same & (F.col(f"c{a}") == F.col(f"u_c{a}"))
        near, far = _near_and_far("k_")
        down = follow.join(here, same, "left").withColumns({"near": F.coalesce(near, F.lit(0.0)), "far": F.coalesce(far, F.lit(8.0))})
        least = F.min("far").over(Window.partitionBy(*place))
        down = down.withColumn("bound", F.least(F.col("bound"), least))
        # a margin far above the rounding of doubles: equal distances are all kept, for the tie by code
        down = down.where(F.col("near") <= F.col("bound") * (1 + 1e-9) + 1e-15)
        moved = F.col("k_level").isNotNull()
        follow = down.select(*place, *[F.when(moved, F.col(f"k_{c}")).otherwise(F.col(c)).alias(c) for c in cube], "bound",
                             F.when(moved, ~F.col("k_leaf")).otherwise(F.col("open")).alias("open"))
    stations = tree["leaves"].select(*cube, F.col("id").alias("s_id"), F.col("lat").alias("s_lat"), F.col("lon").alias("s_lon"))
    tested = follow.join(stations, cube).withColumn("distance_m", haversine_m("s_lat", "s_lon", "lat", "lon"))
    best = F.min_by(F.struct("s_id", "distance_m"), F.struct("distance_m", "s_id")).alias("best")
    return (tested.groupBy(F.col("id").alias(commune_id)).agg(best, F.count(F.lit(1)).alias("n_tested"))
            .select(commune_id, F.col("best.s_id").alias(station_id), F.col("best.distance_m").alias("distance_m"), "n_tested"))
