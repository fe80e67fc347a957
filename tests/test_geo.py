"""Grid radius join and nearest-station search against a brute-force reference."""

import math
import random

import pytest

from hydromart.functions.spatial import EARTH_RADIUS_M
from hydromart.operators import geo

CO = "code_insee string, latitude double, longitude double"
ST = "code_station string, latitude_station double, longitude_station double"


def hav(a, b):
    p1, p2 = math.radians(a[0]), math.radians(b[0])
    dp, dl = p2 - p1, math.radians(b[1]) - math.radians(a[1])
    h = math.sin(dp / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * EARTH_RADIUS_M * math.asin(math.sqrt(min(1.0, h)))


def brute(communes, stations, r):
    near = {s for s, *sp in stations if sp[0] is not None and sp[1] is not None
            and any(hav(cp, sp) <= r for _, *cp in communes)}
    lonely = [(c, cp) for c, *cp in communes
              if not any(sp[0] is not None and hav(cp, sp) <= r for _, *sp in stations)]
    nearest = {}
    for c, cp in lonely:
        cands = [(hav(cp, sp), s) for s, *sp in stations if sp[0] is not None]
        if cands:
            nearest[c] = min(cands)[1]
    return near, nearest


@pytest.mark.parametrize("seed,spread,r", [(1, 2.0, 15000.0), (2, 0.5, 15000.0), (3, 60.0, 200000.0)])
def test_grid_matches_brute_force(spark, seed, spread, r):
    rnd = random.Random(seed)
    communes = [(f"c{i}", 46 + rnd.uniform(-spread, spread), 2 + rnd.uniform(-spread, spread)) for i in range(60)]
    stations = [(f"s{i}", 46 + rnd.uniform(-spread, spread), 2 + rnd.uniform(-spread, spread)) for i in range(80)]
    co, st = spark.createDataFrame(communes, CO), spark.createDataFrame(stations, ST)
    near, nearest = brute(communes, stations, r)
    assert {x.code_station for x in geo.stations_near(co, st, r).collect()} == near
    lonely = geo.communes_without_station(co, st, r)
    got = {x.code_insee: x.code_station for x in geo.nearest_station(lonely, st, r).collect()}
    assert got == nearest
    rel = [x.code_station for x in geo.relevant_stations(co, st, r).collect()]
    assert rel == sorted(near | set(nearest.values()))


def test_poles_and_antimeridian(spark):
    communes = [("n", 89.99, 10.0), ("w", 0.0, 179.99), ("s", -89.95, -170.0)]
    stations = [("sn", 89.99, -170.0), ("se", 0.0, -179.99), ("far", 45.0, 0.0)]
    co, st = spark.createDataFrame(communes, CO), spark.createDataFrame(stations, ST)
    near, nearest = brute(communes, stations, 15000.0)
    assert {x.code_station for x in geo.stations_near(co, st).collect()} == near == {"sn", "se"}
    got = {x.code_insee: x.code_station for x in geo.nearest_station(geo.communes_without_station(co, st), st).collect()}
    assert got == nearest


def test_exactly_one_several_none_and_missing_coordinates(spark):
    communes = [("one", 45.0, 1.0), ("many", 48.0, 2.0), ("none", 43.0, 6.0)]
    stations = [("a", 45.05, 1.0), ("b", 48.01, 2.0), ("c", 47.99, 2.01), ("d", 44.0, 6.0), ("x", None, None)]
    co, st = spark.createDataFrame(communes, CO), spark.createDataFrame(stations, ST)
    assert {x.code_station for x in geo.stations_near(co, st).collect()} == {"a", "b", "c"}
    fallback = geo.nearest_station(geo.communes_without_station(co, st), st).collect()
    assert [(x.code_insee, x.code_station) for x in fallback] == [("none", "d")]


def test_nearest_tie_broken_by_code(spark):
    co = spark.createDataFrame([("c", 45.0, 1.0)], CO)
    st = spark.createDataFrame([("z", 46.0, 1.0), ("y", 44.0, 1.0)], ST)
    # equal latitude offsets north/south are equal distances only on a sphere with symmetric rounding
    got = geo.nearest_station(co, st).first()
    assert got.code_station == min(("z", hav((45.0, 1.0), (46.0, 1.0))), ("y", hav((45.0, 1.0), (44.0, 1.0))),
                                   key=lambda t: (t[1], t[0]))[0]


def test_count_check(spark):
    st = spark.createDataFrame([(str(i),) for i in range(5)], "code_station string")
    assert geo.station_count_check(st, 1, 10, 5).first().status == "ok"
    assert geo.station_count_check(st, 1, 10, 6).first().status == "warning"
    assert geo.station_count_check(st, 6, 10).first().status == "error"


def test_far_commune_jumps_levels_and_stays_exact(spark):
    rnd = random.Random(3)
    stations = [(f"s{i}", 45 + rnd.uniform(0, 1), 2 + rnd.uniform(0, 1)) for i in range(200)] + \
               [("far", -40.0, 100.0), ("mid", 10.0, 20.0)]
    communes = [("desert", 0.0, 0.0), ("pole", -89.0, 0.0), ("city", 45.5, 2.5)]
    co, st = spark.createDataFrame(communes, CO), spark.createDataFrame(stations, ST)
    _, nearest = brute(communes, stations, 0.0)  # radius 0: every commune uses the fallback
    got = {x.code_insee: x.code_station for x in geo.nearest_station(co, st, 15000.0).collect()}
    assert got == nearest


def test_a_dense_neighbourhood_is_not_paired_whole(spark, monkeypatch):
    """Stations and communes of one crowded cube used to be paired all with all."""
    rnd = random.Random(7)
    stations = [(f"s{i:04d}", 46.5 + rnd.uniform(0, 0.1), 2.5 + rnd.uniform(0, 0.1)) for i in range(1500)]
    communes = [(f"c{i}", 46.2 + rnd.uniform(0, 0.1), 2.5 + rnd.uniform(0, 0.1)) for i in range(60)]
    communes += [(f"d{i}", *communes[0][1:]) for i in range(300)]
    tested, descend = [], geo.nearest_in_tree

    def counted(*args, **kw):
        found = descend(*args, **kw)
        tested.append(sum(r.n_tested for r in found.select("n_tested").collect()))
        return found
    monkeypatch.setattr(geo, "nearest_in_tree", counted)
    co, st = spark.createDataFrame(communes, CO), spark.createDataFrame(stations, ST)
    got = {x.code_insee: x.code_station for x in geo.nearest_station(co, st).collect()}
    assert got == {c: min((hav(p, q), s) for s, *q in stations)[1] for c, *p in communes}
    assert tested[0] < 0.1 * 60 * len(stations)


def test_relevant_stations_descend_once_per_place(spark, monkeypatch):
    rnd = random.Random(8)
    stations = [(f"s{i:04d}", 46.5 + rnd.uniform(0, 0.1), 2.5 + rnd.uniform(0, 0.1)) for i in range(800)]
    communes = [(f"c{i}", 46.2 + rnd.uniform(0, 0.05), 2.5) for i in range(20)] + [(f"d{i}", 46.2, 2.51) for i in range(400)]
    tested, descend = [], geo.nearest_in_tree

    def counted(*args, **kw):
        found = descend(*args, **kw)
        tested.append(sum(r.n_tested for r in found.select("n_tested").collect()))
        return found
    monkeypatch.setattr(geo, "nearest_in_tree", counted)
    rel = geo.relevant_stations(spark.createDataFrame(communes, CO), spark.createDataFrame(stations, ST))
    near, nearest = brute(communes, stations, 15000.0)
    assert [x.code_station for x in rel.collect()] == sorted(near | set(nearest.values()))
    assert len(nearest) == 420 and tested[0] < 0.2 * 21 * len(stations)


def test_codes_that_are_null_and_coordinates_that_are_no_numbers(spark):
    nan = float("nan")
    stations = [("b", 46.0, 2.0), (None, 46.0, 2.0), ("c", 40.0, 2.0), ("a", nan, 2.0)]
    communes = [("x", 45.0, 2.0), ("y", 40.5, 2.0), (None, 40.1, 2.0), ("odd", nan, 1.0), ("z", None, 1.0)]
    co, st = spark.createDataFrame(communes, CO), spark.createDataFrame(stations, ST)
    got = {r.code_insee: (r.code_station, round(r.distance_m)) for r in geo.nearest_station(co, st).collect()}
    half = round(math.pi * EARTH_RADIUS_M)
    assert got == {"x": (None, 111195), "y": ("c", 55598), None: ("c", 11120), "odd": (None, half)}
    only = spark.createDataFrame(stations[3:], ST)
    assert {r.code_insee: r.code_station for r in geo.nearest_station(co, only).collect()} == dict.fromkeys(["x", "y", None, "odd"], "a")
    assert geo.nearest_station(co, st.limit(0)).collect() == []
