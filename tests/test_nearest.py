"""Branch-and-bound nearest search against brute force."""

import random

import pytest

from hydromart.operators import nearest
from test_geo import CO, ST, hav


def brute(communes, stations):
    places = [(s, p) for s, *p in stations if s is not None and None not in p]
    out = {}
    for c, *p in communes:
        if None not in p and places:
            best = min((hav(p, q), s) for s, q in places)
            out[c] = min(out.get(c, best), best)
    return {c: s for c, (_, s) in out.items()}


def search(spark, communes, stations):
    tree = nearest.station_tree(spark.createDataFrame(stations, ST))
    return nearest.nearest_in_tree(spark.createDataFrame(communes, CO), tree).collect()


@pytest.mark.parametrize("seed,spread", [(1, 0.3), (2, 60.0)])
def test_matches_brute_force(spark, seed, spread):
    rnd = random.Random(seed)
    point = lambda: (46 + rnd.uniform(-spread, spread) / 2, 2 + rnd.uniform(-spread, spread))
    communes = [(f"c{i}", *point()) for i in range(50)] + [("c0", *point()), ("none", None, 1.0)]
    stations = [(f"s{i}", *point()) for i in range(200)] + [("s9x", None, None), (None, 46.0, 2.0)]
    stations += [(f"t{i}", *stations[i][1:]) for i in range(5)]  # two codes at one place
    got = search(spark, communes, stations)
    assert {r.code_insee: r.code_station for r in got} == brute(communes, stations)


def test_tight_cluster_of_a_third_is_entered_at_its_near_side(spark):
    rnd = random.Random(3)
    n = 900
    stations = [(f"s{i:03d}", 45 + rnd.uniform(0, 0.002), 3 + rnd.uniform(0, 0.002)) for i in range(n // 3)]
    stations += [(f"s{i:03d}", rnd.uniform(-60, 60), rnd.uniform(-170, 170)) for i in range(n // 3, n)]
    communes = [(f"c{i}", 45 + rnd.uniform(-3, 3), 3 + rnd.uniform(-3, 3)) for i in range(60)]
    got = search(spark, communes, stations)
    assert {r.code_insee: r.code_station for r in got} == brute(communes, stations)
    assert sum(r.n_tested for r in got) < 0.1 * len(communes) * n


def test_ties_poles_antimeridian_and_empty(spark):
    stations = [("b", 10.0, 20.0), ("a", 10.0, 22.0), ("n", 90.0, 0.0), ("w", 0.0, -179.9), ("e", 0.0, 179.0)]
    communes = [("mid", 10.0, 21.0), ("pole", 89.0, 120.0), ("line", 0.0, 179.9)]
    got = {r.code_insee: r.code_station for r in search(spark, communes, stations)}
    assert got == {"mid": "a", "pole": "n", "line": "w"}
    assert search(spark, communes, []) == [] and search(spark, [], stations) == []


def test_many_stations_within_one_finest_cube(spark):
    stations = [(f"s{i:02d}", 45.0 + i * 1e-7, 3.0) for i in range(40)]  # 1 cm apart
    communes = [("c", 45.0 + 17.2e-7, 3.0), ("far", -45.0, -177.0)]
    assert {r.code_insee: r.code_station for r in search(spark, communes, stations)} == brute(communes, stations)
