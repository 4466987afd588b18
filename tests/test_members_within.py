"""Sites around all members of their relation: against every pair, and with very many members."""

import math
import random

import pytest
from pyspark.sql import functions as F

import shapes as S
from sitegrid.functions import geometry as G
from sitegrid.operators import relations as R
from sitegrid.schema import ENVELOPE, KEY

CAMP = {"tourism": "camp_site"}
SITE = {"type": "site", "site": "camp_site"}


def star(rng, x, y, n):
    """A ring with inlets around a place."""
    reach = [rng.uniform(0.4, 2) if i % 2 else 2 for i in range(n)]
    return S.ring(*[(x + r * math.cos(2 * math.pi * i / n), y + r * math.sin(2 * math.pi * i / n)) for i, r in enumerate(reach)])


def world(spark, seed):
    """(members, expected): relations of areas, point camps and other members in one small place."""
    rng = random.Random(seed)
    points, polys, rows, own = [], [], [], {}
    for site in range(60):
        x, y = rng.uniform(0, 5), rng.uniform(0, 5)
        rings = [star(rng, x, y, rng.choice([8, 40, 400])) for _ in range(rng.randint(1, 3))]
        # the last camp has the geometry of the first
        camps = [S.area(10 * site + i, r, tags=CAMP) for i, r in enumerate([*rings, rings[0]])]
        polys += camps
        corner = camps[0][5][0][0]
        others = []
        for _ in range(rng.choice([0, 1, 1, 2, 5])):
            place = rng.choice([(x, y), (x + rng.uniform(-0.4, 0.4), y), (corner["x"], corner["y"]), (x + 0.1, y + 0.1)])
            others.append(S.point(len(points) + len(others), *place))
        points += others
        if site % 3 == 0:
            box = S.area(10_000 + site, S.box(x - 0.1, y - 0.1, x + rng.choice([0.1, 0.6]), y + 0.1))
            polys.append(box)
            others.append(box)
        if site % 5 == 0:
            at = others[0] if others else None
            camp = S.point(50_000 + site, at[6] if at else x, at[7] if at else y, tags=CAMP)
            points.append(camp)
            camps.append(camp)
        own[site] = camps, others
        rows += [(site, r[0], r[1], SITE) for r in [*camps, *others]]
    features = S.table(spark, polys).unionByName(S.table(spark, points))
    return R.extend_members(S.members(spark, rows), features), own


def by_pairs(spark, own):
    """The same by testing each site with each member."""
    pairs = [(site, c, o) for site, (camps, others) in own.items() for c in camps if c[4] == "A" for o in others]
    side = lambda rows, p: S.table(spark, [(r[0], k, *r[2:]) for k, r in enumerate(rows)]).selectExpr(
        "osm_id",
        f"kind AS {p}kind",
        f"{G.edges('rings')} AS {p}edges",
        f"{G.inside_points('rings')} AS {p}inner_points",
        *[f"{c} AS {p}{c}" for c in ENVELOPE],
    )
    found = side([c for _, c, _ in pairs], "l_").join(side([o for *_, o in pairs], "r_"), "osm_id")
    holds = {r.osm_id: r.yes for r in found.select("osm_id", F.expr(G.shape_contains("l_", "r_")).alias("yes")).collect()}
    want = {}
    for k, (site, c, o) in enumerate(pairs):
        yes = S.locate(c, o[6], o[7]) == 1 if o[4] == "P" else holds[k]
        want[site, c[0], c[1]] = want.get((site, c[0], c[1]), True) and yes
    result = {key for key, yes in want.items() if yes}
    for site, (camps, others) in own.items():
        for c in camps:
            if c[4] == "P" and others and all(o[4] == "P" and o[6:8] == c[6:8] for o in others):
                result.add((site, c[0], c[1]))
    return result


@pytest.mark.parametrize("seed", [1, 2])
def test_random_relations_equal_all_pairs(spark, seed):
    members, own = world(spark, seed)
    found = R.all_within(members, R.relation_summary(members)).collect()
    want = by_pairs(spark, own)
    assert {(r.site_id, r.osm_type, r.osm_id) for r in found} == want
    assert 0 < len(want) < sum(len(c) for c, _ in own.values())


def test_no_members_and_no_areas(spark):
    none = R.extend_members(S.members(spark, []), S.table(spark, []))
    assert R.all_within(none, R.relation_summary(none)).count() == 0
    camp = S.table(spark, [S.area(1, S.box(0, 0, 1, 1), tags=CAMP)])
    alone = R.extend_members(S.members(spark, [(1, "W", 1, SITE)]), camp)
    assert R.all_within(alone, R.relation_summary(alone)).count() == 0


def test_a_relation_of_a_million_members(spark):
    """Forty sites around a million places: half of them leave out one place in a notch."""
    n = 1_000_000
    grid = spark.range(n).selectExpr("id", "(id % 1000) / 1000D + 0.0005D AS x", "floor(id / 1000) / 1000D + 0.0005D AS y")
    cast = lambda df: df.select(
        F.lit(7).cast("bigint").alias("site_id"), *KEY, F.lit(None).cast("map<string,string>").alias("site_tags"), "member_tags", "kind", "rings", *ENVELOPE
    )
    places = cast(
        grid.selectExpr(
            "'N' AS osm_type",
            "id AS osm_id",
            "map('amenity', 'bench') AS member_tags",
            "'P' AS kind",
            "array(array(struct(x AS x, y AS y))) AS rings",
            *[f"{c[-1]} AS {c}" for c in ENVELOPE],
        )
    )
    rows = []
    for k in range(40):
        far = 1.1 + k / 100
        dent = [(0.4999, far), (0.4999, 0.9991), (0.4991, 0.9991), (0.4991, far)] if k % 2 else []
        rows.append(S.area(k, S.ring((-0.1, -0.1), (far, -0.1), (far, far), *dent, (-0.1, far)), tags=CAMP))
    camps = cast(S.table(spark, rows).withColumnRenamed("tags", "member_tags"))
    members = places.unionByName(camps)
    found = {r.osm_id for r in R.all_within(members, R.relation_summary(members)).collect()}
    assert found == set(range(0, 40, 2))
