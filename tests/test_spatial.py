import math
import random

import pytest
from pyspark.sql import functions as F

import shapes as S
from sitegrid.operators import spatial
from sitegrid.operators.spatial import join_all, join_points, join_shapes
from sitegrid.schema import GEOMETRY


def wobbly(rng, osm_id, cx, cy, radius, n, low=0.5):
    """A star-shaped ring on a lattice of 1/64."""
    corners = []
    for i in range(n):
        r = radius * rng.uniform(low, 1.0)
        a = 2 * math.pi * i / n
        corners.append((round((cx + r * math.cos(a)) * 64) / 64, round((cy + r * math.sin(a)) * 64) / 64))
    return S.area(osm_id, S.ring(*corners))


def layer(seed):
    """Areas of very different size, points a third of which share one place, lines."""
    rng = random.Random(seed)
    place = lambda: (rng.randrange(-640, 640) / 64, rng.randrange(-640, 640) / 64)
    areas = [
        wobbly(rng, i, *place(), rng.choice([0.05, 0.3, 2, 9]), rng.choice([4, 9, 80])) for i in range(40)
    ]
    hot = place()
    points = [S.point(i, *(hot if i % 3 == 0 else place())) for i in range(400)]
    lines = [S.line(i, place(), place()) for i in range(1000, 1015)]
    return areas, points, lines


def keyed(df, name):
    return df.select(F.concat("osm_type", "osm_id").alias(name), *GEOMETRY)


def brute(areas, others):
    return {
        (a[0] + str(a[1]), b[0] + str(b[1])) for a in areas for b in others if S.intersects(a, b)
    }


@pytest.mark.parametrize("seed,split_rows", [(1, None), (2, 20), (3, 5)])
def test_join_equals_brute_force(spark, seed, split_rows):
    areas, points, lines = layer(seed)
    left = keyed(S.table(spark, areas), "a")
    pairs = join_all(
        left,
        keyed(S.table(spark, points), "b"),
        keyed(S.table(spark, areas + lines), "b"),
        split_rows=split_rows,
    )
    found = [tuple(r) for r in pairs.collect()]
    assert len(found) == len(set(found))
    assert set(found) == brute(areas, points + areas + lines)


def test_hot_cells_are_split_without_loss(spark):
    """Half of all points in one cell: they go to several parts of it."""
    areas = [S.area(1, S.box(0, 0, 1, 1))]
    points = [S.point(i, 0.5, 0.5) for i in range(300)]
    left = keyed(S.table(spark, areas), "a")
    right = S.table(spark, points).selectExpr("osm_id AS b", "minx AS r_x", "miny AS r_y", "7L AS cell")
    cells, spread = spatial.split_hot(left.withColumn("cell", F.lit(7).cast("bigint")), right, 50)
    assert cells.count() == 6
    sizes = [r["count"] for r in spread.groupBy("part").count().collect()]
    assert sum(sizes) == 300 and len(sizes) == 6 and max(sizes) < 100
    assert join_points(left, keyed(S.table(spark, points), "b"), split_rows=50).count() == 300


def test_more_hot_cells_than_any_list_was_long(spark):
    """1,500 cells, each hot on both sides: every pair meets once and every part is small."""
    side = lambda name, n: spark.range(1500 * n).selectExpr(f"id AS {name}", "id % 1500 AS cell")
    left, right = spatial.split_hot(side("a", 20), side("b", 40), 4)
    for df, bound in ((left, 20), (right, 40)):
        assert df.groupBy("cell", "part").count().agg(F.max("count")).first()[0] < bound
    pairs = left.join(right, ["cell", "part"]).groupBy("cell").agg(F.count("*").alias("n"), F.count_distinct("a", "b").alias("d"))
    assert [tuple(r) for r in pairs.select("n", "d").distinct().collect()] == [(800, 800)]


def test_far_points_are_dropped_before_the_exchange(spark):
    areas = keyed(S.table(spark, [S.area(i, S.box(i, 0, i + 0.1, 0.1)) for i in range(5)]), "a")
    field = spatial.cell_field(areas.selectExpr("hash(a) AS cell"))
    kept = spark.range(20000).selectExpr("hash(id) AS cell").filter(spatial.may_have(field, "cell"))
    assert kept.count() < 20
    assert areas.selectExpr("hash(a) AS cell").filter(spatial.may_have(field, "cell")).count() == 5
    points = keyed(S.table(spark, [S.point(i, 50 + i / 100, 60) for i in range(400)]), "b")
    pairs = join_points(areas, points)
    assert pairs.count() == 0
    # the filter stands right above the copy to cells, below every exchange, and holds the field as a constant
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.splitlines() if "scalar-subquery" in line]
    assert any("Filter" in line and "xxhash64" in line for line in lines)



def test_large_area_is_cut_into_cells(spark):
    """A ring of many vertices is cut down to the edges near each cell."""
    rng = random.Random(5)
    big = wobbly(rng, 1, 0, 0, 30, 2000, low=0.98)
    df = S.table(spark, [big]).selectExpr(
        "osm_id",
        f"{spatial.G.edges('rings')} AS l_edges",
        *[f"{c} AS l_{c}" for c in spatial.ENVELOPE],
        f"{spatial.home_level('300')} AS l_level",
    )
    cells = spatial.area_cells(df, ["osm_id"])
    assert 1 < cells.count() <= 300
    assert cells.filter("l_edges IS NULL").count() > 0
    assert cells.agg(F.max(F.size("l_edges"))).first()[0] < 1200


def test_envelope_stage(spark):
    areas = [S.area(1, S.ring((0, 0), (8, 0), (8, 2), (2, 2), (2, 8), (0, 8)))]
    other = [S.area(2, S.box(4, 4, 6, 6))]
    left = keyed(S.table(spark, areas), "a")
    right = keyed(S.table(spark, other), "b")
    assert join_shapes(left, right, refine=False).count() == 1
    assert join_shapes(left, right).count() == 0



def test_points_near_loses_no_match(spark):
    areas, points, _ = layer(4)
    few = S.table(spark, areas[:5])
    near = spatial.points_near(S.table(spark, points), few)
    assert 0 < near.count() < len(points)
    kept = {r.osm_id for r in near.collect()}
    assert all(p[1] in kept for a in areas[:5] for p in points if S.intersects(a, p))
    assert spatial.points_near(S.table(spark, points), few.limit(0)).count() == 0


def test_clustering_keeps_all_rows(spark):
    _, points, _ = layer(6)
    assert spatial.clustered(S.table(spark, points)).count() == len(points)
