"""Content of areas by whole cells, boxes inside areas, points against edges as columns."""

import random

import pytest
from pyspark.sql import functions as F

from sitegrid.functions import geometry as G
from sitegrid.operators import spatial
from sitegrid.operators.inside import inside, with_shape
from sitegrid.schema import FEATURE, GEOMETRY

BOX = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
FORMS = [
    [BOX],
    [[(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0)]],
    [BOX, [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]],
    [[(0, 1), (2, 0), (4, 1), (3, 2), (4, 4), (1, 3), (0, 1)]],
    [[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]],
]


def feature(kind, osm_id, rings, tags):
    rings = [[{"x": float(x), "y": float(y)} for x, y in r] for r in rings]
    xs, ys = [v["x"] for r in rings for v in r], [v["y"] for r in rings for v in r]
    return ("N" if kind == "P" else "W", osm_id, None, tags, kind, rings, min(xs), min(ys), max(xs), max(ys))


@pytest.fixture(scope="module")
def areas(spark):
    rng, rows = random.Random(3), []
    for i in range(60):
        x, y, w = rng.randrange(0, 40) / 8, rng.randrange(0, 40) / 8, rng.choice([0.25, 0.5, 1.25])
        rings = [[(x + w * a, y + w * b) for a, b in r] for r in FORMS[i % len(FORMS)]]
        rows.append(feature("A", i, rings, {"sport": rng.choice(["golf", "tennis"])}))
    return with_shape(spark.createDataFrame(rows, FEATURE))


@pytest.fixture(scope="module")
def points(spark):
    rng = random.Random(4)
    kinds = [{"amenity": "telephone"}, {"amenity": "toilets", "shower": "hot"}, {"sport": "swimming"}, {"amenity": "bar", "sport": "darts"}]
    rows = [feature("P", i, [[(rng.randrange(0, 640) / 64, rng.randrange(0, 640) / 64)]], kinds[i * i % 7 % 4]) for i in range(3000)]
    return spark.createDataFrame(rows, FEATURE)


def content(areas, points, finer):
    found = inside(areas, points, areas, {"sport": "sport"}, finer=finer)
    return sorted((r.shape, r.inside_mask, r.inside_shower, r.inside_lacking, sorted(map(str, r.found))) for r in found.collect())


def test_content_by_whole_cells_equals_content_by_pairs(spark, areas, points, monkeypatch):
    monkeypatch.setattr(spatial, "CROWDED", 4)
    assert content(areas, points, True) == content(areas, points, False)
    pairs = spatial.join_points(areas.select("shape", *GEOMETRY), points.select("tags", *GEOMETRY))
    want = {r.shape: r.n for r in pairs.filter("tags['amenity'] = 'telephone'").groupBy("shape").agg(F.count("*").alias("n")).collect()}
    phones = {shape for shape, mask, *_ in content(areas, points, True) if mask & 1}
    assert phones == set(want)


def test_few_points_meet_an_area_one_by_one(spark, points, monkeypatch):
    monkeypatch.setattr(spatial, "CROWDED", 4)
    wide = spark.createDataFrame([feature("A", 1, [[(x * 2.2 + 0.3, y * 2.2 + 0.3) for x, y in BOX]], {})], FEATURE).select("osm_id", *GEOMETRY)
    places = points.selectExpr("minx AS r_x", "miny AS r_y")
    inner, edge = spatial.finer_cells(spatial.first_cells(wide, ["osm_id"]), places, ["osm_id"])
    single = edge.join(spatial.points_at(places, edge), "cell").count()
    whole = inner.join(spatial.points_at(places, inner), "cell").count()
    assert spatial.join_points(wide, points.select("osm_id", *GEOMETRY).withColumnRenamed("osm_id", "p")).count() > 2000
    assert single < 400 and whole > 1800


def test_boxes_lie_inside_and_settle_most_pairs(spark, areas):
    df = areas.withColumn("boxes", F.expr(G.inner_boxes("kind", "rings")))
    grid = "flatten(transform(sequence(1, 9), i -> transform(sequence(1, 9), j -> named_struct('x', b.x0 + (b.x1 - b.x0) * i / 10, 'y', b.y0 + (b.y1 - b.y0) * j / 10))))"
    inner = df.selectExpr("osm_id", f"{G.edges('rings')} AS e", "explode(boxes) AS b")
    assert inner.filter(f"exists({grid}, p -> {G.locate('e', 'p.x', 'p.y')} <> 1)").count() == 0
    assert inner.select("osm_id").distinct().count() >= 36
    named = areas.select("osm_id", *GEOMETRY)
    side = lambda p: spatial._shape_side(named.withColumnRenamed("osm_id", p + "id"), p, [p + "id"])
    pairs = side("l_").crossJoin(side("r_")).filter(G.boxes_overlap("l_", "r_"))
    known, meet = pairs.filter(G.inner_boxes_meet("l_", "r_")), pairs.filter(G.shapes_intersect("l_", "r_"))
    keys = lambda d: {(r.l_id, r.r_id) for r in d.select("l_id", "r_id").collect()}
    assert keys(known) <= keys(meet) and len(keys(known)) > 0.4 * len(keys(meet))
    within = pairs.filter(G.inner_box_covers("l_", "r_"))
    exact = spatial.join_shapes(named.withColumnRenamed("osm_id", "l_id"), named.withColumnRenamed("osm_id", "r_id"), strict=True)
    assert keys(within) <= keys(exact)


@pytest.mark.parametrize("strict", [False, True])
def test_edges_as_columns_equal_the_loop(spark, areas, points, strict):
    rows = areas.filter(f"size({G.edges('rings')}) <= {G.FEW_EDGES}").selectExpr(f"{G.edges('rings')} AS e", *G.edge_columns(G.edges("rings")))
    corner = areas.select(F.explode(F.flatten("rings")).alias("v")).selectExpr("v.x AS px", "v.y AS py").distinct()
    places = points.selectExpr("minx AS px", "miny AS py").limit(500).unionByName(corner)
    both = rows.crossJoin(places)
    assert both.filter(f"{G.columns_cover_point('px', 'py', strict)} <> {G.covers_point('e', 'px', 'py', strict)}").count() == 0
