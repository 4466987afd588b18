import pytest
from pyspark.sql import functions as F

from shapes import area, box, line, point, ring, table
from sitegrid.functions import geometry as G
from sitegrid.operators.spatial import join_all
from sitegrid.schema import GEOMETRY

HOLED = [box(0, 0, 8, 8), box(2, 2, 4, 4)]
NOTCHED = [ring((0, 0), (8, 0), (8, 4), (4, 4), (4, 8), (0, 8))]


def related(spark, a, b, strict):
    left = table(spark, [a]).select(F.col("osm_id").alias("a"), *GEOMETRY)
    right = table(spark, [b]).select(F.col("osm_id").alias("b"), *GEOMETRY)
    points = right.filter("kind = 'P'")
    return join_all(left, points, right.filter("kind <> 'P'"), strict=strict).count() > 0


CASES = [
    ("point on edge", HOLED, point(2, 8, 3), True, False),
    ("point on vertex", HOLED, point(2, 8, 8), True, False),
    ("point on hole edge", HOLED, point(2, 2, 3), True, False),
    ("point in hole", HOLED, point(2, 3, 3), False, False),
    ("point inside", HOLED, point(2, 1, 1), True, True),
    ("point in notch", NOTCHED, point(2, 6, 6), False, False),
    ("equal areas", NOTCHED, area(2, *NOTCHED), True, True),
    ("corner touch", [box(0, 0, 4, 4)], area(2, box(4, 4, 6, 6)), True, False),
    ("area in hole", HOLED, area(2, box(2.5, 2.5, 3.5, 3.5)), False, False),
    ("area filling the hole", HOLED, area(2, box(2, 2, 4, 4)), True, False),
    ("area in notch", NOTCHED, area(2, box(5, 5, 7, 7)), False, False),
    ("area over notch corner", NOTCHED, area(2, box(3, 3, 5, 5)), True, False),
    ("area inside, touching", NOTCHED, area(2, box(0, 0, 4, 8)), True, True),
    ("area around", [box(0, 0, 4, 4)], area(2, box(-1, -1, 9, 9)), True, False),
    ("line through, ends outside", NOTCHED, line(2, (-1, 1), (9, 1)), True, False),
    ("line inside", NOTCHED, line(2, (1, 1), (3, 3)), True, True),
    ("line outside", NOTCHED, line(2, (5, 5), (7, 7)), False, False),
    ("line on border", NOTCHED, line(2, (0, 1), (0, 3)), True, False),
]


@pytest.mark.parametrize("name,rings,other,intersects,contains", CASES, ids=[c[0] for c in CASES])
def test_relations_of_shapes(spark, name, rings, other, intersects, contains):
    assert related(spark, area(1, *rings), other, strict=False) is intersects
    assert related(spark, area(1, *rings), other, strict=True) is contains


def test_centroid_and_inner_point(spark):
    rows = [
        area(1, box(0, 0, 8, 4)),
        area(2, *HOLED),
        area(3, *NOTCHED),
        area(4, box(0, 0, 2, 2), box(10, 10, 14, 14)),
        point(5, 3, 7),
        line(6, (0, 0), (4, 0), (4, 4)),
    ]
    df = table(spark, rows).selectExpr(
        "osm_id",
        f"{G.centroid('kind', 'rings')} AS c",
        f"{G.point_on_surface('kind', 'rings')} AS p",
        "kind",
        "rings",
    ).selectExpr(
        "osm_id",
        "c",
        "p",
        f"CASE WHEN kind = 'A' THEN {G.locate(G.edges('rings'), 'p.x', 'p.y')} END AS where",
    )
    found = {r.osm_id: r for r in df.collect()}
    assert (found[1].c.x, found[1].c.y) == (4, 2)
    # 64 at (4, 4) minus 4 at (3, 3)
    assert found[2].c.x == pytest.approx((64 * 4 - 4 * 3) / 60)
    assert found[4].c.x == pytest.approx((4 * 1 + 16 * 12) / 20)
    assert (found[5].c.x, found[5].p.y) == (3, 7)
    assert (found[6].c.x, found[6].c.y) == (3, 1)
    assert all(found[i]["where"] == 1 for i in (1, 2, 3, 4))


def test_surface_point_of_scattered_parts(spark):
    """The scan line of the whole meets no part; the line of one part is used."""
    rows = [area(1, box(0, 0, 2, 2), box(10, 10, 14, 14))]
    row = table(spark, rows).selectExpr(
        f"{G.point_on_surface('kind', 'rings')} AS p", f"{G.edges('rings')} AS e"
    ).selectExpr(f"{G.locate('e', 'p.x', 'p.y')} AS w").first()
    assert row.w == 1
