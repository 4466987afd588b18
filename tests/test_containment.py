"""Containment of areas: gaps between parts, notches, holes; random parts against a point raster."""

import random

import pytest
from pyspark.sql import functions as F

import shapes as S
from shapes import area, box, line, ring, table
from sitegrid.functions import geometry as G
from sitegrid.schema import ENVELOPE


def contained(spark, pairs):
    """Whether each first area contains the second shape."""
    side = lambda rows, prefix: table(spark, [(*r[:1], k, *r[2:]) for k, r in enumerate(rows)]).selectExpr(
        "osm_id",
        f"kind AS {prefix}kind",
        f"{G.edges('rings')} AS {prefix}edges",
        f"{G.inside_points('rings')} AS {prefix}inner_points",
        *[f"{c} AS {prefix}{c}" for c in ENVELOPE],
    )
    left, right = side([a for a, _ in pairs], "l_"), side([b for _, b in pairs], "r_")
    found = left.join(right, "osm_id").select("osm_id", F.expr(G.shape_contains("l_", "r_")).alias("yes")).collect()
    return [yes for _, yes in sorted((r.osm_id, r.yes) for r in found)]


CASES = [
    ("gap between two parts", [box(0, 0, 4, 4), box(5, 0, 6, 4)], area(2, box(0, 0, 6, 4)), False),
    ("two parts within two parts", [box(0, 0, 4, 4), box(5, 0, 6, 4)], area(2, box(1, 1, 2, 2), box(5, 1, 6, 2)), True),
    ("second part outside", [box(0, 0, 4, 4), box(8, 8, 9, 9)], area(2, box(1, 1, 2, 2), box(6, 6, 7, 7)), False),
    ("notch under a straight edge", [ring((0, 0), (2, 0), (3, 2), (4, 0), (6, 0), (6, 4), (0, 4))], area(2, box(0, 0, 6, 4)), False),
    ("notch, inner above it", [ring((0, 0), (2, 0), (3, 2), (4, 0), (6, 0), (6, 4), (0, 4))], area(2, box(0, 2, 6, 4)), True),
    ("off-centre hole", [box(0, 0, 10, 10), box(7, 7, 8, 8)], area(2, box(1, 1, 9, 9)), False),
    ("hole touching the inner border", [box(0, 0, 10, 10), box(7, 7, 8, 8)], area(2, box(1, 1, 7, 7)), True),
    ("hole exactly filled", [box(0, 0, 10, 10), box(7, 7, 8, 8)], area(2, box(7, 7, 8, 8)), False),
    ("one part fills the hole", [box(0, 0, 10, 10), box(7, 7, 8, 8)], area(2, box(1, 1, 2, 2), box(7, 7, 8, 8)), False),
    ("hole within a hole", [box(0, 0, 10, 10), box(4, 4, 5, 5)], area(2, box(2, 2, 8, 8), box(3, 3, 6, 6)), True),
    ("hole and island", [box(0, 0, 10, 10), box(2, 2, 8, 8), box(4, 4, 6, 6)], area(2, box(4, 4, 6, 6)), True),
    ("equal with hole", [box(0, 0, 10, 10), box(2, 2, 8, 8)], area(2, box(0, 0, 10, 10), box(2, 2, 8, 8)), True),
    ("slanted common border", [ring((0, 0), (9, 3), (9, 9), (0, 9))], area(2, ring((3, 1), (6, 2), (6, 9))), True),
    ("slanted border, beyond", [ring((0, 0), (9, 3), (9, 9), (0, 9))], area(2, ring((3, 1), (6, 1.5), (6, 9))), False),
    ("line along a gap", [box(0, 0, 4, 4), box(5, 0, 6, 4)], line(2, (1, 0), (6, 0)), False),
    ("line through, touching the notch", [ring((0, 0), (2, 0), (3, 2), (4, 0), (6, 0), (6, 4), (0, 4))], line(2, (0, 2), (6, 2)), True),
    ("line on the border only", [box(0, 0, 4, 4)], line(2, (0, 0), (4, 0)), False),
]


def test_cases(spark):
    found = contained(spark, [(area(1, *rings), other) for _, rings, other, _ in CASES])
    assert {c[0]: f for c, f in zip(CASES, found)} == {c[0]: c[3] for c in CASES}


def random_area(rng, osm_id, n):
    """Boxes on even lattice lines that share no edge, each with a hole now and then."""
    cells = rng.sample([(x, y) for x in range(0, 12, 4) for y in range(0, 12, 4)], n)
    rings = []
    for x, y in cells:
        w, h = rng.choice([2, 3]), rng.choice([2, 3])
        rings.append(box(x, y, x + w, y + h))
        if rng.random() < 0.4:
            rings.append(box(x + 0.5, y + 0.5, x + 1.5, y + 1.5))
    return area(osm_id, *rings)


def covers_raster(a, b):
    """All raster points inside b are covered by a; the raster is finer than the lattice."""
    points = [(x / 4 + 0.125, y / 4 + 0.125) for x in range(-2, 62) for y in range(-2, 62)]
    return all(S.locate(a, x, y) for x, y in points if S.locate(b, x, y) == 1)


@pytest.mark.parametrize("seed", [1, 2])
def test_random_parts(spark, seed):
    rng = random.Random(seed)
    pairs = []
    for _ in range(60):
        a = random_area(rng, 1, rng.randrange(1, 7))
        kind = rng.random()
        if kind < 0.4:  # some rings of a itself, or all
            outer = [[(v["x"], v["y"]) for v in r] for r in a[5]]
            pairs.append((a, area(2, *rng.sample(outer, rng.randrange(1, len(outer) + 1)))))
        elif kind < 0.7:
            x, y = rng.randrange(0, 22) / 2, rng.randrange(0, 22) / 2
            pairs.append((a, area(2, box(x, y, x + rng.choice([0.5, 1, 2, 5]), y + rng.choice([0.5, 1, 3])))))
        else:
            pairs.append((a, random_area(rng, 2, rng.randrange(1, 3))))
    assert contained(spark, pairs) == [covers_raster(a, b) for a, b in pairs]
