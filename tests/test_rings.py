"""Rings from open ways: against a walk along the ways, and one ring of very many ways."""

import random

import pytest

from sitegrid.schema import RAW_NODE, RAW_RELATION, RAW_WAY
from sitegrid.sources.assembly import multipolygon_geometry


def walk(paths):
    """{way: path} joined end to end, least way first; None if an end stays loose."""
    left, rings = dict(sorted(paths.items())), []
    while left:
        ring = list(left.pop(next(iter(left))))
        while ring[0] != ring[-1]:
            way = next((w for w, p in left.items() if ring[-1] in (p[0], p[-1])), None)
            if way is None:
                return None
            path = left.pop(way)
            ring += path[1:] if path[0] == ring[-1] else path[-2::-1]
        rings.append(ring)
    return rings


def edges(rings):
    """Edges that bound the area: those met an odd number of times."""
    odd = set()
    for ring in rings:
        for edge in zip(ring, ring[1:]):
            odd ^= {frozenset(edge)}
    return odd


def place(node):
    return float(node % 50), float(node // 50)


def raw(spark, relations):
    """{relation: {way: [nodes]}} as raw tables; ways of None are not there."""
    ways = {w: n for r in relations.values() for w, n in r.items() if n}
    nodes = {n for path in ways.values() for n in path}
    return (
        spark.createDataFrame(
            [(i, None, {}, [("w", w, "") for w in r] + [("n", 1, "")]) for i, r in relations.items()], RAW_RELATION
        ),
        spark.createDataFrame([(w, None, {}, path) for w, path in ways.items()], RAW_WAY),
        spark.createDataFrame([(n, None, {}, *place(n)) for n in nodes], RAW_NODE),
    )


def rings_of(spark, relations):
    found = multipolygon_geometry(*raw(spark, relations)).collect()
    return {r["id"]: [[(v["x"], v["y"]) for v in ring] for ring in r["rings"]] for r in found}


def cut(rng, ring, ways):
    """A closed ring of nodes as ways in either direction, under ids drawn from `ways`."""
    at = sorted(rng.sample(range(len(ring)), rng.randint(2, len(ring))))
    pieces = [ring[a : b + 1] for a, b in zip(at, at[1:])] + [ring[at[-1] :] + ring[: at[0] + 1]]
    return {ways.pop(): p if rng.random() < 0.5 else p[::-1] for p in pieces}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_rings_equal_a_walk(spark, seed):
    rng, relations = random.Random(seed), {}
    ways = rng.sample(range(1, 5000), 3000)
    for i in range(40):
        nodes, members = rng.sample(range(2000), 200), {}
        for _ in range(rng.randint(1, 4)):
            ring = [nodes.pop() for _ in range(rng.randint(3, 30))]
            members |= {ways.pop(): [*ring, ring[0]]} if rng.random() < 0.3 else cut(rng, ring, ways)
        if i % 8 == 0:  # a loose end
            members[ways.pop()] = [nodes.pop(), nodes.pop()]
        if i % 8 == 1:  # a way that is not there
            members[ways.pop()] = None
        relations[i] = members
    found = rings_of(spark, relations)
    for i, members in relations.items():
        paths = {w: n and [place(p) for p in n] for w, n in members.items()}
        if None in paths.values():
            want = None
        else:
            joined = walk({w: p for w, p in paths.items() if p[0] != p[-1]})
            want = None if joined is None else joined + [p for _, p in sorted(paths.items()) if p[0] == p[-1]]
        assert found.get(i) == want, i


def test_rings_that_touch_bound_the_same_area(spark):
    rng = random.Random(3)
    relations = {}
    for i in range(20):
        # three rings through node 0, each cut there
        ways = rng.sample(range(100 * i, 100 * i + 100), 20)
        members = {}
        for k in range(3):
            a, b, c = (3 * k + j + 1 for j in range(3))
            members |= {ways.pop(): [0, a, b], ways.pop(): [0, c, b]}
        relations[i] = members
    found = rings_of(spark, relations)
    for i, members in relations.items():
        assert all(ring[0] == ring[-1] for ring in found[i])
        assert edges(found[i]) == edges([[place(n) for n in path] for path in members.values()])


def test_edge_cases(spark):
    found = rings_of(
        spark,
        {
            1: {10: [1, 2, 3], 11: [1, 2, 3]},  # one way twice: a ring without area
            2: {20: [1, 2]},
            3: {30: None},
            4: {40: [5, 6, 7, 5]},
        },
    )
    assert found == {
        1: [[place(n) for n in (1, 2, 3, 2, 1)]],
        4: [[place(n) for n in (5, 6, 7, 5)]],
    }
    assert rings_of(spark, {5: {50: None}}) == {}


def test_a_ring_of_very_many_ways_is_no_group(spark):
    n = 100_000
    nodes = spark.range(n).selectExpr("id", "CAST(NULL AS string) AS timestamp", "map('', '') AS tags", "id + 0.5D AS lon", "pmod(id * id, 97) + 0D AS lat")
    # neighbours get distant ids, every third way runs backwards
    ways = spark.range(n).selectExpr(
        "pmod(id * 7919, %d) AS id" % n,
        "CASE WHEN id %% 3 = 0 THEN array(pmod(id + 1, %d), id) ELSE array(id, pmod(id + 1, %d)) END AS nodes" % (n, n),
    )
    relation = ways.selectExpr("1L AS id", "struct('w' AS type, id AS ref, '' AS role) AS m").groupBy("id").agg({"m": "collect_list"}).toDF("id", "members")
    found = multipolygon_geometry(relation, ways, nodes)
    plan = found._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    (row,) = found.collect()
    (ring,) = row["rings"]
    xs = [v["x"] for v in ring]
    assert len(xs) == n + 1 and xs[0] == xs[-1] and set(xs) == {i + 0.5 for i in range(n)}
    assert all(abs(a - b) in (1, n - 1) for a, b in zip(xs, xs[1:]))
