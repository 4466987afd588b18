"""Small hand-made features, and brute-force geometry to compare with."""

from datetime import datetime

from sitegrid.schema import FEATURE, SITE_MEMBER

STAMP = datetime(2020, 1, 1)


def ring(*corners):
    return [(float(x), float(y)) for x, y in [*corners, corners[0]]]


def box(x0, y0, x1, y1):
    return ring((x0, y0), (x1, y0), (x1, y1), (x0, y1))


def feature(kind, osm_type, osm_id, rings, tags=None, ts=STAMP):
    vertices = [v for r in rings for v in r]
    xs, ys = [v[0] for v in vertices], [v[1] for v in vertices]
    rows = [[{"x": x, "y": y} for x, y in r] for r in rings]
    return (osm_type, osm_id, ts, tags or {}, kind, rows, min(xs), min(ys), max(xs), max(ys))


def area(osm_id, *rings, tags=None, osm_type="W", ts=STAMP):
    return feature("A", osm_type, osm_id, list(rings), tags, ts)


def point(osm_id, x, y, tags=None, ts=STAMP):
    return feature("P", "N", osm_id, [[(float(x), float(y))]], tags, ts)


def line(osm_id, *vertices, tags=None):
    return feature("L", "W", osm_id, [[(float(x), float(y)) for x, y in vertices]], tags)


def table(spark, rows):
    return spark.createDataFrame(rows, FEATURE)


def members(spark, rows):
    """(site_id, member_type, member_id, site_tags) rows."""
    return spark.createDataFrame([(s, STAMP, t, i, tags) for s, t, i, tags in rows], SITE_MEMBER)


def edges(row):
    out = []
    for r in row[5]:
        out += [(a["x"], a["y"], b["x"], b["y"]) for a, b in zip(r, r[1:])]
    return out


def turn(ax, ay, bx, by, px, py):
    return (bx - ax) * (py - ay) - (px - ax) * (by - ay)


def between(e, px, py):
    return min(e[0], e[2]) <= px <= max(e[0], e[2]) and min(e[1], e[3]) <= py <= max(e[1], e[3])


def locate(row, px, py):
    inside = False
    for e in edges(row):
        t = turn(*e, px, py)
        if t == 0 and between(e, px, py):
            return 2
        if (e[1] > py) != (e[3] > py) and (t > 0) == (e[3] > e[1]):
            inside = not inside
    return int(inside)


def meet(e, f):
    e1, e2 = turn(*f, e[0], e[1]), turn(*f, e[2], e[3])
    f1, f2 = turn(*e, f[0], f[1]), turn(*e, f[2], f[3])
    return (
        (e1 * e2 < 0 and f1 * f2 < 0)
        or (e1 == 0 and between(f, e[0], e[1]))
        or (e2 == 0 and between(f, e[2], e[3]))
        or (f1 == 0 and between(e, f[0], f[1]))
        or (f2 == 0 and between(e, f[2], f[3]))
    )


def intersects(a, b):
    if b[4] == "P":
        return locate(a, b[6], b[7]) > 0
    if any(meet(e, f) for e in edges(a) for f in edges(b)):
        return True
    if any(locate(a, r[0]["x"], r[0]["y"]) for r in b[5]):
        return True
    return b[4] == "A" and any(locate(b, r[0]["x"], r[0]["y"]) for r in a[5])
