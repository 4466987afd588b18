"""Planar geometry as Catalyst expressions; no Python worker is involved.

The functions take and return SQL expression text (column names, lambda variables
or larger expressions), to be used with `F.expr` or `selectExpr`.

Tests use the signs of cross products only, so they are exact wherever the
products are exact in double precision. Edges are array<struct<x1,y1,x2,y2>>,
`starts` holds one vertex per ring. `locate` answers 0 outside, 1 strictly
inside, 2 on the boundary, by the even-odd rule over all edges.
"""

from __future__ import annotations

from sitegrid.schema import ENVELOPE


def let(value: str, name: str, body: str) -> str:
    """`body` with `name` bound to `value`, which is written and computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def vertex(x: str, y: str) -> str:
    return f"named_struct('x', cast({x} AS double), 'y', cast({y} AS double))"


def point_rings(x: str, y: str) -> str:
    return f"array(array({vertex(x, y)}))"


def ring_edges(ring: str) -> str:
    pairs = f"greatest(size({ring}) - 1, 0)"
    return (
        f"zip_with(slice({ring}, 1, {pairs}), slice({ring}, 2, {pairs}), (va, vb) -> "
        "named_struct('x1', va.x, 'y1', va.y, 'x2', vb.x, 'y2', vb.y))"
    )


def edges(rings: str) -> str:
    return f"flatten(transform({rings}, er -> {ring_edges('er')}))"


def starts(rings: str) -> str:
    return f"transform({rings}, sr -> sr[0])"


def envelope(rings: str) -> dict[str, str]:
    return {
        f"{side}{axis}": f"array_{side}(transform(flatten({rings}), v -> v.{axis}))"
        for axis in "xy"
        for side in ("min", "max")
    }


def with_envelope(df):
    return df.selectExpr(
        *[f"`{c}`" for c in df.columns if c not in ENVELOPE],
        *[f"{sql} AS {name}" for name, sql in envelope("rings").items()],
    )


def boxes_overlap(a: str, b: str) -> str:
    """Envelope test on columns with the prefixes `a` and `b`; touching counts."""
    return (
        f"({a}minx <= {b}maxx AND {a}maxx >= {b}minx AND {a}miny <= {b}maxy AND {a}maxy >= {b}miny)"
    )


def box_covers(a: str, b: str) -> str:
    return (
        f"({a}minx <= {b}minx AND {a}maxx >= {b}maxx AND {a}miny <= {b}miny AND {a}maxy >= {b}maxy)"
    )


def _turn(s: str, px: str, py: str) -> str:
    """Sign tells on which side of segment `s` the point lies."""
    return f"(({s}.x2 - {s}.x1) * ({py} - {s}.y1) - ({px} - {s}.x1) * ({s}.y2 - {s}.y1))"


def _in_segment_box(s: str, px: str, py: str) -> str:
    return (
        f"({px} BETWEEN least({s}.x1, {s}.x2) AND greatest({s}.x1, {s}.x2)"
        f" AND {py} BETWEEN least({s}.y1, {s}.y2) AND greatest({s}.y1, {s}.y2))"
    )


def locate(area_edges: str, px: str, py: str) -> str:
    turn = _turn("le", px, py)
    return (
        f"aggregate({area_edges}, 0, (ls, le) -> CASE"
        f" WHEN ls = 2 OR ({_in_segment_box('le', px, py)} AND {turn} = 0) THEN 2"
        f" WHEN (le.y1 > {py}) <> (le.y2 > {py}) AND ({turn} > 0) = (le.y2 > le.y1) THEN 1 - ls"
        " ELSE ls END)"
    )


def covers_point(area_edges: str, px: str, py: str, strict: bool) -> str:
    return f"({locate(area_edges, px, py)} {'= 1' if strict else '<> 0'})"


#: edges that a point is tested against as columns, without a loop over a list
FEW_EDGES = 4


def edge_columns(area_edges: str) -> list[str]:
    """The first `FEW_EDGES` edges as columns, null where there are fewer."""
    return [f"get({area_edges}, {i}).{c} AS e{i}_{c}" for i in range(FEW_EDGES) for c in ("x1", "y1", "x2", "y2")]


def columns_cover_point(px: str, py: str, strict: bool) -> str:
    """`covers_point` over `edge_columns`, in plain arithmetic."""
    on, odd = [], []
    for e in (f"e{i}_" for i in range(FEW_EDGES)):
        turn = f"(({e}x2 - {e}x1) * ({py} - {e}y1) - ({px} - {e}x1) * ({e}y2 - {e}y1))"
        in_box = f"{px} BETWEEN least({e}x1, {e}x2) AND greatest({e}x1, {e}x2) AND {py} BETWEEN least({e}y1, {e}y2) AND greatest({e}y1, {e}y2)"
        on.append(f"coalesce({in_box} AND {turn} = 0, false)")
        odd.append(f"coalesce(({e}y1 > {py}) <> ({e}y2 > {py}) AND ({turn} > 0) = ({e}y2 > {e}y1), false)")
    meets, inside = " OR ".join(on), " <> ".join(f"({x})" for x in odd)
    return f"(NOT ({meets}) AND ({inside}))" if strict else f"({meets} OR ({inside}))"


def _turns(e: str, f: str) -> str:
    """Sides of the ends of each segment relative to the other one."""
    return (
        f"named_struct('e1', {_turn(f, e + '.x1', e + '.y1')}, 'e2', {_turn(f, e + '.x2', e + '.y2')},"
        f" 'f1', {_turn(e, f + '.x1', f + '.y1')}, 'f2', {_turn(e, f + '.x2', f + '.y2')})"
    )


_CROSSING = "(sign(t.e1) * sign(t.e2) < 0 AND sign(t.f1) * sign(t.f2) < 0)"


def segments_cross(e: str, f: str) -> str:
    """The two segments cross in a point inside both."""
    return let(_turns(e, f), "t", _CROSSING)


def segments_meet(e: str, f: str) -> str:
    """The two segments share at least one point."""
    touching = [
        f"t.e1 = 0 AND {_in_segment_box(f, e + '.x1', e + '.y1')}",
        f"t.e2 = 0 AND {_in_segment_box(f, e + '.x2', e + '.y2')}",
        f"t.f1 = 0 AND {_in_segment_box(e, f + '.x1', f + '.y1')}",
        f"t.f2 = 0 AND {_in_segment_box(e, f + '.x2', f + '.y2')}",
    ]
    return let(_turns(e, f), "t", f"({_CROSSING} OR " + " OR ".join(f"({x})" for x in touching) + ")")


def edges_in_box(all_edges: str, minx: str, miny: str, maxx: str, maxy: str) -> str:
    return (
        f"filter({all_edges}, be -> least(be.x1, be.x2) <= {maxx} AND greatest(be.x1, be.x2) >= {minx}"
        f" AND least(be.y1, be.y2) <= {maxy} AND greatest(be.y1, be.y2) >= {miny})"
    )


def _shared_edges(of: str, other: str) -> str:
    """Edges of one shape that reach the shared part of both envelopes."""
    return edges_in_box(
        f"{of}edges",
        f"greatest({of}minx, {other}minx)",
        f"greatest({of}miny, {other}miny)",
        f"least({of}maxx, {other}maxx)",
        f"least({of}maxy, {other}maxy)",
    )


#: places in an envelope where a box inside the area is looked for, the largest first
_BOX_PARTS = [
    (0, 0, 1, 1),
    (0.1, 0.1, 0.9, 0.9),
    *((0, 0, 0.5, 1), (0.5, 0, 1, 1), (0, 0, 1, 0.5), (0, 0.5, 1, 1)),
    (0.15, 0.15, 0.85, 0.85),
    (0.2, 0.2, 0.8, 0.8),
    (0.25, 0.25, 0.75, 0.75),
    *((0, 0, 0.25, 1), (0.75, 0, 1, 1), (0, 0, 1, 0.25), (0, 0.75, 1, 1)),
    *((0, 0, 0.5, 0.5), (0.5, 0, 1, 0.5), (0, 0.5, 0.5, 1), (0.5, 0.5, 1, 1)),
]
INNER_BOXES = 4


def inner_boxes(kind: str, rings: str) -> str:
    """At most `INNER_BOXES` boxes inside an area, as array<struct<x0,y0,x1,y1>>; none where none of a few places fits.

    A box that no edge reaches into and whose middle is inside lies in the area as a whole,
    its border included. Needs the envelope as columns.
    """

    def at(low: str, high: str, part: float) -> str:
        return low if part == 0 else high if part == 1 else f"({low} + ({high} - {low}) * {part}D)"

    whole, *places = [
        f"named_struct('x0', {at('minx', 'maxx', a)}, 'y0', {at('miny', 'maxy', b)}, 'x1', {at('minx', 'maxx', c)}, 'y1', {at('miny', 'maxy', d)})"
        for a, b, c, d in _BOX_PARTS
    ]
    reached = (
        "exists(ie, be -> least(be.x1, be.x2) < bx.x1 AND greatest(be.x1, be.x2) > bx.x0"
        " AND least(be.y1, be.y2) < bx.y1 AND greatest(be.y1, be.y2) > bx.y0)"
    )
    middle = locate("ie", "((bx.x0 + bx.x1) / 2)", "((bx.y0 + bx.y1) / 2)")
    fits = f"bx -> bx.x0 < bx.x1 AND bx.y0 < bx.y1 AND NOT {reached} AND {middle} = 1"
    around = "exists(ba, bo -> bx.x0 >= bo.x0 AND bx.y0 >= bo.y0 AND bx.x1 <= bo.x1 AND bx.y1 <= bo.y1)"
    no_box = "slice(bf, 1, 0)"
    chosen = f"aggregate(bf, {no_box}, (ba, bx) -> CASE WHEN size(ba) = {INNER_BOXES} OR {around} THEN ba ELSE concat(ba, array(bx)) END)"
    some = let(f"filter(array({', '.join(places)}), {fits})", "bf", chosen)
    boxes = let(f"filter(array({whole}), {fits})", "bw", f"CASE WHEN size(bw) > 0 THEN bw ELSE {some} END")
    return f"CASE WHEN {kind} = 'A' THEN {let(edges(rings), 'ie', boxes)} END"


def inner_box_columns(boxes: str, prefix: str) -> list[str]:
    """The coordinates of the inner boxes as columns, null where there is none."""
    return [f"get({boxes}, {i}).{c} AS {prefix}in{i}_{c}" for i in range(INNER_BOXES) for c in ("x0", "y0", "x1", "y1")]


def inner_boxes_meet(a: str, b: str) -> str:
    """An inner box of one area meets one of the other: the areas intersect, whatever their edges are."""
    pairs = [(f"{a}in{i}_", f"{b}in{k}_") for i in range(INNER_BOXES) for k in range(INNER_BOXES)]
    return "(" + " OR ".join(f"({p}x0 <= {q}x1 AND {p}x1 >= {q}x0 AND {p}y0 <= {q}y1 AND {p}y1 >= {q}y0)" for p, q in pairs) + ")"


def inner_box_covers(a: str, b: str) -> str:
    """An inner box of area `a` is around the envelope of `b`."""
    boxes = [f"{a}in{i}_" for i in range(INNER_BOXES)]
    return "(" + " OR ".join(f"({p}x0 <= {b}minx AND {p}x1 >= {b}maxx AND {p}y0 <= {b}miny AND {p}y1 >= {b}maxy)" for p in boxes) + ")"


def shapes_intersect(a: str, b: str) -> str:
    """An area intersects an area or a line; columns `edges`, `starts`, `kind` with prefixes.

    Only edges within the shared part of both envelopes can meet. Without a
    meeting, one shape's ring lies whole inside the other or whole outside.
    """
    meets = let(
        _shared_edges(b, a),
        "near",
        f"exists({_shared_edges(a, b)}, ae -> exists(near, bf -> {segments_meet('ae', 'bf')}))",
    )
    b_in_a = f"exists({b}starts, sv -> {locate(a + 'edges', 'sv.x', 'sv.y')} <> 0)"
    a_in_b = f"({b}kind = 'A' AND exists({a}starts, sv -> {locate(b + 'edges', 'sv.x', 'sv.y')} <> 0))"
    return f"({meets} OR {b_in_a} OR {a_in_b})"


def _on_segment(s: str, px: str, py: str) -> str:
    return f"({_turn(s, px, py)} = 0 AND {_in_segment_box(s, px, py)})"


def _pieces(e: str, vertices: str) -> str:
    """Edge `e` cut at the vertices that lie on it, as edges."""
    ends = f"array({vertex(e + '.x1', e + '.y1')}, {vertex(e + '.x2', e + '.y2')})"
    cuts = f"array_sort(array_distinct(concat({ends}, filter({vertices}, cv -> {_on_segment(e, 'cv.x', 'cv.y')}))))"
    return let(cuts, "cr", ring_edges("cr"))


def _runs_along(p: str, all_edges: str) -> str:
    """Piece `p` lies on one edge; this holds where its middle is off the edge by rounding."""
    return f"exists({all_edges}, re -> {_on_segment('re', p + '.x1', p + '.y1')} AND {_on_segment('re', p + '.x2', p + '.y2')})"


def _middle(area_edges: str, p: str) -> str:
    return locate(area_edges, f"({p}.x1 + {p}.x2) / 2", f"({p}.y1 + {p}.y2) / 2")


def inside_points(rings: str) -> str:
    """At least one inner point of every connected part of an area.

    A scan line half-way up each ring meets the part that the ring bounds; the middle
    of each of its inside stretches is taken.
    """
    return let(
        edges(rings),
        "ie",
        f"array_distinct(flatten(transform({rings}, ir -> {_stretches('ie', rings, 'array(ir)')})))",
    )


def shape_contains(a: str, b: str) -> str:
    """Area `a` contains the area or line `b`; touching the boundary is allowed.

    No edges cross. Each edge of `b`, cut at the vertices of `a` that touch it, is
    covered piece by piece, so none leads through a gap between two of them. For an
    area, no piece of an edge of `a`, cut likewise, runs through the inside of `b`;
    then each connected part of `b` is all inside `a` or all outside, and one point of
    each tells. For a line, some piece lies inside. Needs `inner_points` of `b`.
    """
    of, within = a + "edges", b + "edges"
    near = _shared_edges(a, b)
    crosses = f"exists({within}, cf -> exists(near, ae -> {segments_cross('ae', 'cf')}))"
    a_vertices = f"transform(near, nv -> {vertex('nv.x1', 'nv.y1')})"
    pieces = f"flatten(transform({within}, cf -> {_pieces('cf', 'av')}))"
    covered = f"forall(cp, cq -> {_middle(of, 'cq')} <> 0 OR {_runs_along('cq', 'near')})"
    some_inside = f"exists(cp, cq -> {_middle(of, 'cq')} = 1 AND NOT {_runs_along('cq', 'near')})"
    b_vertices = f"transform({within}, bv -> {vertex('bv.x1', 'bv.y1')})"
    cut_through = (
        f"exists(flatten(transform(near, ae -> {_pieces('ae', 'bw')})), cq -> {_middle(within, 'cq')} = 1"
        f" AND NOT {_runs_along('cq', within)})"
    )
    area = (
        f"NOT {let(b_vertices, 'bw', cut_through)}"
        f" AND forall({b}inner_points, cq -> {locate(of, 'cq.x', 'cq.y')} = 1)"
    )
    tested = f"({covered} AND CASE WHEN {b}kind = 'A' THEN {area} ELSE {some_inside} END)"
    on_pieces = let(a_vertices, "av", let(pieces, "cp", tested))
    ends_covered = (
        f"forall({within}, cf -> {locate(of, 'cf.x1', 'cf.y1')} <> 0 AND {locate(of, 'cf.x2', 'cf.y2')} <> 0)"
    )
    whole = let(near, "near", f"(NOT {crosses} AND {on_pieces})")
    return f"({box_covers(a, b)} AND {ends_covered} AND {whole})"


def _moments(w: str, x: str, y: str) -> str:
    return f"named_struct('w', {w}, 'x', {x}, 'y', {y})"


_NO_MOMENTS = "named_struct('w', 0D, 'x', 0D, 'y', 0D)"


def _shoelace(ring: str, ox: str, oy: str) -> str:
    """(twice the signed area, its x moment, its y moment) relative to (ox, oy)."""
    x1, y1, x2, y2 = f"(me.x1 - {ox})", f"(me.y1 - {oy})", f"(me.x2 - {ox})", f"(me.y2 - {oy})"
    step = let(
        f"{x1} * {y2} - {x2} * {y1}",
        "mw",
        _moments("ma.w + mw", f"ma.x + ({x1} + {x2}) * mw", f"ma.y + ({y1} + {y2}) * mw"),
    )
    return f"aggregate({ring_edges(ring)}, {_NO_MOMENTS}, (ma, me) -> {step})"


def _is_hole(rings: str, ring: str, index: str) -> str:
    """A ring is a hole if an odd number of other rings surround it."""
    surrounds = f"exists({ring}, hv -> {locate(ring_edges('hr'), 'hv.x', 'hv.y')} = 1)"
    return f"(size(filter({rings}, (hr, hj) -> hj <> {index} AND {surrounds})) % 2 = 1)"


def _length_centre(rings: str) -> str:
    step = let(
        "hypot(me.x2 - me.x1, me.y2 - me.y1)",
        "mw",
        _moments("ma.w + mw", "ma.x + (me.x1 + me.x2) / 2 * mw", "ma.y + (me.y1 + me.y2) / 2 * mw"),
    )
    centre = vertex("mt.x / mt.w", "mt.y / mt.w")
    return (
        f"aggregate({edges(rings)}, {_NO_MOMENTS}, (ma, me) -> {step},"
        f" mt -> CASE WHEN mt.w > 0 THEN {centre} ELSE {rings}[0][0] END)"
    )


def _area_centre(rings: str) -> str:
    ox, oy = f"{rings}[0][0].x", f"{rings}[0][0].y"
    sign = f"CASE WHEN size({rings}) > 1 AND {_is_hole(rings, 'cr', 'ci')} THEN -1D ELSE 1D END * sign(cm.w)"
    signed = let(
        _shoelace("cr", ox, oy),
        "cm",
        let(sign, "cs", _moments("cs * cm.w", "cs * cm.x", "cs * cm.y")),
    )
    centre = vertex(f"{ox} + ct.x / (3 * ct.w)", f"{oy} + ct.y / (3 * ct.w)")
    return (
        f"aggregate(transform({rings}, (cr, ci) -> {signed}), {_NO_MOMENTS},"
        f" (ca, cm) -> {_moments('ca.w + cm.w', 'ca.x + cm.x', 'ca.y + cm.y')},"
        f" ct -> CASE WHEN ct.w > 0 THEN {centre} ELSE {_length_centre(rings)} END)"
    )


def centroid(kind: str, rings: str) -> str:
    return (
        f"CASE {kind} WHEN 'A' THEN {_area_centre(rings)} WHEN 'L' THEN {_length_centre(rings)}"
        f" ELSE {rings}[0][0] END"
    )


def _stretches(area_edges: str, rings: str, part: str) -> str:
    """(width, order, x, y) of the inside stretches of a scan line half-way up `part`.

    The line runs midway between the vertex heights next to the middle, so it
    meets no vertex; empty if it meets no edge.
    """
    ys = f"transform(flatten({part}), v -> v.y)"
    heights = f"transform(flatten({rings}), v -> v.y)"
    middle = f"(array_min({ys}) + array_max({ys})) / 2"
    scan = let(
        middle,
        "pm",
        f"(array_max(filter({heights}, ph -> ph <= pm)) + array_min(filter({heights}, ph -> ph > pm))) / 2",
    )
    crossings = (
        f"array_sort(transform(filter({area_edges}, pe -> (pe.y1 > py) <> (pe.y2 > py)),"
        " pe -> pe.x1 + (py - pe.y1) * (pe.x2 - pe.x1) / (pe.y2 - pe.y1)))"
    )
    pairs = "filter(transform(xs, (px, pi) -> named_struct('i', pi, 'x', px)), pp -> pp.i % 2 = 1)"
    stretch = (
        "named_struct('width', pp.x - get(xs, pp.i - 1), 'order', -pp.i,"
        " 'x', (pp.x + get(xs, pp.i - 1)) / 2, 'y', py)"
    )
    return let(scan, "py", let(crossings, "xs", f"transform({pairs}, pp -> {stretch})"))


def _inside_stretch(area_edges: str, rings: str, part: str) -> str:
    """The widest of these stretches, null if there is none."""
    return f"array_max({_stretches(area_edges, rings, part)})"


def _inner_point(rings: str) -> str:
    """A point inside an area: on the scan line of the whole, else of one ring."""
    whole = _inside_stretch("ie", rings, rings)
    by_ring = f"array_max(transform({rings}, ir -> {_inside_stretch('ie', rings, 'array(ir)')}))"
    point = f"CASE WHEN ib IS NOT NULL THEN {vertex('ib.x', 'ib.y')} ELSE {rings}[0][0] END"
    return let(edges(rings), "ie", let(f"coalesce({whole}, {by_ring})", "ib", point))


def point_on_surface(kind: str, rings: str) -> str:
    """A point of the shape itself: inside an area, a middle vertex of a line, the point."""
    return (
        f"CASE {kind} WHEN 'A' THEN {_inner_point(rings)}"
        f" WHEN 'L' THEN {rings}[0][cast(floor(size({rings}[0]) / 2) AS int)] ELSE {rings}[0][0] END"
    )


def geojson_point(point: str) -> str:
    """A GeoJSON geometry, with nine decimals."""
    return f"named_struct('type', 'Point', 'coordinates', array(round({point}.x, 9), round({point}.y, 9)))"


def as_geojson(point: str) -> str:
    return f"to_json({geojson_point(point)})"


def shape_digest(kind: str, rings: str) -> str:
    """Equal for objects with the same geometry; groups copies before a join."""
    return f"sha2(concat({kind}, to_json({rings})), 256)"
