"""Views that only the oracle SQL uses, written independently of the engine.

Geometry works on the integer lattice: edges are joined and crossings counted.
"""

from __future__ import annotations

SITES = "('camp_site', 'caravan_site')"

# facility -> condition on the tag columns of a POI row `p`
FACILITY_SQL = {
    "telephone": "p.amenity = 'telephone'",
    "post_box": "p.amenity = 'post_box'",
    "drinking_water": "p.amenity IN ('drinking_water', 'water_point') OR (p.man_made = 'water_tap' AND p.drinking_water = 'yes')",
    "power_supply": "p.amenity = 'power_supply'",
    "shop": "p.shop IS NOT NULL AND p.shop <> 'laundry'",
    "laundry": "p.amenity = 'washing_machine' OR p.shop = 'laundry'",
    "sanitary_dump_station": "p.amenity = 'sanitary_dump_station'",
    "firepit": "p.leisure = 'firepit'",
    "bbq": "p.amenity = 'bbq' OR (p.leisure = 'firepit' AND p.grate = 'yes')",
    "toilets": "p.amenity = 'toilets'",
    "playground": "p.leisure = 'playground'",
    "swimming_pool": "p.leisure = 'swimming_pool'",
    "golf_course": "p.leisure = 'golf_course'",
    "miniature_golf": "p.leisure = 'miniature_golf'",
    "sauna": "p.leisure = 'sauna'",
    "fast_food": "p.amenity = 'fast_food'",
    "restaurant": "p.amenity = 'restaurant'",
    "pub": "p.amenity = 'pub'",
    "bar": "p.amenity = 'bar'",
    "cabin": "p.building = 'cabin'",
    "static_caravan": "p.building = 'static_caravan'",
    "kitchen": "p.amenity = 'kitchen'",
    "sink": "p.amenity = 'sink' OR (p.amenity = 'kitchen' AND p.sink IS NOT NULL AND p.sink <> 'no')",
    "fridge": "p.amenity = 'fridge' OR (p.amenity = 'kitchen' AND p.fridge IS NOT NULL AND p.fridge <> 'no')",
    "picnic_table": "p.leisure = 'picnic_table'",
}

RELATION_SQL = {
    **{k: v for k, v in FACILITY_SQL.items() if k not in ("power_supply", "cabin", "static_caravan")},
    "drinking_water": "p.amenity = 'drinking_water'",
}

RELATION_SQL_AS_WRITTEN = {
    **{k: v for k, v in RELATION_SQL.items() if k not in ("kitchen", "picnic_table")},
    "bar": "p.amenity IN ('bar', 'kitchen', 'picnic_table')",
}

POI_SHOWER = (
    "CASE WHEN p.amenity = 'shower' AND p.hot_water = 'yes' THEN 0"
    " WHEN p.amenity = 'toilets' AND p.shower = 'hot' THEN 0"
    " WHEN p.amenity = 'shower' AND p.hot_water = 'no' THEN 1"
    " WHEN p.amenity = 'toilets' AND p.shower = 'cold' THEN 1"
    " WHEN p.amenity = 'shower' AND p.hot_water IS NULL THEN 2"
    " WHEN p.amenity = 'toilets' AND p.shower = 'yes' THEN 2 END"
)
OWN_SHOWER = "CASE s.shower WHEN 'hot' THEN 0 WHEN 'cold' THEN 1 WHEN 'yes' THEN 2 WHEN 'outdoor' THEN 2 WHEN 'no' THEN 3 ELSE 4 END"


def shower_name(rank: str) -> str:
    return f"CASE {rank} WHEN 0 THEN 'hot' WHEN 1 THEN 'cold' WHEN 2 THEN 'yes' WHEN 3 THEN 'no' WHEN 4 THEN 'untagged' END"


def category(s: str) -> str:
    return (
        f"CASE WHEN {s}.nudism IN ('yes', 'obligatory', 'customary', 'designated') THEN 'nudist'"
        f" WHEN {s}.group_only = 'yes' OR {s}.scout = 'yes' THEN 'group_only'"
        f" WHEN {s}.backcountry = 'yes' THEN 'backcountry'"
        f" WHEN {s}.tents = 'yes' AND {s}.caravans = 'no' AND ({s}.motorhome IS NULL OR {s}.motorhome <> 'yes') THEN 'camping'"
        f" WHEN {s}.tents = 'no' OR ({s}.tourism = 'caravan_site' AND {s}.tents IS NULL) THEN 'caravan'"
        " ELSE 'standard' END"
    )


def flags(rules: dict[str, str] = FACILITY_SQL, wrap: str = "coalesce(bool_or({}), false)") -> str:
    return ", ".join(
        f"{wrap.format(f'coalesce({rules[n]}, false)')} AS {n}" if n in rules else f"false AS {n}"
        for n in FACILITY_SQL
    )


def _turn(a: str, b: str, px: str, py: str) -> str:
    return f"(({b[0]} - {a[0]}) * ({py} - {a[1]}) - ({px} - {a[0]}) * ({b[1]} - {a[1]}))"


def _kv(key: str) -> str:
    return f"CASE WHEN k1 = '{key}' THEN v1 WHEN k2 = '{key}' THEN v2 END AS {key}"


_POINT_KEYS = [
    "amenity", "leisure", "shop", "man_made", "building", "tourism", "playground",
    "drinking_water", "grate", "hot_water", "shower", "sink", "fridge", "sport", "name",
]
_SITE_KEYS = [
    "nudism", "group_only", "scout", "backcountry", "tents", "caravans", "motorhome", "addr_country",
]


def _poi_select(columns: dict[str, str], table: str, kind: str, k: str) -> str:
    wide = ", ".join(
        f"{columns.get(c, 'CAST(NULL AS varchar)')} AS {c}" for c in (*_POINT_KEYS, *_SITE_KEYS)
    )
    return f"SELECT osm_type, osm_id, ts, '{kind}' AS shape_kind, {k} AS k, {wide} FROM {table}"


_AREA_COLUMNS = {
    c: c
    for c in ("amenity", "leisure", "tourism", "shower", "sport", "name", *_SITE_KEYS)
}

_E1, _E2 = ("a.x1", "a.y1"), ("a.x2", "a.y2")
_F1, _F2 = ("b.x1", "b.y1"), ("b.x2", "b.y2")


def _on(px: str, py: str, s: str) -> str:
    return (
        f"({px} BETWEEN least({s}.x1, {s}.x2) AND greatest({s}.x1, {s}.x2)"
        f" AND {py} BETWEEN least({s}.y1, {s}.y2) AND greatest({s}.y1, {s}.y2))"
    )


# parity and boundary of the point (q.x, q.y) against edges `e`
_PARITY = (
    "sum(CASE WHEN (e.y1 > q.y) <> (e.y2 > q.y) AND ((e.x2 - e.x1) * (q.y - e.y1) - (q.x - e.x1) * (e.y2 - e.y1))"
    " * (e.y2 - e.y1) > 0 THEN 1 ELSE 0 END) % 2 = 1"
)
_ON_EDGE = (
    "bool_or((e.x2 - e.x1) * (q.y - e.y1) = (q.x - e.x1) * (e.y2 - e.y1) AND q.x BETWEEN least(e.x1, e.x2)"
    " AND greatest(e.x1, e.x2) AND q.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))"
)

VIEWS = {
    # all POIs with the tags the rules read as columns
    "ora_poi": (
        "SELECT osm_type, osm_id, ts, 'P' AS shape_kind, CAST(NULL AS bigint) AS k, "
        + ", ".join(_kv(c) for c in _POINT_KEYS)
        + ", "
        + ", ".join(f"CAST(NULL AS varchar) AS {c}" for c in _SITE_KEYS)
        + " FROM fx_point UNION ALL "
        + _poi_select(_AREA_COLUMNS, "fx_poly", "A", "k")
        + " UNION ALL "
        + _poi_select({"amenity": "amenity", "playground": "playground"}, "fx_line", "L", "CAST(NULL AS bigint)")
    ),
    "ora_site_area": f"SELECT * FROM fx_poly WHERE tourism IN {SITES}",
    "ora_site_point": f"SELECT * FROM ora_poi WHERE shape_kind = 'P' AND tourism IN {SITES}",
    "ora_pair": (
        "SELECT a.k AS a, b.k AS b FROM fx_poly0 a JOIN fx_poly0 b ON a.x0 <= b.x0 + b.w AND a.x0 + a.w >= b.x0"
        " AND a.y0 <= b.y0 + b.h AND a.y0 + a.h >= b.y0 WHERE a.k <> b.k"
    ),
    "ora_turn": (
        "SELECT p.a, p.b, "
        + ", ".join(
            f"{sql} AS {n}"
            for n, sql in {
                "e1": _turn(_F1, _F2, *_E1),
                "e2": _turn(_F1, _F2, *_E2),
                "f1": _turn(_E1, _E2, *_F1),
                "f2": _turn(_E1, _E2, *_F2),
                "o1": _on(*_E1, "b"),
                "o2": _on(*_E2, "b"),
                "p1": _on(*_F1, "a"),
                "p2": _on(*_F2, "a"),
            }.items()
        )
        + " FROM ora_pair p JOIN fx_edge a ON a.k = p.a JOIN fx_edge b ON b.k = p.b"
    ),
    "ora_edges": (
        "SELECT a, b, bool_or(e1 * e2 < 0 AND f1 * f2 < 0) AS crosses,"
        " bool_or((e1 * e2 < 0 AND f1 * f2 < 0) OR (e1 = 0 AND o1) OR (e2 = 0 AND o2) OR (f1 = 0 AND p1) OR (f2 = 0 AND p2)) AS meets"
        " FROM ora_turn GROUP BY a, b"
    ),
    # vertices of b against area a
    "ora_vertex": (
        f"SELECT p.a, p.b, q.ring, q.i, {_PARITY} AS inside, {_ON_EDGE} AS on_edge FROM ora_pair p"
        " JOIN fx_vertex q ON q.k = p.b JOIN fx_edge e ON e.k = p.a GROUP BY p.a, p.b, q.ring, q.i"
    ),
    "ora_vertices": (
        "SELECT a, b, bool_and(inside OR on_edge) AS all_covered, bool_or(inside OR on_edge) AS any_covered,"
        " bool_or(inside AND NOT on_edge) AS any_inside FROM ora_vertex GROUP BY a, b"
    ),
    "ora_area_meet": (
        "SELECT k AS a, k AS b FROM fx_poly0 UNION ALL SELECT e.a, e.b FROM ora_edges e"
        " JOIN ora_vertices v ON v.a = e.a AND v.b = e.b JOIN ora_vertices w ON w.a = e.b AND w.b = e.a"
        " WHERE e.meets OR v.any_covered OR w.any_covered"
    ),
    # scan line midway between the vertex heights next to the middle
    "ora_scan": (
        "SELECT p.k, (CAST(max(CASE WHEN v.y * 2 <= 2 * p.y0 + p.h THEN v.y END) AS double)"
        " + min(CASE WHEN v.y * 2 > 2 * p.y0 + p.h THEN v.y END)) / 2 AS y"
        " FROM fx_poly0 p JOIN fx_vertex v ON v.k = p.k GROUP BY p.k"
    ),
    "ora_crossing": (
        "SELECT s.k, s.y, CAST(e.x1 AS double) AS x, row_number() OVER (PARTITION BY s.k ORDER BY e.x1) AS n"
        " FROM ora_scan s JOIN fx_edge e ON e.k = s.k AND (e.y1 > s.y) <> (e.y2 > s.y)"
    ),
    "ora_stretch": (
        "SELECT a.k, a.y, (a.x + b.x) / 2 AS x, row_number() OVER (PARTITION BY a.k ORDER BY b.x - a.x DESC, a.n) AS rn"
        " FROM ora_crossing a JOIN ora_crossing b ON b.k = a.k AND b.n = a.n + 1 WHERE a.n % 2 = 1"
    ),
    "ora_surface": "SELECT k, x, y FROM ora_stretch WHERE rn = 1",
    "ora_surface_in": (
        f"SELECT p.a, p.b, {_PARITY} AND NOT {_ON_EDGE} AS inside FROM ora_pair p JOIN ora_surface q ON q.k = p.b"
        " JOIN fx_edge e ON e.k = p.a GROUP BY p.a, p.b"
    ),
    "ora_area_contains": (
        "SELECT e.a, e.b FROM ora_edges e JOIN ora_vertices v ON v.a = e.a AND v.b = e.b"
        " JOIN ora_vertices w ON w.a = e.b AND w.b = e.a JOIN ora_surface_in s ON s.a = e.a AND s.b = e.b"
        " WHERE v.all_covered AND NOT e.crosses AND NOT w.any_inside AND s.inside"
    ),
    # line against area: the line's end points and edges
    "ora_line_meet": (
        "SELECT DISTINCT p.k AS a, l.osm_id FROM fx_poly0 p JOIN fx_line l ON p.x0 <= greatest(l.x1, l.x2)"
        " AND p.x0 + p.w >= least(l.x1, l.x2) AND p.y0 <= greatest(l.y1, l.y2) AND p.y0 + p.h >= least(l.y1, l.y2)"
        " JOIN ora_line_test t ON t.a = p.k AND t.osm_id = l.osm_id"
    ),
    "ora_line_test": (
        "SELECT a.k AS a, b.osm_id FROM fx_edge a JOIN fx_line b ON least(a.x1, a.x2) <= greatest(b.x1, b.x2)"
        " AND greatest(a.x1, a.x2) >= least(b.x1, b.x2) AND least(a.y1, a.y2) <= greatest(b.y1, b.y2)"
        " AND greatest(a.y1, a.y2) >= least(b.y1, b.y2) WHERE "
        + f"({_turn(_F1, _F2, *_E1)} * {_turn(_F1, _F2, *_E2)} < 0 AND {_turn(_E1, _E2, *_F1)} * {_turn(_E1, _E2, *_F2)} < 0)"
        + f" OR ({_turn(_F1, _F2, *_E1)} = 0 AND {_on(*_E1, 'b')}) OR ({_turn(_F1, _F2, *_E2)} = 0 AND {_on(*_E2, 'b')})"
        + f" OR ({_turn(_E1, _E2, *_F1)} = 0 AND {_on(*_F1, 'a')}) OR ({_turn(_E1, _E2, *_F2)} = 0 AND {_on(*_F2, 'a')})"
        + " UNION SELECT p.k, q.osm_id FROM fx_poly0 p JOIN (SELECT osm_id, x1 AS x, y1 AS y FROM fx_line) q"
        " ON q.x BETWEEN p.x0 AND p.x0 + p.w AND q.y BETWEEN p.y0 AND p.y0 + p.h JOIN fx_edge e ON e.k = p.k"
        f" GROUP BY p.k, q.osm_id HAVING {_PARITY} OR {_ON_EDGE}"
    ),
    # POIs that touch an area: points, areas with itself, lines
    "ora_touch": (
        "SELECT k, osm_type, osm_id FROM fx_point_in_poly WHERE inside OR on_edge"
        " UNION ALL SELECT m.a, p.osm_type, p.osm_id FROM ora_area_meet m JOIN fx_poly0 p ON p.k = m.b"
    ),
    "ora_touch_all": "SELECT k, osm_type, osm_id FROM ora_touch UNION ALL SELECT a, 'W', osm_id FROM ora_line_meet",
    "ora_country": (
        "SELECT c.osm_type, c.osm_id, min(g.country_code) AS country FROM ora_centre c JOIN fx_country g"
        " ON c.x > g.x0 AND c.x < g.x1 AND c.y > g.y0 AND c.y < g.y1 GROUP BY c.osm_type, c.osm_id"
    ),
    # centroid in lattice units, relative to the first corner; holes count negative
    "ora_centre": (
        "SELECT p.osm_type, p.osm_id, p.x0 + CAST(sum(s.sign * s.mx) AS double) / (3 * CAST(sum(s.sign * s.w) AS double)) AS x,"
        " p.y0 + CAST(sum(s.sign * s.my) AS double) / (3 * CAST(sum(s.sign * s.w) AS double)) AS y FROM fx_poly0 p JOIN"
        " (SELECT e.k, e.ring, sum((e.x1 - p.x0) * (e.y2 - p.y0) - (e.x2 - p.x0) * (e.y1 - p.y0)) AS w,"
        " sum((e.x1 + e.x2 - 2 * p.x0) * ((e.x1 - p.x0) * (e.y2 - p.y0) - (e.x2 - p.x0) * (e.y1 - p.y0))) AS mx,"
        " sum((e.y1 + e.y2 - 2 * p.y0) * ((e.x1 - p.x0) * (e.y2 - p.y0) - (e.x2 - p.x0) * (e.y1 - p.y0))) AS my,"
        " CASE WHEN e.ring = 0 THEN 1 ELSE -1 END * sign(sum((e.x1 - p.x0) * (e.y2 - p.y0) - (e.x2 - p.x0) * (e.y1 - p.y0))) AS sign"
        " FROM fx_edge e JOIN fx_poly0 p ON p.k = e.k GROUP BY e.k, e.ring) s ON s.k = p.k"
        " GROUP BY p.osm_type, p.osm_id, p.x0, p.y0"
        " UNION ALL SELECT osm_type, osm_id, CAST(x AS double), CAST(y AS double) FROM fx_point"
    ),
    "ora_site": (
        "SELECT osm_type, osm_id, ts, k, shape_kind, tourism, shower, sport, name, "
        + ", ".join(_SITE_KEYS)
        + f" FROM ora_poi WHERE tourism IN {SITES} AND shape_kind <> 'L'"
    ),
    "ora_addr": (
        "SELECT s.osm_type, s.osm_id, CASE WHEN length(s.addr_country) = 2 THEN lower(s.addr_country)"
        " ELSE coalesce(c.country, s.addr_country) END AS addr_country FROM ora_site s"
        " LEFT JOIN ora_country c ON c.osm_type = s.osm_type AND c.osm_id = s.osm_id"
    ),
    "ora_content": (
        f"SELECT s.osm_type, s.osm_id, greatest(max(p.ts), max(s.ts)) AS ts, min(coalesce({POI_SHOWER}, {OWN_SHOWER})) AS shower_rank, "
        "coalesce(string_agg(DISTINCT CASE WHEN p.osm_type <> s.osm_type OR p.osm_id <> s.osm_id THEN p.sport END, ','"
        " ORDER BY CASE WHEN p.osm_type <> s.osm_type OR p.osm_id <> s.osm_id THEN p.sport END), '') AS sport, "
        + flags()
        + " FROM ora_site s JOIN ora_touch t ON t.k = s.k JOIN ora_poi p ON p.osm_type = t.osm_type AND p.osm_id = t.osm_id"
        " GROUP BY s.osm_type, s.osm_id"
    ),
    # the built product, without relations
    "ora_campsite": (
        f"SELECT s.osm_type, s.osm_id, s.k, s.tourism, s.name, a.addr_country, s.shower AS own_shower, greatest(s.ts, coalesce(c.ts, s.ts)) AS ts, {category('s')} AS category, "
        + f"coalesce(c.shower_rank, {OWN_SHOWER}) AS shower_rank, coalesce(c.sport, '') AS sport, "
        + ", ".join(f"coalesce(c.{n}, false) AS {n}" for n in FACILITY_SQL)
        + " FROM ora_site s JOIN ora_addr a ON a.osm_type = s.osm_type AND a.osm_id = s.osm_id"
        " LEFT JOIN ora_content c ON c.osm_type = s.osm_type AND c.osm_id = s.osm_id"
    ),
    # relation members with tags and camp flag
    "ora_member": (
        "SELECT m.site_id, m.site_name, p.*, coalesce(p.tourism = 'camp_site', false) AS camp FROM fx_site_member m"
        " JOIN ora_poi p ON p.osm_type = m.member_type AND p.osm_id = m.member_id"
    ),
    "ora_gain": (
        "SELECT s.osm_type, s.osm_id, "
        + flags(RELATION_SQL)
        + f", min(CASE WHEN p.amenity = 'shower' OR (p.amenity = 'toilets' AND p.shower IS NOT NULL) THEN coalesce({POI_SHOWER}, {OWN_SHOWER}) END) AS shower_rank,"
        " list(DISTINCT p.sport) FILTER (WHERE p.sport IS NOT NULL) AS sports, max(s.site_id) AS site_id,"
        " max_by(s.site_name, s.site_id) AS site_name"
        " FROM ora_member s JOIN ora_member p ON p.site_id = s.site_id WHERE s.camp GROUP BY s.osm_type, s.osm_id"
    ),
    "ora_gain_as_written": (
        "SELECT s.osm_type, s.osm_id, "
        + flags(RELATION_SQL_AS_WRITTEN)
        + " FROM ora_member s JOIN ora_member p ON p.site_id = s.site_id WHERE s.camp GROUP BY s.osm_type, s.osm_id"
    ),
    "ora_camp_count": "SELECT site_id, count(*) AS camps FROM ora_member WHERE camp GROUP BY site_id",
    "ora_invalid": (
        "SELECT DISTINCT m.osm_type, m.osm_id FROM ora_member m JOIN ora_camp_count c ON c.site_id = m.site_id"
        " WHERE m.camp AND c.camps <> 1"
    ),
    # (area k, object) pairs where the area contains the object, relation members only
    "ora_within": (
        "SELECT t.k, t.osm_type, t.osm_id FROM fx_point_in_poly t WHERE t.inside AND NOT t.on_edge"
        " UNION ALL SELECT c.a, p.osm_type, p.osm_id FROM ora_area_contains c JOIN fx_poly0 p ON p.k = c.b"
    ),
    "ora_useless": (
        "SELECT s.osm_type, s.osm_id FROM ora_member s JOIN ora_member r ON r.site_id = s.site_id AND NOT r.camp"
        " LEFT JOIN ora_within w ON w.k = s.k AND w.osm_type = r.osm_type AND w.osm_id = r.osm_id"
        " LEFT JOIN fx_point sp ON s.shape_kind = 'P' AND sp.osm_type = s.osm_type AND sp.osm_id = s.osm_id"
        " LEFT JOIN fx_point rp ON s.shape_kind = 'P' AND rp.osm_type = r.osm_type AND rp.osm_id = r.osm_id"
        " WHERE s.camp GROUP BY s.osm_type, s.osm_id"
        " HAVING bool_and(w.k IS NOT NULL OR coalesce(sp.x = rp.x AND sp.y = rp.y, false))"
    ),
    "ora_state": (
        "SELECT g.osm_type, g.osm_id, CASE WHEN u.osm_id IS NOT NULL THEN 'useless' WHEN i.osm_id IS NOT NULL THEN 'invalid' END AS state"
        " FROM ora_gain g LEFT JOIN ora_invalid i ON i.osm_type = g.osm_type AND i.osm_id = g.osm_id"
        " LEFT JOIN ora_useless u ON u.osm_type = g.osm_type AND u.osm_id = g.osm_id"
    ),
    "ora_related": (
        "SELECT c.osm_type, c.osm_id, c.k, c.tourism, c.category, c.ts, c.addr_country, coalesce(g.site_name, c.name) AS name,"
        " CAST(g.site_id AS varchar) AS site_relation, t.state AS site_relation_state,"
        " coalesce(g.shower_rank, c.shower_rank) AS shower_rank, "
        + ", ".join(f"c.{n} OR coalesce(g.{n}, false) AS {n}" for n in FACILITY_SQL)
        + ", CASE WHEN g.osm_id IS NULL THEN c.sport ELSE coalesce(array_to_string(list_sort(list_distinct(list_concat("
        "list_filter(string_split(c.sport, ','), lambda v: v <> ''), coalesce(g.sports, CAST([] AS varchar[]))))), ','), '') END AS sport"
        " FROM ora_campsite c LEFT JOIN ora_gain g ON g.osm_type = c.osm_type AND g.osm_id = c.osm_id"
        " LEFT JOIN ora_state t ON t.osm_type = c.osm_type AND t.osm_id = c.osm_id"
    ),
    # outer site contains inner site: areas and points in areas, points of one place
    "ora_nested": (
        "SELECT o.osm_type AS outer_type, o.osm_id AS outer_id, i.osm_type AS inner_type, i.osm_id AS inner_id, i.tourism AS inner_tourism"
        " FROM ora_site o JOIN ora_within w ON w.k = o.k JOIN ora_site i ON i.osm_type = w.osm_type AND i.osm_id = w.osm_id"
        " UNION ALL SELECT a.osm_type, a.osm_id, b.osm_type, b.osm_id, s.tourism FROM fx_point a JOIN fx_point b ON a.x = b.x AND a.y = b.y"
        " AND a.osm_id <> b.osm_id JOIN ora_site o ON o.osm_type = a.osm_type AND o.osm_id = a.osm_id"
        " JOIN ora_site s ON s.osm_type = b.osm_type AND s.osm_id = b.osm_id"
    ),
    "ora_contains": (
        "SELECT outer_type AS osm_type, outer_id AS osm_id, string_agg('https://osm.org/' || CASE inner_type WHEN 'W' THEN 'way/'"
        " WHEN 'N' THEN 'node/' ELSE 'relation/' END || CAST(inner_id AS varchar), ' ' ORDER BY inner_type, inner_id) AS contains_sites"
        " FROM ora_nested WHERE inner_tourism <> 'caravan_site' GROUP BY outer_type, outer_id"
    ),
    "ora_hidden": "SELECT DISTINCT inner_type AS osm_type, inner_id AS osm_id FROM ora_nested",
    # the whole product
    "ora_product": (
        "SELECT r.*, n.contains_sites, h.osm_id IS NULL AS visible FROM ora_related r"
        " LEFT JOIN ora_contains n ON n.osm_type = r.osm_type AND n.osm_id = r.osm_id"
        " LEFT JOIN ora_hidden h ON h.osm_type = r.osm_type AND h.osm_id = r.osm_id"
    ),
    "ora_playground": (
        "SELECT s.osm_type, s.osm_id, greatest(max(p.ts), max(s.ts)) AS ts, "
        + ", ".join(
            f"coalesce(string_agg(DISTINCT CASE WHEN p.osm_type <> s.osm_type OR p.osm_id <> s.osm_id THEN p.{c} END, ','"
            f" ORDER BY CASE WHEN p.osm_type <> s.osm_type OR p.osm_id <> s.osm_id THEN p.{c} END), '') AS {n}"
            for n, c in (("equipment", "playground"), ("sport", "sport"))
        )
        + " FROM fx_poly s JOIN ora_touch_all t ON t.k = s.k JOIN ora_poi p ON p.osm_type = t.osm_type AND p.osm_id = t.osm_id"
        " WHERE s.leisure = 'playground' GROUP BY s.osm_type, s.osm_id"
        " UNION ALL SELECT osm_type, osm_id, ts, '', '' FROM ora_poi WHERE shape_kind = 'P' AND leisure = 'playground'"
    ),
}
