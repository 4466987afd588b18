"""Small map data derived from the driver's tables by SQL both engines accept.

Coordinates are integers on a lattice; degrees are `(v - 2048) / 64`, exact in
double precision. `FIXTURES.md` explains the views.
"""

from __future__ import annotations

import re

VIEWS = {
    "fx_poly0": """
SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 3 THEN 'R' ELSE 'W' END AS osm_type, c_custkey AS
osm_id, c_custkey % 4 AS shape, CASE WHEN c_custkey % 9 = 4 THEN ((c_custkey - 1) * 1597 + 11) %
4001 + 1 ELSE (c_custkey * 1597 + 11) % 4001 END AS x0, CASE WHEN c_custkey % 9 = 4 THEN ((c_custkey
- 1) * (c_custkey - 1) * 17 + (c_custkey - 1) * 2741 + 7) % 3989 + 1 ELSE (c_custkey * c_custkey *
17 + c_custkey * 2741 + 7) % 3989 END AS y0, CASE WHEN c_custkey % 9 = 4 THEN 8 + c_custkey % 5 ELSE
24 + c_custkey % 57 END AS w, CASE WHEN c_custkey % 9 = 4 THEN 8 + c_custkey % 4 ELSE 24 +
(c_custkey * 13) % 49 END AS h FROM customer
""",
    "fx_poly": """
SELECT p.*, o.o_orderdate AS ts, CASE WHEN k % 10 < 4 THEN 'camp_site' WHEN k % 10 < 6 THEN
'caravan_site' END AS tourism, CASE WHEN k % 10 IN (6, 7) THEN 'playground' END AS leisure, CASE
WHEN k % 10 = 8 THEN 'restaurant' WHEN k % 23 = 0 THEN 'bar' END AS amenity, CASE WHEN k % 31 = 0
THEN 'customary' WHEN k % 31 = 1 THEN 'no' END AS nudism, CASE WHEN k % 37 = 1 THEN 'yes' END AS
group_only, CASE WHEN k % 41 = 2 THEN 'yes' END AS scout, CASE WHEN k % 29 = 3 THEN 'yes' END AS
backcountry, CASE WHEN k % 7 IN (0, 2) THEN 'yes' WHEN k % 7 = 1 THEN 'no' END AS tents, CASE WHEN k
% 5 = 0 THEN 'no' WHEN k % 5 = 1 THEN 'yes' END AS caravans, CASE WHEN k % 11 = 0 THEN 'yes' WHEN k
% 11 = 1 THEN 'no' END AS motorhome, CASE WHEN k % 13 = 0 THEN 'hot' WHEN k % 13 = 1 THEN 'cold'
WHEN k % 13 = 2 THEN 'yes' WHEN k % 13 = 3 THEN 'outdoor' WHEN k % 13 = 4 THEN 'no' END AS shower,
CASE WHEN k % 6 = 0 THEN 'DE' WHEN k % 6 = 1 THEN 'Germany' END AS addr_country, CASE WHEN k % 3 <>
0 THEN concat('Site ', cast(k AS varchar(20))) END AS name, CASE WHEN k % 17 = 0 THEN
'tennis;soccer' WHEN k % 17 = 1 THEN 'golf' END AS sport FROM fx_poly0 p JOIN orders o ON
o.o_orderkey = p.k
""",
    "fx_template": """
SELECT * FROM (VALUES
(0,0,0,0,0),(0,0,1,4,0),(0,0,2,4,4),(0,0,3,0,4),(0,0,4,0,0),(1,0,0,0,0),(1,0,1,4,0),(1,0,2,4,4),(1,0,3,0,4),(1,0,4,0,0),(2,0,0,0,0),(2,0,1,4,0),(2,0,2,4,2),(2,0,3,2,2),(2,0,4,2,4),(2,0,5,0,4),(2,0,6,0,0),(3,0,0,0,0),(3,0,1,4,0),(3,0,2,4,4),(3,0,3,0,4),(3,0,4,0,0),(3,1,0,1,1),(3,1,1,1,2),(3,1,2,2,2),(3,1,3,2,1),(3,1,4,1,1))
AS t(shape, ring, i, fx, fy)
""",
    "fx_vertex": """
SELECT p.k, p.osm_type, p.osm_id, t.ring, t.i, p.x0 + cast(floor(cast(p.w * t.fx AS double) / 4) AS
bigint) AS x, p.y0 + cast(floor(cast(p.h * t.fy AS double) / 4) AS bigint) AS y FROM fx_poly0 p JOIN
fx_template t ON t.shape = p.shape
""",
    "fx_edge": """
SELECT a.k, a.osm_type, a.osm_id, a.ring, a.i, a.x AS x1, a.y AS y1, b.x AS x2, b.y AS y2 FROM
fx_vertex a JOIN fx_vertex b ON a.k = b.k AND a.ring = b.ring AND b.i = a.i + 1
""",
    "fx_kind": """
SELECT * FROM (VALUES
(0,'amenity','telephone',NULL,NULL),(1,'amenity','post_box',NULL,NULL),(2,'amenity','drinking_water',NULL,NULL),(3,'man_made','water_tap','drinking_water','yes'),(4,'man_made','water_tap','drinking_water','no'),(5,'amenity','water_point',NULL,NULL),(6,'amenity','power_supply',NULL,NULL),(7,'shop','convenience',NULL,NULL),(8,'shop','laundry',NULL,NULL),(9,'amenity','washing_machine',NULL,NULL),(10,'amenity','sanitary_dump_station',NULL,NULL),(11,'leisure','firepit',NULL,NULL),(12,'leisure','firepit','grate','yes'),(13,'amenity','bbq',NULL,NULL),(14,'amenity','toilets',NULL,NULL),(15,'amenity','toilets','shower','hot'),(16,'amenity','toilets','shower','cold'),(17,'amenity','toilets','shower','yes'),(18,'amenity','toilets','shower','no'),(19,'amenity','shower','hot_water','yes'),(20,'amenity','shower','hot_water','no'),(21,'amenity','shower',NULL,NULL),(22,'leisure','playground',NULL,NULL),(23,'leisure','swimming_pool',NULL,NULL),(24,'leisure','golf_course',NULL,NULL),(25,'leisure','miniature_golf',NULL,NULL),(26,'leisure','sauna',NULL,NULL),(27,'amenity','fast_food',NULL,NULL),(28,'amenity','restaurant',NULL,NULL),(29,'amenity','pub',NULL,NULL),(30,'amenity','bar',NULL,NULL),(31,'building','cabin',NULL,NULL),(32,'building','static_caravan',NULL,NULL),(33,'amenity','kitchen',NULL,NULL),(34,'amenity','kitchen','sink','yes'),(35,'amenity','kitchen','fridge','yes'),(36,'amenity','sink',NULL,NULL),(37,'amenity','fridge',NULL,NULL),(38,'leisure','picnic_table',NULL,NULL),(39,'leisure','pitch','sport','tennis'),(40,'leisure','pitch','sport','soccer;tennis'),(41,'playground','slide',NULL,NULL),(42,'tourism','camp_site','shower','outdoor'),(43,'tourism','caravan_site','name','Stop'))
AS t(kind, k1, v1, k2, v2)
""",
    "fx_point": """
SELECT 'N' AS osm_type, o.o_orderkey AS osm_id, o.o_custkey AS k, o.o_orderdate AS ts, CASE WHEN
o.o_orderkey % 5 = 0 THEN p.x0 + (o.o_orderkey * 7) % (p.w + 1) ELSE ((o.o_orderkey + 5000000) *
1597 + 11) % 4001 END AS x, CASE WHEN o.o_orderkey % 5 = 0 THEN p.y0 + (o.o_orderkey * 11) % (p.h +
1) ELSE ((o.o_orderkey + 5000000) * (o.o_orderkey + 5000000) * 17 + (o.o_orderkey + 5000000) * 2741
+ 7) % 3989 END AS y, (o.o_orderkey * 31 + o.o_custkey) % 44 AS kind, t.k1, t.v1, t.k2, t.v2 FROM
orders o JOIN fx_poly0 p ON p.k = o.o_custkey JOIN fx_kind t ON t.kind = (o.o_orderkey * 31 +
o.o_custkey) % 44
""",
    "fx_line": """
SELECT 'W' AS osm_type, 1000000000 + pa.p_partkey AS osm_id, p.k, o.o_orderdate AS ts, p.x0 + 2 AS
x1, p.y0 + 2 AS y1, p.x0 + p.w + 10 AS x2, p.y0 + p.h + 3 AS y2, CASE WHEN pa.p_size % 3 = 0 THEN
'slide' WHEN pa.p_size % 3 = 1 THEN 'swing' END AS playground, CASE WHEN pa.p_size % 3 = 2 THEN
'bench' END AS amenity FROM part pa JOIN fx_poly0 p ON p.k = pa.p_partkey JOIN orders o ON
o.o_orderkey = pa.p_partkey
""",
    "fx_site_member": """
SELECT 2000000000 + k AS site_id, osm_type AS member_type, osm_id AS member_id, 'fr' AS
site_addr_country, concat('Relation ', cast(k AS varchar(20))) AS site_name FROM fx_poly0 WHERE k %
6 = 0 UNION ALL SELECT 2000000000 + k, osm_type, osm_id, 'fr', concat('Relation ', cast(k AS
varchar(20))) FROM fx_point WHERE (k % 12 = 0 AND osm_id % 5 = 0) OR k % 12 = 6 UNION ALL SELECT
2000000000 + q.k - 10, q.osm_type, q.osm_id, 'fr', concat('Relation ', cast(q.k - 10 AS
varchar(20))) FROM fx_poly0 q WHERE q.k >= 10 AND (q.k - 10) % 18 = 0
""",
    "fx_country": """
SELECT concat(substr('abcde', n_nationkey % 5 + 1, 1), substr('vwxyz', cast(floor(cast(n_nationkey
AS double) / 5) AS int) + 1, 1)) AS country_code, (n_nationkey % 5) * 820 AS x0,
cast(floor(cast(n_nationkey AS double) / 5) AS int) * 820 AS y0, (n_nationkey % 5) * 820 + 820 AS
x1, cast(floor(cast(n_nationkey AS double) / 5) AS int) * 820 + 820 AS y1 FROM nation
""",
    "fx_change": """
SELECT e.event_id AS seq, e.ts, CASE WHEN e.event_type = 'error' THEN 'delete' WHEN e.event_type =
'signup' THEN 'create' ELSE 'modify' END AS op, p.osm_type, p.osm_id, p.x AS old_x, p.y AS old_y,
p.kind AS old_kind, CASE WHEN e.event_type <> 'error' THEN p.x + e.event_id % 21 - 10 END AS new_x,
CASE WHEN e.event_type <> 'error' THEN p.y + e.event_id % 13 - 6 END AS new_y, CASE WHEN
e.event_type <> 'error' THEN (p.kind + e.event_id) % 44 END AS new_kind FROM events e JOIN fx_point
p ON p.osm_id = (e.event_id * 13) % 1500
""",
    "fx_raw_tag": """
SELECT osm_id, k1, v1, CASE WHEN osm_id % 9 = 0 THEN concat('+49 ', cast(osm_id AS varchar(20))) END
AS phone, CASE WHEN osm_id % 10 = 0 THEN 'http://w.example' END AS website, CASE WHEN osm_id % 15 =
0 THEN 'http://u.example' END AS url, CASE WHEN osm_id % 20 = 0 THEN 'http://c.example' END AS
contact_website, CASE WHEN osm_id % 8 = 0 THEN 'required' END AS booking FROM fx_point
""",
    "fx_way_node": """
SELECT osm_id AS way_id, i AS pos, 10000000 + k * 16 + i AS node_id, x, y FROM fx_vertex WHERE ring
= 0 AND osm_type = 'W'
""",
    "fx_raw_diff": """
SELECT CASE WHEN osm_type = 'W' THEN 10000000 + k * 16 + i ELSE 20000000000 + k * 32 + ring * 8 + i END
AS id, x + 1 AS new_x, y + 1 AS new_y, false AS gone, 'n' AS kind FROM fx_vertex WHERE ring = 0 AND i =
2 AND ((osm_type = 'W' AND k % 7 = 3) OR (osm_type = 'R' AND k % 5 = 1)) UNION ALL SELECT osm_id, x + 2,
y, osm_id % 11 = 0, 'n' FROM fx_point WHERE osm_id % 11 < 2 UNION ALL SELECT k, NULL, NULL, true, 'w'
FROM fx_poly0 WHERE osm_type = 'W' AND k % 13 = 5 UNION ALL SELECT DISTINCT site_id, CAST(NULL AS
bigint), CAST(NULL AS bigint), true, 'r' FROM fx_site_member WHERE (site_id - 2000000000) % 18 = 0
""",
    "fx_point_in_poly": """
SELECT t.k, t.area_type, t.osm_type, t.osm_id, t.kind, sum(CASE WHEN (t.y1 > t.y) <> (t.y2 > t.y)
AND ((t.x2 - t.x1) * (t.y - t.y1) - (t.x - t.x1) * (t.y2 - t.y1)) * (t.y2 - t.y1) > 0 THEN 1 ELSE 0
END) % 2 = 1 AS inside, bool_or((t.x2 - t.x1) * (t.y - t.y1) = (t.x - t.x1) * (t.y2 - t.y1) AND t.x
BETWEEN least(t.x1, t.x2) AND greatest(t.x1, t.x2) AND t.y BETWEEN least(t.y1, t.y2) AND
greatest(t.y1, t.y2)) AS on_edge FROM (SELECT p.k, p.osm_type AS area_type, q.osm_type, q.osm_id,
q.kind, q.x, q.y, e.x1, e.y1, e.x2, e.y2 FROM fx_poly0 p JOIN fx_point q ON q.x BETWEEN p.x0 AND
p.x0 + p.w AND q.y BETWEEN p.y0 AND p.y0 + p.h JOIN fx_edge e ON e.k = p.k) t GROUP BY t.k,
t.area_type, t.osm_type, t.osm_id, t.kind
""",
}


def needed_views(sql: str, views: dict[str, str]) -> list[str]:
    """Views that `sql` uses, directly or through others, in dependency order."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(?:fx|ora)_\w+", text):
            if name in views and name not in order:
                visit(views[name])
                if name not in order:
                    order.append(name)

    visit(sql)
    return order


def with_views(sql: str, extra: dict[str, str] | None = None) -> str:
    """`sql` with the views it uses written out in front of it."""
    views = {**VIEWS, **(extra or {})}
    parts = [f"{name} AS ({views[name].strip()})" for name in needed_views(sql, views)]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql
