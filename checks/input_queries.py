"""Sources, sinks, projections and filters."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks.oracle_views import FACILITY_SQL, OWN_SHOWER, POI_SHOWER, SITES, category, shower_name
from checks.registry import query
from sitegrid.functions.scalars import utc_timestamp
from sitegrid.functions.tags import unify_keys, value_in
from sitegrid.operators.facilities import (
    SITE_TOURISM,
    facility_flags,
    is_playground,
    is_site,
    own_shower,
    poi_shower,
    shower_label,
    site_category,
)
from sitegrid.operators.relations import all_features
from sitegrid.plans import features, sitemaps
from sitegrid.plans.campsites import build_campsites
from sitegrid.plans.incremental import keep_tagged
from sitegrid.plans.playgrounds import build_playgrounds
from sitegrid.schema import CAMPSITE, CHANGE, FACILITIES, KEY, TABLES
from sitegrid.session import shared_dir
from sitegrid.sources import ingest
from sitegrid.sources.assembly import multipolygon_geometry, way_geometry
from sitegrid.streaming import updater
from sitegrid.streaming.updater import Store

BASE_URL = "https://maps.example"


def tag(key: str, name: str | None = None):
    return F.col("tags")[key].alias(name or key.replace(":", "_"))


def fresh_path(t, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


_DEG = "(CAST({} AS double) - 2048) / 64"


def deg(v: str) -> str:
    return _DEG.format(v)


_STAMP = "make_timestamp((1500000000 + r.osm_id) * 1000000)"
_RAW_WEB = "coalesce(r.website, r.url, r.contact_website)"


@query(
    f"SELECT 'N' AS osm_type, r.osm_id, {_STAMP} AS ts, {deg('p.x')} AS x, {deg('p.y')} AS y,"
    " CASE WHEN r.k1 = 'amenity' THEN r.v1 END AS amenity, 'contact:phone' || r.phone AS phone,"
    f" {_RAW_WEB} AS website, r.booking AS reservation,"
    f" CAST(1 + (p.k2 IS NOT NULL)::int + (r.phone IS NOT NULL)::int + ({_RAW_WEB} IS NOT NULL)::int + (r.booking IS NOT NULL)::int AS bigint) AS n_tags"
    " FROM fx_raw_tag r JOIN fx_point p ON p.osm_id = r.osm_id"
)
def ingest_points(t):
    return ingest.ingest_points(t.raw_nodes).select(
        *KEY,
        F.col("timestamp").alias("ts"),
        F.col("minx").alias("x"),
        F.col("miny").alias("y"),
        tag("amenity"),
        F.concat(F.lit("contact:phone"), F.col("tags")["contact:phone"]).alias("phone"),
        tag("contact:website", "website"),
        tag("reservation"),
        F.size("tags").cast("bigint").alias("n_tags"),
    )


_AREA_POI = "(p.tourism IS NOT NULL OR p.leisure IS NOT NULL OR p.amenity IS NOT NULL)"
_AREA_BOX = (
    f"{deg('p.x0')} AS minx, {deg('p.y0')} AS miny, {deg('p.x0 + p.w')} AS maxx, {deg('p.y0 + p.h')} AS maxy"
)


@query(
    f"SELECT p.osm_type, p.osm_id, 'A' AS kind, {_AREA_BOX}, CASE p.shape WHEN 2 THEN 7 ELSE 5 END::bigint AS corners, p.tourism"
    f" FROM fx_poly p WHERE p.osm_type = 'W' AND {_AREA_POI} UNION ALL"
    f" SELECT osm_type, osm_id, 'L', {deg('x1')}, {deg('y1')}, {deg('x2')}, {deg('y2')}, 2::bigint, NULL FROM fx_line"
    " WHERE playground IS NOT NULL OR amenity IS NOT NULL"
)
def ingest_ways(t):
    areas, lines = ingest.ingest_ways(t.raw_ways, t.raw_nodes)
    return areas.unionByName(lines).select(
        *KEY, "kind", "minx", "miny", "maxx", "maxy", F.size(F.flatten("rings")).cast("bigint").alias("corners"), tag("tourism")
    )


@query(
    f"SELECT p.osm_type, p.osm_id, {_AREA_BOX}, 10::bigint AS corners, p.tourism FROM fx_poly p WHERE p.osm_type = 'R' AND {_AREA_POI}"
)
def ingest_relations(t):
    return ingest.ingest_relations(t.raw_relations, t.raw_ways, t.raw_nodes).select(
        *KEY, "minx", "miny", "maxx", "maxy", F.size(F.flatten("rings")).cast("bigint").alias("corners"), tag("tourism")
    )


@query("SELECT site_id, member_type, member_id, site_name FROM fx_site_member")
def ingest_site_members(t):
    return ingest.ingest_site_members(t.raw_relations).select(
        "site_id", "member_type", "member_id", F.col("site_tags")["name"].alias("site_name")
    )


@query(
    f"SELECT way_id AS id, CAST(pos AS bigint) AS pos, {deg('x')} AS x, {deg('y')} AS y FROM fx_way_node"
    f" UNION ALL SELECT osm_id, 0, {deg('x1')}, {deg('y1')} FROM fx_line UNION ALL SELECT osm_id, 1, {deg('x2')}, {deg('y2')} FROM fx_line"
    f" UNION ALL SELECT 3000000000 + v.k * 4 + s.part, s.pos, {deg('v.x')}, {deg('v.y')} FROM fx_vertex v JOIN"
    " (VALUES (0, 0, 0, 4), (0, 1, 0, 1), (0, 2, 0, 2), (1, 0, 0, 4), (1, 1, 0, 3), (1, 2, 0, 2), (2, 0, 1, 4), (2, 1, 1, 1), (2, 2, 1, 2),"
    " (2, 3, 1, 3), (2, 4, 1, 4)) AS s(part, pos, ring, i) ON s.ring = v.ring AND s.i = v.i WHERE v.osm_type = 'R'"
)
def assemble_way_geometry(t):
    paths = way_geometry(t.raw_ways, t.raw_nodes)
    steps = paths.select("id", F.posexplode("path").alias("pos", "v"))
    return steps.select(
        "id", F.col("pos").cast("bigint").alias("pos"), F.col("v.x").alias("x"), F.col("v.y").alias("y")
    )


@query(
    f"SELECT DISTINCT osm_id AS id, ring::bigint AS ring, {deg('x')} AS x, {deg('y')} AS y FROM fx_vertex WHERE osm_type = 'R'"
)
def assemble_multipolygon(t):
    found = t.raw_relations.filter(F.col("tags")["type"] == "multipolygon")
    rings = multipolygon_geometry(found, t.raw_ways, t.raw_nodes)
    corners = rings.select("id", F.posexplode("rings").alias("ring", "r")).select(
        "id", F.col("ring").cast("bigint").alias("ring"), F.explode("r").alias("v")
    )
    return corners.select("id", "ring", F.col("v.x").alias("x"), F.col("v.y").alias("y")).distinct()


@query(
    f"SELECT country_code, {deg('x0')} AS minx, {deg('y0')} AS miny, {deg('x1')} AS maxx, {deg('y1')} AS maxy FROM fx_country"
)
def scan_country_grid(t):
    path = fresh_path(t, "grid")
    t.country_grid.write.parquet(path)
    return ingest.read_country_grid(t.spark, path).select("country_code", "minx", "miny", "maxx", "maxy")


@query(
    "SELECT 'points' AS table_name, 10::bigint AS n_columns, count(*) AS n FROM fx_point UNION ALL SELECT 'lines', 10, count(*) FROM fx_line"
    " UNION ALL SELECT 'polys', 10, count(*) FROM fx_poly UNION ALL SELECT 'site_members', 5, count(*) FROM fx_site_member"
    " UNION ALL SELECT 'country_grid', 6, count(*) FROM fx_country"
    " UNION ALL SELECT 'campsites', 39, count(*) FROM ora_site UNION ALL SELECT 'playgrounds', 12, count(*) FROM ora_playground"
)
def typed_schemas(t):
    tables = {n: getattr(t, n) for n in ("points", "lines", "polys", "site_members", "country_grid")}
    tables["campsites"] = t.built
    tables["playgrounds"] = build_playgrounds(t.points, t.lines, t.polys)
    schemas = TABLES | {"campsites": CAMPSITE}
    counts = [
        df.select([F.col(f.name).cast(f.dataType) for f in schemas[n].fields])
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(n).alias("table_name"), F.lit(len(schemas[n])).cast("bigint").alias("n_columns"), "n")
        for n, df in tables.items()
    ]
    return all_features(*counts)


@query(
    "SELECT p.osm_type, p.osm_id, p.k1 FROM fx_point p WHERE p.osm_id % 7 <> 0"
    " UNION ALL SELECT osm_type, osm_id, 'renewed' FROM fx_point WHERE osm_id % 7 = 0 AND osm_id % 2 = 0"
)
def snapshot_sink(t):
    """A full version, then a small one that renews some rows and removes others."""
    store = Store(t.spark, fresh_path(t, "store"))
    store.write_full(0, {"points": t.points})
    store.commit(0, True, -1, None)
    changed = t.points.filter("osm_id % 7 = 0")
    fresh = changed.filter("osm_id % 2 = 0").withColumn("tags", F.create_map(F.lit("renewed"), F.lit("yes")))
    store.write_delta(1, "points", changed, fresh)
    store.commit(1, False, 0, None)
    now = store.read("points")
    return now.select(*KEY, F.when(F.map_contains_key("tags", "renewed"), "renewed").otherwise(_first_key()).alias("k1"))


def _first_key():
    keys = ["amenity", "man_made", "shop", "leisure", "building", "playground", "tourism"]
    return F.coalesce(*[F.when(F.col("tags")[k].isNotNull(), k) for k in keys])


@query("SELECT osm_type, osm_id, ts, equipment, sport FROM ora_playground")
def playground_sink(t):
    path = fresh_path(t, "playgrounds")
    build_playgrounds(t.points, t.lines, t.polys).write.parquet(path)
    return flat_playgrounds(t.spark.read.schema(TABLES["playgrounds"]).parquet(path))


def flat_playgrounds(df):
    return df.select(
        *KEY,
        F.col("timestamp").alias("ts"),
        F.array_join("equipment", ",").alias("equipment"),
        F.array_join("sport", ",").alias("sport"),
    )


def _json(path: str, name: str):
    return F.get_json_object("feature", path).alias(name)


_PLACE = (
    "(SELECT 'N' AS osm_type, osm_id, CAST(x AS double) AS x, CAST(y AS double) AS y FROM fx_point"
    " UNION ALL SELECT p.osm_type, p.osm_id, s.x, s.y FROM fx_poly0 p JOIN ora_surface s ON s.k = p.k)"
)
_TYPE_NAME = "CASE {0}.osm_type WHEN 'N' THEN 'node' WHEN 'W' THEN 'way' ELSE 'relation' END"
_BOX_TEXT = (
    "SELECT osm_type, osm_id, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM fx_poly0"
)


def yes(name: str, wrap: str = "r") -> str:
    return f"CASE WHEN {wrap}.{name} THEN 'yes' END"


@query(
    f"SELECT r.osm_type, r.osm_id, 'Feature' AS type, 'https://www.openstreetmap.org/' || {_TYPE_NAME.format('r')} || '/' || CAST(r.osm_id AS varchar) AS id,"
    f" round({deg('b.x0')}, 7) AS west, round({deg('b.y0')}, 7) AS south, round({deg('b.x1')}, 7) AS east, round({deg('b.y1')}, 7) AS north, round({deg('g.x')}, 9) AS x, round({deg('g.y')}, 9) AS y,"
    " r.category, r.name, r.tourism, r.addr_country, r.site_relation_state, r.contains_sites,"
    f" {', '.join(f'{yes(n)} AS {features.PROPERTY_NAMES.get(n, n)}' for n in FACILITIES)},"
    f" CASE WHEN r.shower_rank = 4 THEN s.shower ELSE {shower_name('r.shower_rank')} END AS shower,"
    " CASE WHEN r.sport <> '' THEN '[\"' || replace(r.sport, ',', '\",\"') || '\"]' WHEN s.sport IS NOT NULL THEN '[\"' || replace(s.sport, ';', '\",\"') || '\"]' END AS sport"
    f" FROM ora_product r JOIN {_PLACE} g ON g.osm_type = r.osm_type AND g.osm_id = r.osm_id"
    " JOIN ora_site s ON s.osm_type = r.osm_type AND s.osm_id = r.osm_id"
    f" LEFT JOIN ({_BOX_TEXT}) b ON b.osm_type = r.osm_type AND b.osm_id = r.osm_id"
)
def geojson_features(t):
    return features.site_features(t.marked).select(
        *KEY,
        _json("$.type", "type"),
        _json("$.id", "id"),
        *[_json(f"$.bbox[{i}]", side).cast("double").alias(side) for i, side in enumerate(("west", "south", "east", "north"))],
        *[_json(f"$.geometry.coordinates[{i}]", axis).cast("double").alias(axis) for i, axis in enumerate("xy")],
        *[_json(f"$.properties.{c}", c) for c in ("category", "name", "tourism")],
        _json("$.properties['addr:country']", "addr_country"),
        *[
            _json(f"$.properties.{c}", c)
            for c in ("site_relation_state", "contains_sites", *(features.PROPERTY_NAMES.get(n, n) for n in FACILITIES), "shower", "sport")
        ],
    )


def _entry_sql(r: str) -> str:
    place = f"'/' || {_TYPE_NAME.format(r)} || '/' || CAST({r}.osm_id AS varchar)"
    text = f"chr(9) || '<url>' || chr(10) || chr(9) || chr(9) || '<loc>{BASE_URL}/en' || {place} || '</loc>' || chr(10)"
    for code in ("en", "de", "fr", "es", "ru"):
        text += (
            f" || chr(9) || chr(9) || '<xhtml:link rel=\"alternate\" hreflang=\"{code}\" href=\"{BASE_URL}/{code}' || {place} || '\"/>' || chr(10)"
        )
    stamp = f"strftime({r}.ts, '%Y-%m-%dT%H:%M:%S')"
    return text + f" || chr(9) || chr(9) || '<lastmod>' || {stamp} || '+00:00</lastmod>' || chr(10) || chr(9) || '</url>' || chr(10)"


@query(
    f"SELECT r.addr_country AS country, r.osm_type, r.osm_id, {_entry_sql('r')} AS entry FROM ora_product r"
    " WHERE r.visible AND r.name IS NOT NULL AND r.addr_country IS NOT NULL"
)
def sitemap_urls(t):
    return sitemaps.sitemap_urls(t.marked, BASE_URL)


@query(
    "SELECT addr_country AS country, (row_number() OVER w - 1) // 7 AS part, osm_type, osm_id, row_number() OVER w - 1 AS position FROM ora_product"
    " WHERE visible AND name IS NOT NULL AND addr_country IS NOT NULL WINDOW w AS (PARTITION BY addr_country ORDER BY osm_type, osm_id)"
)
def sitemap_parts(t):
    """Place of every entry in the documents of its country, in parts of seven."""
    urls = sitemaps.sitemap_urls(t.marked, BASE_URL)
    parts = sitemaps.sitemap_parts(urls, sitemaps.country_dates(t.marked), 7)
    placed = sitemaps.numbered(urls).withColumn("part", F.expr("position DIV 7"))
    return placed.join(parts, ["country", "part"]).select("country", "part", *KEY, "position")


@query(
    f"SELECT addr_country AS country, chr(9) || '<sitemap>' || chr(10) || chr(9) || chr(9) || '<loc>{BASE_URL}/sitemaps/' || addr_country || '.xml</loc>' || chr(10)"
    " || chr(9) || chr(9) || '<lastmod>' || strftime(max(ts), '%Y-%m-%dT%H:%M:%S') || '+00:00</lastmod>' || chr(10) || chr(9) || '</sitemap>' || chr(10) AS entry"
    " FROM ora_product WHERE visible AND addr_country IS NOT NULL GROUP BY addr_country"
)
def sitemap_index(t):
    return sitemaps.sitemap_index(t.marked, BASE_URL)


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS importdate FROM events")
def import_date(t):
    return sitemaps.import_date(t.changes)


@query("SELECT op, count(*) AS n, count(new_x) AS n_new FROM fx_change GROUP BY op")
def change_source(t):
    """The feed as a stream, drained into a table."""
    source, target = fresh_path(t, "feed"), fresh_path(t, "drained")
    t.changes.write.parquet(source)
    run = (
        updater.change_source(t.spark, source)
        .writeStream.option("checkpointLocation", fresh_path(t, "checkpoint"))
        .trigger(availableNow=True)
        .format("parquet")
        .start(target)
    )
    run.awaitTermination()
    drained = t.spark.read.schema(CHANGE).parquet(target)
    return drained.groupBy("op").agg(F.count(F.lit(1)).alias("n"), F.count("new").alias("n_new"))


_UNTAGGED_NODES = (
    "SELECT node_id AS id FROM fx_way_node WHERE pos > 0"
    " UNION ALL SELECT 20000000000 + k * 32 + ring * 8 + i FROM fx_vertex WHERE osm_type = 'R' AND i > 0"
    " UNION ALL SELECT 40000000000 + osm_id * 2 FROM fx_line UNION ALL SELECT 40000000001 + osm_id * 2 FROM fx_line"
)


@query(
    "SELECT 'node' AS what, osm_id AS id, true AS point_poi, true AS polygon_poi, k1 IN ('playground', 'amenity') AS line_poi FROM fx_raw_tag"
    " UNION ALL SELECT 'way', p.osm_id, p.tourism IS NOT NULL OR p.leisure IS NOT NULL OR p.amenity IS NOT NULL,"
    " p.tourism IS NOT NULL OR p.leisure IS NOT NULL OR p.amenity IS NOT NULL, p.amenity IS NOT NULL FROM fx_poly p WHERE p.osm_type = 'W'"
    " UNION ALL SELECT 'way', osm_id, true, true, true FROM fx_line"
    f" UNION ALL SELECT 'node', id, false, false, false FROM ({_UNTAGGED_NODES})"
    f" UNION ALL SELECT 'way', osm_id * 4 + 3000000000 + part, false, false, false FROM fx_poly, (VALUES (0), (1), (2)) AS h(part) WHERE osm_type = 'R'"
)
def tag_whitelist(t):
    both = t.raw_nodes.select(F.lit("node").alias("what"), "id", "tags").unionByName(
        t.raw_ways.select(F.lit("way").alias("what"), "id", "tags")
    )
    tags = F.col("tags")
    return both.select(
        "what",
        "id",
        ingest.is_point_poi(tags).alias("point_poi"),
        ingest.is_polygon_poi(tags).alias("polygon_poi"),
        ingest.is_line_poi(tags).alias("line_poi"),
    )


@query(f"SELECT osm_type, osm_id, coalesce(tourism IN {SITES}, false) AS listed FROM ora_poi")
def value_in_list(t):
    return all_features(t.polys, t.points, t.lines).select(
        *KEY, value_in(F.col("tags")["tourism"], SITE_TOURISM).alias("listed")
    )


@query(
    "SELECT osm_id AS id, phone AS contact_phone, coalesce(website, url, contact_website) AS contact_website, booking AS reservation,"
    " CAST(NULL AS varchar) AS phone, CAST(NULL AS varchar) AS url FROM fx_raw_tag"
    f" UNION ALL SELECT id, NULL, NULL, NULL, NULL, NULL FROM ({_UNTAGGED_NODES})",
    name="unify_keys",
)
def unify_tag_keys(t):
    unified = t.raw_nodes.select("id", unify_keys(F.col("tags")).alias("tags"))
    return unified.select(
        "id", tag("contact:phone"), tag("contact:website"), tag("reservation"), tag("phone"), tag("url")
    )


@query(
    f"SELECT r.osm_id AS id, {_STAMP} AS ts FROM fx_raw_tag r"
    f" UNION ALL SELECT id, make_timestamp(1500000000000000) FROM ({_UNTAGGED_NODES})",
    name="utc_timestamp",
)
def utc_timestamps(t):
    return t.raw_nodes.select("id", utc_timestamp(F.col("timestamp")).alias("ts"))


@query("SELECT osm_type, osm_id, tourism FROM ora_site")
def site_filter(t):
    return all_features(t.polys, t.points).filter(is_site(F.col("tags"))).select(*KEY, tag("tourism"))


@query("SELECT osm_type, osm_id FROM ora_poi WHERE leisure = 'playground'")
def playground_filter(t):
    return all_features(t.polys, t.points, t.lines).filter(is_playground(F.col("tags"))).select(*KEY)


@query(f"SELECT osm_type, osm_id, {category('s')} AS category FROM ora_poi s WHERE shape_kind <> 'L'", name="site_category")
def category_of_site(t):
    return all_features(t.polys, t.points).select(*KEY, site_category(F.col("tags")).alias("category"))


@query(
    "SELECT osm_type, osm_id, "
    + ", ".join(f"coalesce({sql}, false) AS {n}" for n, sql in FACILITY_SQL.items())
    + " FROM ora_poi p"
)
def facility_predicates(t):
    return all_features(t.polys, t.points, t.lines).select(
        *KEY, *[c.alias(n) for n, c in facility_flags().items()]
    )


@query(
    f"SELECT osm_type, osm_id, {shower_name(POI_SHOWER.replace('p.', 's.'))} AS proven, {shower_name(OWN_SHOWER)} AS own FROM ora_poi s"
)
def shower_class(t):
    tags = F.col("tags")
    return all_features(t.polys, t.points, t.lines).select(
        *KEY, shower_label(poi_shower(tags)).alias("proven"), shower_label(own_shower(tags)).alias("own")
    )


_ALL_BOXES = (
    "(SELECT osm_type, osm_id, x0, y0, x0 + w AS x1, y0 + h AS y1 FROM fx_poly0"
    " UNION ALL SELECT 'N', osm_id, x, y, x, y FROM fx_point)"
)
_IN_BOX = f"b.x0 <= {2048 + 20 * 64} AND b.x1 >= {2048 - 10 * 64} AND b.y0 <= {2048 + 15 * 64} AND b.y1 >= {2048 - 5 * 64}"
_BBOX = "-10,-5,20,15"


@query(
    f"SELECT s.osm_type, s.osm_id FROM ora_site s JOIN {_ALL_BOXES} b ON b.osm_type = s.osm_type AND b.osm_id = s.osm_id WHERE {_IN_BOX}"
)
def bbox_query(t):
    return features.query_sites(t.live, bbox=_BBOX).select(*KEY)


@query("SELECT osm_type, osm_id, category FROM ora_product WHERE osm_type = 'W' AND osm_id = 21")
def id_query(t):
    return features.query_sites(t.live, osm_id="21", osm_type="way").select(*KEY, "category")


@query("SELECT osm_type, osm_id FROM ora_product WHERE addr_country = 'de'")
def country_query(t):
    return features.query_sites(t.live, country="DE").select(*KEY)


_REQUESTS = {
    "box before country": {"bbox": _BBOX, "country": "de"},
    "bad box": {"bbox": "1,2,3", "country": "de"},
    "box out of range": {"bbox": "-190,0,10,10"},
    "box not a number": {"bbox": "nan,0,10,10"},
    "country before id": {"country": "De", "osm_id": "21", "osm_type": "way"},
    "long country": {"country": "abcd"},
    "id": {"osm_id": "21", "osm_type": "way"},
    "bad type": {"osm_id": "21", "osm_type": "area"},
    "bad id": {"osm_id": "x21", "osm_type": "way"},
    "nothing": {},
}


@query(
    f"SELECT 'box before country' AS request, s.osm_type, s.osm_id FROM ora_site s JOIN {_ALL_BOXES} b ON b.osm_type = s.osm_type AND b.osm_id = s.osm_id WHERE {_IN_BOX}"
    " UNION ALL SELECT 'country before id', osm_type, osm_id FROM ora_addr WHERE addr_country = 'de'"
    " UNION ALL SELECT 'id', osm_type, osm_id FROM ora_site WHERE osm_type = 'W' AND osm_id = 21"
)
def request_routing(t):
    answers = [
        features.query_sites(t.live, **request).select(F.lit(name).alias("request"), *KEY)
        for name, request in _REQUESTS.items()
    ]
    return all_features(*answers)


@query(
    "SELECT osm_type, osm_id, ts FROM ora_product WHERE addr_country IS NOT NULL AND name IS NOT NULL AND visible"
)
def sitemap_filter(t):
    return t.marked.filter(sitemaps.is_listed()).select(*KEY, F.col("timestamp").alias("ts"))


@query(
    f"SELECT osm_type, osm_id, tourism FROM ora_poi WHERE shape_kind <> 'L' AND (tourism IN {SITES} OR tourism IS NULL)"
)
def retag_cleanup(t):
    """Areas and points after some were retagged; those without the tag stay."""
    return keep_tagged(all_features(t.polys, t.points), "tourism", SITE_TOURISM).select(*KEY, tag("tourism"))


@query(
    f"SELECT osm_type, osm_id, {category('s')} AS category, {shower_name(OWN_SHOWER)} AS shower, '' AS sport, true AS visible, "
    + ", ".join(f"false AS {n}" for n in FACILITY_SQL)
    + " FROM ora_site s WHERE shape_kind = 'P'"
)
def constant_columns(t):
    built = build_campsites(t.points, t.polys, t.country_grid)
    return built.filter("osm_type = 'N'").select(
        *KEY, "category", "shower", F.array_join("sport", ",").alias("sport"), "visible", *FACILITIES
    )
