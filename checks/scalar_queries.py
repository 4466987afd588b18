"""Scalar functions on tags, text, numbers and geometry."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.input_queries import deg, tag
from checks.join_queries import members_of
from checks.registry import query
from sitegrid.functions import geometry as G
from sitegrid.functions import scalars
from sitegrid.functions import tags as tag_functions
from sitegrid.operators.country import country_lookup, unify_country
from sitegrid.operators.facilities import is_site
from sitegrid.operators.relations import NOT_INHERITED, all_features, camp_members
from sitegrid.operators.spatial import join_shapes
from sitegrid.plans import features
from sitegrid.schema import GEOMETRY, KEY


def tags():
    return F.col("tags")


def everything(t):
    return all_features(t.polys, t.points, t.lines)


@query("SELECT osm_type, osm_id, amenity, sport FROM ora_poi")
def tag_get(t):
    return everything(t).select(
        *KEY, tag_functions.tag_get(tags(), "amenity").alias("amenity"), tag_functions.tag_get(tags(), "sport").alias("sport")
    )


@query("SELECT osm_type, osm_id, shop IS NOT NULL AS has_shop, tourism IS NOT NULL AS has_tourism FROM ora_poi")
def tag_exists(t):
    return everything(t).select(
        *KEY,
        tag_functions.tag_exists(tags(), "shop").alias("has_shop"),
        tag_functions.tag_exists(tags(), "tourism").alias("has_tourism"),
    )


@query(
    "SELECT osm_type, osm_id, 'merged' AS name, coalesce(amenity, 'none') AS amenity FROM ora_poi"
)
def tags_merge(t):
    """The right map wins; what only the left one has stays."""
    right = F.create_map(F.lit("name"), F.lit("merged"))
    left = tag_functions.tags_merge(F.create_map(F.lit("amenity"), F.lit("none")), tags())
    return everything(t).select(*KEY, tag_functions.tags_merge(left, right).alias("tags")).select(
        *KEY, tag("name"), tag("amenity")
    )


@query(
    "SELECT osm_type, osm_id, CAST(NULL AS varchar) AS amenity, tourism, CAST((tourism IS NOT NULL)::int + (leisure IS NOT NULL)::int + (nudism IS NOT NULL)::int"
    " + (group_only IS NOT NULL)::int + (scout IS NOT NULL)::int + (backcountry IS NOT NULL)::int + (tents IS NOT NULL)::int + (caravans IS NOT NULL)::int"
    " + (motorhome IS NOT NULL)::int + (shower IS NOT NULL)::int + (addr_country IS NOT NULL)::int AS bigint) AS n_tags FROM fx_poly"
)
def tags_minus(t):
    return t.polys.select(*KEY, tag_functions.tags_minus(tags(), "amenity", "name", "sport").alias("tags")).select(
        *KEY, tag("amenity"), tag("tourism"), F.size("tags").cast("bigint").alias("n_tags")
    )


@query(
    "SELECT osm_type, osm_id, coalesce(tourism, '') || '/' || coalesce(leisure, '') AS pair, CAST((tourism IS NOT NULL)::int + (leisure IS NOT NULL)::int AS bigint) AS n FROM fx_poly"
)
def build_object(t):
    built = tag_functions.build_object({"tourism": tags()["tourism"], "leisure": tags()["leisure"]})
    both = F.concat(F.coalesce(tags()["tourism"], F.lit("")), F.lit("/"), F.coalesce(tags()["leisure"], F.lit("")))
    return t.polys.select(*KEY, built.alias("tags"), both.alias("pair")).select(
        *KEY, "pair", F.size("tags").cast("bigint").alias("n")
    )


def _unified(t):
    sites = all_features(t.polys, t.points).filter(is_site(tags()))
    countries = country_lookup(t.country_grid, sites, KEY)
    return sites.join(countries, KEY, "left").select(*KEY, unify_country(tags(), F.col("country")).alias("tags"))


@query("SELECT osm_type, osm_id, addr_country FROM ora_addr", name="unify_country")
def unified_country(t):
    return _unified(t).select(*KEY, tag("addr:country", "addr_country"))


@query(
    "SELECT a.osm_type, a.osm_id, a.addr_country, s.name, s.tourism FROM ora_addr a JOIN ora_site s ON s.osm_type = a.osm_type AND s.osm_id = a.osm_id"
)
def unify_tags(t):
    """The whole unified tag map."""
    return _unified(t).select(*KEY, tag("addr:country", "addr_country"), tag("name"), tag("tourism"))


@query(
    "SELECT osm_type, osm_id, site_id, site_name AS name, tourism, addr_country FROM ora_member WHERE camp"
)
def site_tags_merge(t):
    """Relation tags over member tags, without the relation's type, site and country."""
    camps = camp_members(members_of(t))
    inherited = tag_functions.tags_minus(F.col("site_tags"), *NOT_INHERITED)
    merged = tag_functions.tags_merge(F.col("member_tags"), inherited)
    return camps.select(*KEY, "site_id", merged.alias("tags")).select(
        *KEY, "site_id", tag("name"), tag("tourism"), tag("addr:country", "addr_country")
    )


@query(
    "SELECT osm_type, osm_id, array_to_string(string_split(sport, ';'), '|') AS sports, CAST(len(string_split(sport, ';')) AS bigint) AS n FROM ora_poi WHERE sport IS NOT NULL"
)
def json_sport_split(t):
    sports = scalars.split_list(tags()["sport"])
    return everything(t).filter(tags()["sport"].isNotNull()).select(
        *KEY, F.array_join(sports, "|").alias("sports"), F.size(sports).cast("bigint").alias("n")
    )


@query(
    "SELECT osm_type, osm_id, category, CASE WHEN pub THEN 'yes' END AS pub, CASE WHEN static_caravan THEN 'yes' END AS static_caravans,"
    " name, tourism, site_relation FROM ora_product"
)
def feature_properties(t):
    properties = t.marked.select(*KEY, F.to_json(features.feature_properties()).alias("p"))
    names = ["category", "pub", "static_caravans", "name", "tourism", "site_relation"]
    return properties.select(*KEY, *[F.get_json_object("p", f"$.{n}").alias(n) for n in names])


@query(
    "SELECT osm_type, osm_id, lower(addr_country) AS lowered, upper(addr_country) AS raised, CAST(length(addr_country) AS bigint) AS n FROM fx_poly WHERE addr_country IS NOT NULL"
)
def lower_upper_length(t):
    code = tags()["addr:country"]
    return t.polys.filter(code.isNotNull()).select(
        *KEY, F.lower(code).alias("lowered"), F.upper(code).alias("raised"), F.length(code).cast("bigint").alias("n")
    )


@query(
    "SELECT osm_type, osm_id, 'https://www.openstreetmap.org/' || CASE osm_type WHEN 'N' THEN 'node/' WHEN 'W' THEN 'way/' ELSE 'relation/' END || CAST(osm_id AS varchar) AS url FROM ora_poi",
    name="osm_url",
)
def object_url(t):
    return everything(t).select(*KEY, scalars.osm_url(F.col("osm_type"), F.col("osm_id")).alias("url"))


@query("SELECT DISTINCT CAST(site_id AS varchar) AS site FROM fx_site_member")
def cast_text(t):
    return t.site_members.select(F.col("site_id").cast("string").alias("site")).distinct()


@query(
    f"SELECT osm_type, osm_id, CAST(round(CAST({deg('x0')} / 3 AS decimal(20,12)), 7) AS double) AS minx FROM fx_poly0",
    name="round7",
)
def rounded(t):
    return t.polys.select(*KEY, scalars.round7(F.col("minx") / 3).alias("minx"))


@query(
    "SELECT osm_type, osm_id, coalesce(sport, name, 'none') AS label, greatest(ts, TIMESTAMP '1995-01-01') AS ts FROM ora_poi WHERE shape_kind <> 'L'"
)
def coalesce_greatest(t):
    floor = F.lit("1995-01-01 00:00:00").cast("timestamp_ntz")
    return all_features(t.polys, t.points).select(
        *KEY,
        F.coalesce(tags()["sport"], tags()["name"], F.lit("none")).alias("label"),
        F.greatest("timestamp", floor).alias("ts"),
    )


@query("SELECT osm_type, osm_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') || '+00:00' AS iso FROM ora_poi", name="iso_timestamp")
def iso_text(t):
    return everything(t).select(*KEY, scalars.iso_timestamp(F.col("timestamp")).alias("iso"))


@query(
    "SELECT osm_type, osm_id, concat_ws('|', amenity, leisure, sport) AS present, CAST((amenity IS NOT NULL)::int + (leisure IS NOT NULL)::int + (sport IS NOT NULL)::int AS bigint) AS n FROM ora_poi"
)
def array_clean(t):
    present = F.array_compact(F.array(tags()["amenity"], tags()["leisure"], tags()["sport"]))
    return everything(t).select(
        *KEY, F.array_join(present, "|").alias("present"), F.size(present).cast("bigint").alias("n")
    )


@query(
    "SELECT osm_type, osm_id, round((x - 2048) / 64, 9) AS x, round((y - 2048) / 64, 9) AS y FROM ora_centre"
)
def st_centroid(t):
    centre = F.expr(G.centroid("kind", "rings"))
    return all_features(t.polys, t.points).select(*KEY, centre.alias("c")).select(
        *KEY, F.round("c.x", 9).alias("x"), F.round("c.y", 9).alias("y")
    )


@query(
    f"SELECT p.osm_type, p.osm_id, {deg('s.x')} AS x, {deg('s.y')} AS y FROM fx_poly0 p JOIN ora_surface s ON s.k = p.k"
    f" UNION ALL SELECT osm_type, osm_id, {deg('x')}, {deg('y')} FROM fx_point"
)
def point_on_surface(t):
    place = F.expr(G.point_on_surface("kind", "rings"))
    return all_features(t.polys, t.points).select(*KEY, place.alias("c")).select(
        *KEY, F.col("c.x").alias("x"), F.col("c.y").alias("y")
    )


@query(
    f"SELECT osm_type, osm_id, {deg('x0')} AS minx, {deg('y0')} AS miny, {deg('x0 + w')} AS maxx, {deg('y0 + h')} AS maxy FROM fx_poly0"
    f" UNION ALL SELECT osm_type, osm_id, {deg('x1')}, {deg('y1')}, {deg('x2')}, {deg('y2')} FROM fx_line"
)
def bbox_extract(t):
    both = all_features(t.polys, t.lines).select(*KEY, "rings")
    return G.with_envelope(both).select(*KEY, "minx", "miny", "maxx", "maxy")


@query("SELECT a, b FROM ora_pair UNION ALL SELECT k, k FROM fx_poly0")
def bbox_overlap(t):
    left = t.polys.select(F.col("osm_id").alias("a"), *GEOMETRY)
    return join_shapes(left, t.polys.select(F.col("osm_id").alias("b"), *GEOMETRY), refine=False)


@query(
    f"SELECT osm_type, osm_id, 'Point' AS type, {deg('x')} AS x, {deg('y')} AS y FROM fx_point"
)
def as_geojson(t):
    made = t.points.select(*KEY, F.col("rings")[0][0].alias("place")).select(
        *KEY, F.expr(G.as_geojson("place")).alias("g")
    )
    return made.select(
        *KEY,
        F.get_json_object("g", "$.type").alias("type"),
        F.get_json_object("g", "$.coordinates[0]").cast("double").alias("x"),
        F.get_json_object("g", "$.coordinates[1]").cast("double").alias("y"),
    )

