"""Joins, aggregates, relations, quality marks and whole products."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from checks.input_queries import flat_playgrounds, tag
from checks.oracle_views import FACILITY_SQL, RELATION_SQL, flags, shower_name
from checks.registry import query
from sitegrid.functions.scalars import object_ref, osm_url
from sitegrid.operators import quality, relations
from sitegrid.operators.country import country_lookup
from sitegrid.operators.facilities import (
    SITE_RULES_AS_WRITTEN,
    is_playground,
    is_site,
    least_shower,
    mask_flags,
    own_shower,
    shower_label,
)
from sitegrid.operators.inside import found_list, inside, with_shape
from sitegrid.operators.relations import all_features, extend_members
from sitegrid.operators.spatial import join_all, join_shapes
from sitegrid.plans import features, sitemaps
from sitegrid.plans.campsites import LISTS, apply_site_relations, build_campsites
from sitegrid.plans.playgrounds import LISTS as GROUND_LISTS
from sitegrid.plans.playgrounds import build_playgrounds
from sitegrid.schema import FACILITIES, GEOMETRY, KEY
from sitegrid.operators.quality import mark_quality

FLAG_LIST = ", ".join(FACILITY_SQL)


def areas_of(df, prefix: str = "site_"):
    """Site areas with prefixed keys and their geometry."""
    return df.filter(is_site(F.col("tags"))).select(
        F.col("osm_type").alias(prefix + "type"), F.col("osm_id").alias(prefix + "id"), *GEOMETRY
    )


def flat_site(df, *more):
    return df.select(
        *KEY,
        F.col("timestamp").alias("ts"),
        "category",
        *FACILITIES,
        "shower",
        F.array_join("sport", ",").alias("sport"),
        tag("addr:country", "addr_country"),
        tag("name"),
        *more,
    )


def members_of(t):
    return extend_members(t.site_members, all_features(t.polys, t.points, t.lines))


@query(
    "SELECT s.osm_type AS site_type, s.osm_id AS site_id, t.osm_type, t.osm_id FROM ora_site_area s JOIN ora_touch t ON t.k = s.k"
)
def poi_in_site(t):
    return join_all(areas_of(t.polys), t.points.select(*KEY, *GEOMETRY), t.polys.select(*KEY, *GEOMETRY))


@query(
    "SELECT s.osm_type AS site_type, s.osm_id AS site_id, b.osm_type, b.osm_id FROM ora_site_area s JOIN fx_poly0 b ON s.x0 <= b.x0 + b.w"
    " AND s.x0 + s.w >= b.x0 AND s.y0 <= b.y0 + b.h AND s.y0 + s.h >= b.y0"
    " UNION ALL SELECT s.osm_type, s.osm_id, l.osm_type, l.osm_id FROM ora_site_area s JOIN fx_line l ON s.x0 <= l.x2"
    " AND s.x0 + s.w >= l.x1 AND s.y0 <= l.y2 AND s.y0 + s.h >= l.y1"
)
def bbox_join_refine(t):
    """The envelope stage alone."""
    extended = t.polys.unionByName(t.lines).select(*KEY, *GEOMETRY)
    return join_shapes(areas_of(t.polys), extended, refine=False)


@query(
    "SELECT s.osm_type, s.osm_id, c.country FROM ora_site s JOIN ora_country c ON c.osm_type = s.osm_type AND c.osm_id = s.osm_id",
    name="country_lookup",
)
def country_of_site(t):
    sites = all_features(t.polys, t.points).filter(is_site(F.col("tags")))
    return country_lookup(t.country_grid, sites, KEY)


@query("SELECT site_id, osm_type, osm_id, shape_kind AS kind, site_name, tourism, amenity FROM ora_member")
def site_members_extended(t):
    tags = F.col("member_tags")
    return members_of(t).select(
        "site_id",
        *KEY,
        "kind",
        F.col("site_tags")["name"].alias("site_name"),
        tags["tourism"].alias("tourism"),
        tags["amenity"].alias("amenity"),
    )


@query(
    "SELECT s.site_id, s.osm_type, s.osm_id, count(DISTINCT CASE WHEN NOT p.camp THEN p.osm_type || CAST(p.osm_id AS varchar) END) AS others, "
    "count(DISTINCT CASE WHEN p.camp THEN p.osm_type || CAST(p.osm_id AS varchar) END) AS camps, "
    + flags(RELATION_SQL)
    + " FROM ora_member s JOIN ora_member p ON p.site_id = s.site_id WHERE s.camp GROUP BY s.site_id, s.osm_type, s.osm_id"
)
def site_self_join(t):
    """Each camp member with what all members of its relation prove, without pairs."""
    members = members_of(t)
    summary = relations.relation_summary(members)
    joined = relations.camp_members(members).join(summary, "site_id")
    return joined.select("site_id", *KEY, "others", "camps", *[c.alias(n) for n, c in mask_flags("rel_mask").items()])


@query(f"SELECT osm_type, osm_id, {FLAG_LIST} FROM ora_related")
def site_facility_update(t):
    gains = relations.relation_gains(members_of(t))
    return relations.apply_gains(t.built, gains).select(*KEY, *FACILITIES)


@query(
    "SELECT c.osm_type, c.osm_id, "
    + ", ".join(f"c.{n} OR coalesce(g.{n}, false) AS {n}" for n in FACILITY_SQL)
    + " FROM ora_campsite c LEFT JOIN ora_gain_as_written g ON g.osm_type = c.osm_type AND g.osm_id = c.osm_id"
)
def site_facility_update_as_written(t):
    gains = relations.relation_gains(members_of(t), SITE_RULES_AS_WRITTEN)
    return relations.apply_gains(t.built, gains).select(*KEY, *FACILITIES)


def nested(t):
    sites = with_shape(t.related)
    return sites, quality.nested_shapes(sites)


@query(
    "SELECT outer_type AS osm_type, outer_id AS osm_id, count(*) AS n, min(inner_type || CAST(inner_id AS varchar)) AS first_inner"
    " FROM ora_nested GROUP BY outer_type, outer_id"
)
def site_contains_site(t):
    sites, pairs = nested(t)
    inner = quality.contained_sites(sites, pairs)
    found = sites.join(inner, "shape").select(*KEY, quality.others_inside().alias("found"))
    refs = F.transform("found", lambda s: object_ref(s["osm_type"], s["osm_id"]))
    return found.filter(F.size("found") > 0).select(
        *KEY, F.size("found").cast("bigint").alias("n"), F.array_min(refs).alias("first_inner")
    )


@query(
    "SELECT s.site_id, s.osm_type, s.osm_id FROM ora_member s JOIN ora_member r ON r.site_id = s.site_id AND NOT r.camp"
    " LEFT JOIN ora_within w ON w.k = s.k AND w.osm_type = r.osm_type AND w.osm_id = r.osm_id"
    " LEFT JOIN fx_point sp ON s.shape_kind = 'P' AND sp.osm_type = s.osm_type AND sp.osm_id = s.osm_id"
    " LEFT JOIN fx_point rp ON s.shape_kind = 'P' AND rp.osm_type = r.osm_type AND rp.osm_id = r.osm_id"
    " WHERE s.camp GROUP BY s.site_id, s.osm_type, s.osm_id"
    " HAVING bool_and(w.k IS NOT NULL OR coalesce(sp.x = rp.x AND sp.y = rp.y, false))"
)
def members_within_site(t):
    members = members_of(t)
    return relations.all_within(members, relations.relation_summary(members))


@query(
    "SELECT site_id, osm_type, osm_id FROM ora_member m WHERE camp AND site_id IN (SELECT site_id FROM ora_camp_count WHERE camps <> 1)"
)
def semi_join_in(t):
    members = members_of(t)
    wrong = relations.relation_summary(members).filter("camps > 1").select("site_id")
    return relations.camp_members(members).join(wrong, "site_id", "left_semi").select("site_id", *KEY)


@query("SELECT osm_type, osm_id, " + FLAG_LIST + " FROM ora_campsite WHERE osm_type <> 'N'")
def facility_bool_or(t):
    areas = with_shape(t.polys.filter(is_site(F.col("tags"))))
    content = inside(areas, t.points, t.polys, LISTS)
    return areas.join(content, "shape").select(*KEY, *[c.alias(n) for n, c in mask_flags("inside_mask").items()])


@query(f"SELECT osm_type, osm_id, {shower_name('shower_rank')} AS shower FROM ora_campsite WHERE osm_type <> 'N'")
def shower_min_enum(t):
    areas = with_shape(t.polys.filter(is_site(F.col("tags"))))
    content = inside(areas, t.points, t.polys, LISTS)
    rank = least_shower(F.col("inside_shower"), F.col("inside_lacking"), own_shower(F.col("tags")))
    return areas.join(content, "shape").select(*KEY, shower_label(rank).alias("shower"))


@query("SELECT osm_type, osm_id, ts FROM ora_campsite")
def site_last_change(t):
    return build_campsites(t.points, t.polys, t.country_grid).select(*KEY, F.col("timestamp").alias("ts"))


def ground_content(t):
    areas = with_shape(t.polys.filter(is_playground(F.col("tags"))))
    content = inside(areas, t.points, t.polys.unionByName(t.lines), GROUND_LISTS, flags=False)
    return areas.join(content, "shape")


@query("SELECT osm_type, osm_id, equipment FROM ora_playground WHERE osm_type <> 'N'")
def playground_equipment(t):
    own = object_ref(F.col("osm_type"), F.col("osm_id"))
    return ground_content(t).select(*KEY, F.array_join(found_list("equipment", own), ",").alias("equipment"))


@query("SELECT osm_type, osm_id, sport FROM ora_campsite WHERE osm_type <> 'N'")
def site_sports(t):
    return t.built.filter("kind = 'A'").select(*KEY, F.array_join("sport", ",").alias("sport"))


@query("SELECT osm_type, osm_id, contains_sites FROM ora_contains")
def contains_sites_urls(t):
    sites, pairs = nested(t)
    inner = quality.contained_sites(sites, pairs, quality.is_camp_inside())
    found = sites.join(inner, "shape").select(*KEY, quality.others_inside().alias("found"))
    urls = F.transform("found", lambda s: osm_url(s["osm_type"], s["osm_id"], quality.SHORT_URL))
    return found.filter(F.size("found") > 0).select(*KEY, F.array_join(urls, " ").alias("contains_sites"))


@query("SELECT osm_type, osm_id FROM ora_useless")
def relation_all_within(t):
    return relations.relation_gains(members_of(t)).filter("useless").select(*KEY)


@query("SELECT site_id, camps FROM ora_camp_count WHERE camps <> 1")
def camp_members_per_site(t):
    return relations.relation_summary(members_of(t)).filter("camps > 1").select("site_id", "camps")


@query("SELECT osm_type, osm_id, sport FROM ora_related")
def site_relation_sports(t):
    return relations.apply_gains(t.built, relations.relation_gains(members_of(t))).select(
        *KEY, F.array_join("sport", ",").alias("sport")
    )


@query(
    "SELECT addr_country AS country, max(ts) AS ts FROM ora_product WHERE visible AND addr_country IS NOT NULL GROUP BY addr_country"
)
def country_max_ts(t):
    return sitemaps.country_dates(t.marked).withColumnRenamed("timestamp", "ts")


@query("SELECT osm_type, osm_id FROM ora_hidden")
def distinct_inner(t):
    sites, pairs = nested(t)
    return sites.join(quality.hidden_shapes(sites, pairs), "shape", "left_semi").select(*KEY)


@query("SELECT count(*) AS n FROM ora_addr WHERE addr_country = 'de'")
def json_agg_features(t):
    """One collection document of a country; counted after parsing it again."""
    found = features.site_features(features.query_sites(t.live, country="de"))
    document = features.feature_collection(found)
    parsed = F.from_json("collection", "type string, features array<struct<id:string>>")
    return document.select(F.size(parsed["features"]).cast("bigint").alias("n"))


@query("SELECT osm_type, osm_id, count(*) AS n FROM (SELECT s.osm_type, s.osm_id FROM ora_site_area s JOIN ora_touch t ON t.k = s.k) GROUP BY osm_type, osm_id")
def group_by_site(t):
    pairs = join_all(areas_of(t.polys), t.points.select(*GEOMETRY), t.polys.select(*GEOMETRY))
    return pairs.groupBy(F.col("site_type").alias("osm_type"), F.col("site_id").alias("osm_id")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query("SELECT osm_type, osm_id, max(site_id) AS site_id, max_by(site_name, site_id) AS site_name FROM ora_member WHERE camp GROUP BY osm_type, osm_id")
def last_relation_wins(t):
    return relations.relation_gains(members_of(t)).select(
        *KEY, "site_id", F.col("site_tags")["name"].alias("site_name")
    )


@query("SELECT osm_type, osm_id, shape_kind AS kind FROM ora_poi")
def all_pois(t):
    return all_features(t.polys, t.points, t.lines).select(*KEY, "kind")


@query("SELECT osm_type, osm_id, category FROM ora_campsite")
def areas_union_points(t):
    return t.built.select(*KEY, "category")


@query(
    "SELECT c.osm_type, c.osm_id, array_to_string(list_sort(list_distinct(list_concat(list_filter(string_split(c.sport, ','), lambda v: v <> ''),"
    " list_filter(string_split(coalesce(s.sport, ''), ';'), lambda v: v <> '')))), ',') AS sports FROM ora_campsite c"
    " JOIN ora_site s ON s.osm_type = c.osm_type AND s.osm_id = c.osm_id WHERE c.sport <> '' OR s.sport IS NOT NULL"
)
def array_union_distinct(t):
    own = F.coalesce(F.split(F.col("tags")["sport"], ";"), F.array().cast("array<string>"))
    merged = F.array_sort(F.array_union("sport", own))
    return t.built.filter(F.size(merged) > 0).select(*KEY, F.array_join(merged, ",").alias("sports"))


@query("SELECT osm_type, osm_id, contains_sites FROM ora_product")
def mark_contains_sites(t):
    return mark_quality(t.related).select(*KEY, tag("contains_sites"))


@query("SELECT osm_type, osm_id, visible FROM ora_product")
def mark_visibility(t):
    return quality.visible_sites(t.related)


@query("SELECT osm_type, osm_id, site_relation FROM ora_related")
def mark_site_relation(t):
    return t.related.select(*KEY, tag("site_relation"))


@query(
    "SELECT c.osm_type, c.osm_id, i.osm_id IS NOT NULL AS invalid FROM ora_gain c LEFT JOIN ora_invalid i ON i.osm_type = c.osm_type AND i.osm_id = c.osm_id"
)
def mark_invalid_relation(t):
    return relations.relation_gains(members_of(t)).select(*KEY, "invalid")


@query("SELECT osm_type, osm_id, site_relation_state FROM ora_related")
def mark_useless_relation(t):
    """Useless overrides invalid."""
    return t.related.select(*KEY, tag("site_relation_state"))


@query(f"SELECT osm_type, osm_id, {shower_name('shower_rank')} AS shower FROM ora_gain")
def site_relation_shower(t):
    return relations.relation_gains(members_of(t)).select(
        *KEY, shower_label(F.col("gain_shower")).alias("shower")
    )


_PRODUCT = f"osm_type, osm_id, ts, category, {FLAG_LIST}, {shower_name('shower_rank')} AS shower, sport, addr_country, name"


@query(f"SELECT {_PRODUCT} FROM ora_campsite", name="build_campsites")
def campsites_built(t):
    return flat_site(build_campsites(t.points, t.polys, t.country_grid))


@query("SELECT osm_type, osm_id, ts, equipment, sport FROM ora_playground", name="build_playgrounds")
def playgrounds_built(t):
    return flat_playgrounds(build_playgrounds(t.points, t.lines, t.polys))


@query(
    f"SELECT {_PRODUCT}, site_relation, site_relation_state FROM ora_related", name="apply_site_relations"
)
def relations_applied(t):
    related = apply_site_relations(t.built, t.site_members, t.points, t.lines, t.polys)
    return flat_site(related, tag("site_relation"), tag("site_relation_state"))


@query(
    f"SELECT r.osm_type, r.osm_id, count(*) OVER (PARTITION BY r.addr_country) AS in_country FROM ora_product r WHERE r.addr_country = 'de'"
)
def query_sites(t):
    found = features.query_sites(t.live, country="de")
    per_country = F.count(F.lit(1)).over(Window.partitionBy(F.col("tags")["addr:country"]))
    return found.select(*KEY, per_country.alias("in_country"))


@query("SELECT m.a AS site, m.b AS other FROM ora_area_meet m JOIN ora_site_area s ON s.k = m.a")
def st_intersects(t):
    """Areas that touch site areas, exact on shared borders."""
    left = t.polys.filter(is_site(F.col("tags"))).select(F.col("osm_id").alias("site"), *GEOMETRY)
    return join_shapes(left, t.polys.select(F.col("osm_id").alias("other"), *GEOMETRY))


@query(
    "SELECT w.k AS area, w.osm_type, w.osm_id FROM ora_within w"
    " UNION ALL SELECT k, osm_type, osm_id FROM fx_poly0"
)
def st_contains(t):
    left = t.polys.select(F.col("osm_id").alias("area"), *GEOMETRY)
    return join_all(left, t.points.select(*KEY, *GEOMETRY), t.polys.select(*KEY, *GEOMETRY), strict=True)

