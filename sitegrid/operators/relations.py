"""Site relations: members, what they give to the sites among them, and their state.

A relation may hold any number of members, so members are first reduced to one
row per relation. Sites join that row; member pairs are never built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrid.functions import geometry as G
from sitegrid.functions.tags import build_object, tags_merge, tags_minus
from sitegrid.operators.facilities import (
    FLAGS_MASK,
    SITE_RULES,
    facility_mask,
    has_shower_evidence,
    least_shower,
    mask_flags,
    own_shower,
    poi_shower,
    shower_label,
)
from sitegrid.operators.spatial import AREA_LEVEL, CELL_LEVEL, area_cells, cell_field, may_have, point_cell
from sitegrid.schema import ENVELOPE, GEOMETRY, KEY
from sitegrid.session import written

# Tags of a relation that are not handed to its sites, and the markers we add.
NOT_INHERITED = ["type", "site", "addr:country"]
RELATION = "site_relation"
STATE = "site_relation_state"


def all_features(*tables: DataFrame) -> DataFrame:
    first, *rest = tables
    for table in rest:
        first = first.unionByName(table)
    return first


def extend_members(site_members: DataFrame, features: DataFrame) -> DataFrame:
    """Members with the tags and geometry of the object they name.

    A bit field of the members' keys drops other objects next to the scan.
    """
    named = site_members.select(
        "site_id",
        F.col("member_type").alias("osm_type"),
        F.col("member_id").alias("osm_id"),
        "site_tags",
    )
    wanted = may_have(cell_field(named.select(F.xxhash64(*KEY).alias("cell"))), f"xxhash64({', '.join(KEY)})")
    objects = features.filter(wanted).select(*KEY, F.col("tags").alias("member_tags"), *GEOMETRY)
    return named.join(objects, KEY)


def is_camp(tags):
    """Relations serve camp sites only, not caravan sites."""
    return F.coalesce(tags["tourism"] == "camp_site", F.lit(False))


def relation_summary(members: DataFrame, rules=SITE_RULES) -> DataFrame:
    """One row per relation: what its members prove, and the reach of the others."""
    tags = F.col("tags")
    other = ~F.col("camp")
    showers = has_shower_evidence(tags)
    narrow = members.withColumnRenamed("member_tags", "tags").select(
        "site_id",
        is_camp(tags).alias("camp"),
        facility_mask(rules).alias("mask"),
        F.when(showers, poi_shower(tags)).alias("shower"),
        (showers & poi_shower(tags).isNull()).alias("lacking"),
        tags["sport"].alias("sport"),
        *ENVELOPE,
    )
    return narrow.groupBy("site_id").agg(
        F.count_if("camp").alias("camps"),
        F.count_if(other).alias("others"),
        F.bit_or("mask").alias("rel_mask"),
        F.min("shower").alias("rel_shower"),
        F.bool_or("lacking").alias("rel_lacking"),
        F.collect_set("sport").alias("rel_sport"),
        F.min(F.when(other, F.col("minx"))).alias("o_minx"),
        F.min(F.when(other, F.col("miny"))).alias("o_miny"),
        F.max(F.when(other, F.col("maxx"))).alias("o_maxx"),
        F.max(F.when(other, F.col("maxy"))).alias("o_maxy"),
    )


def camp_members(members: DataFrame) -> DataFrame:
    return members.filter(is_camp(F.col("member_tags")))


def _covered_places(shapes: DataFrame, places: DataFrame) -> DataFrame:
    """(site_id, shape, n): how many distinct places of its relation each area surrounds.

    Areas are cut into cells. A cell all inside an area takes the number of places that its
    relation has there, which is counted before it meets any area; only cells on an area's
    edge meet single places. So a row is a cell of an area, not an area and a member.
    """
    keys = ["site_id", "shape"]
    left = shapes.select(
        *keys,
        F.expr(G.edges("rings")).alias("l_edges"),
        *[F.col(c).alias("l_" + c) for c in ENVELOPE],
        F.expr(AREA_LEVEL).alias("l_level"),
    )
    cells = written(area_cells(left, keys), "cells").withColumn("level", F.expr(CELL_LEVEL))
    used = cells.select("site_id", "level").distinct()
    placed = places.join(used, "site_id").select("site_id", "x", "y", F.expr(point_cell("level", "x", "y")).alias("cell"))
    counts = placed.groupBy("site_id", "cell").agg(F.count(F.lit(1)).alias("n"))
    inside = cells.filter("l_edges IS NULL").join(counts, ["site_id", "cell"]).select(*keys, "n")
    exact = G.covers_point("l_edges", "x", "y", strict=True)
    box = "x BETWEEN l_minx AND l_maxx AND y BETWEEN l_miny AND l_maxy"
    edge = cells.filter("l_edges IS NOT NULL").join(placed, ["site_id", "cell"]).filter(f"{box} AND {exact}")
    return inside.unionByName(edge.select(*keys, F.lit(1).cast("bigint").alias("n"))).groupBy(*keys).agg(F.sum("n").alias("n"))


def all_within(members: DataFrame, summary: DataFrame) -> DataFrame:
    """(site_id, osm_type, osm_id) of sites around all non-camp members.

    The envelope of all other members must lie in the site's envelope, which
    settles almost every relation. The rest is a division by counting: an area is around
    all members if it surrounds as many distinct places as its relation has. Lines and
    areas among the members, each shape once, meet only the areas that pass. Sites of one
    geometry count once. A point surrounds only points of its own place.
    """
    reach = summary.filter(F.col("others") > 0).select("site_id", "o_minx", "o_miny", "o_maxx", "o_maxy")
    camps = (
        camp_members(members)
        .select("site_id", *KEY, *GEOMETRY)
        .join(reach, "site_id")
        .filter(G.box_covers("", "o_"))
        .drop("o_minx", "o_miny", "o_maxx", "o_maxy")
        .withColumn("shape", F.expr(G.shape_digest("kind", "rings")))
    )
    same_place = camps.filter(F.col("kind") == "P").select("site_id", *KEY)
    areas = written(camps.filter(F.col("kind") == "A"), "camp-areas")
    shapes = areas.dropDuplicates(["site_id", "shape"]).select("site_id", "shape", "rings", *ENVELOPE)
    asked = areas.select("site_id").distinct()
    others = members.filter(~is_camp(F.col("member_tags"))).join(asked, "site_id", "left_semi")
    places = others.filter(F.col("kind") == "P").selectExpr("site_id", "minx AS x", "miny AS y").distinct()
    places = written(places, "member-places")

    total = places.groupBy("site_id").agg(F.count(F.lit(1)).alias("places"))
    around_places = written(
        shapes.join(total, "site_id", "left")
        .join(_covered_places(shapes, places), ["site_id", "shape"], "left")
        .filter("coalesce(places, 0) = coalesce(n, 0)")
        .select("site_id", "shape", F.expr(G.edges("rings")).alias("l_edges"), *[F.col(c).alias("l_" + c) for c in ENVELOPE]),
        "around-places",
    )
    extended = (
        others.filter(F.col("kind") != "P")
        .withColumn("member", F.expr(G.shape_digest("kind", "rings")))
        .dropDuplicates(["site_id", "member"])
        .select(
            "site_id",
            F.col("kind").alias("r_kind"),
            F.expr(G.edges("rings")).alias("r_edges"),
            F.expr(G.inside_points("rings")).alias("r_inner_points"),
            *[F.col(c).alias("r_" + c) for c in ENVELOPE],
        )
    )
    outside = ~F.coalesce(F.expr(G.shape_contains("l_", "r_")), F.lit(False))
    cut = around_places.join(extended, "site_id").filter(outside).select("site_id", "shape").distinct()
    covering = around_places.select("site_id", "shape").join(cut, ["site_id", "shape"], "left_anti")
    around = areas.join(covering, ["site_id", "shape"], "left_semi").select("site_id", *KEY)
    return around.unionByName(same_place)


def relation_gains(members: DataFrame, rules=SITE_RULES) -> DataFrame:
    """One row per camp member: all that its relations give it, and their state.

    The relation with the highest id hands over its tags.
    """
    summary = relation_summary(members, rules)
    within = all_within(members, summary).withColumn("within", F.lit(True))
    camps = (
        camp_members(members)
        .select("site_id", *KEY, "site_tags", own_shower(F.col("member_tags")).alias("own"))
        .dropDuplicates(["site_id", *KEY])
    )
    joined = camps.join(summary, "site_id").join(within.dropDuplicates(), ["site_id", *KEY], "left")
    per_pair = F.when(
        F.col("rel_lacking") | F.col("rel_shower").isNotNull(),
        least_shower(F.col("rel_shower"), F.col("rel_lacking"), F.col("own")),
    )
    fits = F.when(F.col("others") > 0, F.coalesce("within", F.lit(False)))
    return joined.groupBy(*KEY).agg(
        F.bit_or("rel_mask").alias("gain_mask"),
        F.min(per_pair).alias("gain_shower"),
        F.flatten(F.collect_list("rel_sport")).alias("gain_sport"),
        F.max("site_id").alias("site_id"),
        F.max_by("site_tags", "site_id").alias("site_tags"),
        F.bool_or(F.col("camps") != 1).alias("invalid"),
        F.coalesce(F.bool_and(fits), F.lit(False)).alias("useless"),
    )


def apply_gains(sites: DataFrame, gains: DataFrame) -> DataFrame:
    """Merge tags, set flags, shower and sports, and write the markers.

    Order: relation tags, then the relation's id, then its state, where `useless`
    overrides `invalid`.
    """
    columns = sites.columns
    state = F.when(F.col("useless"), "useless").when(F.col("invalid"), "invalid")
    tags = tags_merge(
        tags_merge(F.col("tags"), tags_minus(F.col("site_tags"), *NOT_INHERITED)),
        build_object({RELATION: F.col("site_id"), STATE: state}),
    )
    gained = F.col("gain_mask").isNotNull()
    flags = mask_flags(f"(({FLAGS_MASK}) | coalesce(gain_mask, 0L))")
    joined = sites.join(gains, KEY, "left")
    changed = {
        "tags": F.when(gained, tags).otherwise(F.col("tags")),
        **flags,
        "shower": F.coalesce(shower_label(F.col("gain_shower")), F.col("shower")),
        "sport": F.when(
            gained, F.array_sort(F.array_union("sport", F.col("gain_sport")))
        ).otherwise(F.col("sport")),
    }
    return joined.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in columns])
