"""The campsite product: sites with all that lies inside them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrid.functions.scalars import object_ref
from sitegrid.operators.country import country_lookup, needs_lookup, unify_country
from sitegrid.operators.facilities import (
    SITE_RULES,
    is_site,
    least_shower,
    mask_flags,
    own_shower,
    shower_label,
    site_category,
)
from sitegrid.operators.inside import distinct_shapes, found_list, inside, with_shape
from sitegrid.operators.relations import all_features, apply_gains, extend_members, relation_gains
from sitegrid.operators.quality import mark_quality
from sitegrid.operators.spatial import SPLIT_ROWS
from sitegrid.schema import FACILITIES, GEOMETRY, KEY
from sitegrid.session import written

LISTS = {"sport": "sport"}


def restrict(features: DataFrame, keys: DataFrame | None) -> DataFrame:
    return features if keys is None else features.join(keys.select(*KEY), KEY, "left_semi")


def build_campsites(
    points: DataFrame,
    polys: DataFrame,
    country_grid: DataFrame,
    keys: DataFrame | None = None,
    split_rows: int | None = SPLIT_ROWS,
    content_points: DataFrame | None = None,
) -> DataFrame:
    """All sites, or those in `keys`, with content, category, country and last change.

    `content_points` may be a part of `points` that holds all inside these sites.

    Areas look at points and areas inside them, themselves included. Sites mapped
    as points have no inside.
    """
    site = is_site(F.col("tags"))
    areas = with_shape(restrict(polys.filter(site), keys))
    spots = with_shape(restrict(points.filter(site), keys))
    near = points if content_points is None else content_points
    content = inside(areas, near, polys, LISTS, split_rows=split_rows, finer=keys is None)
    sites = areas.unionByName(spots)
    countries = country_lookup(
        country_grid,
        distinct_shapes(sites.filter(needs_lookup(F.col("tags")))),
        ["shape"],
        split_rows,
    )
    # both are narrow, one row per geometry; the wide site rows move once
    found = content.join(countries, "shape", "full")
    rows = sites.join(found, "shape", "left")
    own = object_ref(F.col("osm_type"), F.col("osm_id"))
    shower = least_shower(
        F.col("inside_shower"), F.col("inside_lacking"), own_shower(F.col("tags"))
    )
    flags = mask_flags("inside_mask")
    return rows.select(
        *KEY,
        unify_country(F.col("tags"), F.col("country")).alias("tags"),
        F.greatest("inside_ts", "timestamp").alias("timestamp"),
        site_category(F.col("tags")).alias("category"),
        *[flags[name].alias(name) for name in FACILITIES],
        shower_label(shower).alias("shower"),
        found_list("sport", own).alias("sport"),
        F.lit(True).alias("visible"),
        *GEOMETRY,
    )


def apply_site_relations(
    sites: DataFrame,
    site_members: DataFrame,
    points: DataFrame,
    lines: DataFrame,
    polys: DataFrame,
    rules=SITE_RULES,
    keys: DataFrame | None = None,
) -> DataFrame:
    """Spread tags, facilities, shower and sports along site relations.

    With `keys`, only relations that one of these objects belongs to are read. The
    members with their objects are written once, because several steps read them.
    """
    if keys is not None:
        wanted = keys.select(F.col("osm_type").alias("member_type"), F.col("osm_id").alias("member_id"))
        touched = site_members.join(wanted, ["member_type", "member_id"], "left_semi").select("site_id")
        site_members = site_members.join(touched, "site_id", "left_semi")
    members = written(extend_members(site_members, all_features(polys, points, lines)), "members")
    return apply_gains(sites, relation_gains(members, rules))


def full_campsites(points, lines, polys, site_members, country_grid, rules=SITE_RULES) -> DataFrame:
    """The whole product, in the order build, relations, nesting marks."""
    built = build_campsites(points, polys, country_grid)
    related = apply_site_relations(built, site_members, points, lines, polys, rules)
    return mark_quality(written(related, "related"))
