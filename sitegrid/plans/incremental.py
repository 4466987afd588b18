"""Apply a batch of changes and rebuild only the sites it can affect.

A site is affected if it changed itself, if an object that touched it before or
touches it now changed, or if a relation it belongs to, or a member of that
relation, changed. All changed objects count, also sites, so the result equals a
full build.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegrid.functions.tags import unify_keys, value_in
from sitegrid.operators.facilities import SITE_RULES, SITE_TOURISM, is_playground, is_site
from sitegrid.operators.quality import mark_quality, renew_marks
from sitegrid.operators.relations import all_features
from sitegrid.operators.spatial import cell_field, join_all, may_have, points_near
from sitegrid.plans.campsites import apply_site_relations, build_campsites, restrict
from sitegrid.plans.playgrounds import build_playgrounds
from sitegrid.schema import GEOMETRY, KEY
from sitegrid.session import written
from sitegrid.sources.ingest import is_line_poi, is_point_poi, is_polygon_poi


@dataclass
class Base:
    """The ingested tables at one moment."""

    points: DataFrame
    lines: DataFrame
    polys: DataFrame
    site_members: DataFrame
    #: all features ordered by key, where they are stored a second time for look-ups
    objects: DataFrame | None = None

    def features(self) -> DataFrame:
        return all_features(self.polys, self.points, self.lines)

    def images(self, keys: DataFrame) -> DataFrame:
        """These objects as they are here. With `objects`, only files and row groups that may hold one are read."""
        if self.objects is None:
            return at_keys(self.features(), keys)
        return at_keys(self.objects.filter(key_ranges(keys)), keys)


#: intervals of keys that travel to the scan, per object type
KEY_RANGES = 256


def key_ranges(keys: DataFrame) -> str:
    """A condition of bounded length that holds for all keys: intervals of ids, as a scan compares them with its statistics."""
    bounds = keys.groupBy("osm_type").agg(F.min("osm_id").alias("low"), F.max("osm_id").alias("high"))
    part = F.expr(f"(osm_id - low) DIV ((high - low) DIV {KEY_RANGES} + 1)")
    parts = keys.join(F.broadcast(bounds), "osm_type").groupBy("osm_type", part.alias("part"))
    found = parts.agg(F.min("osm_id").alias("a"), F.max("osm_id").alias("b")).collect()  # at most KEY_RANGES a type
    return " OR ".join(f"(osm_type = '{r.osm_type}' AND osm_id >= {r.a} AND osm_id <= {r.b})" for r in sorted(found)) or "false"


def at_keys(features: DataFrame, keys: DataFrame) -> DataFrame:
    """The features with these keys; a bit field drops most others next to the scan."""
    keys = keys.select(*KEY)
    maybe = may_have(cell_field(keys.select(F.xxhash64(*KEY).alias("cell"))), f"xxhash64({', '.join(KEY)})")
    return features.filter(maybe).join(keys, KEY, "left_semi").select(*features.columns)


def latest_versions(changes: DataFrame) -> DataFrame:
    """The newest change of each object."""
    newest_first = Window.partitionBy(*KEY).orderBy(F.desc("ts"), F.desc("seq"))
    return changes.withColumn("n", F.row_number().over(newest_first)).filter("n = 1").drop("n")


def flagged(objects: DataFrame, tags: str = "tags") -> DataFrame:
    """Keys with what the object is."""
    return objects.select(*KEY, is_site(F.col(tags)).alias("is_cs"), is_playground(F.col(tags)).alias("is_pg"))


def queue_flags(changes: DataFrame) -> DataFrame:
    """Changed objects with what they are now."""
    return flagged(latest_versions(changes), "new.tags")


def queued(*keys: DataFrame) -> DataFrame:
    """Each key of any of the tables once."""
    return all_features(*(k.select(*KEY) for k in keys)).dropDuplicates(KEY)


def new_features(latest: DataFrame) -> DataFrame:
    """New versions that are still POIs, with unified keys."""
    image = latest.filter("new.kind IS NOT NULL").select(*KEY, "new.*")
    tags, kind = F.col("tags"), F.col("kind")
    poi = (
        F.when(kind == "P", is_point_poi(tags))
        .when(kind == "A", is_polygon_poi(tags))
        .otherwise(is_line_poi(tags))
    )
    return image.filter(poi).select(*KEY, "timestamp", unify_keys(tags).alias("tags"), *GEOMETRY)


def new_members(latest: DataFrame) -> DataFrame:
    """Members of changed site relations that still serve a site."""
    tags = F.col("new.tags")
    served = latest.filter(
        (F.col("osm_type") == "R")
        & (tags["type"] == "site")
        & (value_in(tags["tourism"], SITE_TOURISM) | value_in(tags["site"], SITE_TOURISM))
    )
    return served.select(
        F.col("osm_id").alias("site_id"),
        F.col("new.timestamp").alias("timestamp"),
        F.explode("members").alias("m"),
        unify_keys(tags).alias("site_tags"),
    ).select(
        "site_id",
        "timestamp",
        F.upper("m.type").alias("member_type"),
        F.col("m.ref").alias("member_id"),
        "site_tags",
    )


def changed_relations(latest: DataFrame) -> DataFrame:
    return latest.filter("osm_type = 'R'").select(F.col("osm_id").alias("site_id"))


def without(old: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return old.join(keys.select(*on), on, "left_anti").select(*old.columns)


def replace_rows(old: DataFrame, keys: DataFrame, fresh: DataFrame, on: list[str]) -> DataFrame:
    """`old` without the rows in `keys`, and the fresh rows."""
    return without(old, keys, on).unionByName(fresh.select(*old.columns))


def apply_changes(base: Base, latest: DataFrame) -> Base:
    """The tables after the batch; an object may move from one table to another."""
    keys, fresh = latest.select(*KEY), new_features(latest)
    tables = {
        name: replace_rows(getattr(base, name), keys, fresh.filter(F.col("kind") == kind), KEY)
        for name, kind in (("points", "P"), ("lines", "L"), ("polys", "A"))
    }
    members = replace_rows(base.site_members, changed_relations(latest), new_members(latest), ["site_id"])
    return Base(**tables, site_members=members)


def touched_features(old: Base, latest: DataFrame) -> DataFrame:
    """Changed objects as the tables have them, and as they are now.

    What the feed says an object was does not count: it may be older than the tables."""
    return written(old.images(latest).unionByName(new_features(latest)), "touched")


def touched_areas(areas: DataFrame, touched: DataFrame) -> DataFrame:
    """Keys of areas that one of the touched objects intersects."""
    outer = areas.select(*KEY, *GEOMETRY)
    geometry = touched.select(*GEOMETRY)
    return join_all(
        outer,
        geometry.filter(F.col("kind") == "P"),
        geometry.filter(F.col("kind") != "P"),
    ).distinct()


def named_members(members: DataFrame) -> DataFrame:
    return members.select("site_id", F.col("member_type").alias("osm_type"), F.col("member_id").alias("osm_id"))


def members_of(members: DataFrame, relations: DataFrame) -> DataFrame:
    """Keys of the members of these relations."""
    wanted = relations.select("site_id").distinct()
    return named_members(members).join(wanted, "site_id", "left_semi").select(*KEY).distinct()


def relation_neighbours(old: DataFrame, new: DataFrame, latest: DataFrame) -> DataFrame:
    """Members, before or after, of relations that changed or hold a changed object."""
    both = old.select("site_id", "member_type", "member_id").unionByName(
        new.select("site_id", "member_type", "member_id")
    )
    through_member = named_members(both).join(latest.select(*KEY), KEY, "left_semi").select("site_id")
    return members_of(both, changed_relations(latest).unionByName(through_member))


def affected_sites(old: Base, new: Base, latest: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    """Keys of the sites to rebuild, and of former sites to drop."""
    touched = touched_features(old, latest) if touched is None else touched
    own = flagged(touched).filter("is_cs")
    areas = new.polys.filter(is_site(F.col("tags")))
    around = touched_areas(areas, touched)
    sites = areas.select(*KEY).unionByName(new.points.filter(is_site(F.col("tags"))).select(*KEY))
    related = sites.join(relation_neighbours(old.site_members, new.site_members, latest), KEY, "left_semi")
    return queued(own, around, related)


def affected_playgrounds(old: Base, new: Base, latest: DataFrame, touched: DataFrame | None = None) -> DataFrame:
    touched = touched_features(old, latest) if touched is None else touched
    own = flagged(touched).filter("is_pg")
    around = touched_areas(new.polys.filter(is_playground(F.col("tags"))), touched)
    return queued(own, around)


def rebuilt_campsites(new: Base, grid: DataFrame, affected: DataFrame, rules=SITE_RULES) -> DataFrame:
    """The affected sites as a full build would give them, before nesting marks."""
    built = build_campsites(
        new.points,
        new.polys,
        grid,
        keys=affected,
        content_points=points_near(new.points, restrict(new.polys, affected)),
    )
    return apply_site_relations(
        built, new.site_members, new.points, new.lines, new.polys, rules, keys=affected
    )


def rebuilt_playgrounds(new: Base, affected: DataFrame) -> DataFrame:
    return build_playgrounds(
        new.points,
        new.lines,
        new.polys,
        keys=affected,
        content_points=points_near(new.points, restrict(new.polys, affected)),
    )


def incremental_campsites(
    sites: DataFrame, new: Base, grid: DataFrame, affected: DataFrame, rules=SITE_RULES, nested: DataFrame | None = None
) -> DataFrame:
    """The whole product after a batch.

    With the nested pairs of the sites, which are then marked ones, marks are renewed around
    what changed; without them over all sites."""
    rebuilt = rebuilt_campsites(new, grid, affected, rules)
    if nested is None:
        return mark_quality(written(replace_rows(sites, affected, rebuilt, KEY), "merged"))
    return renew_marks(sites, nested, affected, written(rebuilt, "rebuilt"))[0]


def incremental_playgrounds(playgrounds: DataFrame, new: Base, affected: DataFrame) -> DataFrame:
    return replace_rows(playgrounds, affected, rebuilt_playgrounds(new, affected), KEY)


def keep_tagged(products: DataFrame, key: str, values: list[str]) -> DataFrame:
    """Drop products whose tag has another value now; a missing tag stays."""
    value = F.col("tags")[key]
    return products.filter(value.isin(*values) | value.isNull())
