"""Change handling: queues, affected sites, rebuilds, the stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.input_queries import flat_playgrounds, fresh_path, tag
from checks.join_queries import FLAG_LIST, areas_of, flat_site
from checks.oracle_views import SITES, VIEWS, shower_name
from checks.registry import query
from sitegrid.operators.facilities import is_playground, is_site
from sitegrid.operators.inside import with_shape
from sitegrid.operators.quality import nested_shapes
from sitegrid.operators.relations import all_features, extend_members
from sitegrid.operators.spatial import join_points
from sitegrid.plans import incremental
from sitegrid.plans.campsites import restrict
from sitegrid.plans.incremental import Base
from sitegrid.plans.playgrounds import build_playgrounds
from sitegrid.schema import GEOMETRY, KEY
from sitegrid.session import written
from sitegrid.sources.fixture_views import VIEWS as FIXTURE_VIEWS
from sitegrid.sources.fixture_views import with_views
from sitegrid.sources import diffs
from sitegrid.streaming import updater

# Views after the change feed was applied: points replaced by their newest image.
_MOVED = {
    "fx_point_old": FIXTURE_VIEWS["fx_point"],
    "fx_change": FIXTURE_VIEWS["fx_change"].replace("fx_point", "fx_point_old"),
    "fx_site_member": FIXTURE_VIEWS["fx_site_member"].replace("fx_point", "fx_point_old"),
    "fx_point_in_poly_old": FIXTURE_VIEWS["fx_point_in_poly"].replace("fx_point", "fx_point_old"),
    "fx_latest": (
        "SELECT * FROM (SELECT c.*, row_number() OVER (PARTITION BY osm_type, osm_id ORDER BY ts DESC, seq DESC) AS n FROM fx_change c) WHERE n = 1"
    ),
    "fx_point": (
        "SELECT osm_type, osm_id, k, ts, x, y, kind, k1, v1, k2, v2 FROM fx_point_old WHERE osm_id NOT IN (SELECT osm_id FROM fx_latest)"
        " UNION ALL SELECT l.osm_type, l.osm_id, NULL, l.ts, l.new_x, l.new_y, l.new_kind, t.k1, t.v1, t.k2, t.v2"
        " FROM fx_latest l JOIN fx_kind t ON t.kind = l.new_kind"
    ),
}
_AFTER = {**VIEWS, **_MOVED}


def after(sql: str) -> str:
    """An oracle on the state after the feed."""
    return with_views(sql, _AFTER)


def base_of(t) -> Base:
    return Base(t.points, t.lines, t.polys, t.site_members)


def latest(t):
    return t.fx.saved("latest", lambda: incremental.latest_versions(t.changes))


def affected(t):
    def build():
        old = base_of(t)
        return incremental.affected_sites(old, incremental.apply_changes(old, latest(t)), latest(t))

    return t.fx.saved("affected", build)


@query(
    after(
        "SELECT osm_type, osm_id, coalesce(new_kind IN (42, 43), false) AS is_cs, coalesce(new_kind = 22, false) AS is_pg FROM fx_latest"
    )
)
def enqueue_changes(t):
    return incremental.queue_flags(t.changes)


@query("SELECT DISTINCT site_id FROM fx_site_member WHERE ((site_id - 2000000000) // 6) % 3 < 2")
def enqueue_relations(t):
    queue = incremental.latest_versions(t.relation_changes)
    return incremental.changed_relations(queue).distinct()


@query(after("SELECT osm_type, osm_id, seq, ts, op, new_kind IS NULL AS gone FROM fx_latest"))
def latest_version(t):
    return incremental.latest_versions(t.changes).select(
        *KEY, "seq", "ts", "op", F.col("new").isNull().alias("gone")
    )




@query(
    "SELECT DISTINCT 'campsite' AS product, s.osm_type, s.osm_id FROM fx_change c JOIN fx_point_in_poly t ON t.osm_id = c.osm_id JOIN fx_poly s ON s.k = t.k"
    f" WHERE c.op = 'delete' AND c.old_kind NOT IN (42, 43) AND (t.inside OR t.on_edge) AND s.tourism IN {SITES}"
    " UNION ALL SELECT DISTINCT 'playground', s.osm_type, s.osm_id FROM fx_change c JOIN fx_point_in_poly t ON t.osm_id = c.osm_id JOIN fx_poly s ON s.k = t.k"
    " WHERE c.op = 'delete' AND c.old_kind <> 22 AND (t.inside OR t.on_edge) AND s.leisure = 'playground'"
)
def delete_point_poly(t):
    """Sites around deleted objects that are no site themselves, by their stored place."""
    gone = base_of(t).images(t.changes.filter("op = 'delete'"))
    found = []
    for product, wanted in (("campsite", is_site), ("playground", is_playground)):
        areas = t.polys.filter(wanted(F.col("tags")))
        others = gone.filter(~wanted(F.col("tags")))
        keys = incremental.touched_areas(areas, others)
        found.append(keys.select(F.lit(product).alias("product"), *KEY))
    return all_features(*found)


@query(
    f"SELECT DISTINCT osm_type, osm_id FROM ora_member WHERE ((site_id - 2000000000) // 6) % 3 = 0 AND tourism IN {SITES}"
)
def delete_site_relation(t):
    gone = t.relation_changes.filter("new IS NULL").select(F.col("osm_id").alias("site_id"))
    members = base_of(t).images(incremental.members_of(t.site_members, gone))
    return members.filter(is_site(F.col("tags"))).select(*KEY)


@query(
    "SELECT c.osm_id AS gone_id, s.osm_type, s.osm_id FROM (SELECT DISTINCT osm_id FROM fx_change WHERE op = 'delete') c"
    f" JOIN fx_point_in_poly t ON t.osm_id = c.osm_id JOIN fx_poly s ON s.k = t.k WHERE (t.inside OR t.on_edge) AND s.tourism IN {SITES}"
)
def scalar_subquery_geom(t):
    """The old geometry is that of the tables."""
    gone = base_of(t).images(t.changes.filter("op = 'delete'"))
    pairs = join_points(areas_of(t.polys), gone.select(F.col("osm_id").alias("gone_id"), *GEOMETRY))
    return pairs.select("gone_id", F.col("site_type").alias("osm_type"), F.col("site_id").alias("osm_id"))


@query(
    after(
        "SELECT DISTINCT s.osm_type, s.osm_id FROM fx_latest l JOIN fx_point_in_poly t ON t.osm_id = l.osm_id JOIN ora_site_area s ON s.k = t.k WHERE t.inside OR t.on_edge"
    )
)
def affected_by_change(t):
    """Site areas around the new place of changed objects."""
    fresh = incremental.new_features(latest(t))
    return incremental.touched_areas(t.polys.filter(is_site(F.col("tags"))), fresh)


_AFFECTED = (
    "SELECT osm_type, osm_id FROM fx_latest WHERE old_kind IN (42, 43) OR new_kind IN (42, 43)"
    " UNION SELECT s.osm_type, s.osm_id FROM fx_latest l JOIN fx_point_in_poly t ON t.osm_id = l.osm_id JOIN ora_site_area s ON s.k = t.k WHERE t.inside OR t.on_edge"
    " UNION SELECT s.osm_type, s.osm_id FROM fx_latest l JOIN fx_point_in_poly_old t ON t.osm_id = l.osm_id JOIN ora_site_area s ON s.k = t.k WHERE t.inside OR t.on_edge"
    " UNION SELECT s.osm_type, s.osm_id FROM fx_latest l JOIN fx_site_member c ON c.member_type = 'N' AND c.member_id = l.osm_id"
    " JOIN fx_site_member m ON m.site_id = c.site_id JOIN ora_site s ON s.osm_type = m.member_type AND s.osm_id = m.member_id"
)


@query(after(_AFFECTED))
def affected_sites(t):
    old = base_of(t)
    new = incremental.apply_changes(old, latest(t))
    return incremental.affected_sites(old, new, latest(t))


@query(after(f"SELECT a.osm_type, a.osm_id FROM ({_AFFECTED}) a JOIN fx_poly p ON p.osm_type = a.osm_type AND p.osm_id = a.osm_id"))
def restrict_to_affected(t):
    return restrict(t.polys, affected(t)).select(*KEY)


@query(
    after(
        "SELECT c.osm_type, c.osm_id FROM fx_poly c WHERE NOT EXISTS (SELECT 1 FROM fx_latest l WHERE l.osm_type = c.osm_type AND l.osm_id = c.osm_id)"
        " UNION ALL SELECT c.osm_type, c.osm_id FROM fx_point_old c WHERE NOT EXISTS (SELECT 1 FROM fx_latest l WHERE l.osm_type = c.osm_type AND l.osm_id = c.osm_id)"
    )
)
def delete_using(t):
    return incremental.without(all_features(t.polys, t.points), latest(t), KEY).select(*KEY)


@query(after("SELECT osm_type, osm_id, seq FROM fx_latest"))
def dedupe_self_join(t):
    return incremental.latest_versions(t.changes).select(*KEY, "seq")


@query(
    f"SELECT DISTINCT osm_type, osm_id FROM ora_member WHERE ((site_id - 2000000000) // 6) % 3 = 1 AND osm_id % 2 = 0 AND tourism IN {SITES}"
)
def new_relation_members(t):
    members = incremental.new_members(incremental.latest_versions(t.relation_changes))
    extended = extend_members(members, all_features(t.polys, t.points, t.lines))
    return extended.filter(is_site(F.col("member_tags"))).select(*KEY).distinct()


@query(after("SELECT osm_type, osm_id FROM fx_latest UNION SELECT osm_type, osm_id FROM ora_site"))
def insert_ignore(t):
    sites = all_features(t.polys, t.points).filter(is_site(F.col("tags"))).select(*KEY)
    moved = incremental.new_features(latest(t)).filter(is_site(F.col("tags"))).select(*KEY)
    return incremental.queued(latest(t), sites, moved)


@query(after("SELECT osm_type, osm_id, ts, k1, v1 FROM fx_point"))
def upsert_rebuild(t):
    """The point table after the batch."""
    now = incremental.apply_changes(base_of(t), latest(t)).points
    entry = F.map_entries("tags")
    first = F.filter(entry, lambda e: e["key"].isin("amenity", "man_made", "shop", "leisure", "building", "playground", "tourism"))
    return now.select(
        *KEY, F.col("timestamp").alias("ts"), first[0]["key"].alias("k1"), first[0]["value"].alias("v1")
    )


_PRODUCT = f"osm_type, osm_id, ts, category, {FLAG_LIST}, {shower_name('shower_rank')} AS shower, sport, addr_country, name, contains_sites, visible, site_relation_state"


def flat_marked(df):
    return flat_site(df, tag("contains_sites"), "visible", tag("site_relation_state"))


@query(after(f"SELECT {_PRODUCT} FROM ora_product"), name="incremental_campsites")
def campsites_after(t):
    old = base_of(t)
    new = incremental.apply_changes(old, latest(t))
    nested = t.fx.saved("nested", lambda: nested_shapes(with_shape(t.related)))
    return flat_marked(incremental.incremental_campsites(t.marked, new, t.country_grid, affected(t), nested=nested))


@query(
    after("SELECT osm_type, osm_id, ts, equipment, sport FROM ora_playground"), name="incremental_playgrounds"
)
def playgrounds_after(t):
    old = base_of(t)
    new = incremental.apply_changes(old, latest(t))
    before = t.fx.saved("grounds", lambda: build_playgrounds(t.points, t.lines, t.polys))
    keys = written(incremental.affected_playgrounds(old, new, latest(t)), "ground_keys")
    return flat_playgrounds(incremental.incremental_playgrounds(before, new, keys))


def opened_store(t) -> updater.Store:
    store = updater.Store(t.spark, fresh_path(t, "store"))
    updater.start_store(store, base_of(t), t.country_grid)
    return store


@query(after("SELECT osm_type, osm_id, ts, equipment, sport, 2::bigint AS versions FROM ora_playground"))
def batch_idempotence(t):
    """A batch that is delivered twice counts once."""
    store = opened_store(t)
    updater.apply_batch(store, t.changes, 0)
    updater.apply_batch(store, t.changes, 0)
    versions = F.lit(len(store.commits())).cast("bigint")
    return flat_playgrounds(store.read("playgrounds")).withColumn("versions", versions)


def streamed(t, late_first: bool):
    """The feed in two files, applied as two micro-batches. Its old images are those before an object's first change."""
    store, feed = opened_store(t), fresh_path(t, "feed")
    middle = t.changes.agg(F.expr("percentile_approx(unix_micros(cast(ts AS timestamp)), 0.5)")).first()[0]
    early = F.expr(f"unix_micros(cast(ts AS timestamp)) < {middle}")
    for part in (~early, early) if late_first else (early, ~early):
        t.changes.filter(part).coalesce(1).write.mode("append").parquet(feed)
    source = updater.change_source(t.spark, feed, files_per_batch=1)
    updater.run_updates(store, source, fresh_path(t, "checkpoint"), every=None).awaitTermination()
    return flat_marked(updater.read_campsites(store))


@query(after(f"SELECT {_PRODUCT} FROM ora_product"))
def stream_update(t):
    return streamed(t, late_first=False)


@query(after(f"SELECT {_PRODUCT} FROM ora_product"))
def stream_update_reversed(t):
    """Changes that come after newer ones of the same object do not count."""
    return streamed(t, late_first=True)


_DEGREES = "(cast({} AS double) - 2048) / 64"
_BOX = ", ".join(f"{_DEGREES.format(f'{f}({c})')} AS {f}{c}" for f, c in (("min", "x"), ("min", "y"), ("max", "x"), ("max", "y")))
_NOBOX = ", ".join(f"CAST(NULL AS double) AS {c}" for c in ("minx", "miny", "maxx", "maxy"))


@query(
    "SELECT 'N' AS osm_type, id AS osm_id, gone, " + ", ".join(f"CASE WHEN NOT gone THEN {_DEGREES.format('new_' + c)} END AS {f}{c}" for f, c in (("min", "x"), ("min", "y"), ("max", "x"), ("max", "y")))
    + " FROM fx_raw_diff WHERE kind = 'n' AND id < 10000000"
    f" UNION ALL SELECT 'R', id, true, {_NOBOX} FROM fx_raw_diff WHERE kind = 'r'"
    f" UNION ALL SELECT osm_type, osm_id, true, {_NOBOX} FROM fx_poly WHERE osm_type = 'W' AND k % 13 = 5 AND coalesce(tourism, leisure, amenity) IS NOT NULL"
    f" UNION ALL SELECT osm_type, osm_id, false, {_BOX} FROM (SELECT v.osm_type, v.osm_id, CASE WHEN v.ring = 0 AND v.i = 2 THEN v.x + 1 ELSE v.x END AS x,"
    " CASE WHEN v.ring = 0 AND v.i = 2 THEN v.y + 1 ELSE v.y END AS y FROM fx_vertex v JOIN fx_poly p ON p.k = v.k WHERE coalesce(p.tourism, p.leisure, p.amenity) IS NOT NULL"
    " AND ((p.osm_type = 'W' AND p.k % 7 = 3 AND p.k % 13 <> 5) OR (p.osm_type = 'R' AND p.k % 5 = 1))) GROUP BY osm_type, osm_id"
)
def raw_changes(t):
    """A raw diff pushed from nodes to ways to multipolygons; box and fate of every POI it reaches."""
    old = diffs.RawState.of(t.raw_nodes, t.raw_ways, t.raw_relations)
    last = diffs.newest(t.raw_diff)
    rows = diffs.raw_changes(old, diffs.apply_diff(old, last), last)
    return rows.select(*KEY, F.col("new").isNull().alias("gone"), *[F.col(f"new.{c}").alias(c) for c in ("minx", "miny", "maxx", "maxy")])
