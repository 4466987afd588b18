"""An incremental result equals a full build, for random changes of any kind."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

import shapes as S
from conftest import SF
from sitegrid.operators.inside import with_shape
from sitegrid.operators.quality import nested_shapes, renew_marks
from sitegrid.plans import incremental
from sitegrid.plans.campsites import full_campsites
from sitegrid.plans.incremental import Base
from sitegrid.plans import features
from sitegrid.plans.playgrounds import build_playgrounds
from sitegrid.schema import CAMPSITE, CHANGE, COUNTRY_GRID, PLAYGROUND
from sitegrid.session import written
from sitegrid.sources.fixtures import Fixtures
from sitegrid.streaming import updater

KINDS = [
    {"tourism": "camp_site"},
    {"tourism": "camp_site", "sport": "golf"},
    {"tourism": "caravan_site", "name": "x"},
    {"tourism": "hotel"},
    {"leisure": "playground", "playground": "structure"},
    {"amenity": "toilets", "shower": "hot"},
    {"amenity": "bar", "sport": "darts"},
    {"playground": "slide"},
    {"natural": "tree"},  # no POI
]
SITE = {"type": "site", "site": "camp_site", "name": "group"}


class World:
    """Random objects; every change is recorded with its old and new image."""

    def __init__(self, seed):
        self.rng = random.Random(seed)
        self.objects, self.relations, self.log, self.seq = {}, {}, [], 0

    def image(self, osm_type, osm_id):
        rng = self.rng
        x, y = rng.randrange(0, 60) / 4, rng.randrange(0, 60) / 4
        tags = rng.choice(KINDS)
        ts = datetime(2020, 1, 1) + timedelta(minutes=self.seq)
        if osm_type == "N":
            return S.point(osm_id, x, y, tags, ts)
        if osm_id % 5 == 0:
            return S.feature("L", "W", osm_id, [[(x, y), (x + 3, y + 2)]], tags, ts)
        return S.area(osm_id, S.box(x, y, x + rng.randrange(1, 16) / 2, y + 3), tags=tags, ts=ts)

    def change(self):
        self.seq += 1
        if self.rng.random() < 0.15:
            return self.change_relation()
        key = self.rng.choice([("N", self.rng.randrange(60)), ("W", self.rng.randrange(40))])
        old = self.objects.get(key)
        new = None if old and self.rng.random() < 0.3 else self.image(*key)
        if new is None:
            del self.objects[key]
        else:
            self.objects[key] = new
        self.record(key, old and old[2:], new and new[2:], None)

    def change_relation(self):
        site_id = self.rng.randrange(8)
        gone = site_id in self.relations and self.rng.random() < 0.3
        if gone:
            del self.relations[site_id]
            return self.record(("R", site_id), None, None, None)
        refs = [("n", self.rng.randrange(60), "") for _ in range(4)] + [("w", self.rng.randrange(40), "") for _ in range(2)]
        self.relations[site_id] = refs
        stamp = datetime(2020, 1, 1)
        tags_only = (stamp, {**SITE, "name": f"group {self.seq}"}, None, None, None, None, None, None)
        self.record(("R", site_id), None, tags_only, refs)

    def record(self, key, old, new, refs):
        ts = datetime(2021, 1, 1) + timedelta(seconds=self.seq)
        self.log.append((self.seq, ts, "modify", *key, old, new, refs))

    def drain(self, spark):
        log, self.log = self.log, []
        return spark.createDataFrame(log, CHANGE)


def empty_base(spark):
    none = S.table(spark, [])
    return Base(none, none, none, S.members(spark, []))


def stored(spark, base):
    names = ("points", "lines", "polys", "site_members")
    return Base(**{n: written(getattr(base, n), n) for n in names})


@pytest.fixture(scope="module")
def grid(spark):
    ring = [{"x": float(a), "y": float(b)} for a, b in S.box(0, 0, 10, 10)]
    return spark.createDataFrame([("aa", [ring], 0.0, 0.0, 10.0, 10.0)], COUNTRY_GRID)


def rows(df, schema):
    """Comparable rows: maps as sorted items."""
    items = F.array_sort(F.transform(F.map_entries("tags"), lambda e: F.concat_ws("=", e["key"], e["value"])))
    names = [f.name for f in schema if f.name not in ("rings", "tags")]
    return sorted(map(str, df.select(*names, items.alias("tags")).collect()))


def full(base, grid):
    return full_campsites(base.points, base.lines, base.polys, base.site_members, grid)


@pytest.mark.parametrize("seed", [11, 12])
def test_incremental_equals_full(spark, grid, seed):
    world = World(seed)
    for _ in range(220):
        world.change()
    first = incremental.latest_versions(world.drain(spark))
    base = stored(spark, incremental.apply_changes(empty_base(spark), first))
    sites = written(full(base, grid), "sites")
    grounds = written(build_playgrounds(base.points, base.lines, base.polys), "grounds")
    for _ in range(12):
        world.change()
    latest = written(incremental.latest_versions(world.drain(spark)), "latest")
    new = stored(spark, incremental.apply_changes(base, latest))

    keys = written(incremental.affected_sites(base, new, latest), "keys")
    assert 0 < keys.count() < sites.count()
    after = incremental.incremental_campsites(sites, new, grid, keys)
    assert rows(after, CAMPSITE) == rows(full(new, grid), CAMPSITE)

    # the marked product and its pairs are carried on, twice
    nested = written(nested_shapes(with_shape(sites)), "nested")
    rebuilt = written(incremental.rebuilt_campsites(new, grid, keys), "rebuilt")
    marked, pairs = renew_marks(sites, nested, keys, rebuilt)
    assert rows(marked, CAMPSITE) == rows(full(new, grid), CAMPSITE)
    want = nested_shapes(with_shape(written(marked, "marked"))).collect()
    assert sorted(map(tuple, pairs.select("outer", "inner").collect())) == sorted((r.outer, r.inner) for r in want)

    keys = written(incremental.affected_playgrounds(base, new, latest), "keys")
    after = incremental.incremental_playgrounds(grounds, new, keys)
    assert rows(after, PLAYGROUND) == rows(build_playgrounds(new.points, new.lines, new.polys), PLAYGROUND)


def test_store_follows_the_feed(spark, grid, tmp_path):
    """Batches, one of them twice, and a compaction: the store equals a full build."""
    world = World(21)
    for _ in range(150):
        world.change()
    first = incremental.latest_versions(world.drain(spark))
    base = stored(spark, incremental.apply_changes(empty_base(spark), first))
    store = updater.Store(spark, str(tmp_path / "store"))
    updater.start_store(store, base, grid)
    for batch_id in range(2):
        for _ in range(15):
            world.change()
        batch = world.drain(spark)
        updater.apply_batch(store, batch, batch_id)
        updater.apply_batch(store, batch, batch_id)
        base = stored(spark, incremental.apply_changes(base, incremental.latest_versions(batch)))
    assert [c.version for c in store.commits()] == [0, 1, 2]
    expected = rows(full(base, grid), CAMPSITE)
    live = updater.read_campsites(store)
    assert rows(live, CAMPSITE) == expected
    # requests on the stored product, over a full and small versions
    whole = full(base, grid)
    for request in ({"country": "AA"}, {"bbox": "2,2,6,6"}):
        want = rows(features.query_sites(whole, **request), CAMPSITE)
        assert rows(features.query_sites(live, **request), CAMPSITE) == want and want
    updater.compact(store)
    assert [c.version for c in store.commits()] == [3]
    assert rows(updater.read_campsites(store), CAMPSITE) == expected
    assert store.read("points").count() == base.points.count()


def test_unfinished_version_is_not_seen(spark, tmp_path):
    """Files without a commit do not count, and the next try replaces them."""
    store = updater.Store(spark, str(tmp_path / "store"))
    points = Fixtures.of(spark, SF).saved("points")
    store.write_full(0, {"points": points})
    store.commit(0, True, -1, None)
    few = points.filter("osm_id < 10")
    store.write_delta(1, "points", few, few.limit(0))
    assert store.read("points").count() == points.count()
    store.write_delta(1, "points", few, few.limit(0))
    store.commit(1, False, 0, None)
    assert store.read("points").count() == points.count() - few.count()
