"""Raw diffs: what they alter, applied to the typed tables, equals a fresh import."""

import random

import pytest
from pyspark.sql import functions as F

from conftest import SF
from sitegrid.plans import incremental
from sitegrid.schema import RAW_CHANGE, RAW_NODE, RAW_RELATION, RAW_WAY
from sitegrid.sources import diffs
from sitegrid.sources.fixtures import Fixtures
from sitegrid.streaming import updater

POI = [{"tourism": "camp_site"}, {"amenity": "bar", "phone": "1"}, {"leisure": "playground"}, {"playground": "slide"}]
NONE = [{}, {"natural": "tree"}]
SITE = {"type": "site", "site": "camp_site"}


class Raw:
    """A random map of nodes, ways and relations, and the diffs made to it."""

    def __init__(self, seed):
        self.rng, self.log, self.seq = random.Random(seed), [], 0
        self.nodes, self.ways, self.relations = {}, {}, {}
        for i in range(80):
            self.set_node(i)
        for i in range(30):
            self.set_way(i)
        for i in range(14):
            self.set_relation(i)
        self.log = []

    def put(self, table, kind, i, row):
        self.seq += 1
        if row is None:
            table.pop(i, None)
        else:
            table[i] = row
        tags, lon, lat, nodes, members = row or (None,) * 5
        self.log.append((self.seq, "modify" if row else "delete", kind, i, 1_600_000_000 + self.seq, tags, lon, lat, nodes, members))

    def set_node(self, i):
        r = self.rng
        self.put(self.nodes, "n", i, (r.choice(POI + NONE * 4), r.randrange(80) / 8, r.randrange(80) / 8, None, None))

    def set_way(self, i):
        refs = self.rng.sample(range(80), self.rng.randrange(3, 6))
        refs = refs + refs[:1] if i % 3 else refs
        self.put(self.ways, "w", i, (self.rng.choice(POI + NONE), None, None, refs, None))

    def set_relation(self, i):
        r = self.rng
        ways = [("w", w, "outer") for w in r.sample(range(30), r.randrange(1, 3))]
        if i % 3:
            self.put(self.relations, "r", i, ({**r.choice(POI + NONE), "type": "multipolygon"}, None, None, None, ways))
        else:
            self.put(self.relations, "r", i, (SITE, None, None, None, [*ways, ("n", r.randrange(80), "")]))

    def change(self):
        table, kind, setter, n = self.rng.choice([(self.nodes, "n", self.set_node, 80), (self.ways, "w", self.set_way, 30), (self.relations, "r", self.set_relation, 14)])
        i = self.rng.randrange(n)
        if kind != "n" and self.rng.random() < 0.3:
            return self.put(table, kind, i, None)
        setter(i)

    def tables(self, spark):
        stamp = {(k, i): t for _, _, k, i, t, *_ in self.log}
        of = lambda kind, i: stamp.get((kind, i), 1_500_000_000)
        return diffs.RawState.of(
            spark.createDataFrame([(i, of("n", i), t, x, y) for i, (t, x, y, _, _) in self.nodes.items()], RAW_NODE),
            spark.createDataFrame([(i, of("w", i), t, n) for i, (t, _, _, n, _) in self.ways.items()], RAW_WAY),
            spark.createDataFrame([(i, of("r", i), t, m) for i, (t, _, _, _, m) in self.relations.items()], RAW_RELATION),
        )


def rows(df):
    return sorted(str([sorted(v.items()) if isinstance(v, dict) else v for v in r]) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_diff_equals_a_fresh_import(spark, seed):
    world = Raw(seed)
    old = world.tables(spark)
    for _ in range(25):
        world.change()
    last = diffs.newest(spark.createDataFrame(world.log, RAW_CHANGE))
    new, fresh = diffs.apply_diff(old, last), world.tables(spark)
    assert rows(new.parents.select(*sorted(new.parents.columns))) == rows(fresh.parents.select(*sorted(new.parents.columns)))
    changes = diffs.raw_changes(old, new, last)
    base = incremental.apply_changes(diffs.ingest_raw(old.nodes, old.ways, old.relations), incremental.latest_versions(changes))
    want = diffs.ingest_raw(fresh.nodes, fresh.ways, fresh.relations)
    for name in ("points", "lines", "polys", "site_members"):
        # a relation that does not change keeps the time of its own; geometry follows its nodes
        assert rows(getattr(base, name)) == rows(getattr(want, name).select(*getattr(base, name).columns)), name


def test_a_moved_node_reaches_ways_and_their_multipolygons(spark):
    world = Raw(5)
    state = world.tables(spark)
    node = world.ways[next(m[1] for m in world.relations[1][4])][3][1]
    last = spark.createDataFrame([(1, "modify", "n", node, 0, {}, 1.0, 1.0, None, None)], RAW_CHANGE)
    got = {tuple(r) for r in diffs.reached(last, state.parents).collect()}
    ways = {i for i, row in world.ways.items() if node in row[3]}
    multi = {i for i, row in world.relations.items() if i % 3 and any(m[1] in ways for m in row[4])}
    assert got == {("n", node)} | {("w", i) for i in ways} | {("r", i) for i in multi} and multi
    assert diffs.reached(last.filter(F.lit(False)), state.parents).count() == 0


def test_import_of_raw_tables_starts_a_store(spark, tmp_path):
    fx, folder = Fixtures.of(spark, SF), str(tmp_path / "raw")
    for name in ("nodes", "ways", "relations"):
        getattr(fx, f"raw_{name}").write.parquet(f"{folder}/{name}")
    fx.country_grid.write.parquet(f"{folder}/grid")
    store = updater.Store(spark, str(tmp_path / "store"))
    updater.start_from_raw(store, folder, f"{folder}/grid")
    want = diffs.ingest_raw(fx.raw_nodes, fx.raw_ways, fx.raw_relations)
    for name in ("points", "lines", "polys", "site_members"):
        assert store.read(name).count() == getattr(want, name).count() > 0
    assert store.read("objects").count() == want.features().count()
    assert store.read("campsites").count() > 0 and store.commits()[0].newest is not None
