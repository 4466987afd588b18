"""Raw diffs to change rows: what else a changed node or way alters.

A diff names changed nodes, ways and relations. Ways are drawn by their nodes and
multipolygon relations by their ways, so a moved node changes areas that the diff
does not name. The state keeps a reverse index from each child to its parents; a diff
is pushed along it, node to ways and ways to relations, and only the objects reached
are drawn anew, from the nodes and ways they need.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sitegrid.functions.scalars import utc_timestamp
from sitegrid.operators.relations import all_features
from sitegrid.operators.spatial import cell_field, may_have
from sitegrid.plans.incremental import Base
from sitegrid.schema import CHANGE, IMAGE, KEY, RAW_CHANGE
from sitegrid.session import written
from sitegrid.sources import ingest

OBJECT = ["type", "id"]
CHILD, PARENT = ["child_type", "child_id"], ["parent_type", "parent_id"]
COLUMNS = {"n": ["id", "timestamp", "tags", "lon", "lat"], "w": ["id", "timestamp", "tags", "nodes"], "r": ["id", "timestamp", "tags", "members"]}


@dataclass
class RawState:
    """Raw objects, and the index of which ways and multipolygons each node and way is part of."""

    nodes: DataFrame
    ways: DataFrame
    relations: DataFrame
    parents: DataFrame

    @classmethod
    def of(cls, nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> RawState:
        return cls(nodes, ways, relations, parent_index(ways, relations))

    def of_type(self, kind: str) -> DataFrame:
        return {"n": self.nodes, "w": self.ways, "r": self.relations}[kind]


def is_multipolygon(tags: Column) -> Column:
    return F.coalesce(tags["type"] == "multipolygon", F.lit(False))


def parent_index(ways: DataFrame, relations: DataFrame) -> DataFrame:
    """child_type, child_id, parent_type, parent_id; a parent once for each child."""
    of_ways = ways.select(F.lit("n").alias("child_type"), F.explode(F.array_distinct("nodes")).alias("child_id"), F.lit("w").alias("parent_type"), F.col("id").alias("parent_id"))
    parts = relations.filter(is_multipolygon(F.col("tags"))).select("id", F.explode(F.array_distinct(F.transform(F.filter("members", lambda m: m["type"] == "w"), lambda m: m["ref"]))).alias("ref"))
    return of_ways.unionByName(parts.select(F.lit("w").alias("child_type"), F.col("ref").alias("child_id"), F.lit("r").alias("parent_type"), F.col("id").alias("parent_id")))


def newest(diff: DataFrame) -> DataFrame:
    """The last state of each object that a diff names."""
    last = Window.partitionBy(*OBJECT).orderBy(F.desc("seq"))
    return diff.withColumn("n", F.row_number().over(last)).filter("n = 1").drop("n")


def apply_diff(state: RawState, latest: DataFrame) -> RawState:
    """The raw objects and the index after a diff (`newest`); only the index rows of changed parents are renewed."""
    tables = {}
    for kind, columns in COLUMNS.items():
        named = latest.filter(F.col("type") == kind)
        kept = state.of_type(kind).join(named.select("id"), "id", "left_anti")
        tables[kind] = kept.select(*columns).unionByName(named.filter("op != 'delete'").select(*columns))
    fresh = latest.filter("op != 'delete'")
    renewed = parent_index(fresh.filter("type = 'w'"), fresh.filter("type = 'r'"))
    changed = latest.select(F.col("type").alias("parent_type"), F.col("id").alias("parent_id"))
    kept = state.parents.join(changed, PARENT, "left_anti").select(*state.parents.columns)
    return RawState(tables["n"], tables["w"], tables["r"], kept.unionByName(renewed))


def pushed(changed: DataFrame, parents: DataFrame) -> DataFrame:
    """Objects (type, id) that these make part of, directly."""
    keys = changed.select(F.col("type").alias("child_type"), F.col("id").alias("child_id"))
    maybe = may_have(cell_field(keys.select(F.xxhash64(*CHILD).alias("cell"))), f"xxhash64({', '.join(CHILD)})")
    found = parents.filter(maybe).join(keys, CHILD, "left_semi")
    return found.select(F.col("parent_type").alias("type"), F.col("parent_id").alias("id"))


def reached(latest: DataFrame, parents: DataFrame) -> DataFrame:
    """All objects to draw anew: those of the diff, ways of changed nodes, multipolygons of such ways."""
    named = latest.select(*OBJECT)
    ways = written(named.filter("type = 'w'").unionByName(pushed(named.filter("type = 'n'"), parents)).distinct(), "ways")
    return written(named.unionByName(ways).unionByName(pushed(ways, parents)).distinct(), "reached")


def only(objects: DataFrame, ids: DataFrame) -> DataFrame:
    """The objects with one of these ids; most others are dropped next to the scan."""
    maybe = may_have(cell_field(ids.select(F.xxhash64("id").alias("cell"))), "xxhash64(id)")
    return objects.filter(maybe).join(ids.select("id"), "id", "left_semi").select(*objects.columns)


def drawn(state: RawState, keys: DataFrame) -> DataFrame:
    """POI features among the keys, from the nodes and ways they need."""
    of = lambda kind: only(state.of_type(kind), keys.filter(F.col("type") == kind))
    relations = of("r").filter(is_multipolygon(F.col("tags")))
    parts = relations.select(F.explode("members").alias("m")).filter("m.type = 'w'").select(F.col("m.ref").alias("id")).distinct()
    own, theirs = written(of("w"), "ways"), written(only(state.ways, parts), "ways")
    needed = own.select("nodes").unionByName(theirs.select("nodes")).select(F.explode("nodes").alias("id")).distinct()
    nodes = written(only(state.nodes, needed), "nodes")
    areas, lines = ingest.ingest_ways(own, nodes)
    return all_features(ingest.ingest_points(of("n")), areas, lines, ingest.ingest_relations(relations, theirs, nodes))


def were_pois(state: RawState, keys: DataFrame) -> DataFrame:
    """Those of the keys whose tags made them a POI or a site relation, whatever their shape."""
    tags = F.col("tags")
    rules = {
        "n": ingest.is_point_poi(tags),
        "w": ingest.is_polygon_poi(tags) | ingest.is_line_poi(tags),
        "r": (is_multipolygon(tags) & ingest.is_polygon_poi(tags)) | (tags["type"] == "site"),
    }
    found = [only(state.of_type(k), keys.filter(F.col("type") == k)).filter(rule).select(F.lit(k).alias("type"), "id") for k, rule in rules.items()]
    return all_features(*found)


def raw_changes(old: RawState, new: RawState, latest: DataFrame) -> DataFrame:
    """Change rows of all POIs that a diff alters, as the feed has them.

    An object that the diff itself does not name changes with the newest of it. The feed's
    old images stay empty: updates look them up in their tables."""
    keys = reached(latest, new.parents)
    features = drawn(new, keys).select(F.lower("osm_type").alias("type"), F.col("osm_id").alias("id"), F.struct(*[F.col(f.name) for f in IMAGE.fields]).alias("shape"))
    image = F.struct(
        *[
            (utc_timestamp(F.col("timestamp")) if f.name == "timestamp" else F.col("tags") if f.name == "tags" else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in IMAGE.fields
        ]
    )
    sites = only(new.relations, keys.filter("type = 'r'")).filter("tags['type'] = 'site'").select(F.lit("r").alias("type"), "id", image.alias("bare"), "members")
    was = were_pois(old, keys).withColumn("was", F.lit(True))
    last = lambda c: latest.agg(F.max(c)).scalar()
    named = latest.select(*OBJECT, "seq", "timestamp")
    rows = keys.join(features, OBJECT, "left").join(sites, OBJECT, "left").join(was, OBJECT, "left").join(named, OBJECT, "left")
    rows = rows.withColumn("new", F.coalesce("shape", "bare")).filter("new IS NOT NULL OR was")
    columns = {
        "seq": F.coalesce("seq", last("seq")),
        "ts": utc_timestamp(F.coalesce("timestamp", last("timestamp"))),
        "op": F.when(F.col("new").isNull(), "delete").otherwise("modify"),
        "osm_type": F.upper("type"),
        "osm_id": F.col("id"),
        "old": F.lit(None),
        "new": F.col("new"),
        "members": F.col("members"),
    }
    return rows.select(*[columns[f.name].cast(f.dataType).alias(f.name) for f in CHANGE.fields])


def ingest_raw(nodes: DataFrame, ways: DataFrame, relations: DataFrame) -> Base:
    """The typed tables of a full import."""
    areas, lines = ingest.ingest_ways(ways, nodes)
    polys = areas.unionByName(ingest.ingest_relations(relations, ways, nodes))
    return Base(ingest.ingest_points(nodes), lines, polys, ingest.ingest_site_members(relations))


def read_raw(spark: SparkSession, folder: str) -> RawState:
    """A raw state from the tables nodes, ways and relations of a folder."""
    return RawState.of(ingest.read_nodes(spark, f"{folder}/nodes"), ingest.read_ways(spark, f"{folder}/ways"), ingest.read_relations(spark, f"{folder}/relations"))


def read_diff(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_CHANGE).parquet(path)
