"""Keep the products current from a change feed.

Tables live in a folder as one full version and small versions on top of it. A
small version holds the rows of changed keys and a marker for removed ones, so a
batch writes what it changed and never rewrites a whole table. A version counts
once its commit is written, and no written file is touched again. `compact`
writes a new full version.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sitegrid.operators.quality import mark_changes, mark_quality, nested_shapes
from sitegrid.operators.relations import all_features
from sitegrid.operators.spatial import clustered
from sitegrid.plans.campsites import apply_site_relations, build_campsites
from sitegrid.plans.incremental import (
    Base,
    affected_playgrounds,
    affected_sites,
    apply_changes,
    changed_relations,
    latest_versions,
    new_features,
    new_members,
    rebuilt_campsites,
    rebuilt_playgrounds,
    touched_features,
)
from sitegrid.plans.playgrounds import build_playgrounds
from sitegrid.plans.serving import along_curve, served
from sitegrid.schema import CHANGE, KEY, TABLES
from sitegrid.session import written
from sitegrid.sources.diffs import ingest_raw, read_raw
from sitegrid.sources.ingest import read_country_grid

COMPACT_AFTER = 48
_COMMIT = "version bigint, full boolean, batch_id bigint, newest timestamp_ntz"

KEYS = {name: KEY for name in ("points", "lines", "polys", "objects", "campsites", "playgrounds")}
KEYS["site_members"] = ["site_id"]
KEYS["nested"] = ["outer", "inner"]


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, table: str, version: int) -> str:
        return f"{self.root}/{table}/version={version}"

    def commits(self) -> list:
        """Commits since the newest full version, which is first; at most COMPACT_AFTER + 1."""
        all_commits = self.spark.read.schema(_COMMIT).json(f"{self.root}/commits/*")
        newest_full = all_commits.filter("full").agg(F.max("version")).scalar()
        return all_commits.filter(F.col("version") >= newest_full).orderBy("version").collect()

    def commit(self, version: int, full: bool, batch_id: int, newest) -> None:
        """The last step of a version: readers see it from here on."""
        row = self.spark.createDataFrame([(version, full, batch_id, newest)], _COMMIT)
        row.coalesce(1).write.mode("overwrite").json(f"{self.root}/commits/{version}")

    def read(self, table: str, commits: list | None = None) -> DataFrame:
        """The current rows: full version, minus changed keys, plus their newest rows."""
        full, *later = commits or self.commits()
        base = self.spark.read.schema(TABLES[table]).parquet(self._path(table, full.version))
        if table == "country_grid" or not later:
            return base
        keys = KEYS[table]
        fields = self.spark.createDataFrame([], TABLES[table]).withColumn("removed", F.lit(True)).schema
        deltas = reduce(
            DataFrame.unionByName,
            [
                self.spark.read.schema(fields).parquet(self._path(table, c.version)).withColumn(
                    "version", F.lit(c.version)
                )
                for c in later
            ],
        )
        newest = (
            deltas.withColumn("last", F.max("version").over(Window.partitionBy(*keys)))
            .filter("version = last")
            .drop("version", "last")
        )
        kept = base.join(deltas.select(*keys), keys, "left_anti").select(*base.columns)
        return kept.unionByName(newest.filter("NOT removed").select(*base.columns))

    def write_full(self, version: int, tables: dict[str, DataFrame]) -> None:
        for name, df in tables.items():
            columns = TABLES[name].fieldNames()
            rows = df.select(*columns)
            if name == "objects":
                rows = rows.repartitionByRange(*KEY).sortWithinPartitions(*KEY)
            elif name == "campsites":
                rows = along_curve(rows)
            elif "minx" in columns and "osm_id" in columns:
                rows = clustered(rows)
            rows.write.mode("overwrite").parquet(self._path(name, version))

    def write_delta(self, version: int, table: str, keys: DataFrame, fresh: DataFrame) -> None:
        """Fresh rows, and a marker for every key in `keys` that has none."""
        on = KEYS[table]
        columns = TABLES[table].fieldNames()
        gone = keys.select(*on).distinct().join(fresh.select(*on), on, "left_anti")
        empty = [F.lit(None).cast(TABLES[table][c].dataType).alias(c) for c in columns if c not in on]
        rows = fresh.select(*columns, F.lit(False).alias("removed")).unionByName(
            gone.select(*on, *empty, F.lit(True).alias("removed"))
        )
        rows.write.mode("overwrite").parquet(self._path(table, version))

    def base(self, commits: list) -> Base:
        return Base(**{n: self.read(n, commits) for n in ("points", "lines", "polys", "site_members", "objects")})


def start_store(store: Store, base: Base, grid: DataFrame, newest=None) -> None:
    """Version 0: the ingested tables and the products of a full build.

    All features are stored twice, by place for the joins and by key for look-ups of what a
    changed object was. Campsites carry their nesting marks, and the nested pairs of their geometries
    are kept beside them, so that a batch renews marks around its changes only.
    """
    inputs = {
        "points": base.points,
        "lines": base.lines,
        "polys": base.polys,
        "objects": base.features(),
        "site_members": base.site_members,
        "country_grid": grid,
    }
    store.write_full(0, inputs)
    saved = {n: store.spark.read.schema(TABLES[n]).parquet(store._path(n, 0)) for n in inputs}
    built = build_campsites(saved["points"], saved["polys"], saved["country_grid"])
    related = apply_site_relations(
        built, saved["site_members"], saved["points"], saved["lines"], saved["polys"]
    )
    sites = written(served(related), "sites")
    grounds = build_playgrounds(saved["points"], saved["lines"], saved["polys"])
    store.write_full(0, {"nested": nested_shapes(sites), "playgrounds": grounds})
    nested = store.spark.read.schema(TABLES["nested"]).parquet(store._path("nested", 0))
    store.write_full(0, {"campsites": mark_quality(sites, nested=nested)})
    store.commit(0, True, -1, newest)


def start_from_raw(store: Store, folder: str, grid: str) -> None:
    """A full import: raw tables nodes, ways and relations of a folder, and a country grid, to a started store."""
    raw = read_raw(store.spark, folder)
    tables = ingest_raw(raw.nodes, raw.ways, raw.relations)
    newest = tables.features().agg(F.max("timestamp")).first()[0]
    start_store(store, tables, read_country_grid(store.spark, grid), newest)


def read_campsites(store: Store) -> DataFrame:
    """The marked product, for requests: filters on box, country and id reach the scan."""
    return store.read("campsites")


def apply_batch(store: Store, batch: DataFrame, batch_id: int) -> None:
    """One cycle. A batch that is already committed changes nothing."""
    commits = store.commits()
    last = commits[-1]
    if batch_id <= last.batch_id:
        return
    version = last.version + 1
    grid = store.read("country_grid", commits)
    old = store.base(commits)
    # the change set is read many times from here on
    seen = Observation()
    changes = written(batch.observe(seen, F.max("ts").alias("newest")), "changes")
    latest = written(latest_versions(changes), "latest")
    new = apply_changes(old, latest)
    touched = touched_features(old, latest)
    sites = written(affected_sites(old, new, latest, touched), "sites")
    grounds = written(affected_playgrounds(old, new, latest, touched), "grounds")

    keys, fresh = latest.select(*KEY), new_features(latest)
    for name, kind in (("points", "P"), ("lines", "L"), ("polys", "A")):
        store.write_delta(version, name, keys, fresh.filter(F.col("kind") == kind))
    store.write_delta(version, "objects", keys, fresh)
    store.write_delta(version, "site_members", changed_relations(latest), new_members(latest))
    rebuilt = written(served(rebuilt_campsites(new, grid, sites)), "rebuilt")
    marked, nested = store.read("campsites", commits), store.read("nested", commits)
    rows, ended, begun = mark_changes(marked, nested, sites, rebuilt)
    store.write_delta(version, "campsites", sites, written(rows, "remarked"))
    store.write_delta(version, "nested", ended, begun)
    rebuilt = written(rebuilt_playgrounds(new, grounds), "rebuilt")
    store.write_delta(version, "playgrounds", grounds, rebuilt)
    # what the batch showed while it was written goes into its commit
    newest = [ts for ts in (seen.get["newest"], last.newest) if ts]
    store.commit(version, False, batch_id, max(newest, default=None))
    if len(commits) >= COMPACT_AFTER:
        compact(store)


def compact(store: Store) -> None:
    """A full version with the same content."""
    commits = store.commits()
    last = commits[-1]
    store.write_full(last.version + 1, {name: store.read(name, commits) for name in TABLES})
    store.commit(last.version + 1, True, last.batch_id, last.newest)


def change_source(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(CHANGE)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def newest_so_far(changes: DataFrame) -> DataFrame:
    """A stream that gives, for every object a micro-batch names, the newest change of all batches.

    The newest change of each object ever named is kept as keyed state. A change that is
    older than one of an earlier batch then brings that one once more, which alters nothing.
    There is no watermark, since any change may be the newest of its object."""
    rest = [c for c in changes.columns if c not in KEY]
    newest = F.max_by(F.struct(*rest), F.struct("ts", "seq")).alias("newest")
    return changes.groupBy(*KEY).agg(newest).select(*KEY, "newest.*").select(*changes.columns)


def run_updates(
    store: Store, changes: DataFrame, checkpoint: str, every: str | None = "10 minutes"
) -> StreamingQuery:
    """Apply the feed in micro-batches: on a schedule, or all there is if `every` is None.

    Files may come in any order and more than once."""
    timing = {"processingTime": every} if every else {"availableNow": True}
    return (
        newest_so_far(changes)
        .writeStream.outputMode("update")
        .foreachBatch(lambda batch, batch_id: apply_batch(store, batch, batch_id))
        .option("checkpointLocation", checkpoint)
        .trigger(**timing)
        .start()
    )


def stored_features(store: Store) -> DataFrame:
    commits = store.commits()
    return all_features(*[store.read(n, commits) for n in ("polys", "points", "lines")])
