"""Raw nodes, ways and relations to typed POI tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrid.functions.geometry import point_rings, with_envelope
from sitegrid.functions.scalars import utc_timestamp
from sitegrid.functions.tags import has_any_of, unify_keys, value_in
from sitegrid.operators.facilities import SITE_TOURISM
from sitegrid.schema import (
    COUNTRY_GRID,
    ENVELOPE,
    FEATURE,
    GEOMETRY,
    KEY,
    RAW_NODE,
    RAW_RELATION,
    RAW_WAY,
)
from sitegrid.sources.assembly import multipolygon_geometry, way_geometry

# Keys that make an object a POI, by shape.
POLYGON_KEYS = [
    "amenity",
    "historic",
    "leisure",
    "shop",
    "tourism",
    "industrial",
    "craft",
    "man_made",
    "healthcare",
    "emergency",
    "playground",
    "camp_site",
]
POINT_KEYS = [*POLYGON_KEYS, "highway"]
LINE_KEYS = ["playground", "amenity"]
BUILDINGS = {"building": ["cabin", "static_caravan"]}


def read_nodes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_NODE).parquet(path)


def read_ways(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_WAY).parquet(path)


def read_relations(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RAW_RELATION).parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(FEATURE).parquet(path)


def read_country_grid(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Country areas; the envelope is computed where the file has none."""
    grid = spark.read.schema(COUNTRY_GRID).format(fmt).load(path)
    fresh = with_envelope(grid)
    return fresh.select("country_code", "rings", *ENVELOPE)


def is_point_poi(tags: Column) -> Column:
    return has_any_of(tags, POINT_KEYS, BUILDINGS)


def is_polygon_poi(tags: Column) -> Column:
    return has_any_of(tags, POLYGON_KEYS, BUILDINGS)


def is_line_poi(tags: Column) -> Column:
    return has_any_of(tags, LINE_KEYS, {})


def _feature(df: DataFrame, osm_type: str) -> DataFrame:
    return with_envelope(
        df.select(
            F.lit(osm_type).alias("osm_type"),
            F.col("id").alias("osm_id"),
            utc_timestamp(F.col("timestamp")).alias("timestamp"),
            unify_keys(F.col("tags")).alias("tags"),
            "kind",
            "rings",
        )
    ).select(*KEY, "timestamp", "tags", *GEOMETRY)


def ingest_points(nodes: DataFrame) -> DataFrame:
    found = nodes.filter(is_point_poi(F.col("tags")))
    return _feature(
        found.withColumn("kind", F.lit("P")).withColumn("rings", F.expr(point_rings("lon", "lat"))),
        "N",
    )


def split_ways(ways: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(closed ways that are area POIs, open ways that are line POIs)."""
    refs = F.col("nodes")
    closed = (F.size(refs) > 1) & (F.element_at(refs, 1) == F.element_at(refs, -1))
    tags = F.col("tags")
    return ways.filter(closed & is_polygon_poi(tags)), ways.filter(~closed & is_line_poi(tags))


def ingest_ways(ways: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(areas, lines). Ways are filtered by tag before any node is looked up."""
    closed, opened = split_ways(ways)

    def build(part: DataFrame, kind: str, least: int) -> DataFrame:
        paths = way_geometry(part, nodes).filter(F.size("path") >= least)
        return _feature(
            part.join(paths, "id").withColumn("kind", F.lit(kind)).withColumn("rings", F.array("path")),
            "W",
        )

    return build(closed, "A", 4), build(opened, "L", 2)


def ingest_relations(relations: DataFrame, ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """Multipolygon relations as areas; relations whose ways do not close are left out."""
    tags = F.col("tags")
    found = relations.filter((tags["type"] == "multipolygon") & is_polygon_poi(tags))
    shapes = multipolygon_geometry(found, ways, nodes)
    return _feature(found.join(shapes, "id").withColumn("kind", F.lit("A")), "R")


def ingest_site_members(relations: DataFrame) -> DataFrame:
    """One row per member of a site relation of a camp or caravan site."""
    tags = F.col("tags")
    found = relations.filter(
        (tags["type"] == "site")
        & (value_in(tags["tourism"], SITE_TOURISM) | value_in(tags["site"], SITE_TOURISM))
    )
    return found.select(
        F.col("id").alias("site_id"),
        utc_timestamp(F.col("timestamp")).alias("timestamp"),
        unify_keys(tags).alias("site_tags"),
        F.explode("members").alias("member"),
    ).select(
        "site_id",
        "timestamp",
        F.upper("member.type").alias("member_type"),
        F.col("member.ref").alias("member_id"),
        "site_tags",
    )
