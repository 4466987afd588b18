"""Country of a geometry, and the unified addr:country tag."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrid.functions.geometry import centroid
from sitegrid.functions.tags import build_object, tags_merge
from sitegrid.operators.spatial import SPLIT_ROWS, join_points

KEY = "addr:country"


def needs_lookup(tags: Column) -> Column:
    """Sites whose own tag is not a two-letter code."""
    return F.coalesce(F.length(tags[KEY]) != 2, F.lit(True))


def country_lookup(
    grid: DataFrame, features: DataFrame, keys: list[str], split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """(keys, country): the grid area that strictly contains the centroid, lowest code first."""
    centres = (
        features.select(*keys, F.expr(centroid("kind", "rings")).alias("centre"))
        .select(*keys, F.col("centre.x").alias("minx"), F.col("centre.y").alias("miny"))
    )
    hits = join_points(grid.select("country_code", "rings", "minx", "miny", "maxx", "maxy"), centres, strict=True, split_rows=split_rows)
    return hits.groupBy(*keys).agg(F.min("country_code").alias("country"))


def unify_country(tags: Column, country: Column) -> Column:
    """Two letters: lower case. Otherwise the looked-up code, or the tag as it is."""
    code = F.when(needs_lookup(tags), country).otherwise(F.lower(tags[KEY]))
    return tags_merge(tags, build_object({KEY: code}))
