"""The product as requests read it: columns to filter by, and an order that follows the map."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrid.operators.inside import with_shape
from sitegrid.schema import SERVED


def served(sites: DataFrame) -> DataFrame:
    """Sites with country, tourism and the digest of their geometry as columns; those that have them stay."""
    if set(SERVED.fieldNames()) <= set(sites.columns):
        return sites
    tags = F.col("tags")
    named = {"country": tags["addr:country"], "tourism": tags["tourism"]}
    return with_shape(sites.withColumns(named))


def _spread(v: Column) -> Column:
    """The 16 low bits of `v` on the even places."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        v = v.bitwiseOR(F.shiftleft(v, shift)).bitwiseAND(F.lit(mask).cast("bigint"))
    return v


def curve() -> Column:
    """Place of a row on a Z-order curve over the whole map, by the corner of its envelope."""

    def step(c: str, low: int, width: int) -> Column:
        at = F.floor((F.col(c) - low) / width * 65536).cast("bigint")
        return F.greatest(F.lit(0), F.least(F.lit(65535), at))

    return _spread(step("minx", -180, 360)).bitwiseOR(F.shiftleft(_spread(step("miny", -90, 180)), 1))


def along_curve(sites: DataFrame) -> DataFrame:
    """Rows that are near on the map are near in the files, so the statistics of a row group
    span a small box and few countries. The id in the range key splits a crowded place."""
    place = curve()
    return sites.repartitionByRange(place, "osm_id").sortWithinPartitions(place, "osm_id")
