"""GeoJSON features of campsites, and the request rules in front of them."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrid.functions.geometry import geojson_point, point_on_surface
from sitegrid.functions.scalars import osm_url, round7
from sitegrid.plans.serving import served
from sitegrid.schema import ENVELOPE, FACILITIES

# Facilities whose property has another name.
PROPERTY_NAMES = {"firepit": "openfire", "cabin": "cabins", "static_caravan": "static_caravans"}

OBJECT_TYPES = ["node", "way", "relation"]


def parse_bbox(text: str) -> tuple[float, ...] | None:
    """Four finite degrees, west south east north, in range and in order."""
    try:
        box = tuple(float(part) for part in text.split(","))
    except ValueError:
        return None
    if len(box) != 4 or not all(map(math.isfinite, box)):
        return None
    west, south, east, north = box
    if west > east or south > north:
        return None
    return box if west >= -180 and south >= -90 and east <= 180 and north <= 90 else None


def in_box(box: tuple[float, ...]) -> Column:
    """Envelopes that overlap the box; reaches the Parquet scan as plain comparisons."""
    west, south, east, north = box
    return (
        (F.col("minx") <= east)
        & (F.col("maxx") >= west)
        & (F.col("miny") <= north)
        & (F.col("maxy") >= south)
    )


def in_country(code: str) -> Column:
    return F.col("country") == code


def is_object(osm_type: str, osm_id: str | int) -> Column:
    return (F.col("osm_id") == int(osm_id)) & (F.col("osm_type") == osm_type[0].upper())


def request_filter(bbox=None, country=None, osm_id=None, osm_type=None) -> Column | None:
    """The filter of a request, or None for a bad one.

    A box goes before a country, a country before an id; the ones behind are not
    looked at, also if the first is bad.
    """
    if bbox:
        box = parse_bbox(bbox)
        return None if box is None else in_box(box)
    if country:
        return in_country(country.lower()) if 2 <= len(country) <= 3 and country.isalpha() else None
    if osm_id and osm_type:
        # isdigit() also accepts digits that are no decimal numbers
        number = str(osm_id)
        return is_object(osm_type, number) if number.isdecimal() and osm_type in OBJECT_TYPES else None
    return None


def query_sites(sites: DataFrame, bbox=None, country=None, osm_id=None, osm_type=None) -> DataFrame:
    """Sites that a request asks for; none for a bad request."""
    wanted = request_filter(bbox, country, osm_id, osm_type)
    sites = served(sites)
    return sites.limit(0) if wanted is None else sites.filter(wanted)


def feature_properties() -> Column:
    """Tags, category, facilities, shower and sports as map<string,variant>.

    Derived values override tags; keys are ordered by length, then bytes.
    """
    flags = [
        f"if({name}, named_struct('key', '{PROPERTY_NAMES.get(name, name)}', 'value', cast('yes' AS variant)), NULL)"
        for name in FACILITIES
    ]
    derived = [
        "named_struct('key', 'category', 'value', cast(category AS variant))",
        *flags,
        "if(shower <> 'untagged', named_struct('key', 'shower', 'value', cast(shower AS variant)), NULL)",
        "if(size(sport) > 0, named_struct('key', 'sport', 'value', cast(sport AS variant)), NULL)",
    ]
    own = (
        "transform(map_entries(tags), e -> named_struct('key', e.key, 'value', if(e.key = 'sport',"
        " cast(filter(split(e.value, ';'), s -> e.value <> '') AS variant), cast(e.value AS variant))))"
    )
    merged = (
        f"transform(array(array_compact(array({', '.join(derived)}))), d -> concat(d,"
        f" filter({own}, o -> NOT exists(d, x -> x.key = o.key))))[0]"
    )
    ordered = (
        f"array_sort({merged}, (a, b) -> CASE WHEN octet_length(a.key) <> octet_length(b.key)"
        " THEN octet_length(a.key) - octet_length(b.key) WHEN a.key < b.key THEN -1 WHEN a.key > b.key THEN 1 ELSE 0 END)"
    )
    return F.expr(f"map_from_entries({ordered})")


def site_features(sites: DataFrame) -> DataFrame:
    """(osm_type, osm_id, feature): one GeoJSON Feature per row; areas carry a bbox."""
    place = F.expr(point_on_surface("kind", "rings"))
    bbox = F.when(F.col("osm_type") != "N", F.array(*[round7(F.col(c)) for c in ENVELOPE]))
    prepared = sites.select(
        "osm_type", "osm_id", place.alias("place"), bbox.alias("bbox"), feature_properties().alias("properties")
    )
    feature = F.struct(
        F.lit("Feature").alias("type"),
        osm_url(F.col("osm_type"), F.col("osm_id")).alias("id"),
        "bbox",
        F.expr(geojson_point("place")).alias("geometry"),
        "properties",
    )
    return prepared.select("osm_type", "osm_id", F.to_json(feature).alias("feature"))


def feature_collection(features: DataFrame) -> DataFrame:
    """One document for the answer to a request; `[]` if there is nothing.

    For whole tables use `write_features`, which stays distributed.
    """
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("osm_type", "osm_id", "feature"))), lambda f: f["feature"]), ", ")
    return features.agg(
        F.concat(F.lit('{"type": "FeatureCollection", "features": ['), listed, F.lit("]}")).alias(
            "collection"
        )
    )


def write_features(features: DataFrame, path: str) -> None:
    """Newline-delimited features, one file per task."""
    features.select("feature").write.mode("error").text(path)
