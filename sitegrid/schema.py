"""Fixed column schemas of inputs and products.

An object is identified by (osm_type, osm_id). A geometry is `kind` ('P' point,
'L' line, 'A' area), `rings` and its envelope. An area keeps all its closed rings
and is read by the even-odd rule, which covers holes and multipolygons without
roles. The envelope is stored so that Parquet statistics can skip files.
"""

from __future__ import annotations

from pyspark.sql import types as T

TAGS = T.MapType(T.StringType(), T.StringType())
VERTEX = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(VERTEX))

ENVELOPE = ["minx", "miny", "maxx", "maxy"]
GEOMETRY = ["kind", "rings", *ENVELOPE]
KEY = ["osm_type", "osm_id"]


def _fields(*pairs):
    return [T.StructField(name, kind) for name, kind in pairs]


_ENVELOPE_FIELDS = _fields(*((c, T.DoubleType()) for c in ENVELOPE))
_KEY_FIELDS = _fields(("osm_type", T.StringType()), ("osm_id", T.LongType()))
_GEOMETRY_FIELDS = _fields(("kind", T.StringType()), ("rings", RINGS)) + _ENVELOPE_FIELDS

# points, lines and polys share one schema
FEATURE = T.StructType(
    _KEY_FIELDS
    + _fields(("timestamp", T.TimestampNTZType()), ("tags", TAGS))
    + _GEOMETRY_FIELDS
)

SITE_MEMBER = T.StructType(
    _fields(
        ("site_id", T.LongType()),
        ("timestamp", T.TimestampNTZType()),
        ("member_type", T.StringType()),
        ("member_id", T.LongType()),
        ("site_tags", TAGS),
    )
)

COUNTRY_GRID = T.StructType(
    _fields(("country_code", T.StringType()), ("rings", RINGS)) + _ENVELOPE_FIELDS
)

RAW_NODE = T.StructType(
    _fields(
        ("id", T.LongType()),
        ("timestamp", T.LongType()),
        ("tags", TAGS),
        ("lon", T.DoubleType()),
        ("lat", T.DoubleType()),
    )
)

RAW_WAY = T.StructType(
    _fields(
        ("id", T.LongType()),
        ("timestamp", T.LongType()),
        ("tags", TAGS),
        ("nodes", T.ArrayType(T.LongType())),
    )
)

MEMBER = T.StructType(
    _fields(("type", T.StringType()), ("ref", T.LongType()), ("role", T.StringType()))
)

RAW_RELATION = T.StructType(
    _fields(
        ("id", T.LongType()),
        ("timestamp", T.LongType()),
        ("tags", TAGS),
        ("members", T.ArrayType(MEMBER)),
    )
)

#: one row per change in a raw diff; what does not belong to the type is null
RAW_CHANGE = T.StructType(
    _fields(
        ("seq", T.LongType()),
        ("op", T.StringType()),
        ("type", T.StringType()),
        ("id", T.LongType()),
        ("timestamp", T.LongType()),
        ("tags", TAGS),
        ("lon", T.DoubleType()),
        ("lat", T.DoubleType()),
        ("nodes", T.ArrayType(T.LongType())),
        ("members", T.ArrayType(MEMBER)),
    )
)

IMAGE = T.StructType(_fields(("timestamp", T.TimestampNTZType()), ("tags", TAGS)) + _GEOMETRY_FIELDS)

# `new` is null for a deletion; `members` is set for relations only.
CHANGE = T.StructType(
    _fields(("seq", T.LongType()), ("ts", T.TimestampNTZType()), ("op", T.StringType()))
    + _KEY_FIELDS
    + _fields(("old", IMAGE), ("new", IMAGE), ("members", T.ArrayType(MEMBER)))
)

# Facility columns in product order.
FACILITIES = [
    "telephone",
    "post_box",
    "drinking_water",
    "power_supply",
    "shop",
    "laundry",
    "sanitary_dump_station",
    "firepit",
    "bbq",
    "toilets",
    "playground",
    "swimming_pool",
    "golf_course",
    "miniature_golf",
    "sauna",
    "fast_food",
    "restaurant",
    "pub",
    "bar",
    "cabin",
    "static_caravan",
    "kitchen",
    "sink",
    "fridge",
    "picnic_table",
]

# Shower classes, best first; the smallest rank wins.
SHOWERS = ["hot", "cold", "yes", "no", "untagged"]

CAMPSITE = T.StructType(
    _KEY_FIELDS
    + _fields(
        ("tags", TAGS),
        ("timestamp", T.TimestampNTZType()),
        ("category", T.StringType()),
        *((name, T.BooleanType()) for name in FACILITIES),
        ("shower", T.StringType()),
        ("sport", T.ArrayType(T.StringType())),
        ("visible", T.BooleanType()),
    )
    + _GEOMETRY_FIELDS
)

# Campsites as they are stored, with the columns that requests filter by and the digest of `rings`.
SERVED = T.StructType(
    CAMPSITE.fields + _fields(("country", T.StringType()), ("tourism", T.StringType()), ("shape", T.StringType()))
)

# Digests of a geometry and of another one inside it.
NESTED = T.StructType(_fields(("outer", T.StringType()), ("inner", T.StringType())))

PLAYGROUND = T.StructType(
    _KEY_FIELDS
    + _fields(
        ("tags", TAGS),
        ("timestamp", T.TimestampNTZType()),
        ("equipment", T.ArrayType(T.StringType())),
        ("sport", T.ArrayType(T.StringType())),
    )
    + _GEOMETRY_FIELDS
)

TABLES = {
    "points": FEATURE,
    "lines": FEATURE,
    "polys": FEATURE,
    "objects": FEATURE,
    "site_members": SITE_MEMBER,
    "country_grid": COUNTRY_GRID,
    "campsites": SERVED,
    "nested": NESTED,
    "playgrounds": PLAYGROUND,
}
