"""Facility, category and shower rules, and the narrow evidence a POI carries.

A POI's tags are reduced once, next to the scan, to one bit mask of facilities,
one shower rank and a few texts. Joins and shuffles move these instead of tags,
and a site's facilities become one `bit_or`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sitegrid.functions.scalars import object_ref
from sitegrid.functions.tags import value_in
from sitegrid.schema import FACILITIES, SHOWERS

# Tag values of the site and playground filters.
SITE_TOURISM = ["camp_site", "caravan_site"]
NUDIST_VALUES = ["yes", "obligatory", "customary", "designated"]

# A rule is a list of alternatives; an alternative is a list of (key, test, value).
_IS = "="
_NOT = "!="

# Which POI tags prove a facility.
FACILITY_RULES = {
    "telephone": [[("amenity", _IS, "telephone")]],
    "post_box": [[("amenity", _IS, "post_box")]],
    "drinking_water": [
        [("amenity", _IS, "drinking_water")],
        [("man_made", _IS, "water_tap"), ("drinking_water", _IS, "yes")],
        [("amenity", _IS, "water_point")],
    ],
    "power_supply": [[("amenity", _IS, "power_supply")]],
    "shop": [[("shop", _NOT, "laundry")]],
    "laundry": [[("amenity", _IS, "washing_machine")], [("shop", _IS, "laundry")]],
    "sanitary_dump_station": [[("amenity", _IS, "sanitary_dump_station")]],
    "firepit": [[("leisure", _IS, "firepit")]],
    "bbq": [[("amenity", _IS, "bbq")], [("leisure", _IS, "firepit"), ("grate", _IS, "yes")]],
    "toilets": [[("amenity", _IS, "toilets")]],
    "playground": [[("leisure", _IS, "playground")]],
    "swimming_pool": [[("leisure", _IS, "swimming_pool")]],
    "golf_course": [[("leisure", _IS, "golf_course")]],
    "miniature_golf": [[("leisure", _IS, "miniature_golf")]],
    "sauna": [[("leisure", _IS, "sauna")]],
    "fast_food": [[("amenity", _IS, "fast_food")]],
    "restaurant": [[("amenity", _IS, "restaurant")]],
    "pub": [[("amenity", _IS, "pub")]],
    "bar": [[("amenity", _IS, "bar")]],
    "cabin": [[("building", _IS, "cabin")]],
    "static_caravan": [[("building", _IS, "static_caravan")]],
    "kitchen": [[("amenity", _IS, "kitchen")]],
    "sink": [[("amenity", _IS, "sink")], [("amenity", _IS, "kitchen"), ("sink", _NOT, "no")]],
    "fridge": [[("amenity", _IS, "fridge")], [("amenity", _IS, "kitchen"), ("fridge", _NOT, "no")]],
    "picnic_table": [[("leisure", _IS, "picnic_table")]],
}

_NOT_FROM_RELATIONS = ["power_supply", "cabin", "static_caravan"]

# Rules for members of a site relation: as inside an area, but drinking water has
# one source only and three facilities are not taken over.
SITE_RULES = {
    **{k: v for k, v in FACILITY_RULES.items() if k not in _NOT_FROM_RELATIONS},
    "drinking_water": [[("amenity", _IS, "drinking_water")]],
}

# The relation rules taken to the letter: kitchens and picnic tables (looked up
# as an amenity) set `bar`, and neither sets its own column.
SITE_RULES_AS_WRITTEN = {
    **{k: v for k, v in SITE_RULES.items() if k not in ("kitchen", "picnic_table")},
    "bar": [
        [("amenity", _IS, "bar")],
        [("amenity", _IS, "kitchen")],
        [("amenity", _IS, "picnic_table")],
    ],
}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _test(key: str, test: str, value: str) -> str:
    return f"tags[{_quoted(key)}] {test} {_quoted(value)}"


def rule(alternatives) -> str:
    """True if one alternative holds; a missing tag makes it false, not null.

    As SQL text on the column `tags`.
    """
    held = [" AND ".join(_test(*part) for part in parts) for parts in alternatives]
    return "coalesce(" + " OR ".join(f"coalesce({h}, false)" for h in held) + ", false)"


def facility_flags(rules=FACILITY_RULES) -> dict[str, Column]:
    """Facility columns of one POI from its `tags`."""
    return {name: F.expr(rule(alternatives)) for name, alternatives in rules.items()}


def facility_mask(rules=FACILITY_RULES) -> Column:
    """The facilities of `tags`, one bit each, in product order."""
    bits = [
        f"if({rule(rules[name])}, {1 << i}L, 0L)" for i, name in enumerate(FACILITIES) if name in rules
    ]
    return F.expr(" + ".join(bits))


def mask_flags(mask: str) -> dict[str, Column]:
    """The facility columns of a mask; a null mask has none."""
    return {
        name: F.expr(f"coalesce({mask}, 0L) & {1 << i}L != 0") for i, name in enumerate(FACILITIES)
    }


# The mask of the facility columns of a product row.
FLAGS_MASK = " + ".join(f"if({name}, {1 << i}L, 0L)" for i, name in enumerate(FACILITIES))


def is_site(tags: Column) -> Column:
    return value_in(tags["tourism"], SITE_TOURISM)


def is_playground(tags: Column) -> Column:
    return F.coalesce(tags["leisure"] == "playground", F.lit(False))


def site_category(tags: Column) -> Column:
    """First match wins."""
    no_motorhome = F.coalesce(tags["motorhome"] != "yes", F.lit(True))
    return (
        F.when(tags["nudism"].isin(*NUDIST_VALUES), "nudist")
        .when((tags["group_only"] == "yes") | (tags["scout"] == "yes"), "group_only")
        .when(tags["backcountry"] == "yes", "backcountry")
        .when((tags["tents"] == "yes") & (tags["caravans"] == "no") & no_motorhome, "camping")
        .when(
            (tags["tents"] == "no") | ((tags["tourism"] == "caravan_site") & tags["tents"].isNull()),
            "caravan",
        )
        .otherwise("standard")
    )


def _rank(label: str) -> Column:
    return F.lit(SHOWERS.index(label))


def poi_shower(tags: Column) -> Column:
    """Shower rank that a POI itself proves; null where it proves none."""
    shower_house = tags["amenity"] == "shower"
    toilets = tags["amenity"] == "toilets"
    return (
        F.when(shower_house & (tags["hot_water"] == "yes"), _rank("hot"))
        .when(toilets & (tags["shower"] == "hot"), _rank("hot"))
        .when(shower_house & (tags["hot_water"] == "no"), _rank("cold"))
        .when(toilets & (tags["shower"] == "cold"), _rank("cold"))
        .when(shower_house & tags["hot_water"].isNull(), _rank("yes"))
        .when(toilets & (tags["shower"] == "yes"), _rank("yes"))
    )


def own_shower(tags: Column) -> Column:
    """Shower rank of the site's own tag, used where a POI proves none."""
    tag = tags["shower"]
    return (
        F.when(tag == "hot", _rank("hot"))
        .when(tag == "cold", _rank("cold"))
        .when(tag.isin("yes", "outdoor"), _rank("yes"))
        .when(tag == "no", _rank("no"))
        .otherwise(_rank("untagged"))
    )


def has_shower_evidence(tags: Column) -> Column:
    """Relation members that count for the shower of the relation's sites."""
    return F.coalesce(
        (tags["amenity"] == "shower") | ((tags["amenity"] == "toilets") & tags["shower"].isNotNull()),
        F.lit(False),
    )


def shower_label(rank: Column) -> Column:
    return F.get(F.array(*[F.lit(s) for s in SHOWERS]), rank)


def least_shower(evidence: Column, lacking: Column, own: Column) -> Column:
    """MIN over (site, POI) pairs: `own` counts only if some POI proves nothing."""
    fallback = F.when(F.coalesce(lacking, F.lit(True)), own)
    return F.least(evidence, fallback)


def poi_evidence(features, lists: dict[str, str], flags: bool = True):
    """Reduce POIs to what a surrounding site needs.

    `lists` maps an output list to the tag it collects. Columns: poi (object
    reference), poi_ts, poi_mask, poi_shower, poi_items, and the geometry.
    """
    tags = F.col("tags")
    items = F.filter(
        F.array(
            *[F.named_struct(F.lit("list"), F.lit(name), F.lit("value"), tags[key]) for name, key in lists.items()]
        ),
        lambda i: i["value"].isNotNull(),
    )
    columns = {
        "poi": object_ref(F.col("osm_type"), F.col("osm_id")),
        "poi_ts": F.col("timestamp"),
        "poi_items": items,
    }
    if flags:
        columns["poi_mask"] = facility_mask()
        columns["poi_shower"] = poi_shower(tags)
    geometry = [c for c in ("kind", "rings", "minx", "miny", "maxx", "maxy")]
    return features.select(*[c.alias(n) for n, c in columns.items()], *geometry)
