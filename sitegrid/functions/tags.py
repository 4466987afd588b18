"""Column functions on tag maps. A missing key reads as null, as in SQL/JSON."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Aliases of a unified key, strongest first.
KEY_ALIASES = {
    "reservation": ["booking"],
    "contact:phone": ["phone"],
    "contact:fax": ["fax"],
    "contact:website": ["website", "url"],
    "contact:email": ["email"],
    "contact:mobile": ["mobile"],
}

_NO_TAGS = "map<string,string>"


def tag_get(tags: Column, key: str) -> Column:
    return tags[key]


def tag_exists(tags: Column, key: str) -> Column:
    return F.map_contains_key(tags, key)


def value_in(value: Column, allowed: Iterable[str]) -> Column:
    """Membership that is false, not null, for a missing value."""
    return F.coalesce(value.isin(*allowed), F.lit(False))


def tags_minus(tags: Column, *keys: str) -> Column:
    return F.map_filter(tags, lambda k, _: ~k.isin(*keys))


def tags_merge(left: Column, right: Column) -> Column:
    """Both maps; the right one wins. Null counts as empty. Needs no dedup policy."""
    empty = F.create_map().cast(_NO_TAGS)
    right = F.coalesce(right, empty)
    kept = F.map_filter(F.coalesce(left, empty), lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def build_object(values: Mapping[str, Column]) -> Column:
    """A map of the given values without the null ones."""
    entries = [
        F.named_struct(F.lit("key"), F.lit(k), F.lit("value"), v.cast("string")) for k, v in values.items()
    ]
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def has_any_of(tags: Column, keys: Iterable[str], values: Mapping[str, Iterable[str]]) -> Column:
    """True if a key is listed, or a key's value is in its own list."""
    hit = F.arrays_overlap(F.map_keys(tags), F.array(*[F.lit(k) for k in keys]))
    for key, allowed in values.items():
        hit = hit | value_in(tags[key], allowed)
    return F.coalesce(hit, F.lit(False))


def unify_keys(tags: Column) -> Column:
    """Rename alias keys; an alias replaces a value already under the unified key."""
    aliases = [a for group in KEY_ALIASES.values() for a in group]
    unified = {
        target: F.coalesce(*[tags[a] for a in group]) for target, group in KEY_ALIASES.items()
    }
    return tags_merge(tags_minus(tags, *aliases), build_object(unified))

