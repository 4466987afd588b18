"""Text, number, time and array helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The long name of each object type.
TYPE_NAMES = {"N": "node", "W": "way", "R": "relation"}


def utc_timestamp(epoch: Column) -> Column:
    """Epoch seconds as a zone-less UTC timestamp, whatever the session zone is."""
    seconds = epoch.cast("decimal(18,6)")
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return start + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds)


def iso_timestamp(ts: Column) -> Column:
    """ISO text with the explicit UTC offset; a fraction shows only if there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        whole, F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise(""), F.lit("+00:00")
    )


def type_name(osm_type: Column) -> Column:
    return (
        F.when(osm_type == "N", TYPE_NAMES["N"])
        .when(osm_type == "W", TYPE_NAMES["W"])
        .otherwise(TYPE_NAMES["R"])
    )


def osm_url(osm_type: Column, osm_id: Column, base: str = "https://www.openstreetmap.org/") -> Column:
    return F.concat(F.lit(base), type_name(osm_type), F.lit("/"), osm_id.cast("string"))


def round7(value: Column) -> Column:
    """Seven decimals, half away from zero, through an exact decimal."""
    return F.round(value.cast("decimal(20,12)"), 7).cast("double")


def split_list(value: Column, separator: str = ";") -> Column:
    """Text list as array; an empty text is an empty list."""
    return F.when(value == "", F.array().cast("array<string>")).otherwise(F.split(value, separator))


def object_ref(osm_type: Column, osm_id: Column) -> Column:
    """One text that names an object, such as W123."""
    return F.concat(osm_type, osm_id.cast("string"))
