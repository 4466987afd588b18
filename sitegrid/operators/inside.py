"""What lies inside each area: newest change, facility mask, shower, lists."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrid.functions.geometry import shape_digest
from sitegrid.operators.facilities import poi_evidence
from sitegrid.operators.spatial import SPLIT_ROWS, finer_cells, first_cells, join_shapes, points_at, points_in
from sitegrid.schema import GEOMETRY
from sitegrid.session import written


def with_shape(sites: DataFrame) -> DataFrame:
    """Rows with the digest of their geometry; a stored digest is used again."""
    return sites if "shape" in sites.columns else sites.withColumn("shape", F.expr(shape_digest("kind", "rings")))


def distinct_shapes(sites: DataFrame) -> DataFrame:
    """One row per geometry: copies of an area are joined once, not once each."""
    return sites.select("shape", *GEOMETRY).dropDuplicates(["shape"])


def inside(
    areas: DataFrame,
    points: DataFrame,
    shapes: DataFrame,
    lists: dict[str, str],
    flags: bool = True,
    split_rows: int | None = SPLIT_ROWS,
    finer: bool = True,
) -> DataFrame:
    """One row per shape of `areas` (with column `shape`).

    inside_ts, and with `flags` inside_mask, inside_shower, inside_lacking (some
    POI proves no shower); `found` holds per list and value the only object that
    carries it, or null if there are several. Sites drop values that they alone
    carry, so an object never counts as its own content.

    No measure counts, so points are first merged in the cells that lie in areas as a whole,
    and areas take one row from each such cell. Only points in cells on an area's edge
    meet the area themselves; with `finer`, these cells are cut until they hold few points.
    """
    content = {"inside_ts": F.max("inside_ts")}
    each = {"poi_ts": "inside_ts"}
    if flags:
        content |= {"inside_mask": F.bit_or("inside_mask"), "inside_shower": F.min("inside_shower"), "inside_lacking": F.bool_or("inside_lacking")}
        each |= {"poi_mask": "inside_mask", "poi_shower": "inside_shower", "poi_lacking": "inside_lacking"}
    # only numbers, so they are merged by hash; texts travel for the few that carry a value
    carriers = {"low": F.min("low"), "high": F.max("high")}

    def of_poi(features: DataFrame) -> DataFrame:
        evidence = poi_evidence(features, lists, flags)
        return evidence.withColumn("poi_lacking", F.col("poi_shower").isNull()) if flags else evidence

    def merged(found: DataFrame, keys: list[str], measures: dict) -> DataFrame:
        return found.groupBy(*keys).agg(*[c.alias(n) for n, c in measures.items()])

    # the digests are long; a number stands for each while rows are many
    named = written(distinct_shapes(areas).withColumn("area", F.monotonically_increasing_id()), "areas")
    numbered = named.drop("shape")
    evidence = of_poi(points).withColumnsRenamed({"minx": "r_x", "miny": "r_y"}).drop("kind", "rings", "maxx", "maxy")
    evidence, around = written(evidence, "evidence"), of_poi(shapes)
    cells = first_cells(numbered, ["area"])
    inner, edge = (cells.filter("l_edges IS NULL"), cells.filter("l_edges IS NOT NULL"))
    if finer:
        inner, edge = finer_cells(cells, evidence.select("r_x", "r_y"), ["area"])

    def collected(keys: list[str], measures: dict, select) -> DataFrame:
        """Measures per area and keys; `select` gives rows of keys and measures from evidence."""
        columns = [*keys, *measures]
        spots = select(evidence, "r_x", "r_y")
        whole = inner.select("area", "cell").join(merged(points_at(spots, inner), ["cell", *keys], measures), "cell")
        single = points_in(edge, points_at(spots, edge), ["area"], columns, False, split_rows)
        extended = join_shapes(numbered, select(around, *GEOMETRY), split_rows=split_rows)
        rows = [found.select("area", *columns) for found in (whole, single, extended)]
        return merged(rows[0].unionByName(rows[1]).unionByName(rows[2]), ["area", *keys], measures)

    found = F.struct(
        F.col("item.list").alias("list"),
        F.col("item.value").alias("value"),
        F.when(F.col("low") == F.col("high"), F.col("low")).alias("only"),
    )
    per_value = collected(
        ["item"],
        carriers,
        lambda e, *place: e.filter(F.size("poi_items") > 0).select(F.explode("poi_items").alias("item"), F.col("poi").alias("low"), F.col("poi").alias("high"), *place),
    )
    listed = per_value.groupBy("area").agg(F.collect_list(found).alias("found"))
    measured = collected([], content, lambda e, *place: e.select(*[F.col(c).alias(n) for c, n in each.items()], *place))
    result = named.select("shape", "area").join(measured, "area").join(listed, "area", "left")
    return result.select("shape", F.coalesce("found", F.array().cast(listed.schema["found"].dataType)).alias("found"), *content)


def found_list(name: str, own):
    """Sorted values of one list without those that only `own` carries."""
    kept = F.filter(
        F.col("found"),
        lambda f: (f["list"] == name) & (f["only"].isNull() | (f["only"] != own)),
    )
    values = F.array_sort(F.transform(kept, lambda f: f["value"]))
    return F.coalesce(values, F.array().cast("array<string>"))
