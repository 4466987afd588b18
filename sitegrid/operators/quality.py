"""Nested sites: which sites a site contains, and which are hidden by an outer one."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sitegrid.functions import geometry as G
from sitegrid.functions.scalars import osm_url
from sitegrid.functions.tags import build_object, tags_merge, tags_minus
from sitegrid.operators.inside import distinct_shapes, with_shape
from sitegrid.operators.spatial import SPLIT_ROWS, join_points, join_shapes
from sitegrid.schema import ENVELOPE, GEOMETRY, KEY
from sitegrid.session import written

CONTAINS = "contains_sites"
SHORT_URL = "https://osm.org/"


def nested_shapes(sites: DataFrame, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """(outer, inner) pairs of distinct geometries; `sites` carries `shape`.

    Copies count as one geometry here, so their number is not squared.
    """
    shapes = distinct_shapes(sites)
    areas, spots = shapes.filter(F.col("kind") == "A"), shapes.filter(F.col("kind") == "P")
    outer = areas.withColumnRenamed("shape", "outer")
    points = join_points(outer, spots.withColumnRenamed("shape", "inner"), strict=True, split_rows=split_rows)
    return nested_pairs(outer, shapes.filter(F.col("kind") != "P").withColumnRenamed("shape", "inner"), split_rows).unionByName(points)


def nested_pairs(outer: DataFrame, inner: DataFrame, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """Pairs of an area and another line or area inside it, first by envelopes."""
    boxed = join_shapes(outer, inner, strict=True, refine=False, split_rows=split_rows)
    return proven(boxed, outer, inner)


def proven(boxed: DataFrame, outer: DataFrame, inner: DataFrame) -> DataFrame:
    """Of the pairs (outer, inner) of shapes those where the area contains the other.

    What the exact test needs is drawn once for each shape that has a candidate, not for
    all shapes and cells."""
    candidates = written(boxed.filter("outer != inner").select("outer", "inner"), "candidates")

    def side(shapes: DataFrame, key: str, prefix: str, **drawn) -> DataFrame:
        wanted = shapes.join(candidates.select(key).distinct(), key, "left_semi")
        return wanted.select(key, *[F.expr(e).alias(prefix + n) for n, e in drawn.items()], *[F.col(c).alias(prefix + c) for c in ENVELOPE])

    left = side(outer, "outer", "l_", edges=G.edges("rings"))
    points = "CASE WHEN kind != 'P' THEN {} END"
    right = side(inner, "inner", "r_", kind="kind", edges=points.format(G.edges("rings")), inner_points=points.format(G.inside_points("rings")))
    inside = F.when(F.col("r_kind") == "P", F.expr(G.covers_point("l_edges", "r_minx", "r_miny", strict=True))).otherwise(F.expr(G.shape_contains("l_", "r_")))
    pairs = candidates.join(left, "outer").join(right, "inner")
    return pairs.filter(G.box_covers("l_", "r_")).filter(inside).select("outer", "inner")


def shared_shapes(sites: DataFrame) -> DataFrame:
    """Geometries that several sites have: each contains all the others."""
    return (
        sites.groupBy("shape")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
        .select("shape")
    )


def hidden_shapes(sites: DataFrame, nested: DataFrame) -> DataFrame:
    inner = nested.select(F.col("inner").alias("shape"))
    return inner.unionByName(shared_shapes(sites)).distinct()


def is_camp_inside():
    """Inner caravan sites are not reported."""
    return F.coalesce(F.col("tags")["tourism"] != "caravan_site", F.lit(False))


def contained_sites(sites: DataFrame, nested: DataFrame, listed=None, shared: DataFrame | None = None) -> DataFrame:
    """(shape, inner_sites): sites that lie in an outer geometry, ordered by key.

    The list of a geometry that several sites share names these sites too.
    """
    wanted = sites if listed is None else sites.filter(listed)
    inner = wanted.select(F.col("shape").alias("inner"), F.struct(*KEY).alias("site"))
    shared = shared_shapes(sites) if shared is None else shared
    same = shared.select(F.col("shape").alias("outer"), F.col("shape").alias("inner"))
    return (
        nested.unionByName(same)
        .join(inner, "inner")
        .groupBy(F.col("outer").alias("shape"))
        .agg(F.array_sort(F.collect_list("site")).alias("inner_sites"))
    )


def others_inside():
    """`inner_sites` without the site itself."""
    return F.filter(
        F.col("inner_sites"),
        lambda s: (s["osm_type"] != F.col("osm_type")) | (s["osm_id"] != F.col("osm_id")),
    )


def quality_marks(sites: DataFrame, split_rows: int | None = SPLIT_ROWS, nested: DataFrame | None = None) -> DataFrame:
    """(shape, hidden, inner_sites): one row per geometry with something to mark.

    Only keys, geometry and the tourism tag are needed here; they are written once,
    because the steps below read them several times.
    """
    narrow = written(site_shapes(sites), "site_shapes")
    if nested is None:
        nested = written(nested_shapes(narrow, split_rows), "nested_shapes")
    hidden = hidden_shapes(narrow, nested).withColumn("hidden", F.lit(True))
    return hidden.join(contained_sites(narrow, nested, is_camp_inside()), "shape", "full")


def visible_sites(sites: DataFrame, split_rows: int | None = SPLIT_ROWS) -> DataFrame:
    """Keys of all sites and whether no other one is around them; no lists are made."""
    narrow = written(with_shape(sites).select(*KEY, "shape", *GEOMETRY), "site_shapes")
    hidden = hidden_shapes(narrow, nested_shapes(narrow, split_rows)).withColumn("hidden", F.lit(True))
    return narrow.join(hidden, "shape", "left").select(*KEY, F.col("hidden").isNull().alias("visible"))


def mark_columns() -> dict:
    """The marked columns of a site, from `hidden` and `inner_sites`."""
    others = others_inside()
    urls = F.array_join(
        F.transform(others, lambda s: osm_url(s["osm_type"], s["osm_id"], SHORT_URL)), " "
    )
    mark = build_object({CONTAINS: F.when(F.size(others) > 0, urls)})
    return {
        "tags": tags_merge(tags_minus(F.col("tags"), CONTAINS), mark),
        "visible": F.col("hidden").isNull(),
    }


def mark_quality(sites: DataFrame, split_rows: int | None = SPLIT_ROWS, nested: DataFrame | None = None) -> DataFrame:
    """Renew the `contains_sites` tag and `visible` of all sites, from their nested pairs if those are known."""
    changed = mark_columns()
    marked = with_shape(sites).join(quality_marks(sites, split_rows, nested), "shape", "left")
    return marked.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in sites.columns])


def site_shapes(sites: DataFrame) -> DataFrame:
    """What nesting looks at: keys, the tourism tag, digest and geometry."""
    tourism = F.map_filter("tags", lambda k, _: k == "tourism").alias("tags")
    return with_shape(sites).select(*KEY, tourism, "shape", *GEOMETRY)


def pair_changes(nested: DataFrame, before: DataFrame, after: DataFrame, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nested pairs that a change ends, and those it brings. before, after: `site_shapes`; changed: shapes that left or came.

    A pair of two geometries stays what it is, so pairs go with a geometry that is gone and
    only geometries that were not there before are joined, with all others near them."""
    now = distinct_shapes(after)
    named = lambda df, name: df.withColumnRenamed("shape", name)
    gone = written(changed.join(after.select("shape"), "shape", "left_anti"), "gone")
    ended = [nested.join(named(gone, side), side, "left_semi").select("outer", "inner") for side in ("outer", "inner")]
    fresh = written(now.join(changed, "shape", "left_semi").join(before.select("shape"), "shape", "left_anti"), "fresh")
    areas = now.filter(F.col("kind") == "A")
    # fresh shapes are the side that is cut into cells; their bit field drops the rest next to the scan
    around = join_shapes(named(fresh, "inner"), named(areas, "outer"), refine=False)
    within = join_shapes(named(fresh.filter(F.col("kind") == "A"), "outer"), named(now, "inner"), refine=False)
    boxed = around.select("outer", "inner").unionByName(within.select("outer", "inner")).distinct()
    return ended[0].unionByName(ended[1]).distinct(), proven(boxed, named(areas, "outer"), named(now, "inner"))


def with_pair_changes(nested: DataFrame, ended: DataFrame, begun: DataFrame) -> DataFrame:
    pair = ["outer", "inner"]
    return nested.join(ended, pair, "left_anti").select(*pair).unionByName(begun)


def mark_changes(marked: DataFrame, nested: DataFrame, affected: DataFrame, rebuilt: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, ended, begun) after `affected` sites are replaced by `rebuilt` ones: all sites with new
    content or new marks, as whole rows, and the nested pairs that go and come.

    Marks depend on the sites of a geometry and on its pairs, so only sites whose geometry
    changed its sites, or is paired with one that did, are marked anew."""
    # a stored product has its digests; otherwise they are drawn once
    before = site_shapes(marked) if "shape" in marked.columns else written(site_shapes(marked), "site_shapes")
    new = written(site_shapes(rebuilt), "site_shapes")
    left = before.join(affected.select(*KEY), KEY, "left_semi")
    after = before.join(affected.select(*KEY), KEY, "left_anti").unionByName(new)
    changed = written(left.select("shape").unionByName(new.select("shape")).distinct(), "changed")
    ended, begun = (written(p, "pairs") for p in pair_changes(nested, before, after, changed))
    both = nested.select("outer", "inner").unionByName(begun)
    outer, inner = F.col("outer").alias("shape"), F.col("inner").alias("shape")
    partners = both.join(changed.select(F.col("shape").alias("inner")), "inner").select(outer)
    partners = partners.unionByName(both.join(changed.select(F.col("shape").alias("outer")), "outer").select(inner))
    touched = written(changed.unionByName(partners).distinct(), "touched")

    pairs = with_pair_changes(nested, ended, begun)
    near = written(after.join(touched, "shape", "left_semi").select(*KEY, "shape"), "near")
    listed = pairs.join(touched.select(F.col("shape").alias("outer")), "outer", "left_semi").select("outer", "inner")
    hiding = pairs.join(touched.select(F.col("shape").alias("inner")), "inner", "left_semi").select("outer", "inner")
    hidden = hidden_shapes(near, hiding).withColumn("hidden", F.lit(True))
    lists = contained_sites(after, listed, is_camp_inside(), shared_shapes(near))
    marks = hidden.join(lists, "shape", "full").join(touched, "shape", "left_semi")
    todo = near.join(marks, "shape", "left").drop("shape")
    merged = marked.join(affected.select(*KEY), KEY, "left_anti").unionByName(rebuilt.select(*marked.columns))
    changes = mark_columns()
    rows = merged.join(todo, KEY)
    return rows.select(*[changes[c].alias(c) if c in changes else F.col(c) for c in marked.columns]), ended, begun


def renew_marks(marked: DataFrame, nested: DataFrame, affected: DataFrame, rebuilt: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The whole marked product and its nested pairs after `affected` sites were replaced by `rebuilt` ones."""
    rows, ended, begun = mark_changes(marked, nested, affected, rebuilt)
    rows = written(rows, "remarked")
    away = affected.select(*KEY).unionByName(rows.select(*KEY))
    stay = marked.join(away, KEY, "left_anti").select(*marked.columns)
    return stay.unionByName(rows), with_pair_changes(nested, ended, begun)
