"""Node references to coordinates, and relation members to rings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sitegrid.functions.geometry import vertex
from sitegrid.schema import RINGS
from sitegrid.session import written


def way_geometry(ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, path): the coordinates of each way in order; unknown nodes are skipped."""
    refs = ways.select("id", F.posexplode("nodes").alias("pos", "node"))
    places = nodes.select(F.col("id").alias("node"), "lon", "lat")
    return (
        refs.join(places, "node")
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "lon", "lat"))).alias("steps"))
        .select("id", F.expr(f"transform(steps, s -> {vertex('s.lon', 's.lat')})").alias("path"))
    )


def _followers(open_ways: DataFrame) -> DataFrame:
    """(id, dart, next): which way follows which, for both directions of every open way.

    The dart of way w is 2 w along its nodes and 2 w + 1 against them. Way ends that meet
    at a place are paired in the order of the ways, so rings that touch there part. An end
    without a partner gets a null `next`.
    """
    ends = open_ways.select(
        "id",
        "way",
        F.expr("inline(array(struct(0 AS side, element_at(path, 1) AS at), struct(1 AS side, element_at(path, -1) AS at)))"),
    ).select("id", "way", "side", F.col("at.x").alias("x"), F.col("at.y").alias("y"))
    meeting = Window.partitionBy("id", "x", "y").orderBy("way", "side")
    leave = "2 * way + side"
    nth, before, after = (f(meeting) for f in (F.row_number().over, F.lag(F.expr(leave)).over, F.lead(F.expr(leave)).over))
    # a way that ends here came along its nodes, and a partner that starts here goes along its own
    return ends.select(
        "id",
        F.expr("2 * way + 1 - side").alias("dart"),
        F.when(nth % 2 == 1, after).otherwise(before).alias("next"),
    )


def ring_places(followers: DataFrame, name: str = "rings") -> DataFrame:
    """(id, dart, first, back): the least dart of each dart's ring, and the steps ahead to it.

    Pointer jumping: a row knows the least dart of the next `width` ones and where it is;
    a join with the row behind that stretch doubles it. A stretch as long as the relation
    has ways spans every ring, so a relation leaves after log2(ways) rounds and later
    rounds hold large relations only. Both sides of the join are unique by key: no ring,
    however long, is a group. Every round is written, which cuts the lineage.
    """
    ways = followers.groupBy("id").agg((F.count(F.lit(1)) / 2).cast("bigint").alias("ways"))
    start = followers.join(ways, "id").select(
        "id", "dart", "next", "ways", F.col("dart").alias("first"), F.lit(0).cast("bigint").alias("back")
    )
    known = written(start, name)
    longest = known.agg(F.max("ways")).first()[0] or 0
    done, width = [], 1
    while width < longest:
        done.append(known.filter(F.col("ways") <= width))
        here = known.filter(F.col("ways") > width)
        there = here.select(
            "id",
            F.col("dart").alias("next"),
            F.col("next").alias("beyond"),
            F.col("first").alias("far_first"),
            (F.col("back") + width).alias("far_back"),
        )
        nearer = F.col("first") <= F.col("far_first")
        jumped = here.join(there, ["id", "next"]).select(
            "id",
            "dart",
            F.col("beyond").alias("next"),
            "ways",
            F.least("first", "far_first").alias("first"),
            F.when(nearer, F.col("back")).otherwise(F.col("far_back")).alias("back"),
        )
        known = written(jumped, name)
        width *= 2
    for part in done:
        known = known.unionByName(part)
    return known.select("id", "dart", "first", "back")


def multipolygon_geometry(relations: DataFrame, ways: DataFrame, nodes: DataFrame) -> DataFrame:
    """(id, rings) of multipolygon relations.

    Closed member ways are rings as they are. Open ways are joined end to end: a ring
    starts with its least way, along that way's nodes. A missing way or a loose end leaves
    no valid geometry. Rings are ordered by their least way, joined ones first.
    """
    members = (
        relations.select("id", F.explode("members").alias("m"))
        .filter(F.col("m.type") == "w")
        .select("id", F.col("m.ref").alias("way"))
        .dropDuplicates()
    )
    used = ways.join(members.select(F.col("way").alias("id")), "id", "left_semi").select("id", "nodes")
    paths = way_geometry(used, nodes).filter(F.size("path") >= 2).withColumnRenamed("id", "way")
    closed = F.element_at("path", 1) == F.element_at("path", -1)
    parts = written(members.join(paths, "way", "left").withColumn("closed", closed), "ring-parts")
    gaps = parts.filter("path IS NULL").select("id")

    followers = written(_followers(parts.filter("NOT closed")), "followers")
    broken = gaps.unionByName(followers.filter("next IS NULL").select("id")).distinct()
    placed = ring_places(followers.join(broken, "id", "left_anti"))
    # each ring is found in both directions; the one along its least way is kept
    steps = placed.filter("pmod(first, 2) = 0").selectExpr(
        "id", "CAST(floor(dart / 2) AS bigint) AS way", "pmod(dart, 2) = 1 AS against", "first", "back"
    )
    pieces = steps.join(parts.select("id", "way", "path"), ["id", "way"]).selectExpr(
        "id",
        "first",
        "if(back = 0, NULL, -back) AS place",
        "CASE WHEN against THEN reverse(path) ELSE path END AS path",
    )
    joined = pieces.groupBy("id", "first").agg(F.sort_array(F.collect_list(F.struct("place", "path"))).alias("s")).selectExpr(
        "id",
        "0 AS kind",
        "first AS rank",
        "concat(slice(s[0].path, 1, 1), flatten(transform(s, p -> slice(p.path, 2, size(p.path) - 1)))) AS ring",
    )
    whole = parts.filter("closed").join(broken, "id", "left_anti").selectExpr("id", "1 AS kind", "way AS rank", "path AS ring")
    return (
        joined.unionByName(whole)
        .groupBy("id")
        .agg(F.array_sort(F.collect_list(F.struct("kind", "rank", "ring"))).alias("r"))
        .select("id", F.transform("r", lambda r: r["ring"]).cast(RINGS).alias("rings"))
    )
