"""The engine's input tables, derived from the driver's tables (see FIXTURES.md)."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sitegrid.functions.geometry import point_rings, vertex
from sitegrid.functions.tags import build_object
from sitegrid.schema import CHANGE, ENVELOPE, IMAGE, KEY, RAW_CHANGE, TAGS
from sitegrid.session import configure, written
from sitegrid.sources.fixture_views import with_views

BASE_TABLES = [
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
]

AREA_TAGS = [
    "tourism",
    "leisure",
    "amenity",
    "nudism",
    "group_only",
    "scout",
    "backcountry",
    "tents",
    "caravans",
    "motorhome",
    "shower",
    "name",
    "sport",
]

# Corner positions in quarters of width and height, one list per ring.
_BOX = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
_TEMPLATES = {
    0: [_BOX],
    1: [_BOX],
    2: [[(0, 0), (4, 0), (4, 2), (2, 2), (2, 4), (0, 4), (0, 0)]],
    3: [_BOX, [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]],
}


def _degrees(value: str) -> str:
    return f"((cast({value} AS double) - 2048) / 64)"


def degrees(value: str) -> Column:
    return F.expr(_degrees(value))


def _template_rings() -> Column:
    def corner(fx, fy):
        return vertex(_degrees(f"x0 + floor(w * {fx} / 4)"), _degrees(f"y0 + floor(h * {fy} / 4)"))

    cases = [
        f"WHEN {shape} THEN array({', '.join('array(' + ', '.join(corner(*c) for c in ring) + ')' for ring in rings)})"
        for shape, rings in _TEMPLATES.items()
    ]
    return F.expr(f"CASE shape {' '.join(cases)} END")


def _point_columns(x: str, y: str) -> dict[str, Column]:
    return {
        "kind": F.lit("P"),
        "rings": F.expr(point_rings(_degrees(x), _degrees(y))),
        "minx": degrees(x),
        "miny": degrees(y),
        "maxx": degrees(x),
        "maxy": degrees(y),
    }


def pair_tags(k1: Column, v1: Column, k2: Column, v2: Column) -> Column:
    entries = F.array(
        F.struct(k1.alias("key"), v1.alias("value")), F.struct(k2.alias("key"), v2.alias("value"))
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["key"].isNotNull()))


class Fixtures:
    """Lazily built tables of one scale factor."""

    _open: dict[tuple[str, str], "Fixtures"] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._saved: dict[str, DataFrame] = {}
        self.stores: dict = {}

    @classmethod
    def of(cls, spark: SparkSession, sf_dir: str) -> "Fixtures":
        """The fixtures of a session and folder; tables saved once are used again."""
        key = (spark.sparkContext.applicationId, sf_dir)
        if key not in cls._open:
            cls._open[key] = cls(configure(spark), sf_dir)
        return cls._open[key]

    def saved(self, name: str, build=None) -> DataFrame:
        """A table as Parquet in the shared folder, written at first use."""
        if name not in self._saved:
            # the driver's files hold one row group each; give every core its share
            table = build() if build else getattr(self, name)
            self._saved[name] = written(table.repartition(self.spark.sparkContext.defaultParallelism), name)
        return self._saved[name]

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def sql(self, query: str) -> DataFrame:
        """A query over the driver's tables and the fixture views."""
        text = with_views(query)
        for name in BASE_TABLES:
            if re.search(rf"\b{name}\b", text):
                self.table(name).createOrReplaceTempView(name)
        return self.spark.sql(text)

    @cached_property
    def points(self) -> DataFrame:
        tags = pair_tags(*[F.col(c) for c in ("k1", "v1", "k2", "v2")])
        return self.sql("SELECT * FROM fx_point").select(
            *KEY,
            F.col("ts").alias("timestamp"),
            tags.alias("tags"),
            *[c.alias(n) for n, c in _point_columns("x", "y").items()],
        )

    @cached_property
    def polys(self) -> DataFrame:
        tags = build_object({**{t: F.col(t) for t in AREA_TAGS}, "addr:country": F.col("addr_country")})
        return self.sql("SELECT * FROM fx_poly").select(
            *KEY,
            F.col("ts").alias("timestamp"),
            tags.alias("tags"),
            F.lit("A").alias("kind"),
            _template_rings().alias("rings"),
            degrees("x0").alias("minx"),
            degrees("y0").alias("miny"),
            degrees("x0 + w").alias("maxx"),
            degrees("y0 + h").alias("maxy"),
        )

    @cached_property
    def lines(self) -> DataFrame:
        ends = {c: _degrees(c) for c in ("x1", "y1", "x2", "y2")}
        return self.sql("SELECT * FROM fx_line").select(
            *KEY,
            F.col("ts").alias("timestamp"),
            build_object({t: F.col(t) for t in ("playground", "amenity")}).alias("tags"),
            F.lit("L").alias("kind"),
            F.expr(
                f"array(array({vertex(ends['x1'], ends['y1'])}, {vertex(ends['x2'], ends['y2'])}))"
            ).alias("rings"),
            *[F.expr(c).alias(n) for n, c in zip(ENVELOPE, ends.values())],
        )

    @cached_property
    def site_members(self) -> DataFrame:
        tags = build_object(
            {
                "type": F.lit("site"),
                "site": F.lit("camp_site"),
                "addr:country": F.col("site_addr_country"),
                "name": F.col("site_name"),
            }
        )
        return self.sql("SELECT * FROM fx_site_member").select(
            "site_id",
            F.lit("2020-01-01 00:00:00").cast("timestamp_ntz").alias("timestamp"),
            "member_type",
            "member_id",
            tags.alias("site_tags"),
        )

    @cached_property
    def country_grid(self) -> DataFrame:
        corner = {c: _degrees(c) for c in ("x0", "y0", "x1", "y1")}
        box = [("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"), ("x0", "y0")]
        return self.sql("SELECT * FROM fx_country").select(
            "country_code",
            F.expr(f"array(array({', '.join(vertex(corner[x], corner[y]) for x, y in box)}))").alias("rings"),
            degrees("x0").alias("minx"),
            degrees("y0").alias("miny"),
            degrees("x1").alias("maxx"),
            degrees("y1").alias("maxy"),
        )

    @cached_property
    def changes(self) -> DataFrame:
        """Change feed of points, with old and new image."""
        kinds = self.sql("SELECT * FROM fx_kind").select(
            "kind", pair_tags(*[F.col(c) for c in ("k1", "v1", "k2", "v2")]).alias("tags")
        )
        old = kinds.select(F.col("kind").alias("old_kind"), F.col("tags").alias("old_tags"))
        new = kinds.select(F.col("kind").alias("new_kind"), F.col("tags").alias("new_tags"))

        def image(side: str) -> Column:
            columns = {
                "timestamp": F.col("ts"),
                "tags": F.col(f"{side}_tags"),
                **_point_columns(f"{side}_x", f"{side}_y"),
            }
            whole = F.struct(*[columns[f.name].alias(f.name) for f in IMAGE.fields])
            return F.when(F.col(f"{side}_x").isNotNull(), whole).alias(side)

        return (
            self.sql("SELECT * FROM fx_change")
            .join(F.broadcast(old), "old_kind", "left")
            .join(F.broadcast(new), "new_kind", "left")
            .select(
                "seq",
                "ts",
                "op",
                *KEY,
                image("old"),
                image("new"),
                F.lit(None).cast(CHANGE["members"].dataType).alias("members"),
            )
        )

    @cached_property
    def relation_changes(self) -> DataFrame:
        """Every third site relation is removed, every third keeps its even members."""
        image = CHANGE["new"].dataType
        stamp = F.lit("2030-01-01 00:00:00").cast("timestamp_ntz")

        def only_tags(name: str) -> Column:
            values = {"timestamp": stamp, "tags": F.col("tags")}
            fields = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in image.fields]
            return F.struct(*fields).alias(name)

        changed = F.floor((F.col("id") - 2_000_000_000) / 6) % 3
        kept = F.filter("members", lambda m: m["ref"] % 2 == 0).cast(CHANGE["members"].dataType)
        return (
            self.raw_relations.filter("tags['type'] = 'site'")
            .filter(changed < 2)
            .select(
                F.col("id").alias("seq"),
                stamp.alias("ts"),
                F.when(changed == 0, "delete").otherwise("modify").alias("op"),
                F.lit("R").alias("osm_type"),
                F.col("id").alias("osm_id"),
                only_tags("old"),
                F.when(changed == 1, only_tags("new")).alias("new"),
                F.when(changed == 1, kept).alias("members"),
            )
        )

    @cached_property
    def raw_nodes(self) -> DataFrame:
        """POI nodes with alias keys, and the untagged nodes of ways and relations."""
        extra = build_object(
            {
                "phone": F.col("phone"),
                "website": F.col("website"),
                "url": F.col("url"),
                "contact:website": F.col("contact_website"),
                "booking": F.col("booking"),
            }
        )
        places = self.sql("SELECT osm_id, x, y, k2, v2 FROM fx_point")
        empty = F.create_map().cast(TAGS)
        first = F.create_map("k1", "v1")
        pois = (
            self.sql("SELECT * FROM fx_raw_tag")
            .join(places, "osm_id")
            .select(
                F.col("osm_id").alias("id"),
                (F.lit(1_500_000_000) + F.col("osm_id")).cast("bigint").alias("timestamp"),
                F.map_concat(first, pair_tags(F.lit(None).cast("string"), F.lit(None).cast("string"), F.col("k2"), F.col("v2")), extra).alias("tags"),
                degrees("x").alias("lon"),
                degrees("y").alias("lat"),
            )
        )
        corners = self.sql(
            "SELECT node_id AS id, x, y FROM fx_way_node WHERE pos > 0 "
            "UNION ALL SELECT 20000000000 + k * 32 + ring * 8 + i, x, y FROM fx_vertex "
            "WHERE osm_type = 'R' AND i > 0 "
            "UNION ALL SELECT 40000000000 + osm_id * 2, x1, y1 FROM fx_line "
            "UNION ALL SELECT 40000000001 + osm_id * 2, x2, y2 FROM fx_line"
        ).select(
            "id",
            F.lit(1_500_000_000).cast("bigint").alias("timestamp"),
            empty.alias("tags"),
            degrees("x").alias("lon"),
            degrees("y").alias("lat"),
        )
        return pois.unionByName(corners)

    @cached_property
    def raw_ways(self) -> DataFrame:
        """Closed ways, open line ways, and untagged parts of multipolygon rings.

        A closed way names its first node again at the end (its position 0).
        """
        stamp = F.lit(1_500_000_000).cast("bigint").alias("timestamp")
        empty = F.create_map().cast(TAGS)
        corners = self.sql("SELECT way_id AS k, way_id, max(pos) AS n FROM fx_way_node GROUP BY way_id")
        base = F.lit(10_000_000).cast("bigint") + F.col("k") * 16
        loop = F.concat(
            F.array(base + F.col("n")),
            F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: base + i),
        )
        tagged = self.polys.filter("osm_type = 'W'").select(F.col("osm_id").alias("way_id"), "tags")
        closed = corners.join(tagged, "way_id").select(
            F.col("way_id").alias("id"), stamp, "tags", loop.alias("nodes")
        )
        opened = self.lines.select(
            F.col("osm_id").alias("id"),
            stamp,
            "tags",
            F.array(F.lit(40_000_000_000) + F.col("osm_id") * 2, F.lit(40_000_000_001) + F.col("osm_id") * 2).alias("nodes"),
        )
        start = F.lit(20_000_000_000) + F.col("osm_id") * 32
        # outer ring in two open halves, the second one backwards; hole as one closed way
        parts = F.array(
            F.array(start + 4, start + 1, start + 2),
            F.array(start + 4, start + 3, start + 2),
            F.array(start + 12, start + 9, start + 10, start + 11, start + 12),
        )
        halves = (
            self.polys.filter("osm_type = 'R'")
            .select("osm_id", F.posexplode(parts).alias("part", "nodes"))
            .select(
                (F.lit(3_000_000_000) + F.col("osm_id") * 4 + F.col("part")).alias("id"),
                stamp,
                empty.alias("tags"),
                "nodes",
            )
        )
        return closed.unionByName(opened).unionByName(halves)

    @cached_property
    def raw_relations(self) -> DataFrame:
        """Multipolygons from their three ways, and the site relations."""
        stamp = F.lit(1_500_000_000).cast("bigint").alias("timestamp")
        way = F.lit(3_000_000_000) + F.col("osm_id") * 4
        member = [
            F.struct(F.lit("w").alias("type"), (way + i).alias("ref"), F.lit(role).alias("role"))
            for i, role in enumerate(["outer", "outer", "inner"])
        ]
        areas = self.polys.filter("osm_type = 'R'").select(
            F.col("osm_id").alias("id"),
            stamp,
            F.map_concat("tags", F.create_map(F.lit("type"), F.lit("multipolygon"))).alias("tags"),
            F.array(*member).alias("members"),
        )
        sites = (
            self.site_members.groupBy(F.col("site_id").alias("id"))
            .agg(
                F.first("site_tags").alias("tags"),
                F.array_sort(
                    F.collect_list(
                        F.struct(
                            F.lower("member_type").alias("type"),
                            F.col("member_id").alias("ref"),
                            F.lit("").alias("role"),
                        )
                    )
                ).alias("members"),
            )
            .select("id", stamp, "tags", "members")
        )
        return areas.unionByName(sites)

    @cached_property
    def raw_diff(self) -> DataFrame:
        """Moved corners of areas, moved and deleted POI nodes, deleted ways and site relations."""
        moved = self.sql("SELECT id, new_x, new_y, gone, kind FROM fx_raw_diff")
        tags = self.raw_nodes.select("id", "tags")
        stamp = F.lit(1_600_000_000).cast("bigint")
        nodes = moved.filter("kind = 'n'").join(tags, "id").select("id", "kind", "gone", "tags", degrees("new_x").alias("lon"), degrees("new_y").alias("lat"))
        others = moved.filter("kind != 'n'").select("id", "kind", "gone", F.lit(None).cast(TAGS).alias("tags"), F.lit(None).cast("double").alias("lon"), F.lit(None).cast("double").alias("lat"))
        empty = {"nodes": "array<bigint>", "members": RAW_CHANGE["members"].dataType}
        return nodes.unionByName(others).select(
            F.col("id").alias("seq"),
            F.when(F.col("gone"), "delete").otherwise("modify").alias("op"),
            F.col("kind").alias("type"),
            "id",
            stamp.alias("timestamp"),
            "tags",
            "lon",
            "lat",
            *[F.lit(None).cast(t).alias(c) for c, t in empty.items()],
        )
