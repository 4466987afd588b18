"""Grid join: areas with the points, lines and areas they touch or contain.

Spark plans a bare envelope condition as a nested loop, so both sides are cut
into cells of a fixed hierarchy and meet in an equi-join.

* A shape lives on the finest level where it needs few cells, so large and small
  shapes share a join without one side being copied over and over. A row is
  copied at most `MAX_CELLS` times, and never more often than its own size earns.
* Points meet areas with the edges cut down to the cell. A cell without an edge
  is all inside (no test left) or all outside (dropped before the shuffle).
* Extended shapes keep all their edges; a pair is tested once, in the cell of the
  lower left corner of the envelopes' shared part. No `distinct` is needed. Each area
  carries a few boxes inside it: where boxes meet, so do the areas, and edges
  are compared for the other pairs only.
* The cells of the left side fill a bit field of fixed size. A row of the right side
  is copied to those of its cells only that the field may have, so what lies far
  from all areas is dropped next to the scan.
* The cut cells are written once; levels, bit field and join read that table.
* A hot cell is split while the join runs: both sides are exchanged by cell, and
  adaptive execution (`configure`) deals a large partition of either side over several
  tasks, which read the other side's partition each. That needs no pass to count rows.
  With `split_rows`, for a session without it, cells that hold more rows of a side are
  counted first and split into parts, and the other side's rows are copied into each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitegrid.functions import geometry as G
from sitegrid.schema import ENVELOPE
from sitegrid.session import written

# Cell edge of level n is 2 ** (2 n - 8) degrees: about 400 m up to the whole map.
LEVELS = list(range(9))
FEW_CELLS = 9
MAX_CELLS = 1024
EDGES_PER_CELL = 8

# rows of one side of a cell that a task takes; None leaves hot cells to adaptive execution
SPLIT_ROWS = None
# 2 ** 22 bits in 512 KB
FIELD_WORDS = 1 << 16


def _size(level: str) -> str:
    return f"pow(2D, 2 * {level} - 8)"


def _cell(value: str, level: str) -> str:
    return f"cast(floor({value} / {_size(level)}) AS bigint)"


def _pack(level: str, cx: str, cy: str, lane: str = "0") -> str:
    """One integer per cell; `lane` separates the two directions of a join."""
    return (
        f"(shiftleft(cast({lane} AS bigint), 60) + shiftleft(cast({level} AS bigint), 56)"
        f" + shiftleft({cx} + {1 << 27}L, 28) + {cy} + {1 << 27}L)"
    )


def home_level(allowed: str, prefix: str = "") -> str:
    """Finest level on which the box needs at most `allowed` cells."""
    w, h = f"({prefix}maxx - {prefix}minx)", f"({prefix}maxy - {prefix}miny)"
    steps = [
        f"WHEN (floor({w} / {4.0 ** (n - 4)}D) + 2) * (floor({h} / {4.0 ** (n - 4)}D) + 2) <= {allowed} THEN {n}"
        for n in LEVELS[:-1]
    ]
    return f"CASE {' '.join(steps)} ELSE {LEVELS[-1]} END"


#: level of an area that meets points: more cells for more vertices
AREA_LEVEL = home_level(f"least({MAX_CELLS}, greatest({FEW_CELLS}, size(flatten(rings)) / {EDGES_PER_CELL}))")
#: level of a finished cell
CELL_LEVEL = "cast(shiftright(cell, 56) & 15 AS int)"


def point_cell(level: str, x: str, y: str) -> str:
    return _pack(level, _cell(x, level), _cell(y, level))


def cover(prefix: str, level: str) -> str:
    """Cells of `level` under the box, as array<struct<level,cx,cy>>."""
    xs = f"sequence({_cell(prefix + 'minx', level)}, {_cell(prefix + 'maxx', level)})"
    ys = f"sequence({_cell(prefix + 'miny', level)}, {_cell(prefix + 'maxy', level)})"
    cell = f"named_struct('level', {level}, 'cx', kx, 'cy', ky)"
    return f"flatten(transform({xs}, kx -> transform({ys}, ky -> {cell})))"


# Tiles of 4 degrees: at most 4050 on the map.
TILE_LEVEL = 5


def tile(x: str, y: str) -> str:
    return _pack(str(TILE_LEVEL), _cell(x, str(TILE_LEVEL)), _cell(y, str(TILE_LEVEL)))


def clustered(features: DataFrame) -> DataFrame:
    """Rows ordered by tile, so that Parquet statistics can skip row groups by place.

    The id in the range key lets a crowded place go to several files.
    """
    place = F.expr(tile("minx", "miny"))
    return features.repartitionByRange(place, "minx", "osm_id").sortWithinPartitions(place)


def points_near(points: DataFrame, areas: DataFrame) -> DataFrame:
    """The points in tiles that some of a few areas reach into.

    The map has few tiles, so they travel as constants: the rows of tiles as plain
    comparisons that the scan can use, the tiles themselves as a set.
    """
    tiles = areas.selectExpr(f"explode({cover('', str(TILE_LEVEL))}) AS c").select("c.cx", "c.cy").distinct().collect()
    size = 4.0 ** (TILE_LEVEL - 4)
    rows: dict[int, list[int]] = {}
    for t in tiles:
        rows.setdefault(t.cy, []).append(t.cx)
    within = [
        f"(miny >= {cy * size}D AND miny <= {(cy + 1) * size}D AND minx >= {min(cxs) * size}D AND minx <= {(max(cxs) + 1) * size}D)"
        for cy, cxs in sorted(rows.items())
    ]
    packed = [str(_pack_tile(t.cx, t.cy)) + "L" for t in tiles]
    return points.filter(" OR ".join(within) or "false").filter(f"{tile('minx', 'miny')} IN ({', '.join(packed) or 'NULL'})")


def _pack_tile(cx: int, cy: int) -> int:
    """The number that `tile` gives a point of this tile."""
    return (TILE_LEVEL << 56) + ((cx + (1 << 27)) << 28) + cy + (1 << 27)


def used_levels(df: DataFrame, column: str) -> Column:
    """The levels a side uses (at most nine), as an uncorrelated scalar subquery."""
    return df.select(column).agg(F.array_sort(F.collect_set(column))).scalar()


def _bit(cell: str) -> str:
    return f"pmod(xxhash64({cell}), {64 * FIELD_WORDS})"


def cell_field(cells: DataFrame) -> Column:
    """A bit field of hashed cells, as an uncorrelated scalar subquery of one bounded array."""
    bit = _bit("cell")
    words = cells.selectExpr(f"cast({bit} DIV 64 AS bigint) AS id", f"shiftleft(1L, cast({bit} % 64 AS int)) AS bit")
    words = words.groupBy("id").agg(F.bit_or("bit").alias("word"))
    whole = cells.sparkSession.range(FIELD_WORDS).join(words, "id", "left")
    return whole.agg(F.expr("transform(array_sort(collect_list(struct(id, coalesce(word, 0L) AS word))), w -> w.word)")).scalar()


def may_have(field: Column, cell: str) -> Column:
    """Whether the field may have the cell; false for most others.

    To be used as a filter, where the field is a constant and not a column of the rows."""
    bit = _bit(cell)
    word = F.get(field, F.expr(f"cast({bit} DIV 64 AS int)"))
    return word.bitwiseAND(F.expr(f"shiftleft(1L, cast({bit} % 64 AS int))")) != 0


def split_hot(left: DataFrame, right: DataFrame, split_rows: int | None):
    """Add the same join column `part` to both sides, more than one part in hot cells."""
    if split_rows is None:
        return left.withColumn("part", F.lit(0)), right.withColumn("part", F.lit(0))

    def crowded(df: DataFrame, name: str) -> DataFrame:
        counts = df.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > split_rows)
        return counts.selectExpr("cell", f"cast(ceil(n / {split_rows}) AS int) AS {name}")

    # at most one row per split_rows rows of a side
    hot = crowded(left, "l_parts").join(crowded(right, "r_parts"), "cell", "full")
    hot = hot.selectExpr("cell", "coalesce(l_parts, 1) AS l_parts", "coalesce(r_parts, 1) AS r_parts")

    def spread(df: DataFrame, own: str, other: str, part: str) -> DataFrame:
        # by the row's own values, so a task that runs again spreads alike
        row = ", ".join(f"`{c}`" for c, t in df.dtypes if "map<" not in t)
        kept = [f"`{c}`" for c in df.columns]
        dealt = df.join(hot, "cell", "left").selectExpr(
            *kept,
            "coalesce(r_parts, 1) AS r_parts",
            f"cast(pmod(xxhash64({row}), coalesce({own}, 1)) AS int) AS mine",
            f"explode(sequence(0, coalesce({other}, 1) - 1)) AS theirs",
        )
        return dealt.selectExpr(*kept, f"{part} AS part")

    return spread(left, "l_parts", "r_parts", "mine * r_parts + theirs"), spread(right, "r_parts", "l_parts", "theirs * r_parts + mine")


def area_cells(areas: DataFrame, payload: list[str]) -> DataFrame:
    """One row per area and cell with the edges a point of the cell can depend on.

    A ray to the right from a point in the cell meets only edges of the cell's
    height that do not end left of it. `l_edges` is null where all points of the
    cell are inside.
    """
    keep = [*payload, "l_minx", "l_miny", "l_maxx", "l_maxy"]
    cells = (
        areas.selectExpr(*keep, "l_edges", f"explode({cover('l_', 'l_level')}) AS c")
        .selectExpr(
            *keep,
            "l_edges",
            f"{_pack('c.level', 'c.cx', 'c.cy')} AS cell",
            f"c.cx * {_size('c.level')} AS x0",
            f"c.cy * {_size('c.level')} AS y0",
            f"(c.cx + 1) * {_size('c.level')} AS x1",
            f"(c.cy + 1) * {_size('c.level')} AS y1",
        )
    )
    return _judged(cells, keep)


def _judged(cells: DataFrame, keep: list[str]) -> DataFrame:
    """Cells with the edges that count there; those outside are left out."""
    near = G.edges_in_box("l_edges", "x0", "y0", "double('infinity')", "y1")
    return (
        cells.selectExpr(*keep, "cell", "x0", "y0", "x1", f"{near} AS near")
        .selectExpr(
            *keep,
            "cell",
            "near",
            f"CASE WHEN exists(near, ce -> least(ce.x1, ce.x2) <= x1) THEN 2 ELSE {G.locate('near', 'x0', 'y0')} END AS state",
        )
        .filter("state > 0")
        .selectExpr(*keep, "cell", "CASE WHEN state = 2 THEN near END AS l_edges")
    )


#: points in a cell on an area's edge from which on the cell is cut again
CROWDED = 256


def _cut_again(cells: DataFrame, keep: list[str]) -> DataFrame:
    """The cells of the next finer level in each cell; those outside their area are left out.

    The edges of a cell are all that points of its parts depend on."""
    fine = "cast(level - 1 AS int)"
    part = lambda shift: f"(((shiftright(cell, {shift}) & {(1 << 28) - 1}L) - {1 << 27}L) * 4 + {{}})"
    boxed = cells.withColumn("level", F.expr(CELL_LEVEL)).withColumn("k", F.explode(F.array(*map(F.lit, range(16)))))
    boxed = boxed.selectExpr(*keep, "l_edges", f"{fine} AS fine", f"{part(28).format('k DIV 4')} AS cx", f"{part(0).format('k % 4')} AS cy")
    boxed = boxed.selectExpr(
        *keep,
        "l_edges",
        f"{_pack('fine', 'cx', 'cy')} AS cell",
        f"cx * {_size('fine')} AS x0",
        f"cy * {_size('fine')} AS y0",
        f"(cx + 1) * {_size('fine')} AS x1",
        f"(cy + 1) * {_size('fine')} AS y1",
    )
    return _judged(boxed.filter("x0 <= l_maxx AND x1 >= l_minx AND y0 <= l_maxy AND y1 >= l_miny"), keep)


def points_at(points: DataFrame, cells: DataFrame) -> DataFrame:
    """Points (with r_x and r_y) with each of their cells that `cells` may have."""
    kept = [f"`{c}`" for c in points.columns]
    at = points.withColumn("level", F.explode(levels_of(cells)))
    return at.selectExpr(*kept, f"{point_cell('level', 'r_x', 'r_y')} AS cell").filter(may_have(cell_field(cells), "cell"))


def finer_cells(cells: DataFrame, places: DataFrame, payload: list[str]) -> tuple[DataFrame, DataFrame]:
    """(inner, edge) cells of areas, where those on an edge are cut again and again while they hold many points.

    cells: `first_cells`; places: r_x and r_y of the points. So an area meets the points next to
    its edge one by one, and all others by the cells they are in."""
    keep = [*payload, "l_minx", "l_miny", "l_maxx", "l_maxy"]
    crowded = CROWDED
    inner, edge, settled = cells.filter("l_edges IS NULL"), cells.filter("l_edges IS NOT NULL"), []
    for _ in LEVELS[1:]:
        counts = written(points_at(places, edge).groupBy("cell").agg(F.count(F.lit(1)).alias("n")), "counts")
        full = counts.filter((F.col("n") > crowded) & (F.expr(CELL_LEVEL) > 0)).select("cell")
        if full.isEmpty():
            break
        # cells without a point have nothing to tell
        some = counts.filter((F.col("n") <= crowded) | (F.expr(CELL_LEVEL) == 0)).select("cell")
        settled.append(written(edge.join(some, "cell").select(*cells.columns), "cells"))
        cut = written(_cut_again(edge.join(full, "cell"), keep).select(*cells.columns), "cells")
        inner, edge = inner.unionByName(cut.filter("l_edges IS NULL")), cut.filter("l_edges IS NOT NULL")
    for more in settled:
        edge = edge.unionByName(more)
    return inner, edge


def levels_of(cells: DataFrame) -> Column:
    """The levels that cells lie on, as an uncorrelated scalar subquery; only the cell numbers are read."""
    return used_levels(cells.selectExpr(f"{CELL_LEVEL} AS level"), "level")


def _payload(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in ("kind", "rings", *ENVELOPE, "inner_points")]


def first_cells(areas: DataFrame, payload: list[str]) -> DataFrame:
    """The cells of areas on the level that suits their size, written."""
    left = areas.selectExpr(
        *payload,
        f"{G.edges('rings')} AS l_edges",
        *[f"{c} AS l_{c}" for c in ENVELOPE],
        f"{AREA_LEVEL} AS l_level",
    )
    # cutting edges is the dear part: levels, field and hot cells come from the finished cells
    return written(area_cells(left, payload), "cells")


def join_points(
    areas: DataFrame, points: DataFrame, strict: bool = False, split_rows: int | None = SPLIT_ROWS
) -> DataFrame:
    """Pairs of an area and a point in it; on the boundary too unless `strict`."""
    left_cols, right_cols = _payload(areas), _payload(points)
    cells = first_cells(areas, left_cols)
    right = points_at(points.selectExpr(*right_cols, "minx AS r_x", "miny AS r_y"), cells)
    return points_in(cells, right, left_cols, right_cols, strict, split_rows)


def points_in(cells: DataFrame, right: DataFrame, left_cols: list[str], right_cols: list[str], strict: bool, split_rows: int | None) -> DataFrame:
    """Pairs of an area and a point that meet in a cell, by the edges of the area there.

    Loops over edges have no generated code, and a join with one in its condition runs
    without any. So cells of few edges are joined with their edges as columns, apart from others."""
    left, right = split_hot(cells, right, split_rows)
    in_box = "r_x BETWEEN l_minx AND l_maxx AND r_y BETWEEN l_miny AND l_maxy"
    own = [c for c in left.columns if c != "l_edges"]
    few = left.filter(f"l_edges IS NULL OR size(l_edges) <= {G.FEW_EDGES}").selectExpr(*own, "l_edges IS NULL AS whole", *G.edge_columns("l_edges"))
    many = left.filter(f"size(l_edges) > {G.FEW_EDGES}")
    by_columns = f"(whole OR {G.columns_cover_point('r_x', 'r_y', strict)})"
    by_list = G.covers_point("l_edges", "r_x", "r_y", strict)
    found = [side.join(right, ["cell", "part"]).filter(f"{in_box} AND {exact}").select(*left_cols, *right_cols) for side, exact in ((few, by_columns), (many, by_list))]
    return found[0].unionByName(found[1])


def _shape_side(df: DataFrame, prefix: str, payload: list[str]) -> DataFrame:
    inner = [f"inner_points AS {prefix}inner_points"] if "inner_points" in df.columns else []
    df = df.withColumn(f"{prefix}boxes", F.expr(G.inner_boxes("kind", "rings")))
    return df.selectExpr(
        *payload,
        *G.inner_box_columns(f"{prefix}boxes", prefix),
        f"kind AS {prefix}kind",
        f"{G.edges('rings')} AS {prefix}edges",
        f"{G.starts('rings')} AS {prefix}starts",
        *inner,
        *[f"{c} AS {prefix}{c}" for c in ENVELOPE],
        f"{home_level(str(FEW_CELLS))} AS {prefix}level",
    )


def _cell_box() -> list[str]:
    """Lower left corner and width of `cell`, exact in double precision."""
    size = _size(CELL_LEVEL)
    at = lambda shift: f"((shiftright(cell, {shift}) & {(1 << 28) - 1}L) - {1 << 27}L) * {size}"
    return [f"{at(28)} AS c_x", f"{at(0)} AS c_y", f"{size} AS c_w"]


def _shape_cells(df: DataFrame, prefix: str, other_levels: Column, home_lane: int, same: bool, field: Column | None = None):
    """Cells of a side: its home level in one lane, coarser levels of the other side.

    Lane 0 pairs home cells of the left side with equal or finer right shapes,
    lane 1 home cells of the right side with finer left shapes. So a pair meets on
    the coarser of its two home levels and on no other. With `field`, only cells that
    the other side may have.
    """
    home = prefix + "level"
    coarser = f"filter(other_levels, sn -> sn {'>=' if same else '>'} {home})"

    def in_lane(cells: str, lane: int) -> str:
        return f"transform({cells}, sc -> {_pack('sc.level', 'sc.cx', 'sc.cy', str(lane))})"

    cells = (
        f"concat({in_lane(cover(prefix, home), home_lane)},"
        f" flatten(transform({coarser}, sn -> {in_lane(cover(prefix, 'sn'), 1 - home_lane)})))"
    )
    kept = [f"`{c}`" for c in df.columns if c != home]
    df = df.withColumn("other_levels", other_levels).selectExpr(*kept, f"explode({cells}) AS cell")
    if home_lane == 0:
        df = df.selectExpr("*", *_cell_box())
    return df if field is None else df.filter(may_have(field, "cell"))


def join_shapes(
    areas: DataFrame,
    shapes: DataFrame,
    strict: bool = False,
    refine: bool = True,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """Pairs of an area and a line or area that it touches (`strict`: contains).

    `refine=False` stops after the envelope test (`strict`: one envelope in the other) and
    ships no edges.
    """
    left_cols, right_cols = _payload(areas), _payload(shapes)
    if strict and refine:
        shapes = shapes.withColumn("inner_points", F.expr(G.inside_points("rings")))
    left = _shape_side(areas, "l_", left_cols)
    right = _shape_side(shapes, "r_", right_cols)
    if not refine:
        boxes = [f"in{i}_{c}" for i in range(G.INNER_BOXES) for c in ("x0", "y0", "x1", "y1")]
        left = left.drop("l_edges", "l_starts", *[f"l_{c}" for c in boxes])
        right = right.drop("r_edges", "r_starts", *[f"r_{c}" for c in boxes])
    left_levels, right_levels = used_levels(left, "l_level"), used_levels(right, "r_level")
    left = written(_shape_cells(left, "l_", right_levels, home_lane=0, same=False), "cells")
    right = _shape_cells(right, "r_", left_levels, home_lane=1, same=True, field=cell_field(left))
    left, right = split_hot(left, right, split_rows)
    # the lower left corner of the shared part lies in one cell; the edges of cells are powers of two, so this is exact
    corner = " AND ".join(f"greatest(l_min{a}, r_min{a}) >= c_{a} AND greatest(l_min{a}, r_min{a}) < c_{a} + c_w" for a in "xy")
    boxes = G.box_covers("l_", "r_") if strict else G.boxes_overlap("l_", "r_")
    pairs = left.join(right, ["cell", "part"]).filter(f"{boxes} AND {corner}")
    if refine:
        known = f"(r_kind = 'A' AND {G.inner_box_covers('l_', 'r_')})" if strict else G.inner_boxes_meet("l_", "r_")
        exact = G.shape_contains("l_", "r_") if strict else G.shapes_intersect("l_", "r_")
        # a case, since parts that occur twice in one side of an OR are computed for all rows
        pairs = pairs.filter(f"CASE WHEN {known} THEN true ELSE {exact} END")
    return pairs.select(*left_cols, *right_cols)


def join_all(
    areas: DataFrame,
    points: DataFrame | None,
    shapes: DataFrame | None,
    strict: bool = False,
    split_rows: int | None = SPLIT_ROWS,
) -> DataFrame:
    """`join_points` and `join_shapes` with the same payload, as one table of pairs."""
    found = []
    if points is not None:
        found.append(join_points(areas, points, strict, split_rows))
    if shapes is not None:
        found.append(join_shapes(areas, shapes, strict, split_rows=split_rows))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1])
