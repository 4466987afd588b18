import pytest
from pyspark.sql import functions as F

import shapes as S
from sitegrid.functions.tags import tags_merge, unify_keys
from sitegrid.operators.facilities import SITE_RULES_AS_WRITTEN
from sitegrid.operators.quality import mark_quality
from sitegrid.plans.campsites import apply_site_relations, build_campsites, full_campsites
from sitegrid.plans.playgrounds import build_playgrounds
from sitegrid.schema import CAMPSITE, COUNTRY_GRID, FACILITIES, PLAYGROUND

CAMP = {"tourism": "camp_site"}


@pytest.fixture(scope="module")
def grid(spark):
    rows = []
    for code, x in (("aa", 0), ("bb", 50)):
        ring = [{"x": float(a), "y": float(b)} for a, b in S.box(x, 0, x + 50, 50)]
        rows.append((code, [ring], float(x), 0.0, x + 50.0, 50.0))
    return spark.createDataFrame(rows, COUNTRY_GRID)


def by_key(df):
    return {(r.osm_type, r.osm_id): r for r in df.collect()}


def test_schema_of_products(spark, grid):
    polys = S.table(spark, [S.area(1, S.box(1, 1, 2, 2), tags=CAMP)])
    points = S.table(spark, [S.point(2, 1.5, 1.5, {"leisure": "playground"})])
    sites = build_campsites(points, polys, grid)
    assert {f.name: f.dataType for f in sites.schema} == {f.name: f.dataType for f in CAMPSITE}
    grounds = build_playgrounds(points, points.limit(0), polys)
    assert {f.name: f.dataType for f in grounds.schema} == {f.name: f.dataType for f in PLAYGROUND}


def test_facilities_of_a_site(spark, grid):
    polys = S.table(
        spark,
        [
            S.area(1, S.box(1, 1, 3, 3), tags={**CAMP, "sport": "golf", "shower": "no"}),
            S.area(2, S.box(10, 1, 12, 3), tags={**CAMP, "shower": "outdoor"}),
            # copies of one area, with a sport of their own each
            S.area(3, S.box(20, 1, 22, 3), tags={**CAMP, "sport": "golf"}),
            S.area(4, S.box(20, 1, 22, 3), tags={**CAMP, "sport": "golf"}),
            S.area(5, S.box(30, 1, 32, 3), tags={**CAMP, "sport": "golf"}),
            S.area(6, S.box(30, 1, 32, 3), tags={**CAMP, "sport": "chess"}),
        ],
    )
    points = S.table(
        spark,
        [
            # same number as the surrounding way, but another object
            S.point(1, 2, 2, {"shop": "laundry", "sport": "tennis"}),
            S.point(2, 1, 2, {"amenity": "shower", "hot_water": "no"}),
            S.point(9, 45, 45, CAMP),
        ],
    )
    found = by_key(build_campsites(points, polys, grid))
    one = found["W", 1]
    assert one.laundry and not one.shop
    assert one.shower == "cold" and one.sport == ["tennis"]
    two = found["W", 2]
    assert not any(two[f] for f in FACILITIES) and two.shower == "yes" and two.sport == []
    assert found["W", 3].sport == ["golf"] and found["W", 4].sport == ["golf"]
    assert found["W", 5].sport == ["chess"] and found["W", 6].sport == ["golf"]
    assert found["N", 9].shower == "untagged" and found["N", 9].visible


def test_country_tag(spark, grid):
    tags = [{}, {"addr:country": "DE"}, {"addr:country": "Germany"}]
    rows = [S.point(i, 10, 10, {**CAMP, **t}) for i, t in enumerate(tags)]
    rows += [S.point(10 + i, 200, 10, {**CAMP, **t}) for i, t in enumerate(tags)]
    rows.append(S.point(20, 50, 10, CAMP))  # on the border of two areas
    found = by_key(build_campsites(S.table(spark, rows), S.table(spark, []), grid))
    codes = {k[1]: r.tags.get("addr:country") for k, r in found.items()}
    assert codes == {0: "aa", 1: "de", 2: "aa", 10: None, 11: "de", 12: "Germany", 20: None}


CATEGORIES = [
    ({"nudism": "customary", "group_only": "yes"}, "nudist"),
    ({"nudism": "no", "scout": "yes", "backcountry": "yes"}, "group_only"),
    ({"backcountry": "yes", "tents": "no"}, "backcountry"),
    ({"tents": "yes", "caravans": "no"}, "camping"),
    ({"tents": "yes", "caravans": "no", "motorhome": "yes"}, "standard"),
    ({"tents": "no"}, "caravan"),
    ({"tourism": "caravan_site"}, "caravan"),
    ({"tourism": "caravan_site", "tents": "yes"}, "standard"),
    ({}, "standard"),
]


def test_categories(spark, grid):
    rows = [S.point(i, 10, 10, {**CAMP, **t}) for i, (t, _) in enumerate(CATEGORIES)]
    found = by_key(build_campsites(S.table(spark, rows), S.table(spark, []), grid))
    assert [found["N", i].category for i in range(len(rows))] == [c for _, c in CATEGORIES]


def relation_world(spark):
    site = {"type": "site", "site": "camp_site", "addr:country": "xx", "name": "R"}
    polys = S.table(
        spark,
        [
            S.area(1, S.box(0, 0, 4, 4), tags={**CAMP, "name": "own"}),
            S.area(2, S.box(10, 0, 14, 4), tags=CAMP),
            S.area(3, S.box(20, 0, 24, 4), tags=CAMP),
            S.area(4, S.box(30, 0, 34, 4), tags={"tourism": "caravan_site"}),
        ],
    )
    points = S.table(
        spark,
        [
            S.point(1, 40, 40, {"amenity": "kitchen", "sport": "chess"}),
            S.point(2, 1, 1, {"amenity": "picnic_table"}),
            S.point(3, 21, 1, {"amenity": "toilets", "shower": "no"}),
            S.point(4, 22, 1, {"leisure": "picnic_table"}),
        ],
    )
    members = S.members(
        spark,
        [
            (100, "W", 1, site),
            (100, "N", 1, site),
            (100, "N", 2, site),
            (101, "W", 2, {**site, "name": "S"}),
            (101, "W", 3, {**site, "name": "S"}),
            (101, "N", 3, {**site, "name": "S"}),
            (102, "W", 3, {**site, "name": "T"}),
            (102, "N", 4, {**site, "name": "T"}),
            (103, "W", 4, site),
            (103, "N", 1, site),
        ],
    )
    return points, polys, members


@pytest.mark.parametrize("as_written", [False, True])
def test_site_relations(spark, grid, as_written):
    points, polys, members = relation_world(spark)
    none = S.table(spark, [])
    rules = {"rules": SITE_RULES_AS_WRITTEN} if as_written else {}
    built = build_campsites(points, polys, grid)
    found = by_key(apply_site_relations(built, members, points, none, polys, **rules))
    one, two, three, four = (found["W", i] for i in (1, 2, 3, 4))
    assert one.tags["name"] == "R" and one.tags["addr:country"] == "aa" and "type" not in one.tags
    assert one.tags["site_relation"] == "100" and "site_relation_state" not in one.tags
    assert one.sport == ["chess"]
    assert (one.kitchen, one.bar) == ((False, True) if as_written else (True, False))
    # two camps in one relation; one of them surrounds all other members of both its relations
    assert two.tags["site_relation_state"] == "invalid"
    assert three.tags["site_relation_state"] == "useless" and three.tags["site_relation"] == "102"
    # the proof is missing, so the site's own tag decides: untagged
    assert two.shower == "untagged"
    # relations serve camp sites only
    assert "site_relation" not in four.tags and not four.kitchen


def test_nested_sites(spark, grid):
    polys = S.table(
        spark,
        [
            S.area(1, S.box(0, 0, 10, 10), tags=CAMP),
            S.area(2, S.box(2, 2, 4, 4), tags={"tourism": "caravan_site"}),
            S.area(3, S.box(5, 5, 8, 8), tags=CAMP),
            S.area(4, S.box(20, 20, 24, 24), tags=CAMP),
            S.area(5, S.box(20, 20, 24, 24), tags=CAMP),
        ],
    )
    points = S.table(spark, [S.point(1, 6, 6, CAMP), S.point(7, 40, 40, CAMP), S.point(8, 40, 40, CAMP)])
    marked = by_key(mark_quality(build_campsites(points, polys, grid)))
    urls = {k: r.tags.get("contains_sites") for k, r in marked.items()}
    assert urls["W", 1] == "https://osm.org/node/1 https://osm.org/way/3"
    assert urls["W", 3] == "https://osm.org/node/1"
    assert urls["W", 4] == "https://osm.org/way/5" and urls["W", 5] == "https://osm.org/way/4"
    assert urls["N", 7] == "https://osm.org/node/8"
    hidden = {k for k, r in marked.items() if not r.visible}
    assert hidden == {("W", 2), ("W", 3), ("N", 1), ("W", 4), ("W", 5), ("N", 7), ("N", 8)}
    again = by_key(mark_quality(spark.createDataFrame(list(marked.values()), CAMPSITE_ORDER(marked))))
    assert {k: r.tags for k, r in again.items()} == {k: r.tags for k, r in marked.items()}


def CAMPSITE_ORDER(rows):
    from pyspark.sql import types as T

    names = next(iter(rows.values())).__fields__
    return T.StructType([CAMPSITE[n] for n in names])


def test_playground_lists(spark):
    ground = {"leisure": "playground", "playground": "structure"}
    polys = S.table(spark, [S.area(1, S.box(0, 0, 4, 4), tags=ground)])
    points = S.table(spark, [S.point(1, 1, 1, {"playground": "slide"}), S.point(2, 9, 9, ground)])
    lines = S.table(spark, [S.line(5, (-1, 2), (9, 2), tags={"playground": "zipwire", "sport": "free"})])
    found = by_key(build_playgrounds(points, lines, polys))
    assert found["W", 1].equipment == ["slide", "zipwire"] and found["W", 1].sport == ["free"]
    assert found["N", 2].equipment == []


def test_unified_keys(spark):
    df = spark.createDataFrame(
        [
            ({"website": "w", "url": "u", "contact:website": "c"},),
            ({"url": "u", "contact:website": "c", "fax": "1"},),
            ({"contact:website": "c", "booking": "yes", "reservation": "no"},),
        ],
        "tags map<string,string>",
    )
    found = [r[0] for r in df.select(unify_keys(F.col("tags"))).collect()]
    assert found == [
        {"contact:website": "w"},
        {"contact:website": "u", "contact:fax": "1"},
        {"contact:website": "c", "reservation": "yes"},
    ]


def test_merge_keeps_left_and_prefers_right(spark):
    df = spark.createDataFrame([({"a": "1", "b": "2"}, {"b": "3"}), ({"a": "1"}, None)], "l map<string,string>, r map<string,string>")
    assert [r[0] for r in df.select(tags_merge(F.col("l"), F.col("r"))).collect()] == [
        {"a": "1", "b": "3"},
        {"a": "1"},
    ]


def test_full_product_runs_in_order(spark, grid):
    points, polys, members = relation_world(spark)
    full = by_key(full_campsites(points, S.table(spark, []), polys, members, grid))
    assert len(full) == 4 and full["W", 3].tags["site_relation_state"] == "useless"
