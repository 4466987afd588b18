import json
from pathlib import Path
from xml.etree import ElementTree

import pytest
from pyspark.sql import functions as F

from checks.registry import Tables
from conftest import SF
from sitegrid.plans import features, sitemaps
from sitegrid.plans.serving import curve, served
from sitegrid.schema import KEY
from sitegrid.streaming import updater


@pytest.fixture(scope="module")
def sites(spark):
    return Tables(spark, SF).marked


@pytest.mark.parametrize(
    "request_args",
    [
        {},
        {"bbox": "1,2,3"},
        {"bbox": "a,b,c,d"},
        {"bbox": "nan,0,1,1"},
        {"bbox": "5,0,1,1"},
        {"bbox": "0,5,1,1"},
        {"bbox": "0,0,181,1"},
        {"bbox": "1,2,3", "country": "de"},
        {"country": "d"},
        {"country": "abcd"},
        {"country": "d3"},
        {"osm_id": "1"},
        {"osm_id": "1 or 1=1", "osm_type": "way"},
        {"osm_id": "1", "osm_type": "WAY"},
    ],
)
def test_bad_requests_have_no_answer(sites, request_args):
    assert features.request_filter(**request_args) is None


def test_collections(sites):
    none = features.feature_collection(features.site_features(features.query_sites(sites, country="x")))
    assert json.loads(none.first()[0]) == {"type": "FeatureCollection", "features": []}
    some = features.feature_collection(features.site_features(features.query_sites(sites, bbox="-32,-32,32,32")))
    found = json.loads(some.first()[0])["features"]
    assert len(found) == sites.count()
    for f in found:
        assert ("bbox" in f) != f["id"].startswith("https://www.openstreetmap.org/node/")
        keys = list(f["properties"])
        assert keys == sorted(keys, key=lambda k: (len(k), k.encode()))


def test_sport_lists(sites):
    df = sites.limit(1).select(
        *[c for c in sites.columns if c not in ("tags", "sport")],
        F.create_map(F.lit("sport"), F.lit("golf;chess"), F.lit("shower"), F.lit("cold")).alias("tags"),
        F.array().cast("array<string>").alias("sport"),
    ).withColumn("shower", F.lit("hot"))
    properties = json.loads(features.site_features(df).first().feature)["properties"]
    assert properties["sport"] == ["golf", "chess"] and properties["shower"] == "hot"


def test_written_outputs(spark, sites, tmp_path):
    path = str(tmp_path / "features")
    features.write_features(features.site_features(sites), path)
    assert spark.read.json(path).count() == sites.count()
    urls = sitemaps.sitemap_urls(sites, "https://maps.example")
    # every file is a whole document, also where a country has several, and the index names all of them
    for name, per_file, least in (("sitemaps", 45_000, 1), ("small", 5, 2)):
        folder = tmp_path / name
        parts = sitemaps.sitemap_parts(urls, sitemaps.country_dates(sites), per_file)
        sitemaps.write_sitemaps(urls, str(folder), parts, per_file)
        files = {f.parent.name.removeprefix("file="): f for f in folder.rglob("part-*") if f.is_file()}
        sizes = [len(ElementTree.fromstring(f.read_bytes())) for f in files.values()]
        assert len(files) >= least and len(files) == parts.count()
        assert sum(sizes) == urls.count() and max(sizes) <= per_file
        index = sitemaps.index_document(sitemaps.sitemap_index(sites, "https://maps.example", parts)).first()[0]
        links = [e.text for e in ElementTree.fromstring(index.encode()).iter() if e.tag.endswith("loc")]
        assert sorted(links) == sorted(f"https://maps.example/sitemaps/{n}" for n in files)
        # the parts of a country continue each other
        of_de = [n for n in files if n.startswith("de")]
        of_de.sort(key=lambda n: int(n.removeprefix("de").removesuffix(".xml").removeprefix("-") or 1))
        entries = "".join(files[n].read_text().removeprefix(sitemaps.URLSET_HEAD).removesuffix(sitemaps.URLSET_TAIL) for n in of_de)
        rows = urls.filter("country = 'de'").orderBy("osm_type", "osm_id").collect()
        assert entries == "".join(r.entry for r in rows) and rows
    document = sitemaps.sitemap_document(urls.filter("country = 'de'")).first()[0]
    assert document.startswith("<?xml") and document.endswith("</urlset>\n")
    index = sitemaps.index_document(sitemaps.sitemap_index(sites, "https://maps.example")).first()[0]
    assert index.count("<sitemap>") == sites.filter("visible").select(sitemaps.country()).dropna().distinct().count()


def test_box_filter_reaches_the_scan(sites):
    plan = features.query_sites(sites, bbox="0,0,1,1").select(*KEY)._jdf.queryExecution().toString()
    scan = plan[plan.rindex("FileScan") :]
    assert "PushedFilters: [IsNotNull(minx)" in scan and "LessThanOrEqual(minx,1.0)" in scan
    assert "tags" not in scan[scan.index("ReadSchema") :]


def test_stored_product_skips_by_box_and_country(spark, sites, tmp_path):
    """Country and box are pushed to the scan, and row groups of the stored order are narrow."""
    store = updater.Store(spark, str(tmp_path / "store"))
    store.write_full(0, {"campsites": served(sites)})
    store.commit(0, True, -1, None)
    live = updater.read_campsites(store)
    for request, pushed in (({"country": "de"}, "EqualTo(country,de)"), ({"bbox": "-9,-9,8,8"}, "LessThanOrEqual(minx,8.0)")):
        plan = features.query_sites(live, **request).select(*KEY)._jdf.queryExecution().toString()
        scan = plan[plan.rindex("FileScan") :]
        assert pushed in scan and "tags" not in scan[scan.index("ReadSchema") :]
        want = features.query_sites(sites, **request).select(*KEY).collect()
        assert sorted(features.query_sites(live, **request).select(*KEY).collect()) == sorted(want) and want
    # neighbours in the file are neighbours on the map
    def way(rows):
        return sum(abs(a.minx - b.minx) + abs(a.miny - b.miny) for a, b in zip(rows, rows[1:]))

    stored = live.select("minx", "miny").collect()
    assert way(stored) < way(sites.orderBy(*KEY).select("minx", "miny").collect()) / 2



def test_curve_interleaves_both_axes(spark):
    points = spark.createDataFrame([(-180.0, -90.0), (180.0, 90.0), (0.0, -90.0), (-180.0, 0.0), (500.0, -90.0)], "minx double, miny double")
    got = [r[0] for r in points.select(curve()).collect()]
    assert got == [0, (1 << 32) - 1, 1 << 30, 1 << 31, 0x55555555]
