"""Query registry: name -> Spark query over the fixtures, and its oracle."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame

from checks.oracle_views import VIEWS
from sitegrid.plans.campsites import apply_site_relations, build_campsites
from sitegrid.operators.quality import mark_quality
from sitegrid.plans.serving import served
from sitegrid.session import shared_dir
from sitegrid.sources.fixture_views import with_views
from sitegrid.sources.fixtures import Fixtures
from sitegrid.streaming.updater import Store, read_campsites

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Saved inputs, and saved intermediate products for the steps behind them."""

    def __init__(self, spark, sf_dir):
        self.spark = spark
        self.fx = Fixtures.of(spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        return self.fx.saved(name)

    @property
    def built(self) -> DataFrame:
        return self.fx.saved("built", lambda: build_campsites(self.points, self.polys, self.country_grid))

    @property
    def related(self) -> DataFrame:
        return self.fx.saved(
            "related",
            lambda: apply_site_relations(self.built, self.site_members, self.points, self.lines, self.polys),
        )

    @property
    def marked(self) -> DataFrame:
        return self.fx.saved("marked", lambda: mark_quality(self.related))

    @property
    def live(self) -> DataFrame:
        """The marked product as a store keeps it for requests."""
        if "live" not in self.fx.stores:
            store = Store(self.spark, f"{shared_dir(self.spark)}/live-{uuid.uuid4().hex}")
            store.write_full(0, {"campsites": served(self.marked)})
            store.commit(0, True, -1, None)
            self.fx.stores["live"] = store
        return read_campsites(self.fx.stores["live"])


def query(oracle: str | None = None, name: str | None = None):
    def register(build):
        key = name or build.__name__
        QUERIES[key] = lambda spark, sf_dir: build(Tables(spark, sf_dir))
        if oracle is not None:
            ORACLES[key] = oracle if oracle.startswith("WITH ") else with_views(oracle, VIEWS)
        return build

    return register
