"""Lazy wiring of feeds -> stage -> marts for one input directory.

Nothing is cached or materialised here: every table is built on first access
(PySpark analyses a plan as soon as it is built, so building only what a
query touches matters), and each accessor returns a logical plan so Catalyst
sees and prunes the whole query. The pipeline (``plans.pipeline``) is the
path that materialises the layers as tables.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession

from clickmart.operators import marts, stage
from clickmart.sources.feeds import load_feeds


class LazyTables(Mapping):
    """name -> DataFrame, each built once on first access."""

    def __init__(self, builders: dict[str, Callable[[], DataFrame]]):
        self._builders = builders
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._builders[name]()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)


def stage_tables(feeds: Mapping[str, DataFrame]) -> LazyTables:
    b = lambda: feeds["browser_events"]
    loc = lambda: feeds["location_events"]
    return LazyTables({
        "conversion": lambda: stage.conversion(b(), loc()),
        "devices": lambda: stage.devices(feeds["device_events"]),
        "events": lambda: stage.events(b()),
        "geo": lambda: stage.geo(feeds["geo_events"]),
        "purchases": lambda: stage.purchases(b(), loc()),
        "session_info": lambda: stage.session_info(b()),
        "transitions": lambda: stage.transitions(b(), loc()),
    })


def mart_tables(s: Mapping[str, DataFrame]) -> LazyTables:
    """Mart name -> DataFrame over stage tables (names as in the dashboard)."""
    return LazyTables({
        "campaign_purchase_analysis_hourly":
            lambda: marts.campaign_purchases_hourly(s["purchases"], s["conversion"]),
        "click_conversion_rates_hourly":
            lambda: marts.source_purchases_hourly(s["purchases"], s["conversion"]),
        "events_distribution_hourly":
            lambda: marts.events_distribution_hourly(s["transitions"], s["devices"]),
        "purchased_products_count_hourly": lambda: marts.products_purchased_hourly(s["purchases"]),
        "top_performing_products": lambda: marts.top_products(s["transitions"]),
        "users_segments_agg": lambda: marts.users_segments(s["devices"], s["conversion"]),
        "users_purchases_segments_agg":
            lambda: marts.users_purchases_segments(s["purchases"], s["devices"], s["conversion"]),
    })


def mart_tables_from_feeds(feeds: Mapping[str, DataFrame], s: Mapping[str, DataFrame]) -> LazyTables:
    """Marts for the lazy (nothing materialised) path: the transitions-based
    marts count per event_id on each feed instead of joining row by row."""
    t = mart_tables(s)
    b = lambda: feeds["browser_events"]
    loc = lambda: feeds["location_events"]
    t._builders.update({
        "events_distribution_hourly":
            lambda: marts.events_distribution_hourly_from_feeds(b(), loc(), s["devices"]),
        "top_performing_products": lambda: marts.top_products_from_feeds(b(), loc()),
    })
    return t


class Lake:
    def __init__(self, feeds: Mapping[str, DataFrame]):
        self.feeds = feeds
        self.stage = stage_tables(feeds)
        self.marts = mart_tables_from_feeds(feeds, self.stage)

    @classmethod
    def from_dir(cls, spark: SparkSession, sf_dir: str) -> "Lake":
        return cls(load_feeds(spark, sf_dir))

    @property
    def browser(self) -> DataFrame:
        return self.feeds["browser_events"]

    @property
    def location(self) -> DataFrame:
        return self.feeds["location_events"]

    @property
    def device(self) -> DataFrame:
        return self.feeds["device_events"]

    @property
    def geo(self) -> DataFrame:
        return self.feeds["geo_events"]
