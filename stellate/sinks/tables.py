"""Layers of full-replace tables: releases hold the rows, catalog views name the current ones (SNK-1..6)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stellate.sinks.layout import clustered
from stellate.sinks.releases import Draft, Release, Store

__all__ = ["LAYERS", "Warehouse", "clustered"]

# The four layers and what each holds.
LAYERS = {
    "raw": "Landing: one typed copy per source table",
    "stg": "Staging: cleaned and deduplicated",
    "core": "Core: dimensions and facts of the star schema",
    "mart": "Marts: views that answer business questions",
}


@dataclass(frozen=True)
class Warehouse:
    """Where the layers live: releases below one folder, and a database of views per layer.

    ``root`` must be a folder every executor can reach; without it the releases lie in the
    catalog's own warehouse folder. With ``catalog`` off there are no databases, and tables are read through
    releases only.
    """

    spark: SparkSession
    prefix: str = ""
    root: str | None = None
    catalog: bool = True

    @property
    def store(self) -> Store:
        root = self.root if self.root is not None else self.spark.conf.get("spark.sql.warehouse.dir")
        return Store(self.spark, f"{root.rstrip('/')}/{self.prefix}releases")

    def database(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def name(self, layer: str, table: str) -> str:
        return f"{self.database(layer)}.{table}"

    def create_layers(self) -> None:
        for layer, comment in LAYERS.items() if self.catalog else ():
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {self.database(layer)} COMMENT '{comment}'")

    def drop_layers(self) -> None:
        """Drop the databases and their views; releases stay."""
        for layer in LAYERS if self.catalog else ():
            self.spark.sql(f"DROP DATABASE IF EXISTS {self.database(layer)} CASCADE")

    def describe_layers(self) -> list[tuple[str, str | None, int]]:
        """What the catalog says of each layer that exists: (layer, description, relations)."""
        found = {d.name: d.description for d in self.spark.catalog.listDatabases()}
        return [
            (layer, found[self.database(layer)], sum(not t.isTemporary for t in self.spark.catalog.listTables(self.database(layer))))
            for layer in LAYERS
            if self.database(layer) in found
        ]

    def begin(self) -> Draft:
        """A build that nobody sees before it is published."""
        return self.store.begin()

    def release(self, number: int | None = None) -> Release:
        """The current release, or an earlier one; pins the files that its scans read."""
        return self.store.release(number)

    def publish(self, draft: Draft, views: Iterable[tuple[str, str]] = ()) -> Release:
        """Move the pointer to the draft's tables, then let the catalog's views follow.

        The pointer is one step. Catalogs replace views one by one, so each view names files itself and
        never another view: even while they follow, each shows one release. ``views`` are further ones, of the
        mart layer. If a publish dies on the way, the next one sets all views.
        """
        release = draft.publish()
        if self.catalog:
            self.create_layers()
            texts = [(self.name(*name.split(".", 1)), v.as_sql(self.spark)) for name, v in release.versions.items()]
            texts += [(self.name("mart", view), text) for view, text in views]
            for name, text in texts:
                self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS {text}")
        return release

    def replace(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: str | None = None,
        cluster_by: Sequence[str] = (),
        grain: Sequence[str] = (),
        interleave: bool = False,
    ) -> DataFrame:
        """Replace one table in a release of its own and return a scan of it; readers of the old rows keep them."""
        draft = self.begin()
        draft.replace(layer, table, df, partition_by, cluster_by, grain, interleave)
        return self.publish(draft).table(layer, table)

    def table(self, layer: str, table: str) -> DataFrame:
        """The current rows, by the catalog's name; without a catalog those of the current release."""
        return self.spark.table(self.name(layer, table)) if self.catalog else self.release().table(layer, table)

    def expire(self, older_than: dt.timedelta, keep: int = 1) -> list[str]:
        """Drop releases and files of that age, but the last ``keep`` releases."""
        return self.store.expire(older_than, keep)
