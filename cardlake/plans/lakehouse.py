"""The sample tables taken through bronze, silver and gold, once per Spark application.

Reports read stored gold tables, as they do in production: the joins and keys are
computed once and not again for each report. A layer is built when the first report asks
for it, so a report on bronze or silver does not wait for gold. The tables are derived by Spark from the
given tables and live in the shared folder.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timezone
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from cardlake.operators import gold, ingest, serving, silver
from cardlake.session import small_scans, small_shuffles, staging_path
from cardlake.sources import orders_adapter, sample_landing, tables

SAMPLE_PROCESSED_AT = datetime(2026, 1, 2, tzinfo=timezone.utc)


@dataclass
class Lakehouse:
    """The stored layers, each built at first use and listed once, then reused."""

    spark: SparkSession
    folder: str
    sf_dir: str

    def sized(self):
        """Shuffles and scans to suit the sample tables, for the jobs inside."""
        return small_shuffles(self.spark, tables.stored_bytes(self.spark, self.sf_dir))

    @cached_property
    def bronze(self) -> DataFrame:
        path = f"{self.folder}/bronze"
        with self.sized():
            tables.overwrite(orders_adapter.bronze_transactions(self.spark, self.sf_dir), path)
        return self.spark.read.parquet(path)

    @cached_property
    def silver_path(self) -> str:
        path, stamp = f"{self.folder}/silver", F.lit(SAMPLE_PROCESSED_AT)
        bronze = self.bronze
        with self.sized():
            silver.write_silver(silver.clean_transactions(bronze, stamp), path)
        return path

    @property
    def root(self) -> str:
        """The folder, with bronze and silver in it."""
        return self.silver_path.removesuffix("/silver")

    @cached_property
    def silver(self) -> DataFrame:
        return silver.read_silver(self.spark, self.silver_path)

    @cached_property
    def quarantine(self) -> DataFrame:
        return silver.read_quarantine(self.spark, self.silver_path)

    @cached_property
    def gold_paths(self) -> tuple[str, str, str]:
        paths = tuple(f"{self.folder}/{name}" for name in ("dim_merchant", "dim_date", "fact_transaction"))
        positioned = silver.read_positioned(self.spark, self.silver_path)
        with self.sized():
            gold.write_gold(positioned, *paths)
        return paths

    @cached_property
    def merchants(self) -> DataFrame:
        return self.spark.read.parquet(self.gold_paths[0])

    @cached_property
    def dates(self) -> DataFrame:
        return self.spark.read.parquet(self.gold_paths[1])

    @cached_property
    def fact(self) -> DataFrame:
        return gold.read_fact(self.spark, self.gold_paths[2])

    @cached_property
    def controls(self) -> DataFrame:
        """The controls kept with the gold fact."""
        with self.sized():
            return gold.write_controls(self.spark, *self.gold_paths)

    @cached_property
    def serving(self) -> dict[str, DataFrame]:
        """The reporting tables, derived from gold by projection only."""
        return serving.serving_frames(self.merchants, self.dates, self.fact)

    @cached_property
    def _landing(self) -> dict[str, str]:
        return {}

    def landing(self, name: str) -> str:
        """Folder with the landing CSV files of one domain, written at first use."""
        if name not in self._landing:
            path = f"{staging_path(self.spark, 'landing')}/{name}"
            if name == "transactions":
                rows = sample_landing.transactions(self.bronze)
            else:
                rows = {"cards": sample_landing.cards, "users": sample_landing.users}[name](self.spark, self.sf_dir)
            with small_scans(self.spark):
                sample_landing.write(rows, path)
            self._landing[name] = path
        return self._landing[name]

    def domain_paths(self, *names: str) -> dict[str, ingest.DomainPaths]:
        """Bronze and ledger locations nobody has used yet, for a first ingest."""
        folder = staging_path(self.spark, "ingest")
        return {
            name: ingest.DomainPaths(
                self.landing(name), f"{folder}/{name}", f"{folder}/{name}_ledger"
            )
            for name in names
        }


_BUILT: dict[tuple[str, str], Lakehouse] = {}


def build_sample(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """Store bronze, silver, gold and its controls for the sample tables in a fresh folder."""
    house = _unbuilt(spark, sf_dir)
    house.controls
    return house


def _unbuilt(spark: SparkSession, sf_dir: str) -> Lakehouse:
    return Lakehouse(spark, staging_path(spark, "lakehouse"), sf_dir)


def lakehouse(spark: SparkSession, sf_dir: str) -> Lakehouse:
    """The stored layers of ``sf_dir``, one set for this application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _BUILT:
        _BUILT[key] = _unbuilt(spark, sf_dir)
    return _BUILT[key]
