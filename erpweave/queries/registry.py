"""Registration of queries and lazy access to the tables they read."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from erpweave import crosswalk
from erpweave.plans import domain
from erpweave.plans.silver import silver_table
from erpweave.sources.tables import read_table


@dataclass(frozen=True)
class Tables:
    """Source, raw ERP-shaped, typed and modelled tables over one folder."""

    spark: SparkSession
    folder: str
    # Frames by name: a table is listed and its schema read once per query.
    _frames: dict[str, DataFrame] = field(default_factory=dict, repr=False, compare=False)

    def source(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = read_table(self.spark, f"{self.folder}/{name}.parquet")
        return self._frames[name]

    def raw(self, name: str) -> DataFrame:
        key = f"raw.{name}"
        if key not in self._frames:
            self._frames[key] = crosswalk.shape(self.source(crosswalk.BRONZE[name][0]), name)
        return self._frames[key]

    def raw_stream(self, name: str) -> DataFrame:
        """The rows of ``raw(name)`` as a stream over the source's files."""
        source = crosswalk.BRONZE[name][0]
        # As a pattern: a stream takes a plain path for a folder, and a table may be a single file.
        rows = self.spark.readStream.schema(self.source(source).schema).parquet(f"{self.folder}/{source}.parque[t]")
        return crosswalk.shape(rows, name)

    def silver(self, name: str) -> DataFrame:
        return silver_table(self.raw(name), name)

    def dim_customer(self) -> DataFrame:
        return domain.dim_customer(self.silver("kna1"))

    def dim_vendor(self) -> DataFrame:
        return domain.dim_vendor(self.silver("lfa1"))

    def fact_sales_order(self) -> DataFrame:
        return domain.fact_sales_order(self.silver("vbap"), self.silver("vbak"))

    def fact_billing(self) -> DataFrame:
        return domain.fact_billing(self.silver("vbrp"), self.silver("vbrk"))

    def fact_delivery(self) -> DataFrame:
        return domain.fact_delivery(self.silver("lips"), self.silver("likp"))

    def fact_purchase_order(self) -> DataFrame:
        return domain.fact_purchase_order(self.silver("ekpo"), self.silver("ekko"), self.silver("ekbe"))

    def fact_fiscal_note(self) -> DataFrame:
        return domain.fact_fiscal_note(
            self.silver("j_1bnfdoc"), self.silver("j_1bnflin"), self.silver("j_1bnfstx")
        )


@dataclass(frozen=True)
class Query:
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}

FAMILIES = ("scalars", "quality", "joining", "grouping", "models", "documented", "upkeep", "files", "generated")


def query(name: str, sql: str | None = None):
    """Register a function of ``Tables`` under a name, with its SQL twin if there is one."""

    def register(build: Callable[[Tables], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name!r} registered twice")
        REGISTRY[name] = Query(build, sql)
        return build

    return register


def load_all() -> dict[str, Query]:
    for family in FAMILIES:
        importlib.import_module(f"erpweave.queries.{family}")
    return REGISTRY
