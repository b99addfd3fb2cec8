"""The metric tables of one folder of order tables, each stored once per application.

This is the layering of the pipeline (fact, then metric tables, then views) without a catalog:
tables that many queries start from are written to the shared folder when first needed.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import complexity, metrics, reports, views
from ..sources.shared import bounded_splits, stored
from . import sample

T = TypeVar("T")

INPUTS = ["lineitem", "orders", "customer", "supplier", "part"]


class Workbench:
    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.folder = folder
        self._tables: dict[str, DataFrame] = {}
        self._made: dict[str, object] = {}
        self._lock = threading.RLock()

    def _stored(
        self, name: str, make: Callable[[], DataFrame], *, partition_by: str | None = None
    ) -> DataFrame:
        with self._lock:
            if name not in self._tables:
                self._tables[name] = stored(make(), name, partition_by=partition_by)
            return self._tables[name]

    def once(self, name: str, make: Callable[[], T]) -> T:
        """The result of ``make``, called once for this folder."""
        with self._lock:
            if name not in self._made:
                self._made[name] = make()
            return self._made[name]

    @property
    def fact(self) -> DataFrame:
        return self._stored(
            "fact",
            lambda: sample.fact_table(self.spark, self.folder, by_year=True),
            partition_by="year",
        )

    @property
    def raw(self) -> tuple[DataFrame, DataFrame]:
        return sample.raw_tables(self.fact)

    @property
    def by_product(self) -> DataFrame:
        return self._stored("by_product", lambda: metrics.country_product_year(self.fact))

    @property
    def by_partner(self) -> DataFrame:
        return self._stored("by_partner", lambda: metrics.country_partner_year(self.fact))

    @property
    def country_year(self) -> DataFrame:
        return self._stored("country_year", self.new_country_year)

    def new_country_year(self) -> DataFrame:
        return metrics.country_year_metrics(
            self.fact, by_product=self.by_product, by_partner=self.by_partner
        )

    @property
    def product_year(self) -> DataFrame:
        return self._stored("product_year", self.new_product_year)

    def new_product_year(self) -> DataFrame:
        return metrics.product_year_metrics(self.fact, by_product=self.by_product)

    @property
    def flows(self) -> DataFrame:
        return metrics.bilateral_flows(self.fact)

    @property
    def country_totals(self) -> DataFrame:
        """Exports are never negative, so the total over positive rows is that over all."""
        return self.country_year.withColumnRenamed("total_exports", "country_total")

    @property
    def specialization(self) -> DataFrame:
        """Not stored: it has the size of the fact, and its joins are with small stored tables."""
        return metrics.export_specialization(
            self.fact,
            country_totals=self.country_totals,
            product_totals=self.product_year.withColumnRenamed(
                "global_export_value", "product_total"
            ),
        )

    @property
    def dynamics(self) -> DataFrame:
        return metrics.complexity_dynamics(self.country_year)

    @property
    def complexity(self) -> DataFrame:
        return self._stored(
            "complexity", lambda: complexity.product_complexity(self.product_year)
        )

    @property
    def portfolio(self) -> DataFrame:
        return self._stored("portfolio", self.new_portfolio)

    def new_portfolio(self, **options) -> DataFrame:
        products = metrics.positive_exports(self.by_product).select(
            "country_id", "product_id", "year", "export_value"
        )
        return complexity.export_portfolio(
            metrics.positive_exports(self.fact),
            self.complexity,
            products=metrics.with_country_share(products, self.country_totals),
            all_products_known=True,
            **options,
        )

    @property
    def diversification(self) -> DataFrame:
        return self._stored("diversification", self.new_diversification)

    def new_diversification(self) -> DataFrame:
        return metrics.partner_diversification(metrics.partner_flows(self.by_partner))

    @property
    def growth(self) -> DataFrame:
        return self._stored("growth", self.new_growth)

    def new_growth(self, **options) -> DataFrame:
        return complexity.coi_growth_analysis(
            self.country_year,
            metrics.positive_exports(self.fact),
            self.product_year,
            totals=metrics.stored_export_totals(self.by_product),
            **options,
        )

    @property
    def tier_trade(self) -> DataFrame:
        return self._stored(
            "tier_trade", lambda: reports.tier_year_trade(self.by_product, self.complexity)
        )

    @property
    def global_yearly(self) -> DataFrame:
        return views.v_global_yearly_metrics(self.country_year)

    @property
    def trends(self) -> DataFrame:
        return views.v_eci_balance_trends(self.dynamics)

    @property
    def portfolio_view(self) -> DataFrame:
        return views.v_export_complexity_portfolio(self.portfolio, self.dynamics)

    @property
    def diversification_view(self) -> DataFrame:
        return views.v_diversification_complexity(self.diversification, self.dynamics)

    @property
    def predictive(self) -> DataFrame:
        return views.v_coi_predictive_power(self.growth)

    @property
    def evolution(self) -> DataFrame:
        return views.v_portfolio_evolution(self.portfolio, self.dynamics)

    @property
    def global_trade(self) -> DataFrame:
        return reports.v_global_trade_metrics(self.global_yearly)

    @property
    def products(self) -> DataFrame:
        return reports.v_top_traded_products(self.complexity)

    @property
    def partners(self) -> DataFrame:
        return reports.v_top_trading_partners(self.by_partner)

    @property
    def annual(self) -> DataFrame:
        return reports.mv_country_annual_trade(self.country_year)

    @property
    def correlation(self) -> DataFrame:
        return reports.v_eci_trade_balance_correlation(self.country_year, self.tier_trade)

    @property
    def segments(self) -> DataFrame:
        return reports.v_product_complexity_balance_trends(self.tier_trade)

    @property
    def leaders(self) -> DataFrame:
        return self._stored("leaders", self.new_leaders)

    def new_leaders(self) -> DataFrame:
        return reports.v_product_complexity_leaders(
            self.by_product,
            self.complexity,
            sample.product_categories(self.spark, self.folder),
            self.tier_trade,
        )


_benches: dict[tuple, Workbench] = {}
_benches_lock = threading.Lock()


def input_state(spark: SparkSession, folder: str) -> tuple:
    """Number, size and newest change of the input files, from their listing alone."""
    row = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load([f"{folder}/{name}.parquet" for name in INPUTS])
        .agg(F.count(F.lit(1)), F.sum("length"), F.max("modificationTime"))
        .first()
    )
    return tuple(row)


def workbench(spark: SparkSession, folder: str) -> Workbench:
    """The workbench of ``folder``; a new one when its files have changed."""
    state = input_state(spark, folder)
    bounded_splits(spark, state[1])
    key = (spark.sparkContext.applicationId, folder, *state)
    with _benches_lock:
        if key not in _benches:
            _benches[key] = Workbench(spark, folder)
        return _benches[key]
