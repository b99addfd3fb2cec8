"""The pipeline: source tables to fact table, metric tables and views, in dependency order."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import complexity, hierarchy, ingest, metrics, views
from ..sources import snapshots, tables
from ..sources.shared import discard, scope

COMBINED = "combined_trade_data"
METRICS = [
    "country_year_metrics",
    "product_year_metrics",
    "bilateral_flows",
    "export_specialization",
    "complexity_dynamics",
    "product_complexity",
    "export_portfolio",
    "partner_diversification",
    "coi_growth_analysis",
]


@dataclass(frozen=True)
class Added:
    """Rows that a merge has appended to the fact, and the files of each year before that."""

    rows: DataFrame
    before: dict[int, str]


def build_combined(
    spark: SparkSession,
    database: str,
    *,
    null_safe: bool = False,
    level: str | None = None,
    levels: Sequence[int] | None = None,
) -> DataFrame:
    """Create the fact table from all source tables, or merge them into it when it has rows.

    Of a source table that has not changed since it was merged, the keys are in the fact, so none of its rows
    would be added but those that match nothing (NULL in the key, without ``null_safe``): only these are merged.
    With ``levels``, source tables of these numbers of digits are reconciled; since a finer row
    changes what remains of a coarser one, the fact is then written anew each time.
    """
    added = _combine(spark, database, null_safe, level, levels)
    if added:
        discard(added.rows)
    return tables.fact_in(spark, f"{database}.{COMBINED}")


def _combine(
    spark: SparkSession,
    database: str,
    null_safe: bool,
    level: str | None,
    levels: Sequence[int] | None = None,
) -> Added | None:
    target = f"{database}.{COMBINED}"
    if levels:
        with scope(spark):
            tables.write_fact_table(_reconciled(spark, database, levels), target)
        return None
    names = tables.source_tables(spark, database, level=level)
    sources = [spark.table(f"{database}.{name}") for name in names]
    # A year without rows has no files.
    before = tables.files_by_year(spark, target) if spark.catalog.tableExists(target) else {}
    states = {name: tables.table_state(spark, f"{database}.{name}") for name in names}
    if not before:
        tables.write_fact_table(ingest.combined_trade_data(sources), target)
        _remember(spark, database, states)
        return None
    merged = _merged(spark, database, before)
    unchanged = [n for n, name in enumerate(names) if states[name] and merged.get(name) == states[name]]
    sources = [
        ingest.unkeyed_rows(rows, null_safe=null_safe) if n in unchanged else rows for n, rows in enumerate(sources)
    ]
    # With NULL as a value of the key nothing is left of an unchanged source.
    empty = unchanged if null_safe else ()
    added = Added(tables.append_new(spark, target, *sources, null_safe=null_safe, empty=empty), before)
    _remember(spark, database, merged | states)
    return added


#: The source tables that the fact has been merged from, each with its state and the fact's files after that.
MERGED = "merged_sources"


def _remember(spark: SparkSession, database: str, states: dict[str, str | None]) -> None:
    """Written after the rows, so that a merge that was broken off is repeated."""
    fact = _digest(tables.files_by_year(spark, f"{database}.{COMBINED}"))
    rows = sorted((name, state, fact) for name, state in states.items() if state)
    columns = ("source", "state", "fact")
    listed = pa.table({c: pa.array([r[n] for r in rows], pa.string()) for n, c in enumerate(columns)})
    tables.overwrite_table(spark.createDataFrame(listed), f"{database}.{MERGED}")


def _merged(spark: SparkSession, database: str, files: dict[int, str]) -> dict[str, str]:
    """States of source tables all of whose keys are in the fact; none when anything else has changed the fact."""
    table = f"{database}.{MERGED}"
    if not spark.catalog.tableExists(table):
        return {}
    fact = _digest(files)
    return {r["source"]: r["state"] for r in spark.table(table).collect() if r["fact"] == fact}


def _digest(files: dict[int, str]) -> str:
    return hashlib.md5(repr(sorted(files.items())).encode()).hexdigest()


def _reconciled(spark: SparkSession, database: str, levels: Sequence[int]) -> DataFrame:
    cleaned = {}
    for digits in levels:
        names = tables.source_tables(spark, database, level=str(digits))
        cleaned[digits] = ingest.combined_trade_data([spark.table(f"{database}.{n}") for n in names])
    return hierarchy.as_finest(hierarchy.reconciled(cleaned), max(levels))


#: Totals of the fact that metric tables start from, and the fact files that they were made from.
BY_PRODUCT, BY_PARTNER, FILES = "totals_by_product", "totals_by_partner", "fact_files"


def build_metrics(
    spark: SparkSession, database: str, added: Added | None = None
) -> dict[str, DataFrame]:
    """Bring the metric tables up to date with the fact table and define the views over them.

    Only years whose files of the fact have changed since the last build are computed again, and
    growth also where the next year has. The totals that the metrics start from are sums and maxima,
    so rows that a merge has just appended (``added``) are added to those of their years, unless
    something else has changed these since the last build. A database without totals is built as a
    whole. What is stored on the way is removed.
    """
    with scope(spark):
        return _Build(spark, database).run(added)


class _Build:
    """Tables of one database.

    A table is read back before the next step uses it, so that joins are planned from its size.
    """

    def __init__(self, spark: SparkSession, database: str) -> None:
        self.spark, self.database = spark, database
        #: Years to compute; None for all.
        self.years: list[int] | None = None

    def name(self, table: str) -> str:
        return f"{self.database}.{table}"

    def of_years(self, rows: DataFrame, years: list[int] | None = None) -> DataFrame:
        """Rows of the years to compute, or of ``years``; all tables are partitioned by year."""
        chosen = years if years is not None else self.years
        return rows if chosen is None else rows.filter(F.col("year").isin(chosen))

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(self.name(table))

    def table(self, table: str) -> DataFrame:
        return self.spark.table(self.name(table))

    def overwrite(self, table: str, df: DataFrame) -> DataFrame:
        return tables.overwrite_table(df, self.name(table))

    def keep(
        self, table: str, df: DataFrame, column: str = "year", values: list[int] | None = None
    ) -> DataFrame:
        """A table by year, of which only the years to compute are replaced."""
        if self.years is None:
            return tables.overwrite_table(df, self.name(table), partition_by=column)
        values = self.years if values is None else values
        return tables.replace_partitions(df, self.name(table), column, values)

    def define_views(self) -> None:
        for view, sql in views.catalog_views(self.database).items():
            tables.replace_database_view(self.spark, self.name(view), sql)

    def run(self, added: Added | None) -> dict[str, DataFrame]:
        spark = self.spark
        fact = tables.fact_in(spark, self.name(COMBINED))
        files = tables.files_by_year(spark, self.name(COMBINED))
        simple = self._changed_years(files, added)
        if self.years == []:
            return self._all_tables()
        recent = self.of_years(fact)

        by_product = self._totals(
            BY_PRODUCT, fact, added, simple, metrics.product_totals_of_rows, metrics.added_product_totals
        )
        by_partner = self._totals(
            BY_PARTNER, fact, added, simple, metrics.partner_totals_of_rows, metrics.country_partner_year
        )
        new_product, new_partner = self.of_years(by_product), self.of_years(by_partner)
        country_year = self.keep(
            "country_year_metrics",
            metrics.country_year_metrics(recent, by_product=new_product, by_partner=new_partner),
        )
        product_year = self.keep(
            "product_year_metrics", metrics.product_year_metrics(recent, by_product=new_product)
        )
        self.keep("bilateral_flows", metrics.bilateral_flows(recent))
        # Exports are never negative, so the totals over positive rows are those of the metric tables.
        country_totals = self.of_years(country_year).withColumnRenamed("total_exports", "country_total")
        new_products = self.of_years(product_year)
        self.keep(
            "export_specialization",
            metrics.export_specialization(
                recent,
                country_totals=country_totals,
                product_totals=new_products.withColumnRenamed("global_export_value", "product_total"),
            ),
        )
        # One row per country and year, each of which looks at the year before.
        self.overwrite("complexity_dynamics", metrics.complexity_dynamics(country_year))
        tiers = self.keep("product_complexity", complexity.product_complexity(new_products))
        self.keep(
            "export_portfolio",
            complexity.export_portfolio(
                metrics.positive_exports(recent),
                self.of_years(tiers),
                products=metrics.with_country_share(
                    metrics.positive_exports(new_product), country_totals
                ),
                all_products_known=True,
            ),
        )
        self.keep(
            "partner_diversification",
            metrics.partner_diversification(metrics.partner_flows(new_partner)),
        )
        self._growth(fact, country_year, product_year, by_product)
        self.overwrite("v_global_yearly_metrics", views.v_global_yearly_metrics(country_year))
        self.define_views()
        # Last, so that a build that was broken off is repeated.
        years, digests = zip(*sorted(files.items())) if files else ((), ())
        listed = pa.table({"year": pa.array(years, pa.int32()), "digest": pa.array(digests, pa.string())})
        # From Arrow it is a relation of the plan, which starts no Python workers.
        self.overwrite(FILES, spark.createDataFrame(listed))
        return self._all_tables()

    def _changed_years(self, files: dict[int, str], added: Added | None) -> list[int]:
        """Sets the years to compute; returns those of them that only ``added`` has changed."""
        needed = (*METRICS, BY_PRODUCT, BY_PARTNER, FILES)
        if not all(self.exists(table) for table in needed):
            return []
        known = {r["year"]: r["digest"] for r in self.table(FILES).collect()}
        changed = {y for y in files.keys() | known.keys() if files.get(y) != known.get(y)}
        self.years = sorted(changed)
        if added is None:
            return []
        of_added = {r["year"] for r in added.rows.select("year").distinct().collect()}
        return sorted(y for y in of_added & changed if added.before.get(y) == known.get(y))

    def _totals(
        self,
        table: str,
        fact: DataFrame,
        added: Added | None,
        simple: list[int],
        of_rows: Callable[[DataFrame], DataFrame],
        add_up: Callable[[DataFrame], DataFrame],
    ) -> DataFrame:
        """Totals of the years to compute; old totals, added rows and the fact's rows meet in one shuffle."""
        if self.years is None:
            return self.keep(table, add_up(of_rows(fact)))
        other = [y for y in self.years if y not in simple]
        parts = []
        if simple:
            new = of_rows(self.of_years(added.rows, simple))
            parts += [self.of_years(self.table(table), simple).select(new.columns), new]
        if other:
            parts.append(of_rows(self.of_years(fact, other)))
        return self.keep(table, add_up(reduce(DataFrame.unionByName, parts)))

    def _growth(
        self,
        fact: DataFrame,
        country_year: DataFrame,
        product_year: DataFrame,
        by_product: DataFrame,
    ) -> None:
        """Growth of the base years that have changed themselves or whose next year has."""
        bases = targets = replaced = None
        if self.years is not None:
            every = sorted(r["year"] for r in country_year.select("year").distinct().collect())
            steps = [(a, b) for a, b in zip(every, every[1:]) if a in self.years or b in self.years]
            bases, targets = [a for a, _ in steps], [b for _, b in steps]
            replaced = sorted({*bases, *self.years})
        rows = by_product if bases is None else self.of_years(by_product, sorted({*bases, *targets}))
        growth = complexity.coi_growth_analysis(
            country_year,
            metrics.positive_exports(self.of_years(fact, bases)),
            self.of_years(product_year, bases),
            totals=metrics.stored_export_totals(rows),
        )
        if bases is not None:
            growth = growth.filter(F.col("base_year").isin(bases))
        self.keep("coi_growth_analysis", growth, "base_year", replaced)

    def _all_tables(self) -> dict[str, DataFrame]:
        names = [*METRICS, "v_global_yearly_metrics", *views.catalog_views(self.database)]
        return {name: self.spark.table(self.name(name)) for name in names}


class _Publication(_Build):
    """Metric tables in a draft of the next version instead of the catalog."""

    def __init__(self, spark: SparkSession, database: str, draft: snapshots.Draft) -> None:
        super().__init__(spark, database)
        self.draft = draft

    def exists(self, table: str) -> bool:
        return table in self.draft

    def table(self, table: str) -> DataFrame:
        return self.draft.read(table)

    def overwrite(self, table: str, df: DataFrame) -> DataFrame:
        return self.draft.put(table, df)

    def keep(
        self, table: str, df: DataFrame, column: str = "year", values: list[int] | None = None
    ) -> DataFrame:
        return self.draft.put(table, df, column, self.years if values is None else values)

    def define_views(self) -> None:
        """Views are defined over the version that is read."""

    def _all_tables(self) -> dict[str, DataFrame]:
        return {}


def publish_metrics(
    spark: SparkSession, database: str, root: str, added: Added | None = None
) -> int:
    """``build_metrics`` into a new version of the tables in the folder ``root``; its number.

    Readers of ``published`` see all tables of the version before until the last one is written, and
    go on seeing it when the build breaks off. Without a change of the fact no version is made.
    """
    draft = snapshots.Draft(spark, root)
    with scope(spark):
        build = _Publication(spark, database, draft)
        build.run(added)
    return draft.base.number if build.years == [] else draft.commit()


def published(
    spark: SparkSession, root: str, number: int | None = None
) -> dict[str, DataFrame]:
    """Metric tables and views of the newest published version, or of the one asked for, by name."""
    version = snapshots.current(spark, root, number).number
    found = {
        name: snapshots.read(spark, root, name, version)
        for name in [*METRICS, "v_global_yearly_metrics"]
    }
    dynamics, portfolio = found["complexity_dynamics"], found["export_portfolio"]
    return found | {
        "v_eci_balance_trends": views.v_eci_balance_trends(dynamics),
        "v_export_complexity_portfolio": views.v_export_complexity_portfolio(portfolio, dynamics),
        "v_diversification_complexity": views.v_diversification_complexity(
            found["partner_diversification"], dynamics
        ),
        "v_coi_predictive_power": views.v_coi_predictive_power(found["coi_growth_analysis"]),
        "v_portfolio_evolution": views.v_portfolio_evolution(portfolio, dynamics),
    }


def build_all(
    spark: SparkSession,
    database: str,
    *,
    null_safe: bool = False,
    level: str | None = None,
    levels: Sequence[int] | None = None,
) -> dict[str, DataFrame]:
    """Fact table, metric tables and views of ``database``, by name; see ``build_combined``."""
    added = _combine(spark, database, null_safe, level, levels)
    built = build_metrics(spark, database, added)
    if added:
        discard(added.rows)
    return {COMBINED: tables.fact_in(spark, f"{database}.{COMBINED}"), **built}
