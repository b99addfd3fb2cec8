"""The same results in plain SQL for DuckDB, written the direct way: self-joins and windows."""

from __future__ import annotations

import re

# Relations that the queries below build on, each in terms of earlier ones and the order tables.
RELATIONS = {
    "flow": """
        SELECT CAST(s_nationkey AS BIGINT) AS src,
               CASE WHEN c_nationkey = 24 THEN NULL ELSE CAST(c_nationkey AS BIGINT) END AS dst,
               l_partkey AS product_id,
               CAST(year(o_orderdate) + 21 AS BIGINT) AS yr,
               CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)
                        * (100 - CAST(round(l_discount * 100) AS BIGINT))
                        * CASE WHEN c_nationkey % (1 + s_nationkey) = 0 THEN 20 ELSE 1 END)
                    AS BIGINT) AS v
        FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey
        JOIN supplier ON l_suppkey = s_suppkey
        WHERE s_nationkey <> c_nationkey
        GROUP BY 1, 2, 3, 4""",
    "fact": """
        SELECT country_id, partner_country_id, product_id, year,
               CAST(sum(e) AS DOUBLE) AS export_value, CAST(sum(i) AS DOUBLE) AS import_value,
               ((country_id * 37 + year * 11) % 101 - 50) / 32e0 AS eci,
               ((country_id * 53 + year * 29) % 103 - 51) / 32e0 AS coi,
               ((product_id * 7 + year * 3) % 97 - 40) / 32e0 AS pci
        FROM (SELECT src AS country_id, dst AS partner_country_id, product_id, yr AS year,
                     v AS e, 0 AS i FROM flow
              UNION ALL
              SELECT dst, src, product_id, yr, 0, v FROM flow WHERE dst IS NOT NULL)
        GROUP BY country_id, partner_country_id, product_id, year""",
    "dirty": """
        SELECT country_id, partner_country_id, product_id,
               CASE WHEN product_id % 83 = 0 THEN 2011 ELSE year END AS year,
               CASE WHEN (country_id + product_id) % 97 = 0 THEN NULL
                    WHEN (country_id + product_id) % 89 = 0 THEN -export_value - 1
                    ELSE export_value END AS export_value,
               import_value, eci, coi, pci, year AS original_year
        FROM fact""",
    "raw_a": "SELECT * EXCLUDE (original_year) FROM dirty WHERE original_year <= 2019",
    "raw_b": "SELECT * EXCLUDE (original_year) FROM dirty WHERE original_year >= 2019",
    "clean_a": """
        SELECT DISTINCT * FROM raw_a
        WHERE year >= 2012 AND export_value >= 0 AND import_value >= 0""",
    "clean_b": """
        SELECT DISTINCT * FROM raw_b
        WHERE year >= 2012 AND export_value >= 0 AND import_value >= 0""",
    "combined": "SELECT * FROM clean_a UNION SELECT * FROM clean_b",
    "early_a": "SELECT * FROM clean_a WHERE year < 2018",
    "coded": """
        SELECT country_id, partner_country_id,
               (product_id % 20 + 1) * 10000 + product_id // 20 % 10 * 100 + product_id // 200 % 100
                   AS product_id,
               year, sum(export_value) AS export_value, sum(import_value) AS import_value,
               max(eci) AS eci, max(coi) AS coi, max(pci) AS pci
        FROM fact GROUP BY ALL""",
    "six": "SELECT * FROM coded WHERE (country_id + product_id) % 3 <> 0",
    "four": """
        SELECT country_id, partner_country_id, product_id, year,
               CASE WHEN (product_id + year) % 5 = 0 THEN floor(export_value / 2)
                    ELSE export_value END AS export_value,
               CASE WHEN (product_id + year) % 5 = 0 THEN floor(import_value / 2)
                    ELSE import_value END AS import_value, eci, coi, pci
        FROM (SELECT country_id, partner_country_id, product_id // 100 AS product_id, year,
                     sum(export_value) AS export_value, sum(import_value) AS import_value,
                     max(eci) AS eci, max(coi) AS coi, max(pci) AS pci FROM coded GROUP BY ALL)
        WHERE (country_id + product_id) % 2 = 0""",
    "two": """
        SELECT country_id, partner_country_id, product_id // 10000 AS product_id, year,
               sum(export_value) AS export_value, sum(import_value) AS import_value,
               max(eci) AS eci, max(coi) AS coi, max(pci) AS pci FROM coded GROUP BY ALL""",
    "four_compared": """
        SELECT r.*, f.e, f.i FROM four r LEFT JOIN (
            SELECT country_id, partner_country_id, product_id // 100 AS product_id, year,
                   sum(export_value) AS e, sum(import_value) AS i FROM six GROUP BY ALL) f
        ON r.country_id = f.country_id AND r.product_id = f.product_id AND r.year = f.year
           AND r.partner_country_id IS NOT DISTINCT FROM f.partner_country_id""",
    "four_rest": """
        SELECT * EXCLUDE (e, i) REPLACE (
            greatest(export_value - coalesce(e, 0), 0) AS export_value,
            greatest(import_value - coalesce(i, 0), 0) AS import_value)
        FROM four_compared WHERE e IS NULL OR e < export_value OR i < import_value""",
    "two_compared": """
        SELECT r.*, f.e, f.i FROM two r LEFT JOIN (
            SELECT country_id, partner_country_id, product_id, year,
                   sum(export_value) AS e, sum(import_value) AS i
            FROM (SELECT * REPLACE (product_id // 10000 AS product_id) FROM six UNION ALL
                  SELECT * REPLACE (product_id // 100 AS product_id) FROM four_rest)
            GROUP BY ALL) f
        ON r.country_id = f.country_id AND r.product_id = f.product_id AND r.year = f.year
           AND r.partner_country_id IS NOT DISTINCT FROM f.partner_country_id""",
    "two_rest": """
        SELECT * EXCLUDE (e, i) REPLACE (
            greatest(export_value - coalesce(e, 0), 0) AS export_value,
            greatest(import_value - coalesce(i, 0), 0) AS import_value)
        FROM two_compared WHERE e IS NULL OR e < export_value OR i < import_value""",
    "levels": """
        SELECT *, 6 AS level FROM six UNION ALL SELECT *, 4 FROM four_rest
        UNION ALL SELECT *, 2 FROM two_rest""",
    "two_so_far": """
        SELECT * FROM early_a UNION ALL
        SELECT * FROM clean_b s WHERE NOT EXISTS (
            SELECT 1 FROM early_a t
            WHERE t.country_id = s.country_id AND t.partner_country_id = s.partner_country_id
              AND t.product_id = s.product_id AND t.year = s.year)""",
    "two_null_safe": """
        SELECT * FROM early_a UNION ALL
        SELECT * FROM clean_b s WHERE NOT EXISTS (
            SELECT 1 FROM early_a t
            WHERE t.country_id IS NOT DISTINCT FROM s.country_id
              AND t.partner_country_id IS NOT DISTINCT FROM s.partner_country_id
              AND t.product_id IS NOT DISTINCT FROM s.product_id
              AND t.year IS NOT DISTINCT FROM s.year)""",
    "country_year": """
        SELECT country_id, year, max(eci) AS eci, max(coi) AS coi,
               sum(export_value) AS total_exports, sum(import_value) AS total_imports,
               sum(export_value - import_value) AS trade_balance,
               count(DISTINCT product_id) AS product_count,
               count(DISTINCT partner_country_id) AS partner_count
        FROM fact GROUP BY country_id, year""",
    "product_year": """
        SELECT product_id, year, avg(pci) AS avg_pci, sum(export_value) AS global_export_value,
               count(DISTINCT country_id) AS exporting_countries
        FROM fact GROUP BY product_id, year""",
    "flows": """
        SELECT country_id AS exporter_id, partner_country_id AS importer_id, product_id, year,
               export_value, pci
        FROM fact WHERE partner_country_id IS NOT NULL AND export_value > 0""",
    "specialization": """
        SELECT country_id, product_id, year, export_value, pci,
               export_value / sum(export_value) OVER (PARTITION BY country_id, year)
                   AS export_share,
               export_value / sum(export_value) OVER (PARTITION BY product_id, year)
                   AS global_market_share
        FROM fact WHERE export_value > 0""",
    "lagged": """
        SELECT *, lag(eci) OVER by_country AS prev_eci, lag(coi) OVER by_country AS prev_coi,
               lag(trade_balance) OVER by_country AS prev_balance
        FROM country_year
        WINDOW by_country AS (PARTITION BY country_id ORDER BY year)""",
    "changes": """
        SELECT country_id, year, eci, coi, eci - prev_eci AS eci_change,
               coi - prev_coi AS coi_change, trade_balance,
               trade_balance - prev_balance AS balance_change, prev_eci, prev_balance
        FROM lagged""",
    "dynamics": """
        SELECT country_id, year, eci, coi, eci_change, coi_change, trade_balance, balance_change,
               CASE WHEN eci_change > 0 AND balance_change > 0 THEN 'Both improving'
                    WHEN eci_change > 0 AND balance_change < 0 THEN 'ECI improving only'
                    WHEN eci_change < 0 AND balance_change > 0 THEN 'Balance improving only'
                    ELSE 'Both worsening' END AS trend_category
        FROM changes WHERE prev_eci IS NOT NULL AND prev_balance IS NOT NULL""",
    "dynamics_corrected": """
        SELECT country_id, year, eci, coi, eci_change, coi_change, trade_balance, balance_change,
               CASE WHEN eci_change > 0 AND balance_change > 0 THEN 'Both improving'
                    WHEN eci_change > 0 AND balance_change < 0 THEN 'ECI improving only'
                    WHEN eci_change < 0 AND balance_change > 0 THEN 'Balance improving only'
                    WHEN eci_change < 0 AND balance_change < 0 THEN 'Both worsening'
                    ELSE 'No change data' END AS trend_category
        FROM changes""",
    "complexity": """
        SELECT product_id, year, avg_pci, complexity_quartile,
               CASE complexity_quartile WHEN 4 THEN 'High Complexity'
                    WHEN 3 THEN 'Medium-High Complexity' WHEN 2 THEN 'Medium-Low Complexity'
                    ELSE 'Low Complexity' END AS complexity_tier,
               global_export_value, export_rank
        FROM (SELECT *, ntile(4) OVER (PARTITION BY year ORDER BY avg_pci NULLS FIRST, product_id)
                            AS complexity_quartile,
                     rank() OVER (PARTITION BY year ORDER BY global_export_value DESC NULLS LAST)
                            AS export_rank
              FROM product_year)""",
    "portfolio_rows": """
        SELECT country_id, year, product_id, export_share, avg_pci, complexity_tier AS tier,
               export_value,
               row_number() OVER (PARTITION BY country_id, year ORDER BY export_value DESC)
                   AS place
        FROM specialization JOIN complexity USING (product_id, year)""",
    "product_sums": """
        SELECT country_id, year, product_id, sum(export_value) AS export_value,
               row_number() OVER (PARTITION BY country_id, year ORDER BY sum(export_value) DESC)
                   AS place
        FROM portfolio_rows GROUP BY country_id, year, product_id""",
    "portfolio_sums": """
        SELECT country_id, year, sum(export_value) AS exports,
               sum(export_value) FILTER (WHERE tier = 'High Complexity') AS high,
               sum(export_value) FILTER (WHERE tier = 'Medium-High Complexity') AS medium_high,
               sum(export_value) FILTER (WHERE tier = 'Medium-Low Complexity') AS medium_low,
               sum(export_value) FILTER (WHERE tier = 'Low Complexity') AS low,
               sum(export_value) FILTER (WHERE place <= 10) AS top,
               sum(export_share * avg_pci) AS weighted_complexity,
               count(DISTINCT product_id) AS product_diversity
        FROM portfolio_rows GROUP BY ALL""",
    "portfolio": """
        SELECT country_id, year, coalesce(high, 0) / exports AS high_complexity_share,
               coalesce(medium_high, 0) / exports AS medium_high_share,
               coalesce(medium_low, 0) / exports AS medium_low_share,
               coalesce(low, 0) / exports AS low_complexity_share,
               weighted_complexity, product_diversity, top / exports AS top10_concentration
        FROM portfolio_sums""",
    "partner_sums": """
        SELECT exporter_id AS country_id, year, importer_id, sum(export_value) AS exports
        FROM flows GROUP BY ALL""",
    "partner_parts": """
        SELECT country_id, year, importer_id,
               exports / sum(exports) OVER (PARTITION BY country_id, year) AS part
        FROM partner_sums""",
    "concentrations": """
        SELECT country_id, year, count(*) AS partner_count, sum(part * part) AS partner_hhi
        FROM partner_parts GROUP BY ALL""",
    "diversification": """
        SELECT *, CASE WHEN partner_hhi < 0.15e0 THEN 'Highly Diversified'
                       WHEN partner_hhi < 0.25e0 THEN 'Moderately Diversified'
                       WHEN partner_hhi < 0.45e0 THEN 'Moderately Concentrated'
                       ELSE 'Highly Concentrated' END AS concentration_category
        FROM concentrations""",
    "year_steps": """
        SELECT base_year, (SELECT min(year) FROM country_year WHERE year > base_year)
                              AS target_year
        FROM (SELECT DISTINCT year AS base_year FROM country_year)""",
    "tiled": """
        SELECT s.country_id, s.year, s.product_id, s.export_value,
               ntile(4) OVER (PARTITION BY s.year
                              ORDER BY p.avg_pci NULLS FIRST, s.product_id,
                                       s.country_id NULLS FIRST, s.export_value) AS tile
        FROM specialization s JOIN product_year p USING (product_id, year)""",
    "pairs": """
        SELECT a.country_id, base_year, target_year, a.tile,
               (b.export_value - a.export_value) / a.export_value AS change
        FROM tiled a
        JOIN year_steps ON a.year = base_year AND base_year < 2022
        JOIN tiled b ON b.country_id = a.country_id AND b.product_id = a.product_id
                    AND b.year = target_year""",
    "growth_sums": """
        SELECT country_id, base_year, target_year, sum(change) FILTER (WHERE tile = 4) AS high,
               sum(change) FILTER (WHERE tile = 3) AS medium
        FROM pairs GROUP BY ALL""",
    "growth": """
        SELECT g.country_id, base_year, coi,
               ntile(4) OVER (PARTITION BY base_year ORDER BY coi NULLS FIRST, g.country_id)
                   AS coi_quartile,
               high AS high_complexity_growth, medium AS medium_high_growth, target_year
        FROM growth_sums g
        JOIN country_year c ON c.country_id = g.country_id AND c.year = base_year
        WHERE high IS NOT NULL""",
    "product_tiled": """
        SELECT s.country_id, s.year, s.product_id, s.export_value,
               ntile(4) OVER (PARTITION BY s.year
                              ORDER BY p.avg_pci NULLS FIRST, s.product_id,
                                       s.country_id NULLS FIRST) AS tile
        FROM (SELECT country_id, product_id, year, sum(export_value) AS export_value
              FROM specialization GROUP BY country_id, product_id, year) s
        JOIN product_year p USING (product_id, year)""",
    "product_pairs": """
        SELECT a.country_id, base_year, target_year, a.tile,
               (b.export_value - a.export_value) / a.export_value AS change
        FROM product_tiled a
        JOIN year_steps ON a.year = base_year
        JOIN product_tiled b ON b.country_id = a.country_id AND b.product_id = a.product_id
                            AND b.year = target_year""",
    "product_growth": """
        SELECT country_id, base_year, target_year, sum(change) FILTER (WHERE tile = 4) AS high,
               sum(change) FILTER (WHERE tile = 3) AS medium
        FROM product_pairs GROUP BY ALL""",
    "global_yearly": """
        SELECT year, sum(total_exports) AS global_exports, sum(total_imports) AS global_imports,
               sum(total_exports) AS global_trade_volume, avg(eci) AS avg_eci
        FROM country_year GROUP BY year""",
    "trends": """
        SELECT country_id, year, eci, eci_change, trade_balance, balance_change, trend_category
        FROM dynamics""",
    "portfolio_view": """
        SELECT country_id, year, high_complexity_share, medium_high_share, medium_low_share,
               low_complexity_share, weighted_complexity, eci
        FROM portfolio JOIN dynamics USING (country_id, year)""",
    "diversification_view": """
        SELECT country_id, year, partner_count, partner_hhi, concentration_category, eci,
               eci_change
        FROM diversification JOIN dynamics USING (country_id, year)""",
    "predictive": """
        SELECT coi_quartile, base_year,
               avg(high_complexity_growth) AS avg_high_complexity_growth,
               avg(medium_high_growth) AS avg_medium_high_growth,
               stddev_samp(high_complexity_growth) AS std_high_complexity_growth,
               stddev_samp(medium_high_growth) AS std_medium_high_growth,
               count(*) AS country_count
        FROM growth GROUP BY coi_quartile, base_year""",
    "evolution": """
        SELECT country_id, year, high_complexity_share, medium_high_share, medium_low_share,
               low_complexity_share, eci,
               rank() OVER (PARTITION BY year ORDER BY eci DESC NULLS LAST) AS eci_rank
        FROM portfolio JOIN dynamics USING (country_id, year)""",
    "chosen_portfolio": """
        SELECT * FROM portfolio_view WHERE year = 2022 AND country_id IN (1, 2, 3, 4, 5)""",
    "chosen_evolution": "SELECT * FROM evolution WHERE country_id IN (1, 2, 3, 4, 5)",
    "year_trends": "SELECT * FROM trends WHERE year = 2022",
    "scored": """
        SELECT *, 1 - partner_hhi AS diversification_score,
               ((1 - partner_hhi) + (eci - min(eci) OVER ())
                   / nullif(max(eci) OVER () - min(eci) OVER (), 0)) / 2 AS combined_score
        FROM diversification_view WHERE year = 2022""",
    "coi_rows": "SELECT * FROM predictive WHERE base_year = 2016",
    "global_trade": """
        SELECT year, global_trade_volume,
               100 * (global_trade_volume - lag(global_trade_volume) OVER w)
                   / nullif(lag(global_trade_volume) OVER w, 0) AS trade_volume_pct_change,
               avg_eci AS avg_economic_complexity,
               100 * (avg_eci - lag(avg_eci) OVER w) / nullif(abs(lag(avg_eci) OVER w), 0)
                   AS eci_pct_change
        FROM global_yearly WINDOW w AS (ORDER BY year)""",
    "products": """
        SELECT product_id, year, global_export_value AS global_trade_volume,
               100 * (global_export_value - lag(global_export_value) OVER w)
                   / nullif(lag(global_export_value) OVER w, 0) AS volume_pct_change,
               avg_pci AS product_complexity_index,
               rank() OVER (PARTITION BY year ORDER BY global_export_value DESC) AS rank
        FROM product_year WINDOW w AS (PARTITION BY product_id ORDER BY year)""",
    "partners": """
        SELECT *, rank() OVER (PARTITION BY country_id, year
                               ORDER BY total_trade_with_partner DESC) AS rank
        FROM (SELECT country_id, year, partner_country_id,
                     sum(export_value) AS exports_to_partner,
                     sum(import_value) AS imports_from_partner,
                     sum(export_value) + sum(import_value) AS total_trade_with_partner
              FROM fact GROUP BY country_id, year, partner_country_id)""",
    "tiered": "SELECT f.*, complexity_tier FROM fact f JOIN complexity USING (product_id, year)",
    "segment_years": """
        SELECT country_id, year,
               CASE complexity_tier WHEN 'High Complexity' THEN 'high'
                    WHEN 'Low Complexity' THEN 'low' ELSE 'medium' END
                   AS product_complexity_segment,
               sum(export_value - import_value) AS balance
        FROM tiered GROUP BY 1, 2, 3""",
    "country_trends": """
        SELECT country_id, regr_slope(trade_balance, year) AS balance_trend,
               regr_slope(eci, year) AS eci_trend
        FROM country_year GROUP BY country_id""",
    "segment_slopes": """
        SELECT country_id,
               regr_slope(balance, year) FILTER (WHERE product_complexity_segment = 'high')
                   AS high_complexity_balance_trend,
               regr_slope(balance, year) FILTER (WHERE product_complexity_segment = 'medium')
                   AS medium_complexity_balance_trend,
               regr_slope(balance, year) FILTER (WHERE product_complexity_segment = 'low')
                   AS low_complexity_balance_trend
        FROM segment_years GROUP BY country_id""",
    "concentration": """
        SELECT country_id,
               sum(CASE WHEN complexity_tier = 'High Complexity' THEN export_value ELSE 0 END)
                   / nullif(sum(export_value), 0) AS complexity_concentration
        FROM tiered GROUP BY country_id""",
    "correlation": """
        SELECT country_id, balance_trend, eci_trend, high_complexity_balance_trend,
               medium_complexity_balance_trend, low_complexity_balance_trend,
               complexity_concentration,
               CASE WHEN eci_trend > 0 AND balance_trend > 0 THEN 'Both improving'
                    WHEN eci_trend > 0 AND balance_trend < 0
                        THEN 'ECI improving, balance worsening'
                    WHEN eci_trend < 0 AND balance_trend > 0
                        THEN 'ECI worsening, balance improving'
                    WHEN eci_trend < 0 AND balance_trend < 0 THEN 'Both worsening'
               END AS trend_category
        FROM country_trends LEFT JOIN segment_slopes USING (country_id)
        LEFT JOIN concentration USING (country_id)""",
    "segments": """
        SELECT country_id, product_complexity_segment,
               regr_slope(balance, year) AS segment_balance_trend,
               avg(balance) AS avg_segment_balance, corr(balance, year) AS trend_strength
        FROM segment_years GROUP BY country_id, product_complexity_segment""",
    "high_trade": """
        SELECT country_id, year,
               sum(export_value) FILTER (WHERE complexity_tier = 'High Complexity') AS e,
               sum(import_value) FILTER (WHERE complexity_tier = 'High Complexity') AS i,
               sum(export_value) AS all_e
        FROM tiered GROUP BY country_id, year""",
    "category_places": """
        SELECT country_id, year, category,
               row_number() OVER (PARTITION BY country_id, year
                                  ORDER BY sum(export_value) DESC, category) AS place
        FROM (SELECT t.*, coalesce(p_brand, 'Unknown') AS category
              FROM tiered t LEFT JOIN part ON product_id = p_partkey)
        WHERE complexity_tier = 'High Complexity' AND export_value > 0
        GROUP BY country_id, year, category""",
    "category_columns": """
        SELECT country_id, year, max(category) FILTER (WHERE place = 1) AS top_product_category,
               max(category) FILTER (WHERE place = 2) AS second_product_category,
               max(category) FILTER (WHERE place = 3) AS third_product_category
        FROM category_places GROUP BY country_id, year""",
    "ranked_high": """
        SELECT country_id, year, e AS high_complexity_exports, i AS high_complexity_imports,
               e - i AS high_complexity_trade_balance,
               100 * e / nullif(all_e, 0) AS high_complexity_export_pct,
               rank() OVER (PARTITION BY year ORDER BY e - i DESC) AS trade_balance_rank
        FROM high_trade WHERE e IS NOT NULL""",
    "leaders": """
        SELECT r.*, top_product_category, second_product_category, third_product_category,
               CASE WHEN high_complexity_export_pct >= 50 THEN 'High-complexity specialist'
                    WHEN high_complexity_export_pct >= 25
                        THEN 'Balanced high-complexity exporter'
                    ELSE 'Low-complexity exporter' END AS specialization_pattern,
               avg(trade_balance_rank) OVER (PARTITION BY country_id) AS leadership_score
        FROM ranked_high r LEFT JOIN category_columns USING (country_id, year)""",
}


def _rounded(relation: str, columns: str, digits: int = 6) -> str:
    """All columns of ``relation`` with the named ones rounded."""
    parts = ", ".join(f"round({c}, {digits}) AS {c}" for c in columns.split())
    return f"SELECT * REPLACE ({parts}) FROM {relation}"


def _millions(columns: str) -> str:
    return ", ".join(f"round({c} / 1e6, 3) AS {c}" for c in columns.split())


SHARES = "high_complexity_share medium_high_share medium_low_share low_complexity_share"
SPREAD = (
    "avg_high_complexity_growth avg_medium_high_growth "
    "std_high_complexity_growth std_medium_high_growth"
)
PORTFOLIO = f"{SHARES} weighted_complexity top10_concentration"
SEGMENT_TRENDS = (
    "high_complexity_balance_trend medium_complexity_balance_trend low_complexity_balance_trend"
)


def _long_shares(ids: str, relation: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{label}' AS complexity_tier, round({share}, 6) AS share FROM {relation}"
        for share, label in [
            ("high_complexity_share", "High Complexity"),
            ("medium_high_share", "Medium-High Complexity"),
            ("medium_low_share", "Medium-Low Complexity"),
            ("low_complexity_share", "Low Complexity"),
        ]
    )


def _counts(relation: str, category: str) -> str:
    return (
        f"SELECT {category}, count(*) AS country_count, "
        f"round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS percent "
        f"FROM {relation} GROUP BY {category}"
    )


def _pct(column: str) -> str:
    return f"printf('%.1f%%', {column} * 100)"


_BUILT = {
    "combined_trade_data": "combined",
    "country_year_metrics": "country_year",
    "product_year_metrics": "product_year",
    "bilateral_flows": "flows",
    "export_specialization": "specialization",
    "complexity_dynamics": "dynamics",
    "product_complexity": "complexity",
    "export_portfolio": "portfolio",
    "partner_diversification": "diversification",
    "coi_growth_analysis": "growth",
    "v_global_yearly_metrics": "global_yearly",
    "v_eci_balance_trends": "trends",
    "v_export_complexity_portfolio": "portfolio_view",
    "v_diversification_complexity": "diversification_view",
    "v_coi_predictive_power": "predictive",
    "v_portfolio_evolution": "evolution",
}

# Relations that the sources are made from or made of.
_FROM_FACT = ("flow", "fact", "dirty", "raw_a", "raw_b", "clean_a", "clean_b", "combined")

SOURCE_ONE = "one_country_country_product_year_6"
SOURCE_TWO = "two_country_country_product_year_6"

QUERIES = {
    # Sources
    "landing_report": f"""
        SELECT '{SOURCE_ONE}' AS table_name, 'uploaded' AS status, count(*) AS row_count,
               round(sum(export_value) / 1e6, 3) AS exports_in_millions FROM raw_a
        UNION ALL SELECT '{SOURCE_TWO}', 'uploaded', count(*), round(sum(export_value) / 1e6, 3)
        FROM raw_b""",
    "raw_csv_rows": f"""
        SELECT *, '{SOURCE_ONE}' AS table_name FROM raw_a
        UNION ALL SELECT *, '{SOURCE_TWO}' FROM raw_b""",
    "load_report": f"""
        SELECT '{SOURCE_ONE}' AS table_name, count(*) AS rows, CAST(0 AS BIGINT) AS rejected,
               'loaded' AS status FROM raw_a
        UNION ALL SELECT '{SOURCE_TWO}', count(*), 0, 'loaded' FROM raw_b""",
    "load_counts": """
        SELECT CAST(2 AS BIGINT) AS total, CAST(2 AS BIGINT) AS loaded,
               CAST(0 AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS error""",
    "source_discovery": f"""
        SELECT '{SOURCE_ONE}' AS table_name, true AS table_exists, count(*) > 0 AS has_data
        FROM raw_a
        UNION ALL SELECT '{SOURCE_TWO}', true, count(*) > 0 FROM raw_b
        UNION ALL SELECT 'combined_trade_data', false, false
        UNION ALL SELECT 'combined_trade_data built', true, count(*) > 0 FROM combined""",
    "incremental_ingest": "SELECT * FROM combined",
    "bitmap_counts": """
        SELECT country_id, year, count(DISTINCT product_id) AS product_count,
               count(DISTINCT partner_country_id) AS partner_count
        FROM fact GROUP BY country_id, year HAVING count(partner_country_id) > 0""",
    "products_by_curve": "SELECT * FROM fact WHERE product_id IN (7, 60, 150)",
    "countries_by_curve": "SELECT * FROM fact WHERE country_id IN (1, 2, 3, 4, 5)",
    "reconciled_levels": "SELECT * FROM levels",
    "level_coverage": """
        SELECT year, level, count(*) AS codes, sum(export_value) AS reported,
               sum(least(export_value, coalesce(e, 0))) AS accounted,
               sum(greatest(export_value - coalesce(e, 0), 0)) AS remaining,
               sum(greatest(coalesce(e, 0) - export_value, 0)) AS excess
        FROM (SELECT *, 4 AS level FROM four_compared UNION ALL SELECT *, 2 FROM two_compared)
        GROUP BY year, level""",
    # Chapters are reported in full, so their totals are those of the finest codes.
    "chapter_totals": """
        SELECT country_id, product_id // 10000 AS product_id, year, 2 AS level,
               sum(export_value) AS export_value, sum(import_value) AS import_value
        FROM coded GROUP BY ALL""",
    "heading_totals": """
        SELECT country_id, CASE level WHEN 6 THEN product_id // 100 ELSE product_id END AS product_id,
               year, least(level, 4) AS level, sum(export_value) AS export_value,
               sum(import_value) AS import_value
        FROM levels GROUP BY ALL""",
    "mixed_level_build": """
        SELECT country_id, year, sum(export_value) AS total_exports,
               sum(import_value) AS total_imports, sum(export_value - import_value) AS trade_balance
        FROM coded WHERE year >= 2012 GROUP BY ALL""",
    # The same values as text, and what they can all be cast to.
    "detected_csv_types": """
        SELECT column_name,
               CASE WHEN count(v) = 0 THEN 'string'
                    WHEN bool_and(lower(v) IN ('true', 'false')) FILTER (WHERE v IS NOT NULL) THEN 'boolean'
                    WHEN bool_and(TRY_CAST(v AS BIGINT) IS NOT NULL AND NOT contains(v, '.')) FILTER (WHERE v IS NOT NULL) THEN 'bigint'
                    WHEN bool_and(TRY_CAST(v AS DOUBLE) IS NOT NULL) FILTER (WHERE v IS NOT NULL) THEN 'double'
                    WHEN bool_and(length(v) = 10 AND TRY_CAST(v AS DATE) IS NOT NULL) FILTER (WHERE v IS NOT NULL) THEN 'date'
                    WHEN bool_and(TRY_CAST(v AS TIMESTAMP) IS NOT NULL) FILTER (WHERE v IS NOT NULL) THEN 'timestamp'
                    ELSE 'string' END AS type_name,
               count(v) AS non_empty
        FROM (SELECT unnest(['o_orderkey', 'o_custkey', 'price', 'day', 'moment', 'even', 'mixed',
                             'flag_or_number', 'nothing']) AS column_name,
                     unnest([o_orderkey::VARCHAR,
                             CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey::VARCHAR END,
                             CASE WHEN o_orderkey % 2 = 0 THEN floor(o_totalprice)::BIGINT::VARCHAR
                                  ELSE o_totalprice::VARCHAR END,
                             strftime(o_orderdate, '%Y-%m-%d'),
                             CASE WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
                                  ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END,
                             (o_orderkey % 2 = 0)::VARCHAR,
                             CASE WHEN o_orderkey % 5 = 0 THEN 'n/a' ELSE o_orderkey::VARCHAR END,
                             CASE WHEN o_orderkey % 5 = 0 THEN '1' ELSE 'true' END,
                             NULL]) AS v
              FROM orders)
        GROUP BY column_name""",
    "landed_mixed_headers": """
        SELECT *, CASE WHEN product_id % 2 = 0
            THEN 'line "' || product_id || '",' || chr(10) || country_id END AS note
        FROM raw_a""",
    # Pipeline tables
    "directed_flows": "SELECT * FROM flow",
    "fact_table": "SELECT * FROM fact",
    "clean_source": f"""
        SELECT *, '{SOURCE_ONE}' AS table_name FROM clean_a
        UNION ALL SELECT *, '{SOURCE_TWO}' FROM clean_b""",
    "merge_three_sources": """
        SELECT * FROM two_so_far UNION ALL
        SELECT * FROM clean_a s WHERE NOT EXISTS (
            SELECT 1 FROM two_so_far t
            WHERE t.country_id = s.country_id AND t.partner_country_id = s.partner_country_id
              AND t.product_id = s.product_id AND t.year = s.year)""",
    "merge_by_index": """
        SELECT * FROM two_so_far UNION ALL
        SELECT * FROM clean_a s WHERE NOT EXISTS (
            SELECT 1 FROM two_so_far t
            WHERE t.country_id = s.country_id AND t.partner_country_id = s.partner_country_id
              AND t.product_id = s.product_id AND t.year = s.year)""",
    "merge_by_index_null_safe": """
        SELECT * FROM two_null_safe UNION ALL
        SELECT * FROM clean_a s WHERE NOT EXISTS (
            SELECT 1 FROM two_null_safe t
            WHERE t.country_id IS NOT DISTINCT FROM s.country_id
              AND t.partner_country_id IS NOT DISTINCT FROM s.partner_country_id
              AND t.product_id IS NOT DISTINCT FROM s.product_id
              AND t.year IS NOT DISTINCT FROM s.year)""",
    "eci_text_of_all": "SELECT country_id, year, printf('%.2f', eci) AS eci_text FROM evolution",
    "share_text_of_all": "SELECT country_id, year, " + ", ".join(
        f"printf('%.1f%%', round({c}, 6) * 100) AS {c}" for c in SHARES.split()
    ) + " FROM portfolio",
    "combined_trade_data": "SELECT * FROM combined",
    "merge_combined": """
        SELECT * FROM clean_a UNION ALL
        SELECT * FROM clean_b s WHERE NOT EXISTS (
            SELECT 1 FROM clean_a t
            WHERE t.country_id = s.country_id AND t.partner_country_id = s.partner_country_id
              AND t.product_id = s.product_id AND t.year = s.year)""",
    "merge_combined_null_safe": """
        SELECT * FROM clean_a UNION ALL
        SELECT * FROM clean_b s WHERE NOT EXISTS (
            SELECT 1 FROM clean_a t
            WHERE t.country_id IS NOT DISTINCT FROM s.country_id
              AND t.partner_country_id IS NOT DISTINCT FROM s.partner_country_id
              AND t.product_id IS NOT DISTINCT FROM s.product_id
              AND t.year IS NOT DISTINCT FROM s.year)""",
    "country_year_metrics": "SELECT * FROM country_year",
    "product_year_metrics": "SELECT * FROM product_year",
    "bilateral_flows": "SELECT * FROM flows",
    "export_specialization": _rounded("specialization", "export_share global_market_share", 9),
    "complexity_dynamics": "SELECT * FROM dynamics",
    "complexity_dynamics_corrected": "SELECT * FROM dynamics_corrected",
    "product_complexity": "SELECT * FROM complexity",
    "export_portfolio": _rounded("portfolio", PORTFOLIO),
    "export_portfolio_by_product": """
        SELECT country_id, year, round(high_complexity_share, 6) AS high_complexity_share,
               round(medium_high_share, 6) AS medium_high_share,
               round(medium_low_share, 6) AS medium_low_share,
               round(low_complexity_share, 6) AS low_complexity_share,
               round(weighted_complexity, 6) AS weighted_complexity, product_diversity,
               round(top / total, 6) AS top10_concentration
        FROM portfolio JOIN (
            SELECT country_id, year, sum(export_value) AS total,
                   sum(export_value) FILTER (WHERE place <= 10) AS top
            FROM product_sums GROUP BY country_id, year) USING (country_id, year)""",
    "partner_diversification": _rounded("diversification", "partner_hhi"),
    "coi_growth_analysis": _rounded("growth", "high_complexity_growth medium_high_growth", 4),
    "coi_growth_by_product": """
        SELECT g.country_id, base_year, coi,
               ntile(4) OVER (PARTITION BY base_year ORDER BY coi NULLS FIRST, g.country_id)
                   AS coi_quartile,
               round(high, 4) AS high_complexity_growth, round(medium, 4) AS medium_high_growth,
               target_year
        FROM product_growth g
        JOIN country_year c ON c.country_id = g.country_id AND c.year = base_year
        WHERE high IS NOT NULL""",
    # Views
    "v_global_yearly_metrics": "SELECT * FROM global_yearly",
    "v_eci_balance_trends": "SELECT * FROM trends",
    "v_export_complexity_portfolio": _rounded("portfolio_view", f"{SHARES} weighted_complexity"),
    "v_diversification_complexity": _rounded("diversification_view", "partner_hhi"),
    "v_coi_predictive_power": _rounded("predictive", SPREAD, 4),
    "v_portfolio_evolution": _rounded("evolution", SHARES),
    # Dashboard
    "available_years": "SELECT DISTINCT year FROM fact ORDER BY year",
    "available_countries": "SELECT DISTINCT country_id FROM fact ORDER BY country_id",
    "global_metrics": "SELECT * FROM global_yearly ORDER BY year",
    "global_metrics_yoy": """
        SELECT g.*, p.global_exports AS prev_global_exports,
               p.global_imports AS prev_global_imports,
               p.global_trade_volume AS prev_global_trade_volume, p.avg_eci AS prev_avg_eci
        FROM global_yearly g LEFT JOIN global_yearly p ON p.year = g.year - 1""",
    "top_countries": """
        SELECT country_id, total_exports + total_imports AS trade_volume, total_exports,
               total_imports, eci
        FROM country_year WHERE year = 2022 ORDER BY trade_volume DESC, country_id LIMIT 15""",
    "eci_balance_for_year": "SELECT * FROM year_trends",
    "export_portfolio_for_year": _rounded("portfolio_view", f"{SHARES} weighted_complexity")
    + " WHERE year = 2022",
    "export_portfolio_for_countries": _rounded(
        "chosen_portfolio", f"{SHARES} weighted_complexity"
    ),
    "partner_diversification_for_year": _rounded("diversification_view", "partner_hhi")
    + " WHERE year = 2022",
    "coi_predictive_power": _rounded("predictive", SPREAD, 4) + " ORDER BY base_year, coi_quartile",
    "top_ranked_countries": """
        SELECT country_id, round(avg(eci_rank), 6) AS avg_rank
        FROM evolution GROUP BY country_id ORDER BY avg(eci_rank), country_id LIMIT 16""",
    "portfolio_evolution_for_countries": _rounded("chosen_evolution", SHARES),
    "portfolio_evolution_of_leaders": _rounded("evolution", SHARES)
    + """ WHERE country_id IN (SELECT country_id FROM evolution GROUP BY country_id
                               ORDER BY avg(eci_rank), country_id LIMIT 6)""",
    "trend_split_with_change": "SELECT * FROM trends WHERE trend_category <> 'No change data'",
    "trend_split_no_change": """
        SELECT country_id, year, eci, eci_change, trade_balance, balance_change, trend_category
        FROM dynamics_corrected WHERE trend_category = 'No change data'""",
    "eci_balance_fit": """
        SELECT round(slope / 1e6, 3) AS slope, round(intercept / 1e6, 3) AS intercept, x_min,
               round((slope * x_min + intercept) / 1e6, 3) AS y_min, x_max,
               round((slope * x_max + intercept) / 1e6, 3) AS y_max
        FROM (SELECT regr_slope(balance_change, eci_change) AS slope,
                     regr_intercept(balance_change, eci_change) AS intercept,
                     min(eci_change) AS x_min, max(eci_change) AS x_max, count(*) AS points
              FROM year_trends)
        WHERE points > 1""",
    "trend_category_counts": _counts("year_trends", "trend_category"),
    "single_year_countries": """
        SELECT country_id, max(eci) AS eci FROM country_year
        GROUP BY country_id HAVING count(*) = 1""",
    "portfolio_long": _long_shares("country_id, eci", "chosen_portfolio"),
    "portfolio_table": f"""
        SELECT country_id AS "Country", eci AS "ECI",
               {_pct("high_complexity_share")} AS "High Complexity",
               {_pct("medium_high_share")} AS "Medium-High",
               {_pct("medium_low_share")} AS "Medium-Low",
               {_pct("low_complexity_share")} AS "Low Complexity",
               round(weighted_complexity, 6) AS "Weighted Complexity"
        FROM chosen_portfolio""",
    "diversification_score": _rounded("scored", "partner_hhi diversification_score combined_score"),
    "combined_score_top20": """
        SELECT country_id, round(avg(combined_score), 6) AS combined_score
        FROM scored WHERE country_id IN (
            SELECT country_id FROM scored ORDER BY combined_score DESC NULLS LAST, country_id
            LIMIT 20)
        GROUP BY country_id HAVING avg(combined_score) IS NOT NULL""",
    "concentration_category_counts": _counts(
        "(SELECT * FROM diversification_view WHERE year = 2022)", "concentration_category"
    ),
    "base_years": "SELECT DISTINCT base_year FROM predictive",
    "coi_for_base_year": _rounded("coi_rows", SPREAD, 4),
    "coi_growth_long": """
        SELECT 'Q' || coi_quartile AS coi_quartile, base_year,
               'High-complexity export growth' AS growth_type,
               round(avg_high_complexity_growth, 4) AS growth_rate FROM coi_rows
        UNION ALL
        SELECT 'Q' || coi_quartile, base_year, 'Medium-high complexity export growth',
               round(avg_medium_high_growth, 4) FROM coi_rows""",
    "coi_growth_error_bars": """
        SELECT 'Q' || coi_quartile AS coi_quartile, base_year,
               'High-complexity export growth' AS growth_type,
               round(avg_high_complexity_growth, 4) AS growth_avg,
               round(std_high_complexity_growth, 4) AS growth_std FROM coi_rows
        UNION ALL
        SELECT 'Q' || coi_quartile, base_year, 'Medium-high complexity export growth',
               round(avg_medium_high_growth, 4), round(std_medium_high_growth, 4)
        FROM coi_rows""",
    "coi_quartile_fit": """
        SELECT base_year, round(slope, 4) AS slope, round(intercept, 4) AS intercept,
               'Q' || q AS coi_quartile, round(slope * q + intercept, 4) AS fitted
        FROM (SELECT base_year, regr_slope(avg_high_complexity_growth, coi_quartile) AS slope,
                     regr_intercept(avg_high_complexity_growth, coi_quartile) AS intercept
              FROM coi_rows GROUP BY base_year HAVING count(*) = 4)
        CROSS JOIN range(1, 5) AS quartiles(q)""",
    "coi_table": f"""
        SELECT 'Q' || coi_quartile AS "COI Quartile", base_year AS "Base Year",
               {_pct("avg_high_complexity_growth")} AS "High Complexity Growth",
               {_pct("avg_medium_high_growth")} AS "Medium-High Growth",
               country_count AS "Number of Countries"
        FROM coi_rows""",
    "latest_rank": """
        SELECT country_id, arg_max(eci_rank, year) AS eci_rank
        FROM chosen_evolution GROUP BY country_id""",
    "evolution_long": _long_shares("country_id, year, eci, eci_rank", "chosen_evolution"),
    "evolution_long_all": _long_shares("country_id, year, eci", "chosen_evolution"),
    "latest_eci": """
        SELECT country_id, year, printf('%.2f', eci) AS eci_text FROM chosen_evolution
        WHERE year = (SELECT max(year) FROM chosen_evolution)""",
    # Report views
    "v_global_trade_metrics": _rounded("global_trade", "trade_volume_pct_change eci_pct_change"),
    "v_top_traded_products": _rounded("products", "volume_pct_change", 4),
    "v_top_trading_partners": "SELECT * FROM partners",
    "mv_country_annual_trade": """
        SELECT * EXCLUDE (eci), eci AS economic_complexity_index FROM country_year""",
    "v_eci_trade_balance_correlation": f"""
        SELECT country_id, {_millions("balance_trend " + SEGMENT_TRENDS)},
               round(eci_trend, 6) AS eci_trend,
               round(complexity_concentration, 6) AS complexity_concentration, trend_category
        FROM correlation""",
    "v_product_complexity_balance_trends": f"""
        SELECT country_id, product_complexity_segment,
               {_millions("segment_balance_trend avg_segment_balance")},
               round(trend_strength, 6) AS trend_strength
        FROM segments""",
    "v_product_complexity_leaders": _rounded(
        "leaders", "high_complexity_export_pct leadership_score"
    ),
    # Reports
    "rpt_volume_yoy": """
        SELECT year, global_trade_volume,
               round(trade_volume_pct_change, 6) AS trade_volume_pct_change
        FROM global_trade WHERE year BETWEEN 2018 AND 2022""",
    "rpt_eci_yoy": """
        SELECT year, avg_economic_complexity, round(eci_pct_change, 6) AS eci_pct_change
        FROM global_trade WHERE year BETWEEN 2018 AND 2022""",
    "rpt_top_products": """
        SELECT product_id, global_trade_volume, round(volume_pct_change, 4) AS volume_pct_change
        FROM products WHERE year = 2022 AND rank <= 5""",
    "rpt_top_partners": """
        SELECT partner_country_id, exports_to_partner, imports_from_partner,
               total_trade_with_partner
        FROM partners WHERE country_id = 1 AND year = 2022 AND rank <= 5""",
    "rpt_balance_over_time": """
        SELECT year, sum(exports_to_partner) AS total_exports,
               sum(imports_from_partner) AS total_imports,
               sum(exports_to_partner - imports_from_partner) AS trade_balance
        FROM partners WHERE country_id = 1 GROUP BY year""",
    "rpt_complex_among_top": """
        SELECT product_id, global_trade_volume, product_complexity_index
        FROM products WHERE year = 2022 AND rank <= 20
        ORDER BY product_complexity_index DESC NULLS LAST, product_id LIMIT 10""",
    "rpt_compare_countries": """
        SELECT a.year, a.avg_economic_complexity AS global_avg_eci,
               b.total_exports AS country1_exports, b.total_imports AS country1_imports,
               c.total_exports AS country2_exports, c.total_imports AS country2_imports,
               b.eci AS country1_eci, c.eci AS country2_eci
        FROM global_trade a JOIN country_year b ON a.year = b.year
        JOIN country_year c ON a.year = c.year
        WHERE b.country_id = 1 AND c.country_id = 2 AND a.year BETWEEN 2018 AND 2022""",
    "rpt_both_improving": """
        SELECT country_id, round(balance_trend / 1e6, 3) AS balance_trend,
               round(eci_trend, 6) AS eci_trend, trend_category,
               round(complexity_concentration, 6) AS complexity_concentration
        FROM correlation c WHERE trend_category = 'Both improving'
        ORDER BY round(c.eci_trend, 9) DESC, country_id LIMIT 10""",
    "rpt_eci_up_balance_down": f"""
        SELECT country_id, {_millions("balance_trend " + SEGMENT_TRENDS)},
               round(eci_trend, 6) AS eci_trend,
               round(complexity_concentration, 6) AS complexity_concentration
        FROM correlation c WHERE trend_category = 'ECI improving, balance worsening'
        ORDER BY round(c.eci_trend, 9) DESC, country_id LIMIT 10""",
    "rpt_segment_trends": f"""
        SELECT country_id, product_complexity_segment,
               {_millions("segment_balance_trend avg_segment_balance")},
               round(trend_strength, 6) AS trend_strength
        FROM segments WHERE country_id = 1""",
    "rpt_high_complexity_leaders": """
        SELECT country_id, year, high_complexity_exports, high_complexity_imports,
               high_complexity_trade_balance,
               round(high_complexity_export_pct, 6) AS high_complexity_export_pct,
               trade_balance_rank, top_product_category, specialization_pattern
        FROM leaders WHERE year = 2022 AND trade_balance_rank <= 10""",
    "rpt_consistent_leaders": """
        SELECT country_id, year, high_complexity_exports, high_complexity_trade_balance,
               round(leadership_score, 6) AS leadership_score, specialization_pattern,
               top_product_category, second_product_category, third_product_category
        FROM leaders l WHERE year = 2022 ORDER BY l.leadership_score, country_id LIMIT 15""",
    "rpt_category_specialists": """
        SELECT country_id, year, top_product_category, specialization_pattern,
               round(high_complexity_export_pct, 6) AS high_complexity_export_pct,
               high_complexity_trade_balance
        FROM leaders l WHERE year = 2022 AND specialization_pattern IN
            ('High-complexity specialist', 'Balanced high-complexity exporter')
        ORDER BY l.high_complexity_export_pct DESC, country_id LIMIT 20""",
    "rpt_rank_improvers": """
        SELECT country_id, year, trade_balance_rank AS current_rank, prev_rank,
               prev_rank - trade_balance_rank AS rank_improvement, high_complexity_trade_balance
        FROM (SELECT *, lag(trade_balance_rank) OVER (PARTITION BY country_id ORDER BY year)
                            AS prev_rank FROM leaders)
        WHERE year = 2022 AND prev_rank - trade_balance_rank > 0
        ORDER BY rank_improvement DESC, country_id LIMIT 15""",
}


#: Queries whose relations refer to each other so often that inlining them takes too long.
_NESTED = {"reconciled_levels", "level_coverage", "heading_totals", "merge_three_sources", "merge_by_index", "merge_by_index_null_safe"}


def _with_relations(sql: str, relations: dict[str, str], *, once: bool = False) -> str:
    """Prefix ``sql`` with the relations it needs; with ``once`` each of them is computed only once."""

    def used(text: str) -> set[str]:
        return set(re.findall(r"\w+", text)) & relations.keys()

    needed: set[str] = set()
    open_names = used(sql)
    while open_names:
        name = open_names.pop()
        needed.add(name)
        open_names |= used(relations[name]) - needed
    how = "AS MATERIALIZED" if once else "AS"
    parts = [f"{name} {how} ({relations[name]})" for name in relations if name in needed]
    return f"WITH {', '.join(parts)} {sql}" if parts else sql


def oracle_sql() -> dict[str, str]:
    found = {
        name: _with_relations(sql, RELATIONS, once=name in _NESTED) for name, sql in QUERIES.items()
    }
    # In the full build the metric tables come from the cleaned sources, not from the whole fact.
    cleaned = {
        name: sql if name in _FROM_FACT
        else re.sub(r"\bfact\b", "combined", sql)
        for name, sql in RELATIONS.items()
    }
    counts = " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, count(*) AS row_count FROM {relation}"
        for table, relation in _BUILT.items()
    )
    found["full_build"] = _with_relations(counts, cleaned)
    # Built from one source and then again with the other one merged in.
    of_merged = {}
    for name, sql in RELATIONS.items():
        of_merged[name] = sql if name in _FROM_FACT else re.sub(r"\bfact\b", "merged_fact", sql)
        if name == "clean_b":
            of_merged["merged_fact"] = QUERIES["merge_combined_null_safe"]
    for name in _BUILT:
        sql = "SELECT * FROM merged_fact" if name == "combined_trade_data" else QUERIES[name]
        found[f"built_{name}"] = _with_relations(sql, of_merged)
    for name in ("export_specialization", "v_coi_predictive_power", "v_portfolio_evolution"):
        found[f"published_{name}"] = found[f"built_{name}"]
    # Without null safety: rows without a partner come in with every batch that has them, once each.
    of_batches = dict(of_merged) | {"merged_fact": QUERIES["merge_combined"]}
    found["batch_ingest"] = _with_relations("SELECT * FROM merged_fact", of_batches)
    found["batch_metrics"] = _with_relations("SELECT * FROM country_year", of_batches)
    of_first = dict(of_merged) | {
        "first_year": re.sub(r"\bfact\b", "clean_a", RELATIONS["country_year"])
    }
    both = "SELECT *, 1 AS version FROM first_year UNION ALL SELECT *, 2 FROM country_year"
    found["published_versions"] = _with_relations(both, of_first)
    return found
