"""The semantic layer: certified KPI views as SQL, their renderer, and queries built from visuals.

Statements are kept to what two engines read alike.  ${name} is filled from parameters, DAYS(a; b) is the engine's difference in days.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

#: Loans are orders: product by priority, age by the last shipment; deposits are order lines: kind by return flag.
VIEWS: dict[str, str] = {
    "loan_position": """
        SELECT o.o_orderkey AS loan_id, o.o_custkey AS party_id, o.o_orderpriority AS product, n.n_name AS branch, r.r_name AS region,
               CAST(o.o_orderdate AS DATE) AS opened_on, o.o_orderstatus AS loan_status, CAST(o.o_totalprice AS DECIMAL(18,2)) AS principal,
               DAYS(l.last_ship; CAST(o.o_orderdate AS DATE)) AS dpd
        FROM ${orders} o
        JOIN (SELECT l_orderkey, MAX(CAST(l_shipdate AS DATE)) AS last_ship FROM ${lineitem} GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
        JOIN ${customer} c ON c.c_custkey = o.o_custkey
        JOIN ${nation} n ON n.n_nationkey = c.c_nationkey
        JOIN ${region} r ON r.r_regionkey = n.n_regionkey""",
    "kpi_npa_exposure": """
        SELECT p.*, CASE WHEN dpd > 90 THEN TRUE ELSE FALSE END AS is_npa,
               CAST(CASE WHEN dpd > 90 THEN principal ELSE 0 END AS DECIMAL(18,2)) AS gross_npa,
               CAST(principal * rate AS DECIMAL(18,2)) AS provision
        FROM (SELECT q.*, CASE asset_class WHEN 'STANDARD' THEN 0.004 WHEN 'SUBSTANDARD' THEN 0.15 WHEN 'DOUBTFUL_1' THEN 0.25 WHEN 'DOUBTFUL_2' THEN 0.40 ELSE 1.00 END AS rate
              FROM (SELECT b.*, CASE WHEN dpd <= 90 THEN 'STANDARD' WHEN dpd - 90 <= 365 THEN 'SUBSTANDARD' WHEN dpd - 90 <= 730 THEN 'DOUBTFUL_1' WHEN dpd - 90 <= 1460 THEN 'DOUBTFUL_2' ELSE 'DOUBTFUL_3' END AS asset_class
                    FROM (${loan_position}) b) q) p""",
    "npa_exposure": """
        SELECT loan_id, party_id, product, branch, region, CAST(dpd AS BIGINT) AS dpd, asset_class, is_npa, CAST(principal AS DOUBLE) AS principal, CAST(gross_npa AS DOUBLE) AS gross_npa, CAST(provision AS DOUBLE) AS provision
        FROM (${kpi_npa_exposure}) k""",
    "npa_trend": """
        SELECT t.*, CASE WHEN t.reporting_year = m.last_year THEN 1 ELSE 0 END AS is_latest
        FROM (SELECT CAST(EXTRACT(YEAR FROM opened_on) AS BIGINT) AS reporting_year, COUNT(*) AS loans, SUM(CASE WHEN is_npa THEN 1 ELSE 0 END) AS npa_loans,
                     CAST(SUM(principal) AS DOUBLE) AS gross_advances, CAST(SUM(gross_npa) AS DOUBLE) AS gross_npa,
                     ROUND(CAST(SUM(gross_npa) AS DOUBLE) / CAST(SUM(principal) AS DOUBLE), 6) AS gross_npa_ratio,
                     CAST(SUM(gross_npa) - SUM(CASE WHEN is_npa THEN provision ELSE 0 END) AS DOUBLE) AS net_npa,
                     ROUND(CAST(SUM(CASE WHEN is_npa THEN provision ELSE 0 END) AS DOUBLE) / NULLIF(CAST(SUM(gross_npa) AS DOUBLE), 0), 6) AS coverage
              FROM (${kpi_npa_exposure}) k GROUP BY CAST(EXTRACT(YEAR FROM opened_on) AS BIGINT)) t
        CROSS JOIN (SELECT CAST(EXTRACT(YEAR FROM MAX(CAST(o_orderdate AS DATE))) AS BIGINT) AS last_year FROM ${orders}) m""",
    "npa_breakdown": """
        SELECT region, branch, product, asset_class, COUNT(*) AS loans, CAST(SUM(principal) AS DOUBLE) AS principal, CAST(SUM(gross_npa) AS DOUBLE) AS gross_npa, CAST(SUM(provision) AS DOUBLE) AS provision
        FROM (${kpi_npa_exposure}) k GROUP BY region, branch, product, asset_class""",
    "npa_borrowers": """
        SELECT a.party_id, a.loans, CAST(a.gross_npa AS DOUBLE) AS gross_npa, CAST(COALESCE(d.deposits, 0) AS DOUBLE) AS deposits
        FROM (SELECT party_id, COUNT(*) AS loans, SUM(gross_npa) AS gross_npa FROM (${kpi_npa_exposure}) k WHERE is_npa GROUP BY party_id) a
        LEFT JOIN (SELECT party_id, SUM(balance) AS deposits FROM (${kpi_casa_ratio}) c GROUP BY party_id) d ON d.party_id = a.party_id""",
    "kpi_casa_ratio": """
        SELECT o.o_custkey AS party_id, l.l_orderkey AS account, n.n_name AS branch, r.r_name AS region, COALESCE(c.c_mktsegment, 'UNRESOLVED') AS segment, l.l_partkey AS product,
               CAST(EXTRACT(YEAR FROM l.l_shipdate) AS BIGINT) AS reporting_year,
               CASE l.l_returnflag WHEN 'A' THEN 'SAVINGS' WHEN 'R' THEN 'CURRENT' ELSE 'TERM' END AS deposit_type,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS balance,
               CAST(CASE WHEN l.l_returnflag IN ('A', 'R') THEN l.l_extendedprice ELSE 0 END AS DECIMAL(18,2)) AS casa_balance
        FROM ${lineitem} l JOIN ${orders} o ON o.o_orderkey = l.l_orderkey
        LEFT JOIN ${customer} c ON c.c_custkey = o.o_custkey LEFT JOIN ${nation} n ON n.n_nationkey = c.c_nationkey LEFT JOIN ${region} r ON r.r_regionkey = n.n_regionkey""",
    "casa_ratio": """
        SELECT reporting_year, COUNT(DISTINCT account) AS accounts, CAST(SUM(balance) AS DOUBLE) AS deposits, CAST(SUM(casa_balance) AS DOUBLE) AS casa_balance,
               ROUND(CAST(SUM(casa_balance) AS DOUBLE) / CAST(SUM(balance) AS DOUBLE), 6) AS casa_ratio
        FROM (${kpi_casa_ratio}) k GROUP BY reporting_year""",
    "casa_breakdown": """
        SELECT reporting_year, region, branch, segment, CAST(SUM(balance) AS DOUBLE) AS deposits,
               ROUND(CAST(SUM(casa_balance) AS DOUBLE) / NULLIF(CAST(SUM(balance) AS DOUBLE), 0), 6) AS casa_ratio
        FROM (${kpi_casa_ratio}) k GROUP BY reporting_year, region, branch, segment""",
    "casa_change": """
        SELECT branch, ROUND(after_casa / NULLIF(after_all, 0), 6) AS ratio_after, ROUND(before_casa / NULLIF(before_all, 0), 6) AS ratio_before,
               ROUND(after_casa / NULLIF(after_all, 0) - before_casa / NULLIF(before_all, 0), 6) AS change
        FROM (SELECT branch, CAST(SUM(CASE WHEN reporting_year = 1997 THEN casa_balance END) AS DOUBLE) AS after_casa, CAST(SUM(CASE WHEN reporting_year = 1997 THEN balance END) AS DOUBLE) AS after_all,
                     CAST(SUM(CASE WHEN reporting_year = 1996 THEN casa_balance END) AS DOUBLE) AS before_casa, CAST(SUM(CASE WHEN reporting_year = 1996 THEN balance END) AS DOUBLE) AS before_all
              FROM (${kpi_casa_ratio}) k GROUP BY branch) x""",
    # one row of parameters out of (parameter, value) rows
    "crv_parameters": """
        SELECT MAX(CASE WHEN parameter = 'casa_spread' THEN value END) AS casa_spread, MAX(CASE WHEN parameter = 'td_spread' THEN value END) AS td_spread,
               MAX(CASE WHEN parameter = 'fee_window_days' THEN value END) AS fee_window_days, MAX(CASE WHEN parameter = 'annualisation_factor' THEN value END) AS annualisation_factor
        FROM (SELECT 'casa_spread' AS parameter, CAST(0.030 AS DOUBLE) AS value UNION ALL SELECT 'td_spread', CAST(0.015 AS DOUBLE) UNION ALL SELECT 'fee_window_days', CAST(30 AS DOUBLE) UNION ALL SELECT 'annualisation_factor', CAST(12 AS DOUBLE)) p""",
    "crv_margins": """
        SELECT '1-URGENT' AS product, CAST(0.050 AS DOUBLE) AS margin UNION ALL SELECT '2-HIGH', CAST(0.040 AS DOUBLE) UNION ALL SELECT '3-MEDIUM', CAST(0.030 AS DOUBLE) UNION ALL SELECT '4-NOT SPECIFIED', CAST(0.020 AS DOUBLE)""",
    "crv_component": """
        SELECT party_id, component, product, CAST(base_amount AS DOUBLE) AS base_amount, CAST(rate AS DOUBLE) AS rate, CAST(CAST(CAST(base_amount AS DECIMAL(18,2)) * CAST(rate AS DECIMAL(8,4)) AS DECIMAL(18,2)) AS DOUBLE) AS annual_value
        FROM (SELECT d.party_id, d.component, d.product, d.base_amount, CASE WHEN d.component = 'CASA' THEN p.casa_spread ELSE p.td_spread END AS rate
              FROM (SELECT party_id, CASE WHEN deposit_type = 'TERM' THEN 'TERM_DEPOSIT' ELSE 'CASA' END AS component, deposit_type AS product, SUM(balance) AS base_amount
                    FROM (${kpi_casa_ratio}) k GROUP BY party_id, CASE WHEN deposit_type = 'TERM' THEN 'TERM_DEPOSIT' ELSE 'CASA' END, deposit_type) d CROSS JOIN (${crv_parameters}) p
              UNION ALL
              SELECT n.party_id, 'LENDING', n.product, n.base_amount, COALESCE(m.margin, 0)
              FROM (SELECT party_id, product, SUM(CASE WHEN is_npa THEN 0 ELSE principal END) AS base_amount FROM (${kpi_npa_exposure}) k GROUP BY party_id, product) n
              LEFT JOIN (${crv_margins}) m ON m.product = n.product
              UNION ALL
              SELECT f.party_id, 'FEES', f.product, f.base_amount, p.annualisation_factor
              FROM (SELECT o.o_custkey AS party_id, o.o_orderstatus AS product, SUM(CAST(CAST(ROUND(o.o_totalprice * 0.001 * 100) AS DECIMAL(18,0)) * 0.01 AS DECIMAL(18,2))) AS base_amount
                    FROM ${orders} o CROSS JOIN (${crv_parameters}) q CROSS JOIN (SELECT MAX(CAST(o_orderdate AS DATE)) AS reporting_date FROM ${orders}) x
                    WHERE CAST(o.o_orderdate AS DATE) <= x.reporting_date AND DAYS(x.reporting_date; CAST(o.o_orderdate AS DATE)) < q.fee_window_days
                    GROUP BY o.o_custkey, o.o_orderstatus) f CROSS JOIN (${crv_parameters}) p) c""",
    "crv_total": """
        SELECT k.party_id, COALESCE(c.c_mktsegment, 'UNRESOLVED') AS segment,
               CAST(SUM(CASE WHEN component = 'CASA' THEN CAST(annual_value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS casa_value, CAST(SUM(CASE WHEN component = 'TERM_DEPOSIT' THEN CAST(annual_value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS td_value,
               CAST(SUM(CASE WHEN component = 'LENDING' THEN CAST(annual_value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS lending_value, CAST(SUM(CASE WHEN component = 'FEES' THEN CAST(annual_value AS DECIMAL(18,2)) ELSE 0 END) AS DOUBLE) AS fee_value,
               CAST(SUM(CAST(annual_value AS DECIMAL(18,2))) AS DOUBLE) AS crv
        FROM (${crv_component}) k LEFT JOIN ${customer} c ON c.c_custkey = k.party_id GROUP BY k.party_id, COALESCE(c.c_mktsegment, 'UNRESOLVED')""",
    "crv_segment": """
        SELECT segment, CASE WHEN crv >= 100000 THEN 'PLATINUM' WHEN crv >= 25000 THEN 'GOLD' WHEN crv >= 5000 THEN 'SILVER' ELSE 'BASE' END AS value_band, COUNT(*) AS parties,
               CAST(SUM(CAST(crv AS DECIMAL(18,2))) AS DOUBLE) AS crv, ROUND(CAST(SUM(CAST(crv AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*), 2) AS average_crv
        FROM (${crv_total}) t GROUP BY segment, CASE WHEN crv >= 100000 THEN 'PLATINUM' WHEN crv >= 25000 THEN 'GOLD' WHEN crv >= 5000 THEN 'SILVER' ELSE 'BASE' END""",
    "crv_top25": """
        SELECT place, party_id, segment, crv FROM (SELECT CAST(ROW_NUMBER() OVER (ORDER BY crv DESC, party_id) AS BIGINT) AS place, party_id, segment, crv FROM (${crv_total}) t) x WHERE place <= 25""",
    "size_bands": """
        SELECT deposit_type, band, COUNT(*) AS accounts, CAST(SUM(balance) AS DOUBLE) AS balance
        FROM (SELECT deposit_type, account, SUM(balance) AS balance, CASE WHEN SUM(balance) < 50000 THEN 'UNDER_50K' WHEN SUM(balance) < 100000 THEN '50K_100K' WHEN SUM(balance) < 200000 THEN '100K_200K' ELSE 'OVER_200K' END AS band
              FROM (${kpi_casa_ratio}) k GROUP BY deposit_type, account) x GROUP BY deposit_type, band""",
    "party_by_product": """
        SELECT k.party_id, p.p_brand AS brand, COUNT(*) AS lines, CAST(SUM(k.balance) AS DOUBLE) AS balance
        FROM (${kpi_casa_ratio}) k JOIN ${part} p ON p.p_partkey = k.product WHERE k.segment = 'BUILDING' AND k.reporting_year = 1996 GROUP BY k.party_id, p.p_brand""",
    "kpi_consistency": """
        SELECT 'npa_breakdown' AS consumer, ROUND(SUM(gross_npa), 2) AS consumer_value, ROUND(MAX(c.v), 2) AS certified_value, CASE WHEN ABS(SUM(gross_npa) - MAX(c.v)) <= 0.005 THEN 'MATCHED' ELSE 'MISMATCH' END AS status
        FROM (${npa_breakdown}) b CROSS JOIN (SELECT CAST(SUM(gross_npa) AS DOUBLE) AS v FROM (${kpi_npa_exposure}) k) c
        UNION ALL
        SELECT 'npa_trend', ROUND(SUM(gross_npa), 2), ROUND(MAX(c.v), 2), CASE WHEN ABS(SUM(gross_npa) - MAX(c.v)) <= 0.005 THEN 'MATCHED' ELSE 'MISMATCH' END
        FROM (${npa_trend}) b CROSS JOIN (SELECT CAST(SUM(gross_npa) AS DOUBLE) AS v FROM (${kpi_npa_exposure}) k) c
        UNION ALL
        SELECT 'casa_ratio', ROUND(SUM(casa_balance), 2), ROUND(MAX(c.v), 2), CASE WHEN ABS(SUM(casa_balance) - MAX(c.v)) <= 0.005 THEN 'MATCHED' ELSE 'MISMATCH' END
        FROM (${casa_ratio}) b CROSS JOIN (SELECT CAST(SUM(casa_balance) AS DOUBLE) AS v FROM (${kpi_casa_ratio}) k) c
        UNION ALL
        SELECT 'crv_segment', ROUND(SUM(crv), 2), ROUND(MAX(c.v), 2), CASE WHEN ABS(SUM(crv) - MAX(c.v)) <= 0.01 THEN 'MATCHED' ELSE 'MISMATCH' END
        FROM (${crv_segment}) b CROSS JOIN (SELECT CAST(SUM(CAST(crv AS DECIMAL(18,2))) AS DOUBLE) AS v FROM (${crv_total}) k) c""",
}
#: Views that consumers read; the others are building blocks.
QUERIES = ["npa_exposure", "npa_trend", "npa_breakdown", "npa_borrowers", "casa_ratio", "casa_breakdown", "casa_change", "crv_component", "crv_total", "crv_segment", "crv_top25", "size_bands", "party_by_product", "kpi_consistency"]
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def statements(text: str) -> list[str]:
    """SQL text without comment lines, cut at semicolons that end a line."""
    lines = [x for x in text.splitlines() if not x.lstrip().startswith("--")]
    return [s.strip().rstrip(";").strip() for s in re.split(r";[ \t]*(?:\n|$)", "\n".join(lines)) if s.strip()]


def named_blocks(text: str) -> dict[str, str]:
    """Statements under ``-- name: x`` lines."""
    parts = re.split(r"(?m)^--\s*name:\s*(\w+)\s*$", text)
    return {name: found[0] for name, body in zip(parts[1::2], parts[2::2], strict=True) if (found := statements(body))}


def render(text: str, values: dict[str, str], days: str) -> str:
    """Fills ${name}, views within views; what can't be filled is an error. ``days``: the difference of {a} and {b} in days."""

    def fill(m: re.Match) -> str:
        if m[1] in values:
            return values[m[1]]
        if m[1] in VIEWS:
            return render(VIEWS[m[1]], values, days)
        raise ValueError(f"nothing to fill ${{{m[1]}}} with")

    out = re.sub(r"\$\{(\w+)\}", fill, text)
    return re.sub(r"DAYS\(([^;()]*(?:\([^()]*\))?[^;()]*); ([^()]*(?:\([^()]*\))?[^()]*)\)", lambda m: days.format(a=m[1], b=m[2]), out)


def run(spark: SparkSession, view: str, tables: dict[str, DataFrame]) -> DataFrame:
    text = render(VIEWS[view], {t: f"{{{t}}}" for t in TABLES}, "datediff({a}, {b})")
    return spark.sql(text, **{t: df for t, df in tables.items() if f"{{{t}}}" in text})


def visual_sql(dataset: str, dims: dict[str, str], measures: dict[str, str], filters: list[str] | None = None, limit: int | None = None) -> str:
    """A visual's query: dims and measures are alias -> expression with [column] references; filters are joined by AND."""
    plain = lambda e: re.sub(r"\[(\w+)\]", r"\1", e)
    columns = [f"{plain(e)} AS {a}" for a, e in {**dims, **measures}.items()]
    sql = f"SELECT {', '.join(columns)} FROM {dataset}"
    if filters:
        sql += " WHERE " + " AND ".join(f"({plain(f)})" for f in filters)
    if dims and measures:
        sql += " GROUP BY " + ", ".join(plain(e) for e in dims.values())
    return sql + (f" LIMIT {limit}" if limit else "")


def missing_columns(expressions: list[str], available: list[str]) -> list[str]:
    return sorted({c for e in expressions for c in re.findall(r"\[(\w+)\]", e)} - set(available))
