"""Oracles of the semantic views: the same figures by another way, in whole cents and by tables of bands and rates.

They share no text with the views: amounts are integers, classes come from a join with bands, values from a join with rates.
"""

from __future__ import annotations

#: Days past due from and to, loss rate in thousandths.
_BANDS = "(VALUES ('STANDARD', -1000000, 90, 4), ('SUBSTANDARD', 91, 455, 150), ('DOUBTFUL_1', 456, 820, 250), ('DOUBTFUL_2', 821, 1550, 400), ('DOUBTFUL_3', 1551, 1000000, 1000)) AS bands(label, low, high, rate)"
_KINDS = "(VALUES ('A', 'SAVINGS', 'CASA', 300), ('R', 'CURRENT', 'CASA', 300), ('N', 'TERM', 'TERM_DEPOSIT', 150)) AS kinds(flag, kind, component, rate)"
_LOANS = f"""
    shipped AS (SELECT l_orderkey AS loan, max(l_shipdate)::DATE AS last_day FROM lineitem GROUP BY l_orderkey),
    places AS (SELECT c_custkey AS party, n_name AS branch, r_name AS region, c_mktsegment AS segment FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey),
    loans AS (
        SELECT o_orderkey AS loan, o_custkey AS party, o_orderpriority AS product, branch, region, o_orderdate::DATE AS opened, round(o_totalprice * 100)::BIGINT AS cents, (last_day - o_orderdate::DATE)::BIGINT AS age
        FROM orders JOIN shipped ON loan = o_orderkey JOIN places ON party = o_custkey WHERE region IS NOT NULL
    ),
    exposure AS (SELECT loans.*, label, low > 90 AS bad, CASE WHEN low > 90 THEN cents ELSE 0 END AS bad_cents, (cents * rate + 500) // 1000 AS lost FROM loans JOIN {_BANDS} ON age BETWEEN low AND high)"""
_LINES = f"""
    owners AS (SELECT o_orderkey AS account, o_custkey AS party FROM orders),
    whereabouts AS (SELECT c_custkey AS party, n_name AS branch, r_name AS region, c_mktsegment AS segment FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey),
    lines AS (
        SELECT owners.party, account, l_partkey AS part, branch, region, coalesce(segment, 'UNRESOLVED') AS segment, year(l_shipdate)::BIGINT AS y, kind, component, rate, round(l_extendedprice * 100)::BIGINT AS cents, CASE WHEN component = 'CASA' THEN round(l_extendedprice * 100)::BIGINT ELSE 0 END AS casa
        FROM lineitem JOIN owners ON account = l_orderkey LEFT JOIN whereabouts ON whereabouts.party = owners.party JOIN {_KINDS} ON kinds.flag = CASE WHEN l_returnflag IN ('A', 'R') THEN l_returnflag ELSE 'N' END
    )"""
_VALUES = """
    margins(product, rate) AS (VALUES ('1-URGENT', 500), ('2-HIGH', 400), ('3-MEDIUM', 300), ('4-NOT SPECIFIED', 200)),
    bases AS (
        SELECT party, component, kind AS product, sum(cents)::BIGINT AS base, max(rate) AS rate FROM lines GROUP BY party, component, kind
        UNION ALL SELECT exposure.party, 'LENDING', exposure.product, sum(cents - bad_cents)::BIGINT, coalesce(max(margins.rate), 0) FROM exposure LEFT JOIN margins ON margins.product = exposure.product GROUP BY exposure.party, exposure.product
        UNION ALL SELECT o_custkey, 'FEES', o_orderstatus, sum((CAST(o_totalprice * 0.001 AS DECIMAL(18,2)) * 100)::BIGINT)::BIGINT, 120000 FROM orders WHERE o_orderdate::DATE > (SELECT max(o_orderdate)::DATE - 30 FROM orders) GROUP BY o_custkey, o_orderstatus
    ),
    yearly AS (SELECT *, (base * rate + 5000) // 10000 AS yearly FROM bases),
    totals AS (
        SELECT yearly.party, coalesce(max(c_mktsegment), 'UNRESOLVED') AS segment, sum(yearly) AS v, sum(yearly) FILTER (component = 'CASA') AS casa, sum(yearly) FILTER (component = 'TERM_DEPOSIT') AS term, sum(yearly) FILTER (component = 'LENDING') AS lending, sum(yearly) FILTER (component = 'FEES') AS fees
        FROM yearly LEFT JOIN customer ON c_custkey = yearly.party GROUP BY yearly.party
    )"""


def _money(cents: str) -> str:
    return f"coalesce({cents}, 0)::DOUBLE / 100"


_LOAN, _LINE, _ALL = f"WITH {_LOANS}", f"WITH {_LINES}", f"WITH {_LOANS}, {_LINES}, {_VALUES}"
ORACLES = {
    "npa_exposure": f"{_LOAN} SELECT loan AS loan_id, party AS party_id, product, branch, region, age AS dpd, label AS asset_class, bad AS is_npa, {_money('cents')} AS principal, {_money('bad_cents')} AS gross_npa, {_money('lost')} AS provision FROM exposure",
    "npa_trend": f"""{_LOAN}, years AS (
            SELECT year(opened)::BIGINT AS y, count(*) AS loans, count(*) FILTER (bad) AS bad_loans, sum(cents) AS cents, sum(bad_cents) AS bad_cents, sum(lost) FILTER (bad) AS lost FROM exposure GROUP BY 1
        ) SELECT y AS reporting_year, loans, bad_loans AS npa_loans, {_money('cents')} AS gross_advances, {_money('bad_cents')} AS gross_npa, round({_money('bad_cents')} / ({_money('cents')}), 6) AS gross_npa_ratio,
            {_money('bad_cents - coalesce(lost, 0)')} AS net_npa, CASE WHEN bad_cents > 0 THEN round({_money('lost')} / ({_money('bad_cents')}), 6) END AS coverage,
            CASE WHEN y = (SELECT max(year(o_orderdate)) FROM orders) THEN 1 ELSE 0 END AS is_latest FROM years""",
    "npa_breakdown": f"{_LOAN} SELECT region, branch, product, label AS asset_class, count(*) AS loans, {_money('sum(cents)')} AS principal, {_money('sum(bad_cents)')} AS gross_npa, {_money('sum(lost)')} AS provision FROM exposure GROUP BY ALL",
    "npa_borrowers": f"""WITH {_LOANS}, {_LINES}, held AS (SELECT party, sum(cents) AS cents FROM lines GROUP BY party)
        SELECT exposure.party AS party_id, count(*) AS loans, {_money('sum(bad_cents)')} AS gross_npa, {_money('any_value(held.cents)')} AS deposits FROM exposure LEFT JOIN held ON held.party = exposure.party WHERE bad GROUP BY exposure.party""",
    "casa_ratio": f"{_LINE} SELECT y AS reporting_year, count(DISTINCT account) AS accounts, {_money('sum(cents)')} AS deposits, {_money('sum(casa)')} AS casa_balance, round({_money('sum(casa)')} / ({_money('sum(cents)')}), 6) AS casa_ratio FROM lines GROUP BY y",
    "casa_breakdown": f"{_LINE} SELECT y AS reporting_year, region, branch, segment, {_money('sum(cents)')} AS deposits, CASE WHEN sum(cents) <> 0 THEN round({_money('sum(casa)')} / ({_money('sum(cents)')}), 6) END AS casa_ratio FROM lines GROUP BY ALL",
    "casa_change": f"""{_LINE}, shares AS (SELECT branch, y, CASE WHEN sum(cents) <> 0 THEN {_money('sum(casa)')} / ({_money('sum(cents)')}) END AS share FROM lines GROUP BY branch, y), branches AS (SELECT DISTINCT branch FROM lines)
        SELECT branches.branch, round(a.share, 6) AS ratio_after, round(b.share, 6) AS ratio_before, round(a.share - b.share, 6) AS change
        FROM branches LEFT JOIN shares a ON a.branch IS NOT DISTINCT FROM branches.branch AND a.y = 1997 LEFT JOIN shares b ON b.branch IS NOT DISTINCT FROM branches.branch AND b.y = 1996""",
    "crv_component": f"{_ALL} SELECT party AS party_id, component, product, {_money('base')} AS base_amount, rate::DOUBLE / 10000 AS rate, {_money('yearly')} AS annual_value FROM yearly",
    "crv_total": f"{_ALL} SELECT party AS party_id, segment, {_money('casa')} AS casa_value, {_money('term')} AS td_value, {_money('lending')} AS lending_value, {_money('fees')} AS fee_value, {_money('v')} AS crv FROM totals",
    "crv_segment": f"""{_ALL}, banded AS (SELECT segment, v, list_filter([['PLATINUM', '10000000'], ['GOLD', '2500000'], ['SILVER', '500000'], ['BASE', '-1000000000000']], lambda b: v >= b[2]::BIGINT)[1][1] AS value_band FROM totals)
        SELECT segment, value_band, count(*) AS parties, {_money('sum(v)')} AS crv, round({_money('sum(v)')} / count(*), 2) AS average_crv FROM banded GROUP BY ALL""",
    "crv_top25": f"{_ALL} SELECT 1 + (SELECT count(*) FROM totals o WHERE o.v > t.v OR (o.v = t.v AND o.party < t.party)) AS place, party AS party_id, segment, {_money('v')} AS crv FROM (SELECT * FROM totals ORDER BY v DESC, party LIMIT 25) t",
    "profitability_rank": f"{_ALL} SELECT segment, party AS party_id, rank() OVER (ORDER BY v DESC, party) AS place, {_money('v')} AS crv FROM totals",
    "size_bands": f"""{_LINE}, accounts AS (SELECT kind, account, sum(cents) AS cents FROM lines GROUP BY kind, account)
        SELECT kind AS deposit_type, ['UNDER_50K', '50K_100K', '100K_200K', 'OVER_200K'][1 + (cents >= 5000000)::INT + (cents >= 10000000)::INT + (cents >= 20000000)::INT] AS band, count(*) AS accounts, {_money('sum(cents)')} AS balance FROM accounts GROUP BY ALL""",
    "party_by_product": f"{_LINE} SELECT party AS party_id, p_brand AS brand, count(*) AS lines, {_money('sum(cents)')} AS balance FROM lines JOIN part ON p_partkey = part WHERE segment = 'BUILDING' AND y = 1996 GROUP BY ALL",
    "kpi_consistency": f"""{_ALL}, figures AS (
            SELECT 'npa_breakdown' AS consumer, sum(bad_cents) AS v FROM exposure UNION ALL SELECT 'npa_trend', sum(bad_cents) FROM exposure UNION ALL SELECT 'casa_ratio', sum(casa) FROM lines UNION ALL SELECT 'crv_segment', sum(v) FROM totals
        ) SELECT consumer, {_money('v')} AS consumer_value, {_money('v')} AS certified_value, 'MATCHED' AS status FROM figures""",
    "visual_query": f"{_LOAN} SELECT region, label AS asset_class, round({_money('sum(bad_cents)')} / 100000, 2) AS gross, count(*) AS loans FROM (SELECT *, sum(bad_cents) OVER (PARTITION BY region, branch, product, label) AS kept FROM exposure) x WHERE kept > 0 GROUP BY region, label",
}
