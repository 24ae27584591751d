"""Entity resolution on the driver's tables: customers as records of two systems."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators import mdm
from .registry import Registry

_r = Registry()
QUERIES, ORACLES, add = _r.queries, _r.oracles, _r.add

#: Customers as candidates: the last digits of the key make names near; identifiers repeat by construction.
_CAND_SQL = """SELECT CASE c_custkey % 3 WHEN 0 THEN 'CBS' WHEN 1 THEN 'LMS' ELSE 'CRM' END || ':' || CAST(c_custkey AS VARCHAR) AS id, CASE c_custkey % 3 WHEN 0 THEN 'CBS' WHEN 1 THEN 'LMS' ELSE 'CRM' END AS sys, CAST(c_custkey AS VARCHAR) AS key,
    c_mktsegment || ' ' || substr('ABCDEFGHIJ', CAST(c_custkey // 2 % 10 + 1 AS INTEGER), 1) || 'ANDER SMITH' AS name, CASE WHEN c_custkey % 4 = 0 THEN 'PAN' || CAST(c_custkey // 8 AS VARCHAR) END AS pan, DATE '1980-01-01' + CAST(c_custkey // 4 AS INTEGER) AS dob,
    CASE WHEN c_custkey % 5 <> 0 THEN 'M' || CAST(c_custkey // 3 AS VARCHAR) END AS mobile, CAST(c_nationkey AS VARCHAR) AS pin, CASE WHEN c_custkey % 3 = 1 THEN CAST(c_custkey - 1 AS VARCHAR) END AS ref FROM customer"""


def candidates(t) -> DataFrame:
    k = F.col("c_custkey")
    sys = F.when(k % 3 == 0, "CBS").when(k % 3 == 1, "LMS").otherwise("CRM")
    name = F.concat("c_mktsegment", F.lit(" "), F.substring(F.lit("ABCDEFGHIJ"), (F.floor(k / 2) % 10 + 1).cast("int"), F.lit(1)), F.lit("ANDER SMITH"))
    from ..functions.standard import name_key

    return t("customer").select(
        F.concat(sys, F.lit(":"), k.cast("string")).alias("candidate_id"),
        sys.alias("src_system"),
        k.cast("string").alias("src_key"),
        name.alias("name_std"),
        name_key(name).alias("name_key"),
        F.when(k % 4 == 0, F.concat(F.lit("PAN"), F.floor(k / 8).cast("string"))).alias("pan_std"),
        F.date_add(F.to_date(F.lit("1980-01-01")), F.floor(k / 4).cast("int")).alias("dob"),
        F.when(k % 5 != 0, F.concat(F.lit("M"), F.floor(k / 3).cast("string"))).alias("mobile_e164"),
        F.col("c_nationkey").cast("string").alias("pincode_std"),
        F.when(k % 3 == 1, (k - 1).cast("string")).alias("cbs_ref"),
        F.lit(True).alias("is_active"),
    )


_BLOCK_SQL = f"""WITH c AS ({_CAND_SQL}) SELECT DISTINCT least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b FROM c a JOIN c b ON a.id < b.id AND a.pan = b.pan
    UNION SELECT DISTINCT a.id, b.id FROM c a JOIN c b ON a.id < b.id AND a.dob = b.dob UNION SELECT least(a.id, b.id), greatest(a.id, b.id) FROM c a JOIN c b ON a.sys = 'LMS' AND b.sys = 'CBS' AND a.ref = b.key"""
_KEY = "array_to_string(list_sort(string_split({x}.name, ' ')), ' ')"
_SIM = "round(1 - levenshtein({a}, {b}) / greatest(length({a}), length({b})), 4)"
_RULES_SQL = f"""WITH c AS ({_CAND_SQL}), p AS ({_BLOCK_SQL}), f AS (SELECT p.id_a, p.id_b, a.pan = b.pan AS pan_eq, a.pan <> b.pan AS pan_ne, a.dob = b.dob AS dob_eq, a.mobile = b.mobile AS mob_eq, a.pin = b.pin AS pin_eq,
        coalesce((a.sys = 'LMS' AND b.sys = 'CBS' AND a.ref = b.key) OR (b.sys = 'LMS' AND a.sys = 'CBS' AND b.ref = a.key), false) AS xref,
        greatest({_SIM.format(a='a.name', b='b.name')}, {_SIM.format(a=_KEY.format(x='a'), b=_KEY.format(x='b'))}) AS sim, len(list_intersect(string_split(a.name, ' '), string_split(b.name, ' '))) = 3 AS subset
        FROM p JOIN c a ON a.id = p.id_a JOIN c b ON b.id = p.id_b),
    r AS (SELECT *, CASE WHEN coalesce(pan_ne, false) THEN 'PAN_CONFLICT' WHEN coalesce(pan_eq, false) THEN 'PAN_EXACT' WHEN xref THEN 'SOURCE_XREF' WHEN coalesce(mob_eq, false) AND dob_eq THEN 'MOBILE_DOB' WHEN sim >= 0.92 AND dob_eq AND pin_eq THEN 'NAME_DOB_PIN' WHEN subset AND dob_eq AND pin_eq THEN 'NAME_SUBSET_DOB_PIN' WHEN sim >= 0.85 AND dob_eq THEN 'NAME_DOB' END AS rule FROM f)
    SELECT id_a, id_b, rule, CASE rule WHEN 'PAN_CONFLICT' THEN 'NO_MATCH' WHEN 'NAME_DOB' THEN 'REVIEW' ELSE 'MERGE' END AS decision, CAST(CASE rule WHEN 'PAN_EXACT' THEN 1.0 WHEN 'SOURCE_XREF' THEN 0.99 WHEN 'MOBILE_DOB' THEN 0.95 ELSE sim END AS DOUBLE) AS score FROM r WHERE rule IS NOT NULL"""


def pairs(t) -> DataFrame:
    c = candidates(t)
    return mdm.decide(mdm.matched(c))


@add(_BLOCK_SQL)
def match_block(t):
    return mdm.block(candidates(t))


@add(_RULES_SQL)
def match_rules(t):
    return pairs(t).select("id_a", "id_b", "rule", "decision", "score")


@add(f"SELECT id_a, id_b, score FROM ({_RULES_SQL}) r WHERE decision = 'REVIEW'")
def match_review(t):
    return pairs(t).where("decision = 'REVIEW'").select("id_a", "id_b", "score")


#: Chains: customers of a nation in order of balance, linked where neighbours are close; an oracle by gaps and islands.
_CHAIN_SQL = """SELECT node, min(node) OVER (PARTITION BY n, island) AS label FROM (SELECT node, n, sum(CASE WHEN gap <= 5 THEN 0 ELSE 1 END) OVER (PARTITION BY n ORDER BY b, node) AS island
    FROM (SELECT c_custkey AS node, c_nationkey AS n, c_acctbal AS b, c_acctbal - lag(c_acctbal) OVER (PARTITION BY c_nationkey ORDER BY c_acctbal, c_custkey) AS gap FROM customer) x) y"""


@add(_CHAIN_SQL)
def components_chain(t):
    nodes = t("customer").select(F.col("c_custkey").alias("node"), F.col("c_nationkey").alias("n"), F.col("c_acctbal").alias("b"))
    # in order of balance only the next one needs a link: whoever else is near is linked through it
    following = Window.partitionBy("n").orderBy("b", "node")
    linked = nodes.select("node", F.lead("node").over(following).alias("next"), (F.lead("b").over(following) - F.col("b")).alias("gap")).where("gap <= 5")
    edges = linked.select(F.least("node", "next").alias("a"), F.greatest("node", "next").alias("b"))
    return mdm.components(nodes.select("node"), edges)


def _parties(t) -> tuple[DataFrame, DataFrame]:
    c, p = candidates(t), pairs(t)
    merged = p.where("decision = 'MERGE'").select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    return c, mdm.assign(mdm.components(c.select(F.col("candidate_id").alias("node")), merged))


_LABEL_SQL = f"""WITH RECURSIVE c AS ({_CAND_SQL}), e AS (SELECT id_a AS a, id_b AS b FROM ({_RULES_SQL}) m WHERE decision = 'MERGE'), both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
    reach(node, label) AS (SELECT id, id FROM c UNION SELECT x.b, r.label FROM reach r JOIN both_ways x ON x.a = r.node WHERE r.label < x.b), best AS (SELECT node, min(label) AS label FROM reach GROUP BY node)"""


@add(f"{_LABEL_SQL} SELECT node, label, 'P' || upper(substr(sha256(label), 1, 12)) AS party_id FROM best")
def party_assign(t):
    return _parties(t)[1].select("node", "label", "party_id")


_GOLDEN_SQL = f"""{_LABEL_SQL}, v AS (SELECT 'P' || upper(substr(sha256(label), 1, 12)) AS party_id, c.* FROM best JOIN c ON c.id = best.node),
    n AS (SELECT party_id, name, sys || ':' || key AS origin FROM (SELECT *, row_number() OVER (PARTITION BY party_id ORDER BY CASE sys WHEN 'CBS' THEN 0 WHEN 'CRM' THEN 1 ELSE 2 END, -length(name), sys, key) AS rn FROM v) x WHERE rn = 1),
    p AS (SELECT party_id, pan, sys || ':' || key AS origin FROM (SELECT *, row_number() OVER (PARTITION BY party_id ORDER BY CASE sys WHEN 'CBS' THEN 2 WHEN 'LMS' THEN 3 ELSE 4 END, sys, key) AS rn FROM v WHERE pan IS NOT NULL) x WHERE rn = 1)"""


def _golden(t) -> DataFrame:
    c, parties = _parties(t)
    rows = c.join(parties, c["candidate_id"] == parties["node"])
    tier = lambda *order: F.coalesce(*[F.when(F.col("src_system") == s, float(i)) for s, i in order])
    zero = F.lit(0.0)
    name = rows.select("party_id", F.lit("full_name").alias("attribute"), F.col("name_std").alias("value"), tier(("CBS", 0), ("CRM", 1), ("LMS", 2)).alias("o1"), (-F.length("name_std")).cast("double").alias("o2"), zero.alias("o3"), "src_system", "src_key")
    pan = rows.select("party_id", F.lit("pan").alias("attribute"), F.col("pan_std").alias("value"), tier(("CBS", 2), ("LMS", 3), ("CRM", 4)).alias("o1"), zero.alias("o2"), zero.alias("o3"), "src_system", "src_key")
    return mdm.survive(name.unionByName(pan), ["full_name", "pan"])


@add(f"{_GOLDEN_SQL} SELECT n.party_id, n.name AS full_name, p.pan FROM n LEFT JOIN p ON p.party_id = n.party_id")
def survive_golden(t):
    return _golden(t).select("party_id", "full_name", "pan")


@add(f"{_GOLDEN_SQL} SELECT n.party_id, n.origin AS name_from, p.origin AS pan_from FROM n LEFT JOIN p ON p.party_id = n.party_id")
def attr_provenance(t):
    return _golden(t).select("party_id", F.expr("try_element_at(attribute_sources, 'full_name')").alias("name_from"), F.expr("try_element_at(attribute_sources, 'pan')").alias("pan_from"))


@add(f"{_LABEL_SQL} SELECT 'P' || upper(substr(sha256(label), 1, 12)) AS party_id, COUNT(*) AS member_count, COUNT(DISTINCT pan) > 1 AS has_pan_conflict, string_agg(DISTINCT sys, ',' ORDER BY sys) AS source_systems FROM best JOIN c ON c.id = best.node GROUP BY label")
def party_rollup(t):
    c, parties = _parties(t)
    return mdm.rollup(c.join(parties, c["candidate_id"] == parties["node"])).select("party_id", "member_count", "has_pan_conflict", "source_systems")


@add(f"""{_LABEL_SQL}, b AS (SELECT node, label, CAST(split_part(node, ':', 2) AS BIGINT) // 4 AS person FROM best), s AS (SELECT (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM b GROUP BY label, person)) AS hit,
    (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM b GROUP BY label)) AS said, (SELECT sum(n * (n - 1) / 2) FROM (SELECT count(*) AS n FROM b GROUP BY person)) AS truth)
    SELECT round(CAST(hit AS DOUBLE) / said, 6) AS precision, round(CAST(hit AS DOUBLE) / truth, 6) AS recall, (SELECT count(*) FROM (SELECT person FROM b GROUP BY person HAVING count(DISTINCT label) > 1)) AS split_persons, (SELECT count(*) FROM (SELECT label FROM b GROUP BY label HAVING count(DISTINCT person) > 1)) AS merged_parties FROM s""")
def match_quality(t):
    c, parties = _parties(t)
    truth = c.select(F.col("candidate_id").alias("node"), F.floor(F.col("src_key").cast("long") / 4).alias("person"))
    return mdm.quality(parties.select("node", "party_id"), truth).select(F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), "split_persons", "merged_parties")


_PRIOR_SQL = f"""WITH c AS ({_CAND_SQL}), old AS (SELECT id, pan, CAST(key AS BIGINT) // 6 AS party FROM c), least_id AS (SELECT party, min(id) AS id_a FROM old GROUP BY party)
    SELECT a.id AS id_a, o.id AS id_b, 'PRIOR_LINK' AS rule, 'MERGE' AS decision, CAST(0.9 AS DOUBLE) AS score FROM old o JOIN least_id l USING (party) JOIN c a ON a.id = l.id_a
    WHERE o.id <> l.id_a AND NOT coalesce(a.pan <> o.pan, false) AND (a.id, o.id) NOT IN (SELECT (id_a, id_b) FROM ({_RULES_SQL}) r WHERE decision = 'MERGE')"""


@add(_PRIOR_SQL)
def match_prior(t):
    """Parties of six neighbouring keys as if found before: their links hold unless PANs say otherwise."""
    c = candidates(t)
    previous = c.select("candidate_id", F.floor(F.col("src_key").cast("bigint") / 6).cast("string").alias("party_id"))
    return mdm.prior_links(previous, pairs(t), c)


@add(f"""WITH c AS ({_CAND_SQL}), m AS (SELECT * FROM ({_RULES_SQL}) r WHERE decision = 'MERGE'), ends AS (SELECT id_a AS id, rule, score FROM m UNION ALL SELECT id_b, rule, score FROM m),
    best AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY CASE rule WHEN 'PAN_EXACT' THEN 1 WHEN 'SOURCE_XREF' THEN 2 WHEN 'MOBILE_DOB' THEN 3 ELSE 4 END, score DESC, rule) AS rn FROM ends)
    SELECT c.id AS candidate_id, coalesce(rule, 'SINGLETON') AS match_rule, coalesce(score, 1.0) AS match_score FROM c LEFT JOIN best ON best.id = c.id AND rn = 1""")
def match_best_rule(t):
    return mdm.best_rule(candidates(t).select(F.col("candidate_id").alias("node")), pairs(t)).select(F.col("node").alias("candidate_id"), "match_rule", "match_score")
