"""Entity resolution: blocking, pair rules, connected components, stable party ids, survivorship.

Candidates have candidate_id, src_system, src_key, name_std, name_key, pan_std, dob, mobile_e164, pincode_std, cbs_ref, is_active.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.standard import similarity
from .relational import cut, latest

#: Least name similarity of a merge with a postal code, and of a review.
MERGE_SIMILARITY, REVIEW_SIMILARITY = 0.92, 0.85
#: The rules in order; the first that holds decides. Those that merge, with their score (None: the similarity).
MERGES = {"PAN_EXACT": 1.00, "SOURCE_XREF": 0.99, "MOBILE_DOB": 0.95, "NAME_DOB_PIN": None, "NAME_SUBSET_DOB_PIN": None, "PRIOR_LINK": 0.90}
RULE_ORDER = {"PAN_EXACT": 1, "SOURCE_XREF": 2, "MOBILE_DOB": 3, "PRIOR_LINK": 5}


def block(candidates: DataFrame, on: list[list[str]] = [["pan_std"], ["dob"]], xref: bool = True) -> DataFrame:  # noqa: B006
    """Distinct pairs (id_a < id_b) that share a value: one equality self-join a key, and records that name another system's key."""
    found = []
    for keys in on:
        a = candidates.select(*keys, F.col("candidate_id").alias("id_a"))
        found.append(a.join(candidates.select(*keys, F.col("candidate_id").alias("id_b")), keys).where("id_a < id_b").select("id_a", "id_b"))
    if xref:
        lms = candidates.where("src_system = 'LMS' AND cbs_ref IS NOT NULL").select(F.col("candidate_id").alias("x"), F.col("cbs_ref").alias("k"))
        cbs = candidates.where("src_system = 'CBS'").select(F.col("candidate_id").alias("y"), F.col("src_key").alias("k"))
        found.append(lms.join(cbs, "k").select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")))
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out.distinct()


def _equal(c: str) -> Column:
    return F.coalesce(F.col(f"a.{c}") == F.col(f"b.{c}"), F.lit(False))


def _compared() -> list[Column]:
    """What decide() asks of candidates a and b."""
    ta, tb = F.split("a.name_std", " "), F.split("b.name_std", " ")
    shorter = F.least(F.size(ta), F.size(tb))
    xref = lambda x, y: (F.col(f"{x}.src_system") == "LMS") & (F.col(f"{y}.src_system") == "CBS") & (F.col(f"{x}.cbs_ref") == F.col(f"{y}.src_key"))
    return [
        F.col("a.name_std").alias("name_a"),
        F.col("b.name_std").alias("name_b"),
        _equal("pan_std").alias("pan_equal"),
        (F.col("a.pan_std").isNotNull() & F.col("b.pan_std").isNotNull() & (F.col("a.pan_std") != F.col("b.pan_std"))).alias("pan_differs"),
        _equal("dob").alias("dob_equal"),
        _equal("mobile_e164").alias("mobile_equal"),
        _equal("pincode_std").alias("pin_equal"),
        F.coalesce(xref("a", "b") | xref("b", "a"), F.lit(False)).alias("xref"),
        F.greatest(similarity(F.col("a.name_std"), F.col("b.name_std")), similarity(F.col("a.name_key"), F.col("b.name_key"))).alias("similarity"),
        F.coalesce((shorter >= 2) & (F.size(F.array_intersect(ta, tb)) == shorter), F.lit(False)).alias("name_subset"),
    ]


def features(pairs: DataFrame, candidates: DataFrame) -> DataFrame:
    p = pairs.join(candidates.alias("a"), F.col("id_a") == F.col("a.candidate_id")).join(candidates.alias("b"), F.col("id_b") == F.col("b.candidate_id"))
    return p.select("id_a", "id_b", *_compared())


def matched(candidates: DataFrame, on: list[list[str]] = [["pan_std"], ["dob"]], xref: bool = True) -> DataFrame:  # noqa: B006
    """features() of block()'s pairs, compared where they meet: a pair comes from the first of its keys only, so pairs aren't shuffled.

    A candidate_id must stand for one candidate.
    """
    needed = candidates.select("candidate_id", "src_system", "src_key", "name_std", "name_key", "pan_std", "dob", "mobile_e164", "pincode_std", "cbs_ref")
    a, b = needed.alias("a"), needed.alias("b")
    met = lambda keys: reduce(lambda x, y: x & y, [_equal(k) for k in keys])
    out, before = [], F.lit(False)
    for keys in on:
        same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
        out.append(a.join(b, [*same, F.col("a.candidate_id") < F.col("b.candidate_id"), ~before]))
        before = before | met(keys)
    if xref:
        for x, y in (("a", "b"), ("b", "a")):
            named = [F.col(f"{x}.cbs_ref") == F.col(f"{y}.src_key"), F.col(f"{x}.src_system") == "LMS", F.col(f"{y}.src_system") == "CBS"]
            out.append(a.join(b, [*named, F.col("a.candidate_id") < F.col("b.candidate_id"), ~before]))
    found = [pairs.select(F.col("a.candidate_id").alias("id_a"), F.col("b.candidate_id").alias("id_b"), *_compared()) for pairs in out]
    return reduce(DataFrame.unionByName, found)


def decide(pairs: DataFrame) -> DataFrame:
    """rule, decision (MERGE, REVIEW or NO_MATCH) and score; pairs that no rule names are dropped."""
    near = F.col("similarity") >= MERGE_SIMILARITY
    rule = (
        F.when(F.col("pan_differs"), "PAN_CONFLICT")
        .when(F.col("pan_equal"), "PAN_EXACT")
        .when(F.col("xref"), "SOURCE_XREF")
        .when(F.col("mobile_equal") & F.col("dob_equal"), "MOBILE_DOB")
        .when(near & F.col("dob_equal") & F.col("pin_equal"), "NAME_DOB_PIN")
        .when(F.col("name_subset") & F.col("dob_equal") & F.col("pin_equal"), "NAME_SUBSET_DOB_PIN")
        .when((F.col("similarity") >= REVIEW_SIMILARITY) & F.col("dob_equal"), "NAME_DOB")
    )
    fixed = F.col("similarity")
    for name, score in MERGES.items():
        if score is not None:
            fixed = F.when(F.col("rule") == name, score).otherwise(fixed)
    decision = F.when(F.col("rule") == "PAN_CONFLICT", "NO_MATCH").when(F.col("rule") == "NAME_DOB", "REVIEW").otherwise("MERGE")
    return pairs.withColumn("rule", rule).where("rule IS NOT NULL").withColumns({"decision": decision, "score": fixed.cast("double")})


def prior_links(previous: DataFrame, merges: DataFrame, candidates: DataFrame) -> DataFrame:
    """Members of an earlier party tied to its smallest member, unless both have a PAN and they differ or the pair merges anyway."""
    least = previous.groupBy("party_id").agg(F.min("candidate_id").alias("id_a"))
    star = previous.join(least, "party_id").where("candidate_id <> id_a").select("id_a", F.col("candidate_id").alias("id_b"))
    pans = candidates.select("candidate_id", "pan_std")
    both = star.join(pans.toDF("id_a", "pan_a"), "id_a").join(pans.toDF("id_b", "pan_b"), "id_b").where("NOT coalesce(pan_a <> pan_b, false)")
    new = both.join(merges.where("decision = 'MERGE'"), ["id_a", "id_b"], "left_anti")
    return new.select("id_a", "id_b", F.lit("PRIOR_LINK").alias("rule"), F.lit("MERGE").alias("decision"), F.lit(MERGES["PRIOR_LINK"]).alias("score"))


def components(nodes: DataFrame, edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """(node, label): the smallest node of each connected component, over edges (a, b).

    Alternating large-star and small-star steps, until every link is one from a node to its smallest: rounds grow with the
    logarithm of a component's size, whatever the order of its nodes.  Lineage is cut by tables in the cluster's shared folder.
    Components that aren't stable after the last round are an error.
    """

    def star(links: DataFrame, large: bool) -> DataFrame:
        ends = links.unionByName(links.select(F.col("y").alias("x"), F.col("x").alias("y"))) if large else links
        near = ends.join(ends.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m")), "x")
        to = near.where("y > x").select(F.col("y").alias("x"), F.col("m").alias("y")) if large else near.select("x", F.col("m").alias("y")).unionByName(near.select(F.col("y").alias("x"), F.col("m").alias("y")))
        return cut(to.where("x > y").distinct())

    def stable(links: DataFrame) -> bool:
        ends = links.groupBy("x").agg(F.min("y").alias("low"), F.max("y").alias("high"))
        loose = ends.where("low < high").select("x").unionByName(ends.join(links.select(F.col("y").alias("x")), "x", "left_semi").select("x"))
        return not loose.limit(1).count()

    nodes = cut(nodes.select("node"))
    known = edges.join(nodes.withColumnRenamed("node", "a"), "a", "left_semi").join(nodes.withColumnRenamed("node", "b"), "b", "left_semi")
    links = cut(known.where("a <> b").select(F.greatest("a", "b").alias("x"), F.least("a", "b").alias("y")).distinct())
    for _ in range(most_rounds):
        if stable(links):
            return cut(nodes.join(links.withColumnRenamed("x", "node"), "node", "left").select("node", F.coalesce("y", "node").alias("label")))
        links = star(star(links, True), False)
    raise RuntimeError(f"components not stable after {most_rounds} rounds")


def assign(labels: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """(node, label, party_id, previous_party_id): a cluster claims its smallest earlier id; of several claimants the one with the
    smallest label keeps it; others get an id from their label."""
    fresh = F.concat(F.lit("P"), F.upper(F.substring(F.sha2("label", 256), 1, 12)))
    if previous is None:
        return labels.select("node", "label", fresh.alias("party_id"), F.lit(None).cast("string").alias("previous_party_id"))
    old = previous.select(F.col("candidate_id").alias("node"), F.col("party_id").alias("old_id"))
    known = labels.join(old, "node", "left")
    claims = known.groupBy("label").agg(F.min("old_id").alias("claim")).where("claim IS NOT NULL")
    kept = claims.groupBy("claim").agg(F.min("label").alias("label")).select("label", F.col("claim").alias("kept"))
    named = known.join(kept, "label", "left").withColumn("party_id", F.coalesce("kept", fresh))
    return named.select("node", "label", "party_id", F.when(F.col("old_id") != F.col("party_id"), F.col("old_id")).alias("previous_party_id"))


def best_rule(xref: DataFrame, pairs: DataFrame) -> DataFrame:
    """Of each record the strongest rule that merged it; SINGLETON where none did."""
    merged = pairs.where("decision = 'MERGE'")
    ends = merged.select(F.col("id_a").alias("node"), "rule", "score").unionByName(merged.select(F.col("id_b").alias("node"), "rule", "score"))
    rank = F.lit(4)
    for name, place in RULE_ORDER.items():
        rank = F.when(F.col("rule") == name, place).otherwise(rank)
    best = latest(ends, ["node"], [rank, F.desc("score"), F.col("rule")])
    return xref.join(best, "node", "left").withColumns({"match_rule": F.coalesce("rule", F.lit("SINGLETON")), "match_score": F.coalesce("score", F.lit(1.0))}).drop("rule", "score")


def survive(values: DataFrame, attributes: list[str]) -> DataFrame:
    """Rows (party_id, attribute, value, o1, o2, o3, src_system, src_key) -> one row a party with each attribute's best value and where
    it came from. Each attribute survives by itself: smallest (o1, o2, o3), then source."""
    order = [F.col(c) for c in ("o1", "o2", "o3", "src_system", "src_key")]
    best = latest(values.where("value IS NOT NULL"), ["party_id", "attribute"], order)
    wide = best.groupBy("party_id").pivot("attribute", attributes).agg(F.first("value"))
    origin = best.groupBy("party_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("attribute", F.concat_ws(":", "src_system", "src_key"))))).alias("attribute_sources"))
    return wide.join(origin, "party_id")


def rollup(members: DataFrame) -> DataFrame:
    """Per party: its systems, members, ids, and whether its records have several PANs."""
    return members.groupBy("party_id").agg(
        F.array_join(F.array_sort(F.collect_set("src_system")), ",").alias("source_systems"),
        F.count("*").alias("member_count"),
        F.array_join(F.array_sort(F.collect_list("src_key")), ",").alias("source_keys"),
        (F.countDistinct("pan_std") > 1).alias("has_pan_conflict"),
    )


def quality(found: DataFrame, truth: DataFrame) -> DataFrame:
    """Pairwise precision and recall of (node, party_id) against (node, person), from group sizes instead of pairs."""
    both = found.join(truth, "node")
    pairs = lambda keys: both.groupBy(*keys).count().agg(F.coalesce(F.sum(F.expr("count * (count - 1) / 2")), F.lit(0.0)).alias("n"))
    hit, said, real = pairs(["party_id", "person"]).toDF("hit"), pairs(["party_id"]).toDF("said"), pairs(["person"]).toDF("real")
    split = both.groupBy("person").agg(F.countDistinct("party_id").alias("n")).agg(F.count_if(F.col("n") > 1).alias("split_persons"))
    merged = both.groupBy("party_id").agg(F.countDistinct("person").alias("n")).agg(F.count_if(F.col("n") > 1).alias("merged_parties"))
    one = hit.crossJoin(said).crossJoin(real).crossJoin(split).crossJoin(merged)  # single rows
    return one.select(F.when(F.col("said") > 0, F.col("hit") / F.col("said")).otherwise(1.0).alias("precision"), F.when(F.col("real") > 0, F.col("hit") / F.col("real")).otherwise(1.0).alias("recall"), "split_persons", "merged_parties")
