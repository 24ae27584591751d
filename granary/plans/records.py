"""Contracts, quarantine, deduplication, change capture and merge on the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import cdc, contract
from ..operators.relational import duplicates, latest
from .registry import Registry

_r = Registry()
QUERIES, ORACLES, add = _r.queries, _r.oracles, _r.add

ORDER_CONTRACT = {
    "entity": "orders",
    "key": ["o_orderkey"],
    "columns": [
        {"name": "o_orderkey", "type": "bigint", "required": True},
        {"name": "o_custkey", "type": "int", "required": True},
        {"name": "o_totalprice", "type": "decimal", "min": 1000.0},
        {"name": "o_orderdate", "type": "date", "required": True, "formats": ["yyyy-MM-dd"]},
        {"name": "o_orderstatus", "type": "string", "allowed": ["F", "O"], "severity": "warn"},
        {"name": "o_orderpriority", "type": "string", "pattern": "^[1-4]-", "severity": "reject"},
    ],
}
#: The same rows as text with planted faults, as the contract meets them: first for Spark, then for the oracle.
_TEXT_SQL = """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN ' ' WHEN o_orderkey % 13 = 0 THEN 'abc' ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey,
    CASE WHEN o_orderkey % 17 = 0 THEN 'N/A' ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) END AS o_totalprice, CASE WHEN o_orderkey % 19 = 0 THEN '1985-02-30' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS o_orderdate, o_orderstatus, o_orderpriority FROM orders"""
_REASONS_SQL = f"""SELECT o_orderkey, list_filter([CASE WHEN trim(o_custkey) = '' THEN 'o_custkey:REQUIRED' END, CASE WHEN o_custkey = 'abc' THEN 'o_custkey:NOT_INTEGER' END, CASE WHEN o_totalprice = 'N/A' THEN 'o_totalprice:NOT_DECIMAL' END,
    CASE WHEN TRY_CAST(o_totalprice AS DOUBLE) < 1000 THEN 'o_totalprice:BELOW_MIN' END, CASE WHEN o_orderdate = '1985-02-30' THEN 'o_orderdate:INVALID_DATE' END, CASE WHEN NOT regexp_matches(o_orderpriority, '^[1-4]-') THEN 'o_orderpriority:PATTERN' END], lambda x: x IS NOT NULL) AS reasons,
    CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'o_orderstatus:NOT_ALLOWED' ELSE '' END AS warnings FROM ({_TEXT_SQL}) x"""


def order_text(t):
    key = F.col("o_orderkey")
    return t("orders").select(
        key.cast("string").alias("o_orderkey"),
        F.when(key % 11 == 0, " ").when(key % 13 == 0, "abc").otherwise(F.col("o_custkey").cast("string")).alias("o_custkey"),
        F.when(key % 17 == 0, "N/A").otherwise(F.col("o_totalprice").cast("decimal(18,2)").cast("string")).alias("o_totalprice"),
        F.when(key % 19 == 0, "1985-02-30").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("o_orderdate"),
        "o_orderstatus",
        "o_orderpriority",
    )


@add(f"SELECT o_orderkey, array_to_string(reasons, ',') AS reasons, warnings FROM ({_REASONS_SQL}) r")
def contract_validate(t):
    return contract.validate(order_text(t), ORDER_CONTRACT).select("o_orderkey", F.array_join(F.col("_reject_reasons"), ",").alias("reasons"), F.array_join(F.col("_warnings"), ",").alias("warnings"))


@add(f"SELECT CASE WHEN len(reasons) = 0 THEN 'accepted' ELSE 'quarantined' END AS side, COUNT(*) AS row_count FROM ({_REASONS_SQL}) r GROUP BY 1")
def quarantine_split(t):
    good, bad = contract.split(contract.validate(order_text(t), ORDER_CONTRACT))
    both = good.select(F.lit("accepted").alias("side")).unionByName(bad.select(F.lit("quarantined").alias("side")))
    return both.groupBy("side").agg(F.count("*").alias("row_count"))


@add(f"SELECT reason, COUNT(*) AS count FROM (SELECT unnest(reasons) AS reason FROM ({_REASONS_SQL}) r) x GROUP BY reason ORDER BY count DESC, reason LIMIT 5")
def reject_reason_top5(t):
    return contract.top_reasons(contract.split(contract.validate(order_text(t), ORDER_CONTRACT))[1])


@add("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, COUNT(*) AS copies FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1")
def dup_in_batch(t):
    rows = t("lineitem").select(F.col("l_orderkey").cast("string").alias("l_orderkey"), F.col("l_linenumber").cast("string").alias("l_linenumber"))
    seen = contract.validate(rows, {"key": ["l_orderkey", "l_linenumber"], "columns": [{"name": "l_orderkey"}, {"name": "l_linenumber"}]})
    return seen.where(F.array_contains("_warnings", "DUPLICATE_IN_BATCH")).groupBy(F.col("l_orderkey").cast("long").alias("l_orderkey"), F.col("l_linenumber").cast("long").alias("l_linenumber")).agg(F.count("*").alias("copies"))


@add("SELECT c_custkey, sha256(CAST(c_custkey AS VARCHAR) || chr(1) || c_name || chr(1) || coalesce(CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END, chr(0))) AS record_hash FROM customer")
def record_hash(t):
    from ..operators.relational import record_hash as hashed

    rows = t("customer").withColumn("s", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")))
    return rows.select("c_custkey", hashed([F.col("c_custkey"), F.col("c_name"), F.col("s")]).alias("record_hash"))


@add("SELECT event_type AS file, 'j' AS field, COUNT(*) AS count FROM events WHERE event_id % 7 = 0 GROUP BY event_type")
def key_drift(t):
    text = F.when(F.col("event_id") % 7 == 0, F.regexp_replace("props", r"\{", '{"j": 1, ')).otherwise(F.col("props"))
    rows = t("events").select(F.col("event_type").alias("_source_file"), text.alias("payload"))
    return contract.json_key_drift(rows, ["k"]).select(F.col("_source_file").alias("file"), "field", "count")


@add("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) AS rn FROM lineitem) x WHERE rn = 1")
def dedup_first(t):
    return latest(t("lineitem"), ["l_orderkey", "l_linenumber"], [F.col(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")]).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@add("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) x WHERE rn = 1")
def dedup_latest(t):
    return latest(t("events"), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "event_type", "value")


#: Events as a change feed: signups create, errors delete, the rest update; the file order is a hash, every tenth event is sent again.
_CDC_SQL = """SELECT event_id, user_id, CASE event_type WHEN 'signup' THEN 'c' WHEN 'error' THEN 'd' ELSE 'u' END AS op, ts, value, sha256(CAST(event_id AS VARCHAR)) AS file_order, 'bin:' || CAST(event_id AS VARCHAR) AS pos FROM events"""
USER_CONTRACT = {"table": "users", "key": ["user_id"], "columns": [{"name": "user_id", "type": "bigint"}, {"name": "value", "type": "string"}]}


def change_events(t):
    """The feed as JSON payloads with _source_row in file order."""
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    image = F.struct("user_id", F.col("value").cast("string").alias("value"))
    payload = F.to_json(
        F.struct(
            op.alias("op"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("ts_ms"),
            F.struct(F.lit("users").alias("table"), F.lit("bin").alias("file"), F.col("event_id").alias("pos")).alias("source"),
            F.when(op == "d", image).alias("before"),
            F.when(op != "d", image).alias("after"),
        )
    )
    rows = t("events").select("event_id", F.sha2(F.col("event_id").cast("string"), 256).alias("_source_row"), payload.alias("payload"))
    again = rows.where(F.col("event_id") % 10 == 0).withColumn("_source_row", F.concat(F.lit("z"), "_source_row"))
    return cdc.images(rows.unionByName(again), USER_CONTRACT)


@add(f"SELECT user_id, value, op, event_id AS pos FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) DESC, event_id DESC) AS rn FROM ({_CDC_SQL}) c) x WHERE rn = 1")
def cdc_latest_state(t):
    first, _ = cdc.resent(change_events(t))
    return cdc.newest(first, ["user_id"]).select("user_id", F.col("value").cast("double").alias("value"), F.col("_src_op").alias("op"), F.col("_pos").alias("pos"))


@add("SELECT event_id, 'DUPLICATE_EVENT' AS exception FROM events WHERE event_id % 10 = 0")
def cdc_duplicate(t):
    return cdc.resent(change_events(t))[1].select("event_id", "exception")


@add(f"SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY file_order) AS a, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts), event_id) AS b FROM ({_CDC_SQL}) c) x WHERE a <> b")
def cdc_out_of_order(t):
    return cdc.out_of_order(cdc.resent(change_events(t))[0], ["user_id"]).select("event_id")


def _state(t):
    """A state table of users with odd ids, as of the middle of the month."""
    rows = t("events").where(F.col("user_id") % 2 == 1).groupBy("user_id").agg(F.lit("state").alias("value"))
    return rows.select("user_id", "value", F.to_timestamp(F.lit("2024-01-20 00:00:00")).alias("_src_ts"), F.sha2(F.lit("state"), 256).alias("_record_hash"), F.lit(False).alias("_is_deleted"), F.lit("B1").alias("_first_batch_id"))


def _source(t):
    """The newest event a user up to the 20th for a third of the users, up to the month's end for the others."""
    early = cdc.resent(change_events(t))[0].where((F.col("user_id") % 3 != 0) | (F.col("_src_ts") < F.to_timestamp(F.lit("2024-01-20 00:00:00"))))
    new = cdc.newest(early, ["user_id"])
    return new.select("user_id", "value", "_src_ts", "_src_op", F.sha2("value", 256).alias("_record_hash"), "_is_deleted", F.lit("B2").alias("_first_batch_id"))


_SOURCE_SQL = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY epoch_ms(ts) DESC, event_id DESC) AS rn FROM ({_CDC_SQL}) c WHERE user_id % 3 <> 0 OR epoch_ms(ts) < epoch_ms(TIMESTAMP '2024-01-20')) x WHERE rn = 1"


@add(f"SELECT user_id, 'STALE_EVENT' AS exception, 'IGNORED' AS action FROM ({_SOURCE_SQL}) s WHERE user_id % 2 = 1 AND epoch_ms(ts) < epoch_ms(TIMESTAMP '2024-01-20')")
def cdc_stale(t):
    return cdc.merge_exceptions(_source(t), _state(t), ["user_id"]).where("exception = 'STALE_EVENT'").select("user_id", "exception", "action")


@add(f"SELECT user_id, CASE op WHEN 'd' THEN 'DELETE_UNKNOWN_KEY' ELSE 'UPSERT_UNKNOWN_KEY' END AS exception, CASE op WHEN 'd' THEN 'IGNORED' ELSE 'INSERTED' END AS action FROM ({_SOURCE_SQL}) s WHERE user_id % 2 = 0 AND op <> 'c'")
def cdc_unknown_key(t):
    return cdc.merge_exceptions(_source(t), _state(t), ["user_id"]).where("exception <> 'STALE_EVENT'").select("user_id", "exception", "action")


_MERGED_SQL = f"""SELECT coalesce(b.user_id, s.user_id) AS user_id, CASE WHEN b.user_id IS NULL OR epoch_ms(s.ts) >= epoch_ms(TIMESTAMP '2024-01-20') THEN CAST(s.value AS DOUBLE) END AS value,
    CASE WHEN b.user_id IS NULL OR epoch_ms(s.ts) >= epoch_ms(TIMESTAMP '2024-01-20') THEN s.op = 'd' ELSE false END AS is_deleted, CASE WHEN b.user_id IS NULL THEN 'B2' ELSE 'B1' END AS first_batch
    FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 2 = 1) b FULL JOIN ({_SOURCE_SQL}) s ON s.user_id = b.user_id WHERE b.user_id IS NOT NULL OR s.op <> 'd'"""


def _shown(df):
    return df.select("user_id", F.col("value").try_cast("double").alias("value"), F.col("_is_deleted").alias("is_deleted"), F.col("_first_batch_id").alias("first_batch"))


@add(_MERGED_SQL)
def merge_upsert(t):
    return _shown(cdc.merge(_state(t), _source(t), ["user_id"]))


@add(_MERGED_SQL)
def merge_idempotent(t):
    """The same merge twice changes nothing the second time."""
    return _shown(cdc.merge(cdc.merge(_state(t), _source(t), ["user_id"]), _source(t), ["user_id"]))


@add("SELECT COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS left_out FROM lineitem")
def dedup_left_out(t):
    rows = t("lineitem")
    return duplicates(rows, ["l_orderkey", "l_linenumber"], [F.col(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate")]).agg(F.count("*").alias("left_out"))


@add("SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'at:INVALID_TIMESTAMP' WHEN event_id % 5 = 0 THEN 'at:REQUIRED' ELSE '' END AS reasons FROM events")
def timestamp_contract(t):
    at = F.when(F.col("event_id") % 9 == 0, "2024-02-30 10:00:00").when(F.col("event_id") % 5 == 0, " ").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rows = t("events").select("event_id", at.alias("at"))
    return contract.validate(rows, {"columns": [{"name": "at", "type": "timestamp", "required": True}]}).select("event_id", F.array_join("_reject_reasons", ",").alias("reasons"))


@add("""SELECT event_id, CASE event_type WHEN 'error' THEN CASE WHEN user_id % 4 = 0 THEN 'before.user_id:REQUIRED' ELSE '' END ELSE array_to_string(list_filter([CASE WHEN user_id % 4 = 0 THEN 'after.user_id:REQUIRED' END, CASE WHEN event_id % 6 = 0 THEN 'after.value:NOT_DECIMAL' END], lambda x: x IS NOT NULL), ',') END AS reasons FROM events""")
def image_contract(t):
    """Change events whose images break the target's contract: after it for c and u, the key before for d."""
    target = {"table": "users", "key": ["user_id"], "columns": [{"name": "user_id", "type": "bigint", "required": True}, {"name": "value", "type": "decimal"}]}
    op = F.when(F.col("event_type") == "signup", "c").when(F.col("event_type") == "error", "d").otherwise("u")
    image = F.struct(F.when(F.col("user_id") % 4 != 0, F.col("user_id")).alias("user_id"), F.when(F.col("event_id") % 6 == 0, "N/A").otherwise(F.col("value").cast("string")).alias("value"))
    rows = t("events").select("event_id", op.alias("op"), F.to_json(F.struct(F.when(op == "d", image).alias("before"), F.when(op != "d", image).alias("after"))).alias("payload"))
    checks = contract.image_checks({}, F.col("payload"), F.col("op"), F.lit("users"), target)
    return contract.validate(rows, {"columns": [{"name": "op"}]}, checks).select("event_id", F.array_join("_reject_reasons", ",").alias("reasons"))


@add(f"SELECT t.o_orderkey, t.o_custkey, t.o_totalprice, t.o_orderdate FROM ({_TEXT_SQL}) t JOIN ({_REASONS_SQL}) r USING (o_orderkey) WHERE len(reasons) > 0")
def quarantined_record(t):
    """What the quarantine keeps of a record: its text as it came."""
    bad = contract.split(contract.validate(order_text(t), ORDER_CONTRACT))[1]
    return bad.select(*[F.get_json_object("_record", f"$.{c}").alias(c) for c in ("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")])
