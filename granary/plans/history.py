"""Type-2 history, as-of joins, star joins and snapshot queries on the driver's tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import relational, scd2, store
from . import consumers
from .registry import Registry

_r = Registry()
QUERIES, ORACLES, add = _r.queries, _r.oracles, _r.add

#: A customer's state on a month's last day: status and priority of the latest order placed in that month.
MONTHS = ("1995-01", "1995-02", "1995-03", "1995-04", "1995-05", "1995-06")
_DAYS = {m: d for m, d in zip(MONTHS, ("1995-01-31", "1995-02-28", "1995-03-31", "1995-04-30", "1995-05-31", "1995-06-30"), strict=True)}
_SNAP_SQL = """SELECT o_custkey AS cust, strftime(o_orderdate, '%Y-%m') AS month, o_orderstatus AS status, o_orderpriority AS priority FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey, strftime(o_orderdate, '%Y-%m') ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders WHERE o_orderdate >= TIMESTAMP '1995-01-01' AND o_orderdate < TIMESTAMP '1995-07-01') x WHERE rn = 1"""
#: Versions without the step function: runs of equal states among months; a month without an order closes.
_HISTORY_SQL = f"""
    WITH s AS (SELECT cust, CAST(CAST(substr(month, 6) AS INTEGER) AS BIGINT) AS m, status, priority FROM ({_SNAP_SQL}) q),
    marked AS (SELECT *, CASE WHEN lag(m) OVER w = m - 1 AND lag(status) OVER w = status AND lag(priority) OVER w = priority THEN 0 ELSE 1 END AS fresh, lag(m) OVER w AS prior_m, lag(status) OVER w AS prior_status, lag(priority) OVER w AS prior_priority FROM s WINDOW w AS (PARTITION BY cust ORDER BY m)),
    numbered AS (SELECT *, sum(fresh) OVER (PARTITION BY cust ORDER BY m) AS version FROM marked),
    runs AS (SELECT cust, version, min(m) AS m_from, max(m) AS m_to, any_value(status) AS status, any_value(priority) AS priority, max(CASE WHEN fresh = 1 THEN CASE WHEN prior_m IS NULL THEN 'NEW' WHEN prior_m = m - 1 THEN 'CHANGED' ELSE 'REAPPEARED' END END) AS change_reason FROM numbered GROUP BY cust, version),
    ends AS (SELECT *, lead(m_from) OVER (PARTITION BY cust ORDER BY version) AS next_from FROM runs)
    SELECT cust, CAST(version AS INTEGER) AS version, status, priority, last_day(make_date(1995, CAST(m_from AS INTEGER), 1)) AS effective_from,
        CASE WHEN m_to = 6 THEN DATE '9999-12-31' ELSE CAST(last_day(make_date(1995, CAST(m_to AS INTEGER) + 1, 1)) - INTERVAL 1 DAY AS DATE) END AS effective_to, change_reason,
        CASE WHEN m_to = 6 THEN NULL WHEN next_from = m_to + 1 THEN 'SUPERSEDED' ELSE 'REMOVED_AT_SOURCE' END AS end_reason FROM ends"""


def _snapshot(t, month: str) -> DataFrame:
    first = F.lit(f"{month}-01").cast("date")  # a range that reaches the scan
    orders = t("orders").where((F.col("o_orderdate") >= first.cast("timestamp_ntz")) & (F.col("o_orderdate") < F.add_months(first, 1).cast("timestamp_ntz")))
    return relational.latest(orders, ["o_custkey"], [F.desc("o_orderdate"), F.desc("o_orderkey")]).select(F.col("o_custkey").alias("cust"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))


def _history(t) -> DataFrame:
    return reduce(lambda h, m: relational.cut(scd2.step(h, _snapshot(t, m), ["cust"], ["status", "priority"], _DAYS[m])), MONTHS, None)


@add(_HISTORY_SQL)
def scd2_history(t):
    return _history(t).select("cust", "version", "status", "priority", "effective_from", "effective_to", "change_reason", "end_reason")


@add(f"SELECT cust, version, effective_from FROM ({_HISTORY_SQL}) h WHERE change_reason = 'REAPPEARED'")
def scd2_reappear(t):
    return _history(t).where("change_reason = 'REAPPEARED'").select("cust", "version", "effective_from")


@add(f"SELECT cust, version, effective_to FROM ({_HISTORY_SQL}) h WHERE end_reason = 'REMOVED_AT_SOURCE'")
def scd2_removed(t):
    return _history(t).where("end_reason = 'REMOVED_AT_SOURCE'").select("cust", "version", "effective_to")


@add(f"SELECT cust, 1 AS version, 'X' || status AS status, DATE '1995-01-31' AS effective_from, 'NEW' AS change_reason FROM ({_SNAP_SQL}) s WHERE month = '1995-01'")
def scd2_restate(t):
    """The same day again with other values: versions are restated in place."""
    first = scd2.step(None, _snapshot(t, "1995-01"), ["cust"], ["status", "priority"], "1995-01-31")
    again = _snapshot(t, "1995-01").withColumn("status", F.concat(F.lit("X"), "status"))
    return scd2.step(first, again, ["cust"], ["status", "priority"], "1995-01-31").select("cust", "version", "status", "effective_from", "change_reason")


@add(f"""SELECT a.cust, array_to_string(list_filter([CASE WHEN a.status <> b.status THEN 'status' END, CASE WHEN a.priority <> b.priority THEN 'priority' END], lambda x: x IS NOT NULL), ',') AS changed FROM ({_SNAP_SQL}) a JOIN ({_SNAP_SQL}) b ON a.cust = b.cust AND a.month = '1995-01' AND b.month = '1995-02'
    WHERE a.status <> b.status OR a.priority <> b.priority""")
def scd2_changed(t):
    """What made a key's next version."""
    first = scd2.step(None, _snapshot(t, "1995-01"), ["cust"], ["status", "priority"], "1995-01-31")
    second = scd2.step(first, _snapshot(t, "1995-02"), ["cust"], ["status", "priority"], "1995-02-28")
    return second.where("change_reason = 'CHANGED'").select("cust", F.array_join("changed_attributes", ",").alias("changed"))


@add(f"SELECT cust, CASE WHEN cust % 2 = 0 THEN NULL ELSE 'REMOVED_AT_SOURCE' END AS end_reason FROM ({_SNAP_SQL}) s WHERE month = '1995-01'")
def scd2_held(t):
    """Nothing arrives on the second day; keys in quarantine stay open."""
    first = scd2.step(None, _snapshot(t, "1995-01"), ["cust"], ["status", "priority"], "1995-01-31")
    held = _snapshot(t, "1995-01").where("cust % 2 = 0")
    return scd2.step(first, _snapshot(t, "1995-01").where("false"), ["cust"], ["status", "priority"], "1995-02-28", held).select("cust", "end_reason")


@add(f"""SELECT o.o_orderkey, h.version, h.status FROM orders o LEFT JOIN ({_HISTORY_SQL}) h ON h.cust = o.o_custkey AND h.effective_from <= CAST(o.o_orderdate AS DATE) AND h.effective_to >= CAST(o.o_orderdate AS DATE)
    WHERE o.o_orderdate >= TIMESTAMP '1995-03-01' AND o.o_orderdate < TIMESTAMP '1995-08-01'""")
def asof_version_join(t):
    facts = t("orders").where("o_orderdate >= TIMESTAMP_NTZ '1995-03-01 00:00:00' AND o_orderdate < TIMESTAMP_NTZ '1995-08-01 00:00:00'").select("o_orderkey", F.col("o_custkey").alias("cust"), F.col("o_orderdate").cast("date").alias("day"))
    return relational.join_as_of(facts, _history(t).select("cust", "version", "status", "effective_from", "effective_to"), "cust", "day").select("o_orderkey", "version", "status")


@add(f"SELECT status, COUNT(*) AS customers FROM ({_HISTORY_SQL}) h WHERE effective_from <= DATE '1995-04-15' AND effective_to >= DATE '1995-04-15' GROUP BY status")
def range_validity_join(t):
    return relational.as_of(_history(t), "1995-04-15").groupBy("status").agg(F.count("*").alias("customers"))


@add("""SELECT o_custkey AS party_id, o_orderkey AS account, 'PRIMARY' AS role FROM orders UNION ALL SELECT CAST(l_suppkey AS BIGINT), l_orderkey, 'JOINT' FROM (SELECT DISTINCT l_suppkey, l_orderkey FROM lineitem WHERE l_linenumber = 1) x
    UNION ALL SELECT o_custkey, o_orderkey, 'BORROWER' FROM orders WHERE o_orderpriority = '1-URGENT'""")
def bridge_roles(t):
    orders = t("orders").select(F.col("o_custkey").alias("party_id"), F.col("o_orderkey").alias("account"), "o_orderpriority")
    joint = t("lineitem").where("l_linenumber = 1").select(F.col("l_suppkey").alias("party_id"), F.col("l_orderkey").alias("account")).distinct()
    role = lambda df, name: df.select("party_id", "account", F.lit(name).alias("role"))
    return role(orders, "PRIMARY").unionByName(role(joint, "JOINT")).unionByName(role(orders.where("o_orderpriority = '1-URGENT'"), "BORROWER"))


@add("""SELECT r.r_name AS region, n.n_name AS nation, p.p_type AS product, CAST(EXTRACT(YEAR FROM l.l_shipdate) AS BIGINT) AS year, COUNT(*) AS lines, CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS amount
    FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN supplier s ON s.s_suppkey = l.l_suppkey JOIN nation n ON n.n_nationkey = s.s_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY 1, 2, 3, 4""")
def fact_star(t):
    lines = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey")).join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return lines.groupBy(F.col("r_name").alias("region"), F.col("n_name").alias("nation"), F.col("p_type").alias("product"), F.year("l_shipdate").cast("long").alias("year")).agg(F.count("*").alias("lines"), F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double").alias("amount"))


_BEFORE = "SELECT c_custkey, c_mktsegment, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_custkey % 10 <> 9"
_AFTER = "SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'MOVED' ELSE c_mktsegment END AS c_mktsegment, round(c_acctbal, 2) AS c_acctbal FROM customer WHERE c_custkey % 10 <> 8"


def _versions(t) -> store.Table:
    """A stored table of two versions: some rows change, go and come."""
    rows = t("customer").select("c_custkey", "c_mktsegment", F.round("c_acctbal", 2).alias("c_acctbal"))
    spark = rows.sparkSession
    table = store.Table(spark, relational.work_folder(spark, "customers"))
    table.create(rows.where("c_custkey % 10 <> 9"), batch="B1")
    table.overwrite(rows.where("c_custkey % 10 <> 8").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 7 == 0, "MOVED").otherwise(F.col("c_mktsegment"))), batch="B2")
    return table


@add(f"SELECT a.c_custkey, b.c_mktsegment AS old_c_mktsegment, a.c_mktsegment AS new_c_mktsegment FROM ({_BEFORE}) b JOIN ({_AFTER}) a USING (c_custkey) WHERE a.c_mktsegment IS DISTINCT FROM b.c_mktsegment")
def snapshot_diff(t):
    table = _versions(t)
    return store.difference(table.read(version=0), table.read(), ["c_custkey"], ["c_mktsegment"])


@add(f"SELECT c_custkey FROM ({_AFTER}) a WHERE c_custkey NOT IN (SELECT c_custkey FROM ({_BEFORE}) b)")
def parties_new(t):
    table = _versions(t)
    return table.read().join(table.read(batch="B1"), "c_custkey", "left_anti").select("c_custkey")


@add(f"SELECT 'before' AS version, c_custkey, c_mktsegment, c_acctbal FROM ({_BEFORE}) b WHERE c_custkey % 7 = 0 UNION ALL SELECT 'after', c_custkey, c_mktsegment, c_acctbal FROM ({_AFTER}) a WHERE c_custkey % 7 = 0")
def time_travel_union(t):
    table = _versions(t)
    shown = lambda df, name: df.where("c_custkey % 7 = 0").select(F.lit(name).alias("version"), "c_custkey", "c_mktsegment", "c_acctbal")
    return shown(table.read(version=0), "before").unionByName(shown(table.read(version=1), "after"))


@add("SELECT 'B1' AS batch_id, 'create' AS operation, CAST(NULL AS BIGINT) AS snapshot_before, CAST(0 AS BIGINT) AS snapshot_after UNION ALL SELECT 'B2', 'overwrite', 0, 1")
def batch_snapshots(t):
    return consumers.batch_snapshots(_versions(t)).select("batch_id", "operation", "snapshot_before", "snapshot_after")


@add(f"SELECT 'then' AS version, c_custkey, c_mktsegment, c_acctbal FROM ({_BEFORE}) b UNION ALL SELECT 'now', c_custkey, c_mktsegment, c_acctbal FROM ({_AFTER}) a")
def record_as_of_time(t):
    """Every record as it stood at a moment between two commits, and now."""
    table = _versions(t)
    commits = [r.committed_at for r in table.history().orderBy("version").select("committed_at").collect()]
    shown = lambda df, name: df.select(F.lit(name).alias("version"), "c_custkey", "c_mktsegment", "c_acctbal")
    return shown(table.read(timestamp=(commits[0] + commits[1]) / 2), "then").unionByName(shown(table.read(timestamp=commits[1]), "now"))


_COMPOSITION = "SELECT CAST(year(l_shipdate) AS BIGINT) AS reporting_date, CASE l_returnflag WHEN 'A' THEN 'SAVINGS' WHEN 'R' THEN 'CURRENT' ELSE 'TERM' END AS deposit_type, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem"


@add(f"SELECT reporting_date, CAST(sum(c) FILTER (deposit_type <> 'TERM') AS DOUBLE) / 100 AS casa_balance, CAST(sum(c) AS DOUBLE) / 100 AS deposits, round((CAST(sum(c) FILTER (deposit_type <> 'TERM') AS DOUBLE) / 100) / (CAST(sum(c) AS DOUBLE) / 100), 6) AS casa_ratio FROM ({_COMPOSITION}) x GROUP BY reporting_date")
def ratio_as_reported(t):
    """What a submitted dataset said before its balances were restated."""
    kind = F.when(F.col("l_returnflag") == "A", "SAVINGS").when(F.col("l_returnflag") == "R", "CURRENT").otherwise("TERM")
    rows = t("lineitem").groupBy(F.year("l_shipdate").cast("long").alias("reporting_date"), kind.alias("deposit_type")).agg(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("balance"))
    table = store.Table(rows.sparkSession, relational.work_folder(rows.sparkSession, "composition"))
    submitted = table.create(rows, batch="B1")
    table.overwrite(rows.withColumn("balance", F.when(F.col("deposit_type") == "TERM", F.col("balance") * 2).otherwise(F.col("balance"))), batch="B2")
    return consumers.ratio_as_reported(table, submitted)


@add("SELECT CAST(0 AS BIGINT) AS version, 'create' AS operation, 'B1' AS batch_id UNION ALL SELECT 1, 'overwrite', 'B2' UNION ALL SELECT 2, 'rollback', NULL")
def table_history(t):
    table = _versions(t)
    table.rollback(0)
    return table.history().select("version", "operation", "batch_id")
