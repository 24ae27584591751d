"""Type-2 history as a pure function: yesterday's versions and today's rows give today's versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .relational import record_hash

OPEN = "9999-12-31"
META = ["version", "effective_from", "effective_to", "is_current", "change_reason", "end_reason", "changed_attributes", "_hash"]


def first(rows: DataFrame, keys: list[str], tracked: list[str], day: str) -> DataFrame:
    return _keyed(_opened(rows.withColumn("_hash", record_hash([F.col(c) for c in tracked])), F.lit(1), F.lit(day).cast("date"), F.lit("NEW"), F.array().cast("array<string>")), keys, rows.columns)


def _opened(df: DataFrame, version: Column, day: Column, reason: Column, changed: Column) -> DataFrame:
    return df.withColumns({"version": version.cast("int"), "effective_from": day, "effective_to": F.lit(OPEN).cast("date"), "is_current": F.lit(True), "change_reason": reason, "end_reason": F.lit(None).cast("string"), "changed_attributes": changed})


def _keyed(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    return df.select(F.xxhash64(*keys, "version").alias("surrogate_key"), *columns, *META)


def differing(tracked: list[str], a: str, b: str) -> Column:
    return F.array_compact(F.array(*[F.when(~F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")), F.lit(c)) for c in tracked]))


def step(history: DataFrame | None, rows: DataFrame, keys: list[str], tracked: list[str], day: str, held: DataFrame | None = None) -> DataFrame:
    """The whole history after ``day``.

    New keys open version 1; a key closed earlier reappears with its next version; changed attributes close the open version the day
    before and open the next, or restate it if it opened the same day; equal rows change nothing, untracked columns included; keys
    that are gone close the day before unless they are ``held`` (their row is in quarantine).  History only goes
    forward: a version from after ``day`` fails the job that reads the result.  A caller that takes many steps stores each one.
    """
    if history is None:
        return first(rows, keys, tracked, day)
    columns = rows.columns
    ahead = F.col("effective_from") > F.lit(day).cast("date")
    history = history.where(F.coalesce(F.when(ahead, F.raise_error(F.lit(f"history already goes beyond {day}")).cast("boolean")), F.lit(True)))
    today, before = F.lit(day).cast("date"), F.date_sub(F.lit(day).cast("date"), 1)
    cur = rows.withColumn("_hash", record_hash([F.col(c) for c in tracked]))
    opened, closed = history.where("is_current").drop("surrogate_key"), history.where("NOT is_current").drop("surrogate_key")
    last = closed.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc("version")))).where("_rn = 1").drop("_rn")
    waiting = (held.select(*keys).distinct() if held is not None else rows.select(*keys).limit(0)).withColumn("_held", F.lit(True))
    on = lambda a, b: reduce(lambda x, y: x & y, [F.col(f"{a}.{k}").eqNullSafe(F.col(f"{b}.{k}")) for k in keys])
    joined = cur.alias("c").join(opened.alias("o"), on("c", "o"), "full_outer")
    key = {k: F.coalesce(F.col(f"c.{k}"), F.col(f"o.{k}")) for k in keys}
    joined = joined.join(last.alias("h"), reduce(lambda x, y: x & y, [key[k].eqNullSafe(F.col(f"h.{k}")) for k in keys]), "left")
    joined = joined.join(waiting.alias("w"), reduce(lambda x, y: x & y, [key[k].eqNullSafe(F.col(f"w.{k}")) for k in keys]), "left")
    has_c, has_o, has_h = (F.col(f"{a}._hash").isNotNull() for a in "coh")
    same = F.col("c._hash") == F.col("o._hash")
    same_day = F.col("o.effective_from") == today
    case = (
        F.when(has_c & has_o & same, "same")
        .when(has_c & has_o & same_day, "restate")
        .when(has_c & has_o, "roll")
        .when(has_c & has_h, "again")
        .when(has_c, "new")
        .when(F.coalesce(F.col("w._held"), F.lit(False)), "same")
        .otherwise("gone")
    )
    names = [*columns, *META]
    old = F.struct(*[F.col(f"o.{c}").alias(c) for c in names])

    def fresh(version: Column, start: Column, reason: Column, changed: Column) -> Column:
        meta = [version.cast("int"), start, F.lit(OPEN).cast("date"), F.lit(True), reason, F.lit(None).cast("string"), changed, F.col("c._hash")]
        return F.struct(*[F.col(f"c.{c}").alias(c) for c in columns], *[m.alias(n) for m, n in zip(meta, META, strict=True)])

    def shut(reason: str) -> Column:
        replaced = {"effective_to": before, "is_current": F.lit(False), "end_reason": F.lit(reason)}
        return F.struct(*[replaced.get(c, F.col(f"o.{c}")).alias(c) for c in names])

    nothing = F.array().cast("array<string>")
    versions = (
        F.when(case == "same", F.array(old))
        .when(case == "restate", F.array(fresh(F.col("o.version"), F.col("o.effective_from"), F.coalesce(F.col("o.change_reason"), F.lit("CHANGED")), F.col("o.changed_attributes"))))
        .when(case == "roll", F.array(shut("SUPERSEDED"), fresh(F.col("o.version") + 1, today, F.lit("CHANGED"), differing(tracked, "c", "o"))))
        .when(case == "again", F.array(fresh(F.col("h.version") + 1, today, F.lit("REAPPEARED"), differing(tracked, "c", "h"))))
        .when(case == "new", F.array(fresh(F.lit(1), today, F.lit("NEW"), nothing)))
        .otherwise(F.array(shut("REMOVED_AT_SOURCE")))
    )
    out = joined.select(F.explode(versions).alias("v")).select("v.*").unionByName(closed.select(*names))
    return _keyed(out, keys, columns)
