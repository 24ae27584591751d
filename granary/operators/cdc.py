"""Change data capture: images of events, newest state in source time, exceptions, and the merge into a state table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.typing import typed
from .relational import latest


def images(events: DataFrame, target: dict, payload: str = "payload") -> DataFrame:
    """Typed rows of one table's events: the image before for d, after for c and u; source time and position as columns.

    A payload is parsed once, whatever the table's columns.
    """
    image = "struct<" + ",".join(f"`{c['name']}`:string" for c in target["columns"]) + ">"
    parsed = events.withColumn("_event", F.from_json(payload, f"op string, ts_ms string, source struct<table:string,file:string,pos:string>, before {image}, after {image}"))
    at = lambda path: F.col(f"_event.{path}")
    op = at("op")
    rows = parsed.where(at("source.table") == target["table"])
    values = {c["name"]: typed(F.when(op == "d", at(f"before.`{c['name']}`")).otherwise(at(f"after.`{c['name']}`")), c.get("type", "string"), c.get("formats")) for c in target["columns"]}
    return rows.withColumns(
        values
        | {
            "_src_op": op,
            "_ts_ms": at("ts_ms").try_cast("bigint"),
            "_src_ts": F.timestamp_millis(at("ts_ms").try_cast("bigint")),
            "_pos": at("source.pos").try_cast("bigint"),
            "_src_position": F.concat_ws(":", at("source.file"), at("source.pos")),
            "_is_deleted": op == "d",
        }
    ).drop("_event")


def resent(changes: DataFrame, row: str = "_source_row") -> tuple[DataFrame, DataFrame]:
    """(first of each position, exceptions for the others)."""
    ranked = changes.withColumn("_rn", F.row_number().over(Window.partitionBy("_src_position").orderBy(row)))
    again = ranked.where("_rn > 1").drop("_rn").withColumns({"exception": F.lit("DUPLICATE_EVENT"), "action": F.lit("DEDUPED")})
    return ranked.where("_rn = 1").drop("_rn"), again


def out_of_order(changes: DataFrame, keys: list[str], row: str = "_source_row", time: list[str] | None = None) -> DataFrame:
    """Events whose place in the file isn't their place in source time; they are used all the same."""
    by_file = F.row_number().over(Window.partitionBy(*keys).orderBy(row))
    by_time = F.row_number().over(Window.partitionBy(*keys).orderBy(*(time or ["_ts_ms", "_pos"])))
    moved = changes.withColumns({"_by_file": by_file, "_by_time": by_time}).where("_by_file <> _by_time")
    return moved.drop("_by_file", "_by_time").withColumns({"exception": F.lit("OUT_OF_ORDER"), "action": F.lit("APPLIED_BY_TS")})


def newest(changes: DataFrame, keys: list[str]) -> DataFrame:
    return latest(changes, keys, [F.desc("_ts_ms"), F.desc("_pos")])


def merge_exceptions(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """What a merge of source will do with late and unknown events; to be taken before the merge."""
    known = target.select(*keys, F.col("_src_ts").alias("_known_ts"), F.lit(True).alias("_known"))
    both = source.join(known, keys, "left")
    code = (
        F.when(F.col("_known") & (F.col("_src_ts") < F.col("_known_ts")), F.struct(F.lit("STALE_EVENT").alias("exception"), F.lit("IGNORED").alias("action")))
        .when(F.col("_known").isNull() & (F.col("_src_op") == "d"), F.struct(F.lit("DELETE_UNKNOWN_KEY").alias("exception"), F.lit("IGNORED").alias("action")))
        .when(F.col("_known").isNull() & (F.col("_src_op") == "u"), F.struct(F.lit("UPSERT_UNKNOWN_KEY").alias("exception"), F.lit("INSERTED").alias("action")))
    )
    return both.withColumn("_x", code).where("_x IS NOT NULL").select("*", "_x.exception", "_x.action").drop("_x", "_known", "_known_ts")


def merge(target: DataFrame, source: DataFrame, keys: list[str], keep: tuple[str, ...] = ("_first_batch_id",)) -> DataFrame:
    """The target after an upsert by source time and content.

    Matched: all columns but ``keep`` are the source's where its time isn't older and its hash differs (a missing time never
    updates); the hash must cover the deletion flag. Unmatched source rows are inserted unless deleted. One full outer join; running it again changes nothing.
    """
    t, s = target.alias("t"), source.alias("s")
    joined = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    in_target, in_source = F.col("t._record_hash").isNotNull(), F.col("s._record_hash").isNotNull()
    update = in_target & in_source & (F.col("s._src_ts") >= F.col("t._src_ts")) & (F.col("s._record_hash") != F.col("t._record_hash"))
    insert = ~in_target & in_source & ~F.coalesce(F.col("s._is_deleted"), F.lit(False))
    take = F.coalesce(update, F.lit(False)) | insert

    def value(c: str) -> Column:
        if c in keep:
            return F.when(in_target, F.col(f"t.{c}")).otherwise(F.col(f"s.{c}"))
        return F.when(take, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}"))

    return joined.where(in_target | insert).select(*[value(c).alias(c) for c in target.columns])
