"""Landing files written from the driver's tables and read back."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import relational
from ..ship import ship
from ..sources import readers, writers
from .registry import Registry

_r = Registry()
QUERIES, ORACLES, add = _r.queries, _r.oracles, _r.add


def landed(rows: DataFrame, lines: Callable[[Iterator[tuple]], Iterator[str]], folder: str) -> None:
    """One text file a partition of rows, from a function of its rows."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = lines(row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns], strict=True))
        while held := list(islice(out, 1000)):
            yield pa.RecordBatch.from_arrays([pa.array(held, pa.string())], ["value"])

    ship(rows.sparkSession)
    rows.mapInArrow(write, "value string").write.text(folder)


def _landed(rows: DataFrame, name: str, lines: Callable[[Iterator[tuple]], Iterator[str]]) -> str:
    """The pattern of the files in a new folder."""
    folder = relational.work_folder(rows.sparkSession, name)
    landed(rows, lines, folder)
    return f"{folder}/*.txt"


@add("SELECT doc_id, lang, source, length(text) AS chars, sha256(text) AS digest FROM documents")
def dump_round_trip(t):
    """Texts with every mark through extended INSERTs beside another table's."""
    rows = t("documents").select(F.col("doc_id").cast("string").alias("doc_id"), "lang", "source", "text")
    found = readers.read_dump(rows.sparkSession, _landed(rows, "dump", lambda v: writers.dump_lines({"other": (["z"], [(1,)])}, "doc", ["doc_id", "lang", "source", "text"], v)), "doc", ["text", "source", "doc_id", "lang"])
    return found.select(F.col("doc_id").cast("bigint").alias("doc_id"), "lang", "source", F.length("text").cast("bigint").alias("chars"), F.sha2("text", 256).alias("digest"))


def _order_lines(values):
    yield "o_orderkey|o_custkey|o_orderdate|o_totalprice|o_orderpriority"
    count, total = 0, 0
    for key, cust, day, cents, priority in values:
        count, total = count + 1, total + cents
        if count % 100 == 0:
            yield ""
        yield f"{key}|{'' if cust % 10 == 0 else cust}|{day}|{cents // 100}.{cents % 100:02d}|{priority}"
    yield f"T|{count}|{total // 100}.{total % 100:02d}"


def _extract(t) -> str:
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint").alias("cents")
    return _landed(t("orders").select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"), cents, "o_orderpriority"), "extract", _order_lines)


@add("SELECT o_orderkey, CASE WHEN o_custkey % 10 <> 0 THEN o_custkey END AS o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents, o_orderpriority, CAST(NULL AS VARCHAR) AS missing FROM orders")
def psv_round_trip(t):
    spark = t("orders").sparkSession
    found = readers.read_psv(spark, _extract(t), ["o_orderpriority", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "missing"])
    day = F.to_date("o_orderdate", "dd/MM/yyyy").alias("o_orderdate")
    return found.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.col("o_custkey").cast("bigint").alias("o_custkey"), day, (F.col("o_totalprice").cast("decimal(18,2)") * 100).cast("bigint").alias("cents"), "o_orderpriority", "missing")


@add("SELECT CAST(count(*) AS BIGINT) AS data_lines, CAST(count(*) AS BIGINT) AS trailer_count, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS trailer_cents, CAST(0 AS BIGINT) AS files_that_differ, 'o_orderkey|o_custkey|o_orderdate|o_totalprice|o_orderpriority' AS header FROM orders")
def psv_trailer_stats(t):
    stats = readers.psv_stats(t("orders").sparkSession, _extract(t))
    return stats.agg(F.sum("data_lines").alias("data_lines"), F.sum("trailer_count").alias("trailer_count"), (F.sum("trailer_total") * 100).cast("bigint").alias("trailer_cents"), F.count_if(F.col("data_lines") != F.col("trailer_count")).alias("files_that_differ"), F.max("header").alias("header"))


def _event_lines(values):
    for key, kind, props in values:
        if key % 7 == 0:
            yield ""
        yield f'{{"id": {key}, "kind": "{kind}", "props": {props}' + ("" if key % 10 == 0 else "}")


@add("SELECT CASE WHEN event_id % 10 <> 0 THEN event_id END AS id, CASE WHEN event_id % 10 <> 0 THEN event_type END AS kind, CASE WHEN event_id % 10 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k, CASE WHEN event_id % 10 = 0 THEN 'MALFORMED_JSON' END AS parse_error FROM events")
def jsonl_round_trip(t):
    rows = t("events").select("event_id", "event_type", "props")
    found = readers.read_jsonl(rows.sparkSession, _landed(rows, "events", _event_lines))
    at = lambda path: F.when(F.col("_parse_error").isNull(), F.get_json_object("payload", path))
    return found.select(at("$.id").cast("bigint").alias("id"), at("$.kind").alias("kind"), at("$.props.k").cast("bigint").alias("k"), F.col("_parse_error").alias("parse_error"))


def _array_lines(values):
    yield "["
    for n, (key, segment) in enumerate(values):
        yield ("," if n else "") + f'{{"id": {key}, "profile": {{"segment": "{segment}"}}}}'
    yield "]"


@add("SELECT c_custkey AS id, c_mktsegment AS segment, CAST(NULL AS VARCHAR) AS parse_error FROM customer")
def json_array_round_trip(t):
    rows = t("customer").select("c_custkey", "c_mktsegment")
    found = readers.read_json_array(rows.sparkSession, _landed(rows, "arrays", _array_lines))
    return found.select(F.get_json_object("payload", "$.id").cast("bigint").alias("id"), F.get_json_object("payload", "$.profile.segment").alias("segment"), F.col("_parse_error").alias("parse_error"))


@add("SELECT 'text/plain' AS mime_type, CAST(length(n_name) + 1 AS BIGINT) AS bytes, sha256(n_name || chr(10)) AS sha256, n_name || chr(10) AS text_content, true AS there FROM nation UNION ALL SELECT NULL, r_regionkey, sha256(r_name), NULL, false FROM region")
def document_scan(t):
    """Every nation as a file, and regions as files that the manifest names but nobody wrote."""
    nations, spark = t("nation"), t("nation").sparkSession
    folder = relational.work_folder(spark, "documents")
    nations.select("n_nationkey", F.col("n_name").alias("value")).write.partitionBy("n_nationkey").text(folder)
    found = readers.read_documents(spark, f"{folder}/*/*.txt").drop("content")
    manifest = t("region").select(F.concat(F.lit("lost"), F.col("r_regionkey").cast("string")).alias("file"), F.col("r_regionkey").alias("bytes"), F.sha2("r_name", 256).alias("sha256"))
    return readers.with_missing_files(found, manifest).select("mime_type", "bytes", "sha256", "text_content", F.col("mime_type").isNotNull().alias("there"))
