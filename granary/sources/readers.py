"""Readers of landing files: SQL dumps, pipe-delimited extracts with trailers, JSON lines, JSON arrays, documents.

Files are read by Spark from any file system it knows; each reader gives (_source_file, _source_row, text columns).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.relational import cut, small_side
from ..ship import ship

#: Kinds of documents by file ending.
MIME = {"eml": "message/rfc822", "txt": "text/plain", "png": "image/png", "pdf": "application/pdf", "jpg": "image/jpeg"}


def _files(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row a whole file; for formats that have no lines."""
    df = spark.read.text(paths, wholetext=True)
    return df.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("_source_file"), F.col("value").alias("_text"))


def _lines(spark: SparkSession, paths: str | list[str], header: bool = False) -> DataFrame:
    """Rows (_path, _source_file, _source_row, line) of text files: physical lines from 1; with ``header`` also _header, their file's first line.

    Files are split wherever Spark splits them. A line's number is its place in its split and the lines of the splits before, so
    one file of any size is read by many tasks. A place is what a line's id is past the first id of its split. Lines of splits are
    counted first, without the lines; a split that wasn't counted, or was read elsewhere, is an error.
    """
    at = {"_path": F.col("_metadata.file_path"), "_split": F.col("_metadata.file_block_start"), "_id": F.monotonically_increasing_id(), "line": F.when(F.contains("value", F.lit("\r")), F.regexp_replace("value", "\r$", "")).otherwise(F.col("value"))}
    read = spark.read.option("lineSep", "\n").text(paths)
    read = read.select(*[c.alias(name) for name, c in at.items()])
    splits = read.groupBy("_path", "_split").agg(F.count("*").alias("_lines"), F.min("_id").alias("_start"))
    before = Window.partitionBy("_path").orderBy("_split")
    splits = splits.withColumn("_before", F.sum("_lines").over(before) - F.col("_lines"))
    if header:
        splits = splits.join(read.where("_split = 0").groupBy("_path").agg(F.min_by("line", "_id").alias("_header")), "_path", "left")
    rows = read.join(small_side(cut(splits)), ["_path", "_split"], "left")
    place = F.col("_id") - F.col("_start")
    lost = F.raise_error(F.concat(F.lit("files were split anew while they were read: "), "_path")).cast("long")
    number = F.when((place >= 0) & (place < F.col("_lines")), F.col("_before") + place + 1).otherwise(lost)
    return rows.select("_path", F.element_at(F.split("_path", "/"), -1).alias("_source_file"), number.cast("int").alias("_source_row"), "line", *(["_header"] if header else []))


def dump_columns(text: str, table: str) -> list[str]:
    """Columns of the CREATE TABLE statement, in order."""
    found = re.search(rf"CREATE TABLE `{re.escape(table)}` \((.*?)\n\)", text, re.S)
    return re.findall(r"^\s*`([^`]+)`", found[1], re.M) if found else []


_ESCAPES = {"n": "\n", "t": "\t", "0": "\0", "r": "\r"}
_TOKEN = re.compile(r"'((?:[^'\\]|\\.|'')*)'|([^,()']+)|([,()])", re.S)
_EMPTY = object()


def _unquoted(text: str) -> str:
    return re.sub(r"\\(.)|''", lambda x: "'" if x[1] is None else _ESCAPES.get(x[1], x[1]), text, flags=re.S)


def tuples(values: str) -> Iterator[list[str | None]]:
    """Rows of an extended INSERT's VALUES: quotes, backslash escapes and doubled quotes undone; a bare null in any case is None,
    and nothing between two commas is an empty text, so that later values keep their places."""
    row: list[str | None] | None = None
    value: object = _EMPTY
    for m in _TOKEN.finditer(values):
        quoted, bare, mark = m.groups()
        if row is None:
            row, value = ([] if mark == "(" else None), _EMPTY
        elif quoted is not None:
            value = _unquoted(quoted)
        elif bare is not None and bare.strip():
            value = None if bare.strip().upper() == "NULL" else bare.strip()
        elif mark in (",", ")"):
            row.append("" if value is _EMPTY else value)
            value = _EMPTY
            if mark == ")":
                yield row
                row = None


def read_dump(spark: SparkSession, paths: str | list[str], table: str, columns: list[str]) -> DataFrame:
    """Rows of one table's INSERTs, numbered over their file; a column that the dump lacks is NULL.

    Every INSERT is a line, and lines are dealt to tasks; tokenising isn't expressible in SQL: Arrow batches of lines.
    """

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, list[str]] = {}
        for batch in batches:
            for path, file, at, line, ddl in zip(*[batch.column(c).to_pylist() for c in ("_path", "_source_file", "_source_row", "line", "_ddl")], strict=True):
                there = known.setdefault(ddl, dump_columns(ddl, table))
                rows = [dict(zip(there, values, strict=False)) for values in tuples(line.split(" VALUES ", 1)[1])]
                if rows:
                    own = [pa.array([path] * len(rows)), pa.array([file] * len(rows)), pa.array([at] * len(rows), pa.int32()), pa.array(range(1, len(rows) + 1), pa.int32())]
                    yield pa.RecordBatch.from_arrays([*own, *[pa.array([row.get(c) for row in rows], pa.string()) for c in columns]], ["_path", "_source_file", "_line", "_place", *columns])

    ship(spark)
    lines = _lines(spark, paths)
    definitions = lines.where(r"line RLIKE '^(CREATE TABLE |[)]|\\s*`)'").groupBy("_path").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_source_row", "line"))), lambda x: x["line"]), "\n").alias("_ddl"))
    inserts = lines.where(F.col("line").startswith(f"INSERT INTO `{table}`") & F.col("line").contains(" VALUES "))
    inserts = inserts.join(small_side(cut(definitions)), "_path", "left").withColumn("_ddl", F.coalesce("_ddl", F.lit("")))  # a row a file
    schema = ", ".join(["_path string, _source_file string, _line int, _place int", *[f"`{c}` string" for c in columns]])
    rows = cut(inserts.mapInArrow(parse, schema))  # tokenised once
    counts = rows.groupBy("_path", "_line").agg(F.max("_place").alias("_rows"))
    before = counts.select("_path", "_line", (F.sum("_rows").over(Window.partitionBy("_path").orderBy("_line")) - F.col("_rows")).alias("_before"))
    return rows.join(small_side(cut(before)), ["_path", "_line"]).select("_source_file", (F.col("_before") + F.col("_place")).cast("int").alias("_source_row"), *columns)


def read_psv(spark: SparkSession, paths: str | list[str], columns: list[str]) -> DataFrame:
    """Rows of pipe-delimited files by their header's names; blank lines and the trailer go, empty values are NULL, and
    _source_row is the physical line."""
    data = _lines(spark, paths, header=True).where(r"_source_row > 1 AND trim(line) <> '' AND line NOT LIKE 'T|%'")
    data = data.withColumns({"_names": F.split("_header", r"\|", -1), "_v": F.split("line", r"\|", -1)})
    value = lambda c: F.nullif(F.get("_v", F.array_position("_names", c).cast("int") - 1), F.lit(""))
    return data.select("_source_file", "_source_row", *[F.when(F.array_contains("_names", c), value(c)).alias(c) for c in columns])


def psv_stats(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Per file: header, data lines, and the trailer's record count (NULL unless digits) and control total."""
    lines = _lines(spark, paths).where("trim(line) <> ''")
    trailer = F.split(F.max(F.when(F.col("line").startswith("T|"), F.col("line"))), r"\|", -1)
    return lines.groupBy("_source_file").agg(
        F.max(F.when(F.col("_source_row") == 1, F.col("line"))).alias("header"),
        F.count_if((F.col("_source_row") > 1) & ~F.col("line").startswith("T|")).alias("data_lines"),
        F.when(F.get(trailer, F.lit(1)).rlike("^[0-9]+$"), F.get(trailer, F.lit(1)).try_cast("long")).alias("trailer_count"),
        F.get(trailer, F.lit(2)).try_cast("decimal(18,2)").alias("trailer_total"),
    )


def read_jsonl(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """payload and _parse_error by line; blank lines go but keep their number."""
    lines = _lines(spark, paths).where("trim(line) <> ''")
    return lines.select("_source_file", "_source_row", F.col("line").alias("payload"), F.when(F.expr("try_parse_json(line) IS NULL"), "MALFORMED_JSON").alias("_parse_error"))


def read_json_array(spark: SparkSession, paths: str | list[str], excerpt: int = 2000) -> DataFrame:
    """One row an element, as compact JSON; a malformed file is one row 0 with the beginning of its text."""
    files = _files(spark, paths).withColumn("_items", F.expr("try_variant_get(try_parse_json(_text), '$', 'array<variant>')"))
    good = files.where("_items IS NOT NULL").select("_source_file", F.posexplode("_items").alias("_n", "_item")).select("_source_file", (F.col("_n") + 1).alias("_source_row"), F.to_json("_item").alias("payload"), F.lit(None).cast("string").alias("_parse_error"))
    bad = files.where("_items IS NULL").select("_source_file", F.lit(0).alias("_source_row"), F.substring("_text", 1, excerpt).alias("payload"), F.lit("MALFORMED_JSON").alias("_parse_error"))
    return good.unionByName(bad)


def read_documents(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Files as rows: name, kind, bytes, SHA-256, text of mails and texts, content; names that begin with _ are left out."""
    df = spark.read.format("binaryFile").load(paths)
    name = F.element_at(F.split("path", "/"), -1)
    ending = F.lower(F.element_at(F.split(name, r"\."), -1))
    mime: Column = F.lit("application/octet-stream")
    for k, v in MIME.items():
        mime = F.when(ending == k, v).otherwise(mime)
    text = F.when(ending.isin("eml", "txt"), F.expr("try_validate_utf8(cast(content AS string))"))
    return df.select(name.alias("_source_file"), F.lit(1).alias("_source_row"), name.alias("file_name"), mime.alias("mime_type"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), text.alias("text_content"), "content").where(~F.col("file_name").startswith("_"))


def with_missing_files(documents: DataFrame, manifest_files: DataFrame) -> DataFrame:
    """Files (file, bytes, sha256) of the manifest that weren't read, as rows without content."""
    lost = manifest_files.join(documents.select(F.col("file_name").alias("file")), "file", "left_anti")
    rows = lost.select(F.col("file").alias("_source_file"), F.lit(1).alias("_source_row"), F.col("file").alias("file_name"), F.col("bytes").cast("long").alias("bytes"), "sha256")
    return documents.unionByName(rows, allowMissingColumns=True)


READERS = {"mysqldump": read_dump, "psv": read_psv, "jsonl": read_jsonl, "json_array": read_json_array, "binary": read_documents}


def raw_frame(spark: SparkSession, contract: dict, folder: str) -> DataFrame:
    """The contract's files as text columns, by its format."""
    paths, names = f"{folder.rstrip('/')}/{contract['files']}", [c["name"] for c in contract["columns"]]
    kind = contract["format"]
    if kind == "mysqldump":
        return read_dump(spark, paths, contract["table"], names)
    if kind == "psv":
        return read_psv(spark, paths, names)
    if kind in ("jsonl", "json_array"):
        from ..operators.contract import json_fields

        return json_fields(READERS[kind](spark, paths), contract)
    if kind == "binary":
        return read_documents(spark, paths)
    raise ValueError(f"no reader for {kind}")


def read_manifest(spark: SparkSession, path: str) -> dict | None:
    """A manifest's JSON from any file system, None if it isn't there."""
    import json

    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()
