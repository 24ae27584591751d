"""Contract-driven validation: every row stays text, failed checks become reasons, rows split into accepted and quarantined.

A contract is a dict: entity, format, key, columns; a column has name, type and optionally required, formats, pattern, allowed,
min, severity ("reject" or "warn") and path (into a JSON payload).
"""

from __future__ import annotations

import json
from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.typing import blank_to_null, to_date, to_instant, to_whole, typed
from .relational import cut, record_hash, small_side


def load(path: str) -> dict:
    return json.loads(Path(path).read_text())


def _checks(column: dict, value: Column, label: str) -> tuple[list[Column], list[Column]]:
    """(rejects, warnings) of a column, each NULL or its reason."""
    v, kind = blank_to_null(value), column.get("type", "string")
    reason = lambda cond, code: F.when(cond, F.lit(f"{label}:{code}"))
    rejects, warns = [], []
    if column.get("required"):
        rejects.append(reason(v.isNull(), "REQUIRED"))
    bad = {
        "int": ("NOT_INTEGER", lambda: to_whole(v)),
        "bigint": ("NOT_INTEGER", lambda: to_whole(v)),
        "decimal": ("NOT_DECIMAL", lambda: v.try_cast("decimal(20,4)")),
        "date": ("INVALID_DATE", lambda: to_date(v, column.get("formats", ["yyyy-MM-dd"]))),
        "timestamp": ("INVALID_TIMESTAMP", lambda: to_instant(v, column.get("formats", ["yyyy-MM-dd HH:mm:ss"])[0])),
    }.get(kind)
    if bad:
        rejects.append(reason(v.isNotNull() & bad[1]().isNull(), bad[0]))
    soft = rejects if column.get("severity", "warn") == "reject" else warns
    if "pattern" in column:
        soft.append(reason(v.isNotNull() & ~v.rlike(column["pattern"]), "PATTERN"))
    if "allowed" in column:
        soft.append(reason(v.isNotNull() & ~v.isin(column["allowed"]), "NOT_ALLOWED"))
    if "min" in column:
        (warns if column.get("severity") == "warn" else rejects).append(reason(v.try_cast("double") < column["min"], "BELOW_MIN"))
    return rejects, warns


def _compact(reasons: list[Column]) -> Column:
    return F.array_compact(F.array(*reasons)) if reasons else F.array().cast("array<string>")


def validate(df: DataFrame, contract: dict, more_rejects: list[Column] | None = None) -> DataFrame:
    """Adds _reject_reasons, _warnings and _record_hash; df has the contract's columns as text."""
    rejects, warns = list(more_rejects or []), []
    for column in contract["columns"]:
        r, w = _checks(column, F.col(column["name"]), column["name"])
        rejects += r
        warns += w
    if contract.get("key"):
        # only keys are counted and shuffled; the few that are there more than once are known before whole rows are read, and come to them
        keys = contract["key"]
        repeated = cut(df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).count().where("count > 1").drop("count").withColumn("_many", F.lit(True)))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)])
        df = df.join(small_side(repeated), same, "left").drop(*[f"_k{i}" for i in range(len(keys))])
        warns.append(F.when(F.col("_many"), F.lit("DUPLICATE_IN_BATCH")))
    names = [c["name"] for c in contract["columns"]]
    return df.withColumns({"_reject_reasons": _compact(rejects), "_warnings": _compact(warns), "_record_hash": record_hash([F.col(n) for n in names])}).drop("_many")


def image_checks(contract: dict, payload: Column, op: Column, table: Column, target: dict) -> list[Column]:
    """Rejects of change events: the after-image of c and u meets the target's contract, d has the key before."""
    here = table == target["table"]
    out = []
    for column in target["columns"]:
        value = F.get_json_object(payload, f"$.after.{column['name']}")
        out += [F.when(here & op.isin("c", "u"), r) for r in _checks(column, value, f"after.{column['name']}")[0]]
    for key in target["key"]:
        out.append(F.when(here & (op == "d") & blank_to_null(F.get_json_object(payload, f"$.before.{key}")).isNull(), F.lit(f"before.{key}:REQUIRED")))
    return out


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantined); the latter keeps the record as JSON."""
    good = F.size("_reject_reasons") == 0
    data = [c for c in checked.columns if not c.startswith("_")]
    record = F.col("payload") if "payload" in data else F.to_json(F.struct(*data))
    return checked.where(good).drop("_reject_reasons"), checked.where(~good).withColumn("_record", record)


def counts(checked: DataFrame) -> tuple[int, int, int]:
    """Rows in, accepted and rejected, in one job."""
    row = checked.agg(F.count("*"), F.count_if(F.size("_reject_reasons") == 0)).first()
    return row[0], row[1], row[0] - row[1]


def top_reasons(quarantined: DataFrame, most: int = 5) -> DataFrame:
    return quarantined.select(F.explode("_reject_reasons").alias("reason")).groupBy("reason").count().orderBy(F.desc("count"), "reason").limit(most)


def json_fields(df: DataFrame, contract: dict, payload: str = "payload") -> DataFrame:
    """The contract's paths as text columns beside the payload."""
    return df.withColumns({c["name"]: F.get_json_object(payload, f"$.{c.get('path', c['name'])}") for c in contract["columns"]})


#: Top-level keys that a source's messages have beside those of the contract's columns.
ENVELOPES = {
    "cbs_cdc_event": ("op", "ts_ms", "source", "before", "after"),
    "pay_transaction": ("end_to_end_id", "debtor", "creditor", "amount", "charges", "remittance"),
    "crm_customer": ("profile", "identifiers", "addresses", "contacts", "consent", "source_channel"),
}


def known_keys(contract: dict) -> list[str]:
    """The top-level keys that this entity's messages are known to have; another entity's are drift here."""
    return sorted({c.get("path", c["name"]).split(".")[0] for c in contract["columns"]} | set(ENVELOPES.get(contract["entity"], ())))


def json_key_drift(df: DataFrame, known: list[str], payload: str = "payload", file: str = "_source_file") -> DataFrame:
    """Top-level keys that the contract doesn't know, by file."""
    keys = df.select(file, F.explode(F.json_object_keys(payload)).alias("field"))
    return keys.where(~F.col("field").isin(known)).groupBy(file, "field").count().withColumn("drift", F.lit("NEW_FIELD"))


def header_drift(header: list[str], contract: dict) -> list[tuple[str, str]]:
    names = [c["name"] for c in contract["columns"]]
    return [("NEW_COLUMN", h) for h in header if h not in names] + [("MISSING_COLUMN", n) for n in names if n not in header]


def typed_columns(contract: dict) -> list[Column]:
    return [typed(F.col(c["name"]), c.get("type", "string"), c.get("formats")).alias(c["name"]) for c in contract["columns"]]
