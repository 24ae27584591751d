"""Stage states, gates and run trails, kept as append-only tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .relational import latest

STATES = ("STARTED", "COMMITTED", "SKIPPED", "COMPLETED", "FAILED", "MISSING_MANIFEST")
#: The kinds of transforms.
TRANSFORM_TYPES = ("ingest", "validate", "cleanse", "standardise", "deduplicate", "match", "survive", "enrich", "normalise", "aggregate", "historise", "consume")
TRANSFORM_LOG = "batch_id string, stage string, step string, transform_type string, source_tables string, target_table string, rows_in long, rows_out long, details string"
LOAD_AUDIT = "batch_id string, stage string, entity string, status string, rows_in long, rows_ok long, rows_bad long, message string, at timestamp"


def _later() -> list:
    """The order of states: by time, and of one instant the later in a run first."""
    return [F.desc("at"), F.expr("array_position(array('STARTED', 'MISSING_MANIFEST', 'SKIPPED', 'COMMITTED', 'FAILED', 'COMPLETED'), status)").desc()]


class StageNotReady(RuntimeError):
    pass


def stage_status(audit: DataFrame) -> DataFrame:
    """batch_id, stage, status: whether each stage's last run began, completed or failed."""
    return latest(audit.where(F.col("status").isin("STARTED", "COMPLETED", "FAILED")), ["batch_id", "stage"], _later()).select("batch_id", "stage", "status")


def latest_runs(audit: DataFrame) -> DataFrame:
    """batch_id, stage, entity, status: outcomes since each stage's newest run of the batch began, the last one of each entity."""
    began = audit.where("status = 'STARTED'").groupBy("batch_id", "stage").agg(F.max("at").alias("_began"))
    rows = audit.join(began, ["batch_id", "stage"]).where((F.col("at") >= F.col("_began")) & (F.col("status") != "STARTED"))
    return latest(rows, ["batch_id", "stage", "entity"], _later()).select("batch_id", "stage", "entity", "status")


class TransformLog:
    """What a stage did to which tables, gathered while it runs and written at its end, however that comes."""

    def __init__(self, batch: str, stage: str):
        self.batch, self.stage, self.rows = batch, stage, []

    def add(self, step: str, kind: str, sources: str, target: str, rows_in: int | None = None, rows_out: int | None = None, details: str = "") -> None:
        if kind not in TRANSFORM_TYPES:
            raise ValueError(f"no transform type {kind}")
        self.rows.append((self.batch, self.stage, step, kind, sources, target, rows_in, rows_out, details[:2000]))


def require_completed(audit: DataFrame, batch: str, stage: str) -> None:
    """The stage's last run of the batch must have completed."""
    last = stage_status(audit.where((F.col("batch_id") == batch) & (F.col("stage") == stage))).collect()
    if not last or last[0]["status"] != "COMPLETED":
        raise StageNotReady(f"{stage} of {batch} is {last[0]['status'] if last else 'not there'}")


def resume_set(audit: DataFrame, batch: str, stage: str) -> DataFrame:
    """Entities committed since the stage last completed: a resumed run skips them."""
    mine = audit.where((F.col("batch_id") == batch) & (F.col("stage") == stage))
    done = mine.where("status = 'COMPLETED'").agg(F.coalesce(F.max("at"), F.to_timestamp(F.lit("1970-01-01 00:00:00"))).alias("since"))
    return mine.where("status = 'COMMITTED'").join(F.broadcast(done), F.col("at") > F.col("since")).select("entity").distinct()  # one row


def last_attempts(audit: DataFrame) -> DataFrame:
    """The last outcome of every batch, stage and entity; STARTED isn't one."""
    return latest(audit.where("status <> 'STARTED'"), ["batch_id", "stage", "entity"], _later())


def error_summary(error: BaseException, most: int = 500) -> str:
    """The innermost line that names an error."""
    lines = [x.strip() for x in str(error).splitlines()]
    named = [x for x in lines if re.match(r"(Caused by: )?[\w.$]*(Error|Exception)\b", x)]
    return (named[-1] if named else f"{type(error).__name__}: {lines[0] if lines else ''}")[:most]
