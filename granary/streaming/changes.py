"""Change events as a stream: each micro-batch is reduced to the newest image a key and merged into a state table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import cdc
from ..operators.relational import record_hash
from ..operators.store import Table


def reduce_batch(events: DataFrame, contract: dict) -> DataFrame:
    """Newest image a key of some events (payload, _source_row), as rows that merge() takes."""
    first, _ = cdc.resent(cdc.images(events, contract))
    names = [c["name"] for c in contract["columns"]]
    new = cdc.newest(first, contract["key"])
    return new.select(*names, "_src_ts", "_is_deleted", record_hash([F.col(n) for n in [*names, "_is_deleted"]]).alias("_record_hash"))


def merge_stream(spark: SparkSession, folder: str, table: Table, contract: dict, checkpoint: str) -> StreamingQuery:
    """Files of JSON lines in ``folder``, each once; a batch that is run again after a failure merges to the same state."""
    lines = spark.readStream.schema("value string").text(folder)
    events = lines.select(F.col("value").alias("payload"), F.get_json_object("value", "$.source.pos").alias("_source_row"))

    def apply(batch: DataFrame, number: int) -> None:
        rows = reduce_batch(batch, contract)
        if not table.exists:
            table.create(rows.where("NOT _is_deleted"), batch=f"S{number:09d}")
        elif rows.limit(1).count():
            table.merge(rows, contract["key"], f"S{number:09d}")

    return events.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
