"""Ingest as a stream: files of JSON requests, one request per line, arriving in a folder."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from starload.operators.requests import MAX_ROWS
from starload.plans.ingest import IngestResult, ingest_requests
from starload.sources.requests import request_lines, with_request_ids
from starload.warehouse import Warehouse


def ingest_stream(
    warehouse: Warehouse,
    table: str,
    folder: str,
    checkpoint: str,
    max_rows: int = MAX_ROWS,
    on_batch: Callable[[IngestResult], None] | None = None,
    trigger: dict | None = None,
    **source_options: str,
) -> StreamingQuery:
    """Start the query. ``trigger`` defaults to ``{"availableNow": True}``; ``source_options`` go to the
    file source, for instance ``maxFilesPerTrigger``.

    Each micro-batch is one ingest whose batch id is the query's id and the batch number. A replay
    after a failure finds the batch published and adds nothing. Small folders are joined as they gather, and the
    batch numbers taken in are kept as intervals, so neither the commit record nor the number of folders grows with
    the stream.
    """
    warehouse.create()
    whole_files = source_options.get("wholetext", "false").lower() == "true"
    lines = request_lines(warehouse.spark.readStream.format("text").options(**source_options).load(folder), whole_files)

    def store(batch: DataFrame, number: int) -> None:
        batch_id = f"{_query_id(warehouse, checkpoint)}-{number}"
        result = ingest_requests(warehouse, table, with_request_ids(batch), batch_id, max_rows)
        if on_batch:
            on_batch(result)
        warehouse.join_small(table)

    return (
        lines.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def _query_id(warehouse: Warehouse, checkpoint: str) -> str:
    """Spark keeps the id in the checkpoint, so it survives restarts and differs for a new checkpoint."""
    return json.loads(warehouse.spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]
