"""Streaming scoring of request payloads into responses and the two collected tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marram.functions.payload import parse_payloads
from marram.operators import scoring
from marram.sources.sinks import write_collection

log = logging.getLogger(__name__)


def stream_scores(
    requests: DataFrame,
    *,
    raw: str,
    request_id: str,
    scorer: scoring.Scorer,
    features: Sequence[str],
    codes: Mapping[str, int],
    root: str,
    checkpoint: str,
    strict_collection: bool = False,
) -> StreamingQuery:
    """Score all requests available now.

    Each batch replaces the folders of its own number, so a batch that runs again after a lost
    executor or driver leaves one copy. Responses are written first; a failing collection is
    logged and does not fail scoring unless `strict_collection` is set.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        parsed = parse_payloads(batch, raw, features)
        predicted = scoring.predict_requests(parsed, scorer, features, codes, request_id).persist(
            StorageLevel.MEMORY_AND_DISK)
        try:
            answers = scoring.responses(predicted, request_id)
            answers.write.mode("overwrite").parquet(f"{root}/responses/batch_id={batch_id}")
            stamp = F.lit(datetime.now()).cast("timestamp")
            try:
                write_collection(
                    scoring.model_inputs(predicted, features, request_id).withColumn("collected_at", stamp),
                    scoring.model_outputs(predicted, request_id).withColumn("collected_at", stamp),
                    root, batch_id,
                )
            except Exception as error:
                if strict_collection:
                    raise
                log.warning("collection of batch %s failed: %s", batch_id, error)
        finally:
            predicted.unpersist()

    return (
        requests.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
