"""Score a table of requests in one batch: responses, rejects, and the collected tables."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.functions.payload import parse_payloads
from marram.operators import scoring
from marram.sources.sinks import write_collection


def score_batch(
    requests: DataFrame,
    *,
    raw: str,
    request_id: str,
    scorer: scoring.Scorer,
    features: Sequence[str],
    codes: Mapping[str, int],
    root: str,
    batch_id: int | str,
    collected_at: datetime | None = None,
) -> None:
    """Everything is written under the batch's own number, so a rerun replaces it."""
    stamp = F.lit(collected_at or datetime.now()).cast("timestamp")
    parsed = parse_payloads(requests, raw, features)
    predicted = scoring.predict_requests(parsed, scorer, features, codes, request_id).persist(
        StorageLevel.MEMORY_AND_DISK)
    try:
        answers = scoring.responses(predicted, request_id)
        answers.write.mode("overwrite").parquet(f"{root}/responses/batch_id={batch_id}")
        refused = scoring.rejected(predicted, request_id)
        refused.write.mode("overwrite").parquet(f"{root}/rejected/batch_id={batch_id}")
        try:
            write_collection(
                scoring.model_inputs(predicted, features, request_id).withColumn("collected_at", stamp),
                scoring.model_outputs(predicted, request_id).withColumn("collected_at", stamp),
                root, batch_id,
            )
        except Exception:  # answers are worth more than their collection
            logging.getLogger(__name__).exception("collection of batch %s failed", batch_id)
    finally:
        predicted.unpersist()
