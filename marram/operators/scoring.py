"""Requests in, predictions out, and the two collected tables that belong to each other."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marram.functions.features import decode_label, quoted
from marram.functions.payload import parse_payloads, request_rows

# Adds a `prediction` column to rows that hold the feature columns: `PipelineModel.transform`
# fits, and so does any column expression.
Scorer = Callable[[DataFrame], DataFrame]


def predict_requests(parsed: DataFrame, scorer: Scorer, features: Sequence[str], codes: Mapping[str, int],
                     request_id: str) -> DataFrame:
    """(request id, error_code, error, row_pos, features…, prediction, predicted_label).

    A rejected request is one row without `row_pos`, prediction and label.
    """
    scored = scorer(request_rows(parsed, features, [request_id, "error_code", "error"]))
    valid = F.col("row_pos").isNotNull()
    code = F.col("prediction").cast("long")
    return scored.select(
        request_id, "error_code", "error", "row_pos", *[quoted(f) for f in features],
        F.when(valid, code).alias("prediction"),
        F.when(valid, decode_label(code, codes)).alias("predicted_label"),
    )


def predicted_rows(predicted: DataFrame) -> DataFrame:
    """The rows of valid requests."""
    return predicted.where(F.col("row_pos").isNotNull()).drop("error_code", "error")


def responses(predicted: DataFrame, request_id: str) -> DataFrame:
    """One row per request: ordered predictions and labels, or the error.

    A response is one document, so its rows meet again; its size is bounded by the request body,
    itself a single value.
    """
    each = F.when(F.col("row_pos").isNotNull(), F.struct("row_pos", "prediction", "predicted_label"))
    whole = predicted.groupBy(request_id).agg(
        F.sort_array(F.collect_list(each)).alias("each"), F.max("error").alias("error"))
    good = F.col("error").isNull()
    return whole.select(
        request_id, F.when(good, F.col("each.prediction")).alias("predictions"),
        F.when(good, F.col("each.predicted_label")).alias("predicted_labels"), "error",
    )


def rejected(parsed: DataFrame, request_id: str, *more: str) -> DataFrame:
    """Rejected requests with code and message.

    The verdict passes through a generator, below which the filter cannot sink: else every body
    would be parsed in the filter and once more after it.
    """
    verdict = F.struct("error_code", "error")
    judged = parsed.select(request_id, *more, F.inline(F.array(verdict)))
    return judged.where(F.col("error_code") != 0).select(request_id, "error_code", "error", *more)


def score_requests(df: DataFrame, raw: str, scorer: Scorer, features: Sequence[str],
                   codes: Mapping[str, int], request_id: str) -> DataFrame:
    parsed = parse_payloads(df, raw, features)
    return responses(predict_requests(parsed, scorer, features, codes, request_id), request_id)


def response_json(answered: DataFrame, request_id: str) -> DataFrame:
    """The response document; absent parts are left out of the text."""
    return answered.select(request_id, F.to_json(F.struct("predictions", "predicted_labels", "error")).alias("response"))


def model_inputs(predicted: DataFrame, features: Sequence[str], request_id: str) -> DataFrame:
    return predicted_rows(predicted).select(
        F.col(request_id).alias("correlation_id"), "row_pos", *[quoted(f) for f in features])


def model_outputs(predicted: DataFrame, request_id: str) -> DataFrame:
    return predicted_rows(predicted).select(
        F.col(request_id).alias("correlation_id"), "row_pos", "prediction", "predicted_label")


def correlate(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    """Inputs with the outputs made from them, by correlation id and row."""
    twice = [c for c in outputs.columns if c in inputs.columns and c not in ("correlation_id", "row_pos")]
    return inputs.join(outputs.drop(*twice), ["correlation_id", "row_pos"])


def unscored(inputs: DataFrame, outputs: DataFrame) -> DataFrame:
    return inputs.join(outputs, ["correlation_id", "row_pos"], "left_anti")
