"""Request bodies as VARIANT expressions: parse, check, and read rows without leaving the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a rejected request is told, by rule. Code 0 is a valid request; the first
# rule that fails decides. Rule 1 (no model) stops the job instead.
MESSAGES = {
    2: "Request payload is not valid JSON.",
    3: "Request payload must be a JSON object.",
    4: "Request payload must contain a 'data' field.",
    5: "The 'data' field must contain a list of rows.",
    6: "The 'data' field must not be empty.",
    7: "Each input row must contain exactly {width} values.",
    8: "Each object row must contain all required feature names.",
    9: "Object rows may only contain the expected feature names.",
    10: "Each entry in 'data' must use the same format: all lists or all objects.",
    11: "Feature values must be numbers.",
}

_LIST = "array<variant>"
_OBJECT = "map<string,variant>"


def _as_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", _LIST)


def _as_object(v: Column) -> Column:
    return F.try_variant_get(v, "$", _OBJECT)


def _is_number(v: Column) -> Column:
    kind = F.schema_of_variant(v)
    return F.coalesce(kind.isin("BIGINT", "DOUBLE", "FLOAT") | kind.startswith("DECIMAL"), F.lit(False))


def _ordered_values(row: Column, features: Sequence[str]) -> Column:
    """The row's values as variants in feature order, for either row shape."""
    named = _as_object(row)
    by_name = F.array(*[F.element_at(named, F.lit(f)) for f in features])
    return F.coalesce(_as_list(row), by_name)


def error_message(code: Column, width: int) -> Column:
    text = F.lit(None).cast("string")
    for number, message in MESSAGES.items():
        text = F.when(code == number, F.lit(message.format(width=width))).otherwise(text)
    return text


def parse_payloads(df: DataFrame, raw: str, features: Sequence[str]) -> DataFrame:
    """Add `error_code`, `error` and `rows` (array of double arrays, NULL when rejected).

    One bad row rejects its whole request. Bad input is data, never an exception.
    """
    width = len(features)
    expected = F.array(*[F.lit(f) for f in features])
    body = F.col("__body")
    items = F.col("__items")
    parsed = df.withColumn("__body", F.try_parse_json(F.col(raw)))
    parsed = parsed.withColumn("__items", F.try_variant_get(body, "$.data", _LIST))

    all_lists = F.forall(items, lambda r: _as_list(r).isNotNull())
    all_objects = F.forall(items, lambda r: _as_object(r).isNotNull())
    wrong_width = F.exists(items, lambda r: F.size(_as_list(r)) != width)
    missing = F.exists(items, lambda r: F.size(F.array_except(expected, F.map_keys(_as_object(r)))) > 0)
    extra = F.exists(items, lambda r: F.size(F.array_except(F.map_keys(_as_object(r)), expected)) > 0)
    not_number = F.exists(items, lambda r: F.exists(_ordered_values(r, features), lambda v: ~_is_number(v)))
    code = (
        F.when(body.isNull(), 2)
        .when(_as_object(body).isNull(), 3)
        .when(F.try_variant_get(body, "$.data", "variant").isNull(), 4)
        .when(items.isNull(), 5)
        .when(F.size(items) == 0, 6)
        .when(all_lists, F.when(wrong_width, 7).when(not_number, 11).otherwise(0))
        .when(all_objects, F.when(missing, 8).when(extra, 9).when(not_number, 11).otherwise(0))
        .otherwise(10)
    )
    coded = parsed.withColumn("error_code", code)
    values = F.transform(items, lambda r: F.transform(
        _ordered_values(r, features), lambda v: F.try_variant_get(v, "$", "double")))
    return coded.withColumns({
        "error": error_message(F.col("error_code"), width),
        "rows": F.when(F.col("error_code") == 0, values),
    }).drop("__body", "__items")


def request_rows(parsed: DataFrame, features: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Requests as typed rows (keep…, row_pos, features…); a rejected one is one row without row_pos.

    Rejected requests stay in line, with zeros for features, so that parsing happens once for both
    outcomes: a filter on the parse result would be pushed below it and parse every body again.
    """
    opened = parsed.select(*keep, F.posexplode_outer("rows").alias("row_pos", "__row"))
    return opened.select(
        *keep, "row_pos",
        *[F.coalesce(F.get("__row", F.lit(i)), F.lit(0.0)).alias(f) for i, f in enumerate(features)],
    )
