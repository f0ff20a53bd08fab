"""Projections over the measurement columns and the class label."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marram.session import shared_root


def require_columns(df: DataFrame, needed: Iterable[str], what: str = "input") -> DataFrame:
    """Fail on the driver, before any job, naming every absent column."""
    absent = [c for c in needed if c not in df.columns]
    if absent:
        raise ValueError(f"{what} lacks required columns: {absent}")
    return df


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def add_products(df: DataFrame, products: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Add one product column per entry; a column of that name is computed afresh.

    A square is the product of a column with itself: `a * a` is bit-stable across engines,
    `pow` is not.
    """
    require_columns(df, dict.fromkeys(c for pair in products.values() for c in pair), "feature table")
    return df.withColumns({name: quoted(a) * quoted(b) for name, (a, b) in products.items()})


def encode_label(label: Column, codes: Mapping[str, int]) -> Column:
    """Integer class code, NULL for a label outside the map."""
    coded = F.lit(None).cast("int")
    for name, code in codes.items():
        coded = F.when(label == name, F.lit(code)).otherwise(coded)
    return coded


def decode_label(prediction: Column, codes: Mapping[str, int]) -> Column:
    """Class name of a numeric prediction; the number's own text when the code is unknown."""
    code = prediction.try_cast("int")
    name = F.lit(None).cast("string")
    for text, value in codes.items():
        name = F.when(code == value, F.lit(text)).otherwise(name)
    return F.coalesce(name, prediction.cast("string"))


def unknown_labels(df: DataFrame, label: str, codes: Mapping[str, int]) -> DataFrame:
    """Sorted distinct labels outside the map, NULL shown as the text `null`."""
    text = F.coalesce(quoted(label).cast("string"), F.lit("null"))
    return (
        df.where(encode_label(quoted(label), codes).isNull())
        .select(text.alias("unknown_label"))
        .distinct()
        .orderBy("unknown_label")
    )


def with_label_code(
    df: DataFrame, label: str, codes: Mapping[str, int], out: str = "label_code", strict: bool = False
) -> DataFrame:
    """Add the class code. Strict mode writes all unknown labels to a table and raises if there are any.

    The error gives their number, the table's place and the first of them in order.
    """
    if strict:
        path = f"{shared_root(df.sparkSession)}/unknown_labels/{uuid.uuid4().hex}"
        unknown_labels(df, label, codes).write.parquet(path)
        found = df.sparkSession.read.schema("unknown_label string").parquet(path)
        number = found.count()
        if number:
            first = [r.unknown_label for r in found.orderBy("unknown_label").limit(100).collect()]
            raise ValueError(f"{number} unsupported labels in {label!r}, all of them in {path}; first: {first}")
    return df.withColumn(out, encode_label(quoted(label), codes))
