from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marram.functions.features import decode_label, unknown_labels, with_label_code
from marram.functions.text import abfss_uri, or_default, parse_store_uri, strip_prefix, text_to_bool
from marram.operators.preprocess import PopulationScaler, preprocessing_pipeline
from marram.schema import FLOWERS

ONE = (5.1, 3.5, 1.4, 0.2)
MEASURES = ", ".join(f"`{c}` double" for c in FLOWERS.features)


def test_products_are_exact(spark):
    row = FLOWERS.with_products(spark.createDataFrame([ONE], MEASURES)).first()
    sl, sw, pl, pw = ONE
    assert [row[c] for c in FLOWERS.products] == [sl * sl, pl * pl, sl * sw, pl * pw, sl * pl]


def test_stale_products_are_refreshed_and_others_kept(spark):
    stale = spark.createDataFrame([(*ONE, -1.0, "x")], MEASURES + ", `sepal length squared` double, note string")
    row = FLOWERS.with_products(stale).first()
    assert row["sepal length squared"] == 5.1 * 5.1 and row["note"] == "x"


def test_model_frame_order(spark):
    frame = FLOWERS.model_frame(spark.createDataFrame([ONE], "`petal width (cm)` double, `petal length (cm)` double, "
                                                             "`sepal width (cm)` double, `sepal length (cm)` double"))
    assert tuple(frame.columns) == FLOWERS.model_features and len(frame.columns) == 9


def test_missing_columns_are_all_named(spark):
    with pytest.raises(ValueError, match="sepal width.*petal width"):
        FLOWERS.with_products(spark.createDataFrame([(1.0, 2.0)], "`sepal length (cm)` double, `petal length (cm)` double"))


def test_canonical_renames_and_drops_extras(spark):
    raw = spark.createDataFrame([(*ONE, "setosa", 9)], "sepal_length double, sepal_width double, petal_length double, "
                                                       "petal_width double, species string, extra int")
    assert tuple(FLOWERS.canonical(raw).columns) == FLOWERS.columns
    again = FLOWERS.canonical(FLOWERS.canonical(raw))
    assert again.first()[0] == 5.1


def test_unknown_labels_are_sorted_and_show_null(spark):
    df = spark.createDataFrame([("tulip",), (None,), ("setosa",), ("aster",), ("tulip",)], "species string")
    assert [r[0] for r in unknown_labels(df, "species", FLOWERS.codes).collect()] == ["aster", "null", "tulip"]
    with pytest.raises(ValueError, match=r"\['aster', 'null', 'tulip'\]"):
        with_label_code(df, "species", FLOWERS.codes, strict=True)


def test_decode_falls_back_to_text(spark):
    df = spark.createDataFrame([(0,), (2,), (7,)], "p long")
    assert [r[0] for r in df.select(decode_label(F.col("p"), FLOWERS.codes)).collect()] == ["setosa", "virginica", "7"]


def test_text_rules(spark):
    df = spark.createDataFrame([(" Yes ", "", "model__max_depth"), ("N", "x", "model"), ("2", None, "a_model__b")],
                               "t string, d string, p string")
    rows = df.select(text_to_bool(F.col("t")), or_default(F.col("d"), "none"), strip_prefix(F.col("p"))).collect()
    assert [tuple(r) for r in rows] == [(True, "none", "max_depth"), (False, "x", "model"), (None, "none", "a_model__b")]


def test_strict_switch_names_the_text(spark):
    df = spark.createDataFrame([("yes",), ("perhaps",)], "t string")
    with pytest.raises(Exception, match="got perhaps"):
        df.select(text_to_bool(F.col("t"), strict=True)).collect()
    assert df.limit(1).select(text_to_bool(F.col("t"), strict=True)).first()[0] is True


def test_addresses(spark):
    df = spark.createDataFrame([("azureml://datastores/lake/paths/a/paths/b.csv",), ("azureml://datastores/lake/x",),
                                ("https://datastores/lake/paths/a",)], "u string")
    rows = [r[0] for r in df.select(parse_store_uri(F.col("u"))).collect()]
    assert tuple(rows[0]) == ("lake", "a/paths/b.csv") and rows[1:] == [None, None]
    made = spark.range(1).select(abfss_uri(F.lit("acct"), F.lit("fs"), F.lit("/data/x.csv"))).first()[0]
    assert made == "abfss://fs@acct.dfs.core.windows.net/data/x.csv"


def test_preprocessing_keeps_its_shape(spark):
    df = spark.createDataFrame([ONE, (4.9, 3.0, 1.4, 0.2)], MEASURES)
    for scaled in (False, True):
        out = preprocessing_pipeline(FLOWERS, scaled).fit(df).transform(df)
        assert [len(r.features) for r in out.collect()] == [9, 9]


def test_scaler_uses_population_deviation_and_survives_constants(spark):
    df = spark.createDataFrame([(1.0, 0.1), (3.0, 0.1)], "a double, b double")
    scaled = PopulationScaler(inputs=["a", "b"], outputs=["x", "y"]).fit(df).transform(df)
    assert sorted((r.x, r.y) for r in scaled.collect()) == [(-1.0, 0.0), (1.0, 0.0)]
