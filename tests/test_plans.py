from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from marram.operators.timing import SCALING_RULES, sliding_means
from marram.operators.forest import in_parallel
from marram.plans.feature_source import claim_version, prepare_feature_source, read_registry, registered_spec
from marram.plans.monitor_daily import monitor_daily
from marram.plans.score_batch import score_batch
from marram.schema import FLOWERS
from marram.sources.readers import Candidate, asset_choice, read_feature_set, resolve_source

NAMES = FLOWERS.features


def test_feature_source_versions(spark, flowers, tmp_path):
    flowers.write.parquet(str(tmp_path / "flowers"))
    chain = [Candidate("table", str(tmp_path / "flowers"))]
    first = prepare_feature_source(spark, chain, FLOWERS, "row_key", str(tmp_path / "store"))
    second = prepare_feature_source(spark, chain, FLOWERS, "row_key", str(tmp_path / "store"))
    assert (first.version, second.version) == ("1", "2")
    assert read_registry(spark, str(tmp_path / "store")).count() == 20
    kept, refused = read_feature_set(spark, second, format="parquet")
    assert kept.count() == 150 and refused.count() == 0


def test_asset_switch(spark, tmp_path):
    gone, there = Candidate("asset", str(tmp_path / "gone")), Candidate("local", build=lambda s: s.range(3))
    pick = lambda mode: resolve_source(spark, asset_choice(mode, gone, [there]), strict=False)
    assert pick("auto").count() == 3 and pick("false").count() == 3
    with pytest.raises(FileNotFoundError):
        pick("true")
    with pytest.raises(ValueError, match="auto, true or false"):
        pick("maybe")


def _rule(rows):
    return rows.withColumn("prediction", F.when(F.col("`petal width (cm)`") < 1, 0.0).otherwise(2.0))


def test_scored_days_are_monitored(spark, flowers, tmp_path):
    root = str(tmp_path / "served")
    body = F.to_json(F.struct(F.array(F.array(*[F.col(f"`{c}`") + F.col("shift") for c in NAMES])).alias("data")))
    for day, shift in ((3, 0.0), (4, 5.0)):
        requests = flowers.withColumn("shift", F.lit(shift)).select(F.col("row_key").cast("string").alias("id"), body.alias("raw"))
        bad = spark.createDataFrame([("bad", "{")], "id string, raw string")
        for _ in range(2):
            score_batch(requests.union(bad), raw="raw", request_id="id", scorer=_rule, features=NAMES, codes=FLOWERS.codes,
                        root=root, batch_id=day, collected_at=datetime(2024, 1, day, 12))
    assert spark.read.parquet(f"{root}/rejected").count() == 2
    assert spark.read.parquet(f"{root}/responses").count() == 302
    seen = {}
    for day in (4, 5):
        tables = monitor_daily(spark, root, flowers, NAMES, "species", date(2024, 1, day), str(tmp_path / "monitor"))
        of_day = lambda name: tables[name].where(F.col("monitor_day") == date(2024, 1, day))  # noqa: B023,E731
        assert of_day("data_quality").agg(F.min("n")).first()[0] == 150
        seen[day] = (of_day("drift_exact").agg(F.max("ks")).first()[0], of_day("drift_binned").agg(F.min("psi")).first()[0],
                     of_day("data_quality").agg(F.sum("out_of_bounds")).first()[0])
    assert seen[4] == (0.0, pytest.approx(0.0), 0)
    assert seen[5][0] > 0.9 and seen[5][1] > 1 and seen[5][2] > 400
    drifted = tables["prediction_drift"].where(F.col("monitor_day") == date(2024, 1, 4)).first()
    assert drifted.total_variation == pytest.approx(1 / 3)


def test_sliding_rule_on_a_stream(spark, tmp_path):
    rows = [(datetime(2024, 1, 1, 0, m), "cpu", 90.0 if m < 5 else 10.0) for m in range(20)]
    df = spark.createDataFrame(rows, "t timestamp, s string, v double")
    batch = {(r.window_end, r.fires) for r in sliding_means(df, series="s", time="t", value="v", rule=SCALING_RULES[0]).collect()}
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    live = sliding_means(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), series="s", time="t", value="v", rule=SCALING_RULES[0])
    out = str(tmp_path / "out")
    live.writeStream.outputMode("update").foreachBatch(lambda b, i: b.write.mode("overwrite").parquet(f"{out}/b={i}")).option(
        "checkpointLocation", str(tmp_path / "check")).trigger(availableNow=True).start().awaitTermination()
    assert {(r.window_end, r.fires) for r in spark.read.parquet(out).collect()} == batch
    assert sum(f for _, f in batch) == 6


def test_registry_reads_back_as_a_spec(spark, flowers, tmp_path):
    root = str(tmp_path / "store")
    flowers.write.parquet(str(tmp_path / "flowers"))
    chain = [Candidate("table", str(tmp_path / "flowers"))]
    written = [prepare_feature_source(spark, chain, FLOWERS, "row_key", root, id_column="plant") for _ in range(2)]
    for spec in written:
        again = registered_spec(spark, root, "feature_source", spec.version)
        assert again == spec and again.index == ("plant",)
        assert read_feature_set(spark, again, format="parquet")[0].count() == 150
    with pytest.raises(LookupError):
        registered_spec(spark, root, "feature_source", "9")


def test_versions_are_claimed_once(spark, tmp_path):
    claims = [lambda: claim_version(spark, str(tmp_path), "x", "3")] * 6
    assert sorted(in_parallel(spark, claims, 6)) == ["3", "4", "5", "6", "7", "8"]
