from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import types as T

from marram.operators.entities import build_feature_source
from marram.schema import FLOWERS, FeatureSetSpec
from marram.session import scratch_path, shared_root
from marram.sources import readers, sinks


def test_csv_by_header_name(spark, tmp_path):
    path = tmp_path / "flowers.csv"
    path.write_text("species,extra,petal_width,petal_length,sepal_width,sepal_length\nsetosa,x,0.2,1.4,3.5,5.1\n")
    df = readers.read_canonical_csv(spark, str(path), FLOWERS)
    assert tuple(df.columns) == FLOWERS.columns and tuple(df.first()) == (5.1, 3.5, 1.4, 0.2, "setosa")
    path.write_text("species,petal_width\nsetosa,0.2\n")
    with pytest.raises(ValueError, match="sepal length.*petal length"):
        readers.read_canonical_csv(spark, str(path), FLOWERS)


def test_source_chain(spark, flowers, tmp_path):
    there = str(tmp_path / "there")
    flowers.write.parquet(there)
    chain = [readers.Candidate("given", str(tmp_path / "gone")), readers.Candidate("default", there),
             readers.Candidate("built in", build=lambda s: s.range(1))]
    assert readers.resolve_source(spark, chain, strict=False).select("source_description").distinct().first()[0] == "default"
    assert readers.resolve_source(spark, [chain[0], chain[2]], strict=False).count() == 1
    with pytest.raises(FileNotFoundError, match="given"):
        readers.resolve_source(spark, chain)


def test_a_broken_source_is_not_skipped(spark, tmp_path):
    (tmp_path / "bad.parquet").write_text("no parquet")
    with pytest.raises(Exception):
        readers.resolve_source(spark, [readers.Candidate("bad", str(tmp_path / "bad.parquet")),
                                       readers.Candidate("built in", build=lambda s: s.range(1))], strict=False).count()


@pytest.mark.parametrize("fmt", ["csv", "parquet"])
def test_feature_source_survives_the_disk(spark, flowers, tmp_path, fmt):
    built = build_feature_source(flowers, FLOWERS, "row_key")
    sinks.write_feature_source(built, str(tmp_path / "fs"), format=fmt, partition_by_date=True)
    spec = FeatureSetSpec.of(built, "measurements", ("flower_id",))
    kept, refused = readers.read_feature_set(spark, spec, str(tmp_path / "fs"), format=fmt)
    assert refused.count() == 0 and kept.schema["event_timestamp"].dataType == T.TimestampNTZType()
    want = {r.flower_id: tuple(r)[2:] for r in built.collect()}
    assert {r.flower_id: tuple(r)[2:] for r in kept.collect()} == want
    assert kept.where("flower_id = 'flower_00002'").first().event_timestamp == datetime(2024, 1, 1, 1)


def test_rows_that_break_the_spec_are_set_aside(spark):
    spec = FeatureSetSpec("s", ("id",), {"x": "double"})
    raw = spark.createDataFrame([("a", "2024-01-01T00:00:00Z", "1.5"), (None, "2024-01-01T00:00:00Z", "1"),
                                 ("b", "01/01/2024", "1"), ("c", "2024-01-01T00:00:00Z", "one"), ("d", "2024-01-01T00:00:00Z", None)],
                                "id string, event_timestamp string, x string")
    got = {r.id: r.reject_reason for r in readers.enforce_spec(raw, spec).collect()}
    assert got == {"a": None, None: "index:id", "b": "timestamp", "c": "type:x", "d": None}
    with pytest.raises(ValueError, match="x"):
        readers.enforce_spec(raw.drop("x"), spec)


def test_requests_get_distinct_ids(spark, tmp_path):
    (tmp_path / "r.txt").write_text('{"data": []}\n{"data": []}\n')
    rows = readers.read_requests(spark, str(tmp_path / "r.txt")).collect()
    assert len({r.request_id for r in rows}) == 2 and rows[0].raw_data == '{"data": []}'


def test_registry_records(spark, flowers):
    built = build_feature_source(flowers, FLOWERS, "row_key")
    rows = sinks.registry_records(built, FeatureSetSpec.of(built, "measurements", ("flower_id",))).orderBy("position").collect()
    assert [r.feature for r in rows] == [*FLOWERS.model_features, "species"]
    assert rows[0].type == "double" and rows[9].type == "string" and rows[0].n_rows == rows[0].n_values == 150
    assert rows[0].first_event == "2024-01-01T00:00:00Z"


def test_run_folders():
    assert sinks.run_path("/runs/", "r7", datetime(2024, 5, 6, 7, 8, 9)) == "/runs/2024-05-06/070809_r7"


def test_shared_folder_comes_from_the_session(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a", 1) == scratch_path(spark, "a", 1) != scratch_path(spark, "a", 2)


def test_stream_ids_equal_batch_ids(spark, tmp_path):
    """Equal bodies have different ids, the same in batch and stream, whatever arrives together."""
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.txt").write_text("x\nx\ny\n" * 30)
    (source / "b.txt").write_text("x\nz\n")
    batch = {(r.raw_data, r.request_id) for r in readers.read_requests(spark, str(source)).collect()}
    assert len(batch) == 92
    running = readers.stream_requests(spark, str(source)).writeStream.format("parquet").option(
        "checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
    running.awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert len(rows) == 92 and {(r.raw_data, r.request_id) for r in rows} == batch


def test_a_crowded_body_is_numbered_in_parts(spark, tmp_path):
    (tmp_path / "r.txt").write_text("same\n" * 5000)
    ids = readers.read_requests(spark, str(tmp_path / "r.txt")).select("request_id")
    assert ids.distinct().count() == 5000
