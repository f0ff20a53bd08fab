from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from marram.functions.payload import parse_payloads
from marram.operators import scoring
from marram.schema import FLOWERS
from marram.sources.sinks import read_collection, write_collection
from marram.streaming.scoring import stream_scores

NAMES = FLOWERS.features
GOOD = dict(zip(NAMES, (5.1, 3.5, 1.4, 0.2)))
CASES = {
    "lists": ({"data": [[5.1, 3.5, 1.4, 0.2], [6.2, 3.4, 5.4, 2.3]]}, 0),
    "objects, other order": ({"data": [dict(reversed(GOOD.items()))], "more": 1}, 0),
    "not json": ("{oops", 2),
    "empty text": ("", 2),
    "top list": ([1], 3),
    "top null": ("null", 3),
    "no data": ({"rows": []}, 4),
    "null data": ({"data": None}, 5),
    "text data": ({"data": "x"}, 5),
    "object data": ({"data": {"a": 1}}, 5),
    "empty data": ({"data": []}, 6),
    "short row": ({"data": [[1, 2, 3, 4], [1, 2, 3]]}, 7),
    "missing name": ({"data": [GOOD, {NAMES[0]: 1}]}, 8),
    "missing before extra": ({"data": [{NAMES[0]: 1, "z": 2}]}, 8),
    "extra name": ({"data": [{**GOOD, "z": 1}]}, 9),
    "mixed": ({"data": [GOOD, [1, 2, 3, 4]]}, 10),
    "scalars": ({"data": [1, 2]}, 10),
    "text value": ({"data": [["1", 2, 3, 4]]}, 11),
    "null value": ({"data": [{**GOOD, NAMES[3]: None}]}, 11),
    "nested value": ({"data": [[[1], 2, 3, 4]]}, 11),
}


@pytest.fixture(scope="module")
def requests(spark):
    text = lambda body: body if isinstance(body, str) else json.dumps(body)
    rows = [(name, text(body)) for name, (body, _) in CASES.items()] + [("null text", None)]
    return spark.createDataFrame(rows, "id string, raw string")


def petal_rule(rows):
    return rows.withColumn("prediction", F.when(F.col("`petal width (cm)`") < 1, 0.0).otherwise(9.0))


def test_first_failing_rule_decides(requests):
    got = {r.id: (r.error_code, r.error, r.rows) for r in parse_payloads(requests, "raw", NAMES).collect()}
    assert {k: v[0] for k, v in got.items()} == {**{k: c for k, (_, c) in CASES.items()}, "null text": 2}
    assert all((v[1] is None) == (v[0] == 0) and (v[2] is not None) == (v[0] == 0) for v in got.values())
    assert got["short row"][1] == "Each input row must contain exactly 4 values."
    assert got["objects, other order"][2] == [[5.1, 3.5, 1.4, 0.2]]


def test_responses_keep_order_and_reject_whole_requests(requests):
    got = {r.id: r for r in scoring.score_requests(requests, "raw", petal_rule, NAMES, FLOWERS.codes, "id").collect()}
    assert len(got) == len(CASES) + 1
    assert got["lists"].predictions == [0, 9] and got["lists"].predicted_labels == ["setosa", "9"]
    assert got["mixed"].predictions is None and "same format" in got["mixed"].error
    shown = {r.id: json.loads(r.response) for r in scoring.response_json(
        scoring.score_requests(requests, "raw", petal_rule, NAMES, FLOWERS.codes, "id"), "id").collect()}
    assert shown["lists"] == {"predictions": [0, 9], "predicted_labels": ["setosa", "9"]}
    assert list(shown["mixed"]) == ["error"]


def test_collections_belong_together(spark, requests, tmp_path):
    parsed = parse_payloads(requests, "raw", NAMES)
    predicted = scoring.predict_requests(parsed, petal_rule, NAMES, FLOWERS.codes, "id")
    inputs = scoring.model_inputs(predicted, NAMES, "id")
    outputs = scoring.model_outputs(predicted, "id").where("correlation_id = 'lists'")
    for _ in range(2):  # a batch written twice is there once
        write_collection(inputs, outputs, str(tmp_path), 0)
    inputs, outputs = read_collection(spark, str(tmp_path))
    assert scoring.correlate(inputs, outputs).count() == 2
    assert [r.correlation_id for r in scoring.unscored(inputs, outputs).collect()] == ["objects, other order"]
    assert scoring.rejected(parsed, "id").count() == len(CASES) - 1


def test_parsing_is_not_repeated_by_filters(requests, capsys):
    parsed = parse_payloads(requests, "raw", NAMES)
    for df in (scoring.score_requests(requests, "raw", petal_rule, NAMES, FLOWERS.codes, "id"),
               scoring.rejected(parsed, "id")):
        df.explain()
        assert capsys.readouterr().out.count("parseJson") == 1


def _stream(spark, folder, root, **more):
    source = spark.readStream.schema("id string, raw string").json(str(folder))
    query = stream_scores(source, raw="raw", request_id="id", scorer=petal_rule, features=NAMES, codes=FLOWERS.codes,
                          root=f"{root}/out", checkpoint=f"{root}/check", **more)
    query.awaitTermination()


def test_stream_equals_batch_and_resumes(spark, requests, tmp_path):
    folder = tmp_path / "in"
    requests.where("length(id) % 2 = 0").coalesce(1).write.mode("append").json(str(folder))
    _stream(spark, folder, tmp_path)
    requests.where("length(id) % 2 = 1").coalesce(1).write.mode("append").json(str(folder))
    _stream(spark, folder, tmp_path)
    batch = scoring.score_requests(requests, "raw", petal_rule, NAMES, FLOWERS.codes, "id")
    show = lambda df: sorted((r.id, r.predictions, r.predicted_labels, r.error) for r in df.collect())
    got = spark.read.parquet(f"{tmp_path}/out/responses")
    assert [str(r) for r in show(got)] == [str(r) for r in show(batch)]
    assert {r.batch_id for r in got.select("batch_id").distinct().collect()} == {0, 1}


def test_failing_collection_does_not_fail_scoring(spark, requests, tmp_path, monkeypatch):
    import marram.streaming.scoring as module

    def broken(*_):
        raise OSError("store is down")

    monkeypatch.setattr(module, "write_collection", broken)
    requests.coalesce(1).write.json(str(tmp_path / "in"))
    _stream(spark, tmp_path / "in", tmp_path)
    assert spark.read.parquet(f"{tmp_path}/out/responses").count() == len(CASES) + 1
