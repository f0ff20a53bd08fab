"""Scoring requests built from the event table, one broken form per validation rule."""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.bindings.registry import EVENT_SQL, EVENTS, event_measurements, load, query
from marram.functions.features import encode_label
from marram.functions.payload import parse_payloads
from marram.operators import scoring
from marram.operators.forest import fit_forest, fitted_rows, training_table
from marram.operators.preprocess import preprocessing_stages
from marram.session import scratch_path
from marram.sources.readers import read_requests
from marram.sources.sinks import read_collection, write_collection
from marram.streaming.scoring import stream_scores

FORMS = 20  # event_id % 20 picks the form of the request


def event_requests(events: DataFrame) -> DataFrame:
    """(event_id, raw_data): forms 2 to 11 break the rule of that number, the rest are valid."""
    rows = event_measurements(events)
    v, k, user, hour = (F.col(c) for c in EVENTS.features)
    named = lambda **more: F.to_json(F.struct(F.array(F.struct(
        hour.alias("hour"), k.alias("k"), user.alias("user"), v.alias("value"),
        *[F.lit(x).alias(n) for n, x in more.items()])).alias("data")))
    lists = lambda *items: F.to_json(F.struct(F.array(*items).alias("data")))
    full = F.array(v, k, user, hour)
    text = lambda s: F.lit(s)
    forms = {
        0: lists(full, F.array(k, v, hour, user)),
        1: named(),
        2: text('{"data": [[1, 2'),
        3: F.to_json(F.array(v, k)),
        4: F.to_json(F.struct(F.array(full).alias("rows"))),
        5: text('{"data": null}'),
        6: text('{"data": []}'),
        7: lists(full, F.array(v, k, user)),
        8: F.to_json(F.struct(F.array(F.struct(v.alias("value"), k.alias("k"))).alias("data"))),
        9: named(colour=1),
        10: F.concat(F.lit('{"data": ['), F.to_json(full), F.lit(', {"value": 1}]}')),
        11: F.concat(F.lit('{"data": [["a", 1, 2, '), user.cast("string"), F.lit("]]}")),
    }
    raw = lists(full)
    for form, body in forms.items():
        raw = F.when(F.col("event_id") % FORMS == form, body).otherwise(raw)
    return rows.select("event_id", raw.alias("raw_data"))


def value_rule(rows: DataFrame) -> DataFrame:
    """A fixed model on the value column; 7 is a code without a name."""
    v = F.col("value")
    return rows.withColumn("prediction", F.when(v < 25, 0.0).when(v < 50, 1.0).when(v < 100, 4.0).otherwise(7.0))


# The rows of the valid requests, straight from the table.
ROWS_SQL = f"""
    e as ({EVENT_SQL}),
    r as (select event_id, 0 as row_pos, value, k, "user", hour from e where event_id % 20 < 2 or event_id % 20 > 11
          union all
          select event_id, 1, k, value, hour, "user" from e where event_id % 20 = 0),
    p as (select *, cast(case when value < 25 then 0 when value < 50 then 1 when value < 100 then 4 else 7 end as bigint) as prediction from r),
    o as (select *, case prediction when 0 then 'click' when 1 then 'error' when 4 then 'view' else '7' end as predicted_label from p)
"""
ERROR_SQL = """
    case event_id % 20
      when 2 then 'Request payload is not valid JSON.' when 3 then 'Request payload must be a JSON object.'
      when 4 then 'Request payload must contain a ''data'' field.'
      when 5 then 'The ''data'' field must contain a list of rows.' when 6 then 'The ''data'' field must not be empty.'
      when 7 then 'Each input row must contain exactly 4 values.'
      when 8 then 'Each object row must contain all required feature names.'
      when 9 then 'Object rows may only contain the expected feature names.'
      when 10 then 'Each entry in ''data'' must use the same format: all lists or all objects.'
      when 11 then 'Feature values must be numbers.' end
"""


def parsed_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_payloads(event_requests(load(spark, sf_dir, "events")), "raw_data", EVENTS.features)


def predicted_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.predict_requests(
        parsed_requests(spark, sf_dir), value_rule, EVENTS.features, EVENTS.codes, "event_id")


@query("parse_requests", f"""
    with {ROWS_SQL}
    select event_id, 0 as error_code, row_pos, value, k, "user", hour from r
    union all
    select event_id, cast(event_id % 20 as integer), -1, null, null, null, null from e where event_id % 20 between 2 and 11
""")
def parse_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = parsed_requests(spark, sf_dir)
    rows = parsed.select("event_id", "error_code", F.posexplode_outer("rows").alias("row_pos", "row"))
    return rows.select("event_id", "error_code", F.coalesce("row_pos", F.lit(-1)).alias("row_pos"),
                       *[F.col("row")[i].alias(f) for i, f in enumerate(EVENTS.features)])


def _flat(answers: DataFrame) -> DataFrame:
    return answers.select("event_id", F.array_join(F.transform("predictions", lambda p: p.cast("string")), ",").alias("predictions"),
                          F.array_join("predicted_labels", ",").alias("predicted_labels"), "error")


@query("request_files", """
    select cast(case when event_id % 20 between 2 and 11 then event_id % 20 else 0 end as integer) as error_code,
           2 * count(*) as n_requests, 2 * count(*) as n_ids
    from events group by 1
""")
def request_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every request body twice in text files, read back under ids of its own and judged."""
    bodies = event_requests(load(spark, sf_dir, "events")).select("raw_data")
    path = scratch_path(spark, "request_files", sf_dir)
    bodies.unionAll(bodies).write.mode("overwrite").text(path)
    judged = parse_payloads(read_requests(spark, path), "raw_data", EVENTS.features)
    return judged.groupBy(F.coalesce("error_code", F.lit(0)).alias("error_code")).agg(
        F.count(F.lit(1)).alias("n_requests"), F.countDistinct("request_id").alias("n_ids"))


SCORES_SQL = f"""
    with {ROWS_SQL}
    select event_id, string_agg(cast(prediction as varchar), ',' order by row_pos) as predictions,
           string_agg(predicted_label, ',' order by row_pos) as predicted_labels, cast(null as varchar) as error
    from o group by event_id
    union all
    select event_id, null, null, {ERROR_SQL} from e where event_id % 20 between 2 and 11
"""


@query("score_requests", SCORES_SQL)
def score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = event_requests(load(spark, sf_dir, "events"))
    return _flat(scoring.score_requests(requests, "raw_data", value_rule, EVENTS.features, EVENTS.codes, "event_id"))


@query("rejected_requests", f"""
    select event_id, cast(event_id % 20 as integer) as error_code, {ERROR_SQL} as error from events
    where event_id % 20 between 2 and 11
""")
def rejected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.rejected(parsed_requests(spark, sf_dir), "event_id")


def _collected(spark: SparkSession, sf_dir: str, name: str) -> tuple[DataFrame, DataFrame]:
    """Write both collections of all requests and read them back."""
    root = scratch_path(spark, name, sf_dir)
    predicted = predicted_requests(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    write_collection(scoring.model_inputs(predicted, EVENTS.features, "event_id"),
                     scoring.model_outputs(predicted, "event_id"), root, 0)
    predicted.unpersist()
    return read_collection(spark, root)


@query("collect_correlated", f"""
    with {ROWS_SQL}
    select event_id as correlation_id, row_pos, value, k, "user", hour, prediction, predicted_label from o
""")
def collect_correlated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scoring.correlate(*_collected(spark, sf_dir, "collect_correlated"))


@query("unscored_inputs", f"""
    with {ROWS_SQL}
    select event_id as correlation_id, row_pos, value, k, "user", hour from o where predicted_label = '7'
""")
def unscored_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All inputs against the outputs that got a class name; code 7 has none and stands for lost outputs."""
    inputs, outputs = _collected(spark, sf_dir, "unscored_inputs")
    return scoring.unscored(inputs, outputs.where(F.col("predicted_label") != "7"))


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    schema = load(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query("stream_score", SCORES_SQL)
def stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream_score", sf_dir, uuid.uuid4())
    running = stream_scores(
        event_requests(stream_table(spark, sf_dir, "events")), raw="raw_data", request_id="event_id",
        scorer=value_rule, features=EVENTS.features, codes=EVENTS.codes, root=root,
        checkpoint=f"{root}/checkpoint",
    )
    running.awaitTermination()
    return _flat(spark.read.parquet(f"{root}/responses").drop("batch_id"))


@query("score_requests_model", f"""
    with {ROWS_SQL}
    select event_id, count(*) as n_rows, cast(0 as bigint) as n_unknown, cast(null as varchar) as error from o group by event_id
    union all
    select event_id, 0, 0, {ERROR_SQL} from e where event_id % 20 between 2 and 11
""")
def score_requests_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same requests under the default forest, fitted on a bounded number of labelled events."""
    events = load(spark, sf_dir, "events")
    labelled = event_measurements(events).withColumn("code", encode_label(F.col("event_type"), EVENTS.codes))
    stages = Pipeline(stages=preprocessing_stages(EVENTS)).fit(labelled)
    train = training_table(stages.transform(fitted_rows(labelled, "event_id")), "event_id", "code", len(EVENTS.codes))
    model = PipelineModel([*stages.stages, fit_forest(train, {})])
    answers = scoring.score_requests(event_requests(events), "raw_data", model.transform, EVENTS.features,
                                     EVENTS.codes, "event_id")
    unknown = F.filter("predicted_labels", lambda v: ~F.coalesce(v.isin(list(EVENTS.codes)), F.lit(False)))
    return answers.select("event_id", F.coalesce(F.size("predictions"), F.lit(0)).cast("long").alias("n_rows"),
                          F.coalesce(F.size(unknown), F.lit(0)).cast("long").alias("n_unknown"), "error")
