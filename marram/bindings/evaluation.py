"""Metrics, curves and search tables of a fixed classifier on the warehouse tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marram.bindings.registry import LINES, PRICE_RULE_SQL, load, price_rule, query
from marram.operators import metrics, roc, search
from marram.operators.preprocess import preprocessing_pipeline
from pyspark.ml.functions import vector_to_array


def judged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("actual"),
                                                price_rule().alias("predicted"))


def order_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_counts(judged_orders(spark, sf_dir), "actual", "predicted")


def _rounded(df: DataFrame, *columns: str, places: int = 9) -> DataFrame:
    return df.withColumns({c: F.round(c, places) for c in columns})


@query("accuracy", f"""
    select round(avg(case when o_orderstatus = {PRICE_RULE_SQL} then 1e0 else 0e0 end), 9) as accuracy from orders
""")
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.accuracy(judged_orders(spark, sf_dir), "actual", "predicted"), "accuracy")


@query("label_prediction_join", f"""
    select o_orderkey, o_orderstatus as actual, {PRICE_RULE_SQL} as predicted from orders
""")
def label_prediction_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders")
    labels = orders.select("o_orderkey", F.col("o_orderstatus").alias("actual"))
    guesses = orders.select("o_orderkey", price_rule().alias("predicted"))
    return metrics.align_predictions(labels, guesses, "o_orderkey")


# A rule that never says F and invents Q, so the matrix has empty rows and columns.
ODD_RULE_SQL = "case when o_totalprice < 200000 then 'O' when o_totalprice < 400000 then 'P' else 'Q' end"


def odd_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("o_totalprice")
    rule = F.when(price < 200000, "O").when(price < 400000, "P").otherwise("Q")
    judged = load(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("actual"), rule.alias("predicted"))
    return metrics.confusion_counts(judged, "actual", "predicted")


@query("confusion_matrix", f"""
    with p as (select o_orderstatus as y, {ODD_RULE_SQL} as h from orders),
    l as (select y as c from p union select h from p),
    n as (select y, h, count(*) as n from p group by y, h)
    select a.c as actual, b.c as predicted, coalesce(n.n, 0) as n
    from l a cross join l b left join n on n.y = a.c and n.h = b.c
""")
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_matrix(odd_counts(spark, sf_dir))


@query("confusion_wide", f"""
    select o_orderstatus as actual, count(*) filter ({PRICE_RULE_SQL} = 'F') as "F",
           count(*) filter ({PRICE_RULE_SQL} = 'O') as "O", count(*) filter ({PRICE_RULE_SQL} = 'P') as "P"
    from orders group by 1
""")
def confusion_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.confusion_wide(order_counts(spark, sf_dir), ["F", "O", "P"])


def _class_sql(rule: str) -> str:
    return f"""
    p as (select o_orderstatus as y, {rule} as h from orders),
    l as (select y as c from p union select h from p),
    m as (select l.c, count(*) filter (p.y = l.c and p.h = l.c) as tp, count(*) filter (p.y = l.c) as sup,
                 count(*) filter (p.h = l.c) as guessed
          from l cross join p group by l.c),
    s as (select c, tp, sup, case when guessed = 0 then 0e0 else tp / guessed end as pr,
                 case when sup = 0 then 0e0 else tp / sup end as rc,
                 case when sup + guessed = 0 then 0e0 else 2 * tp / (sup + guessed) end as f1 from m)
    """


REPORT_SQL = f"""
    with {_class_sql(ODD_RULE_SQL)}
    select 'class' as kind, c as label, round(pr, 9) as precision, round(rc, 9) as recall, round(f1, 9) as f1_score,
           cast(sup as bigint) as support from s
    union all select 'average', 'accuracy', round(sum(tp) / sum(sup), 9), round(sum(tp) / sum(sup), 9),
                     round(sum(tp) / sum(sup), 9), cast(sum(sup) as bigint) from s
    union all select 'average', 'macro avg', round(avg(pr), 9), round(avg(rc), 9), round(avg(f1), 9),
                     cast(sum(sup) as bigint) from s
    union all select 'average', 'weighted avg', round(sum(pr * sup) / sum(sup), 9), round(sum(rc * sup) / sum(sup), 9),
                     round(sum(f1 * sup) / sum(sup), 9), cast(sum(sup) as bigint) from s
"""


@query("classification_report", REPORT_SQL)
def classification_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = metrics.classification_report(odd_counts(spark, sf_dir))
    return _rounded(report, "precision", "recall", "f1_score")


@query("report_display", f"""
    select label, printf('%.2f', precision) as precision, printf('%.2f', recall) as recall,
           printf('%.2f', f1_score) as f1_score, cast(support as varchar) as support
    from ({REPORT_SQL}) where not (kind = 'average' and label = 'accuracy')
""")
def report_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.report_display(metrics.classification_report(odd_counts(spark, sf_dir)))


WEIGHTED_SQL = f"""
    with {_class_sql(PRICE_RULE_SQL)}
    select round(sum(tp) / sum(sup), 9) as accuracy, round(sum(pr * sup) / sum(sup), 9) as precision_weighted,
           round(sum(rc * sup) / sum(sup), 9) as recall_weighted, round(sum(f1 * sup) / sum(sup), 9) as f1_weighted,
           cast(sum(sup) as bigint) as n_rows
    from s
"""
WEIGHTED = ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted")


@query("weighted_metrics", WEIGHTED_SQL)
def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(metrics.weighted_metrics(order_counts(spark, sf_dir)), *WEIGHTED)


@query("metrics_record", f"""
    select *, 5901 as model_random_state, 0.2e0 as test_size, 'builtin_or_default' as data_input, false as use_scaling
    from ({WEIGHTED_SQL})
""")
def metrics_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    record = metrics.metrics_record(order_counts(spark, sf_dir), model_random_state=5901, test_size=0.2,
                                    data_input="builtin_or_default", use_scaling=False)
    return _rounded(record, *WEIGHTED)


# Class scores of the orders: coarse steps of the price, so many rows tie.
SCORES_SQL = """
    select o_orderstatus as label, s.c as class, case when o_orderstatus = s.c then 1 else 0 end as positive,
           case s.c when 'F' then 1e0 - floor(o_totalprice / 1000) / 500
                    when 'O' then 1e0 - abs(floor(o_totalprice / 1000) - 225) / 500
                    else floor(o_totalprice / 1000) / 500 end as score
    from orders, unnest(['F', 'O', 'P']) s(c)
"""


def order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = F.floor(F.col("o_totalprice") / 1000).cast("double")
    scores = {"F": 1.0 - step / 500, "O": 1.0 - F.abs(step - 225) / 500, "P": step / 500}
    return roc.one_vs_rest(load(spark, sf_dir, "orders"), "o_orderstatus", scores)


@query("roc_ovr", f"""
    select class, round(score, 9) as score, cast(sum(positive) as bigint) as positives, count(*) as n
    from ({SCORES_SQL}) group by 1, 2
""")
def roc_ovr(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_scores(spark, sf_dir).groupBy("class", F.round("score", 9).alias("score")).agg(
        F.sum("positive").alias("positives"), F.count(F.lit(1)).alias("n"))


@query("roc_points", """
    with x as (select l.quality as y, cast(d.n_chars as double) as sc from labels l join documents d on l.doc_id = d.doc_id),
    g as (select sc, sum(y) as p, count(*) - sum(y) as n from x group by sc),
    w as (select sc, sum(n) over (order by sc desc) as fp, sum(p) over (order by sc desc) as tp,
                 sum(p) over () as pp, sum(n) over () as nn from g),
    k as (select *, lag(fp) over (order by sc desc) as pf, lag(tp) over (order by sc desc) as pt,
                 lead(fp) over (order by sc desc) as nf, lead(tp) over (order by sc desc) as nt from w),
    a as (select sc as threshold, round(cast(fp as double) / nn, 9) as fpr, round(cast(tp as double) / pp, 9) as tpr
          from k where pf is null or nf is null or (nf - fp) <> (fp - pf) or (nt - tp) <> (tp - pt))
    select * from a union all select cast('Infinity' as double), 0e0, 0e0
""")
def roc_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = load(spark, sf_dir, "labels").join(load(spark, sf_dir, "documents").select("doc_id", "n_chars"), "doc_id")
    points = roc.roc_points(scored.select(F.col("quality").alias("positive"), F.col("n_chars").cast("double").alias("score")))
    return _rounded(points, "fpr", "tpr")


@query("roc_points_ovr", f"""
    with g as (select class, score as sc, sum(positive) as p, count(*) - sum(positive) as n from ({SCORES_SQL}) group by 1, 2),
    w as (select class, sc, sum(n) over o as fp, sum(p) over o as tp, sum(p) over (partition by class) as pp,
                 sum(n) over (partition by class) as nn from g window o as (partition by class order by sc desc)),
    k as (select *, lag(fp) over o as pf, lag(tp) over o as pt, lead(fp) over o as nf, lead(tp) over o as nt
          from w window o as (partition by class order by sc desc)),
    a as (select class, round(sc, 9) as threshold, round(cast(fp as double) / nn, 9) as fpr, round(cast(tp as double) / pp, 9) as tpr
          from k where pf is null or nf is null or (nf - fp) <> (fp - pf) or (nt - tp) <> (tp - pt))
    select * from a union all select c, cast('Infinity' as double), 0e0, 0e0 from unnest(['F', 'O', 'P']) s(c)
""")
def roc_points_ovr(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = roc.roc_points(order_scores(spark, sf_dir), ["class"])
    shown = F.when(F.col("threshold") == float("inf"), F.col("threshold")).otherwise(F.round("threshold", 9))
    return _rounded(points.withColumn("threshold", shown), "fpr", "tpr")


@query("auc_ovr", f"""
    with g as (select class, score as sc, sum(positive) as p, count(*) - sum(positive) as n from ({SCORES_SQL}) group by 1, 2),
    w as (select class, sc, p, n, coalesce(sum(n) over (partition by class order by sc rows between unbounded preceding
            and 1 preceding), 0) as below from g)
    select 'auc_' || class as metric, round(cast(sum(p * (below + 0.5e0 * n)) as double) / (sum(p) * sum(n)), 9) as auc,
           cast(sum(p) as bigint) as positives, cast(sum(n) as bigint) as negatives
    from w group by class
""")
def auc_ovr(spark: SparkSession, sf_dir: str) -> DataFrame:
    areas = _rounded(roc.auc(order_scores(spark, sf_dir), ["class"]), "auc")
    return areas.select(F.concat(F.lit("auc_"), "class").alias("metric"), "auc", "positives", "negatives")


def scaled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = LINES.canonical(load(spark, sf_dir, "lineitem"))
    return preprocessing_pipeline(LINES, use_scaling=True).fit(lines).transform(lines)


@query("standard_scale", """
    with s as (select avg(l_quantity) as mq, stddev_pop(l_quantity) as sq, avg(l_extendedprice) as mp,
                      stddev_pop(l_extendedprice) as sp, avg(l_discount) as md, stddev_pop(l_discount) as sd,
                      avg(l_tax) as mt, stddev_pop(l_tax) as st from lineitem)
    select round((l_quantity - mq) / sq, 6) + 0e0 as quantity, round((l_extendedprice - mp) / sp, 6) + 0e0 as price,
           round((l_discount - md) / sd, 6) + 0e0 as discount, round((l_tax - mt) / st, 6) + 0e0 as tax
    from lineitem, s
""")
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    scaled = scaled_lines(spark, sf_dir)
    return scaled.select(*[(F.round(f"scaled {c}", 6) + F.lit(0.0)).alias(c) for c in LINES.features])


@query("preprocessed_vectors", """
    with f as (select l_returnflag as return_flag, l_quantity as a, l_extendedprice as b, l_discount as c, l_tax as d,
                      l_quantity * l_quantity as e, l_extendedprice * l_extendedprice as g, l_quantity * l_extendedprice as h,
                      l_discount * l_tax as i, l_quantity * l_discount as j from lineitem),
    s as (select avg(a) ma, stddev_pop(a) sa, avg(b) mb, stddev_pop(b) sb, avg(c) mc, stddev_pop(c) sc, avg(d) md,
                 stddev_pop(d) sd, avg(e) me, stddev_pop(e) se, avg(g) mg, stddev_pop(g) sg, avg(h) mh, stddev_pop(h) sh,
                 avg(i) mi, stddev_pop(i) si, avg(j) mj, stddev_pop(j) sj from f)
    select return_flag, 9 as width, count(*) as n,
           round(avg((a-ma)/sa + (b-mb)/sb + (c-mc)/sc + (d-md)/sd + (e-me)/se + (g-mg)/sg + (h-mh)/sh + (i-mi)/si + (j-mj)/sj), 6) as mean_sum,
           round(avg(((a-ma)/sa)*((j-mj)/sj)), 6) as mean_first_last
    from f, s group by return_flag
""")
def preprocessed_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vector = scaled_lines(spark, sf_dir).select("return_flag", vector_to_array("features").alias("v"))
    total = F.aggregate("v", F.lit(0.0), lambda a, x: a + x)
    return vector.groupBy("return_flag", F.size("v").alias("width")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.avg(total), 6).alias("mean_sum"),
        F.round(F.avg(F.col("v")[0] * F.col("v")[8]), 6).alias("mean_first_last"))


def event_fold_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value per (user group, fold): stands for candidate scores."""
    return load(spark, sf_dir, "events").groupBy(
        (F.col("user_id") % 12).cast("int").alias("candidate_id"), (F.col("event_id") % 5).cast("int").alias("fold")
    ).agg(F.round(F.avg("value"), 6).alias("score"))


FOLD_SCORES_SQL = """
    select cast(user_id % 12 as integer) as candidate_id, cast(event_id % 5 as integer) as fold, round(avg(value), 6) as score
    from events group by 1, 2
"""
CV_SQL = f"""
    with s as ({FOLD_SCORES_SQL}),
    m as (select candidate_id, {", ".join(f"max(score) filter (fold = {i}) as split{i}_test_score" for i in range(5))},
                 avg(score) as mean_score, stddev_pop(score) as sd from s group by 1)
    select * exclude (mean_score, sd), round(mean_score, 6) as mean_test_score, round(sd, 6) as std_test_score,
           rank() over (order by mean_score desc) as rank_test_score from m
"""


def event_cv_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = search.cv_results(event_fold_scores(spark, sf_dir), 5)
    return _rounded(table, "mean_test_score", "std_test_score", places=6)


@query("cv_results", CV_SQL)
def cv_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_cv_table(spark, sf_dir)


@query("rank_candidates", """
    with m as (select event_type as candidate, round(avg(value), 1) as mean_test_score from events group by 1)
    select candidate, mean_test_score, rank() over (order by mean_test_score desc) as rank_test_score from m
""")
def rank_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = load(spark, sf_dir, "events").groupBy(F.col("event_type").alias("candidate")).agg(
        F.round(F.avg("value"), 1).alias("mean_test_score"))
    return search.rank_candidates(means, candidate="candidate")


@query("best_candidate", f"""
    select candidate_id, mean_test_score from ({CV_SQL}) order by mean_test_score desc, candidate_id limit 1
""")
def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = search.best_candidate(event_cv_table(spark, sf_dir))
    return best.select("candidate_id", "mean_test_score")
