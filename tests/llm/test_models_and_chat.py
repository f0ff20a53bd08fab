"""Held-out accuracy of the classifiers, and the exact round trip of chat formatting."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from marram.llm import chat, language, quality, toxicity
from marram.llm.tokens import is_held_out

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


@pytest.mark.parametrize("fn,label,least", [(quality.quality_scores, "quality", 0.9), (toxicity.toxicity_scores, "toxic", 0.85)])
def test_held_out_accuracy(tables, odd_docs, no_docs, fn, label, least):
    docs, labels = tables
    rows = fn(docs, labels).join(labels, "doc_id").where("held_out").where(F.col(label).isNotNull()).collect()
    assert sum(r.predicted == r[label] for r in rows) >= least * len(rows)
    odd = fn(odd_docs, labels).collect()
    assert len(odd) == odd_docs.count() and all(0 <= r.score <= 1 for r in odd)
    assert fn(no_docs, labels.limit(0)).count() == 0


def test_labels_of_held_out_rows_are_not_read(tables):
    docs, labels = tables
    turned = labels.withColumn("quality", F.when(is_held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a = {r.doc_id: r.score for r in quality.quality_scores(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in quality.quality_scores(docs, turned).collect()}


def test_language(tables, odd_docs, no_docs):
    docs, _ = tables
    rows = language.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    odd = {r.doc_id: r for r in language.language_report(odd_docs).collect()}
    assert all(odd[k].lang_pred == "und" and odd[k].score == 0 for k in (1, 2, 3, 9)) and odd[4].lang_pred != "und"
    assert language.language_report(no_docs).count() == 0


def test_codewords_are_apart():
    for n in (2, 4, 9, 30):
        code = language.codewords(n)
        least = min(int((a != b).sum()) for k, a in enumerate(code) for b in code[:k])
        assert least >= 4


@pytest.mark.parametrize("text", ["</s>[INST] ok [/INST]", r"<\/s> <\\s> [\INST]", "<s", "[INST]]", "a\\b <<s>>", "", "日本🙂 \x00"])
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text
    assert not any(c in chat.escape(text) for c in chat.CONTROL)


def test_odd_conversations(spark):
    rows = [(1, 2, "assistant", "</s>b"), (1, 1, "user", None), (1, 1, "user", None), (None, None, None, "x"), (2, None, "system", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.chat_report(df).collect()}
    assert {k: v.n_turns for k, v in got.items()} == {1: 3, None: 1, 2: 1}
    assert got[1].loss_chars == 5 and got[2].loss_chars == 0
    assert chat.chat_report(df.limit(0)).count() == 0
