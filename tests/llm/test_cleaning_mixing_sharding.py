"""Line rules, mixing and sharding: SQL on the shared tables (test_registered), laws and odd rows here."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from marram.llm import cleaning, mixing, sharding, tokens
from marram.llm.tokens import GAP_CHARS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _base(text):
    words = WORD.findall(text or "")
    windows = Counter(tuple(words[k:k + 3]) for k in range(len(words) - 2))
    covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def test_base_counts_by_hand(odd_docs, docs):
    for df in (odd_docs, docs):
        want = Counter((r.doc_id, _base(r.text)) for r in df.collect())
        rows = cleaning.quality_report(df).collect()
        assert Counter((r.doc_id, tuple(r)[1:6]) for r in rows) == want
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) for r in rows)
        assert not any(r.kept and r.base_failed for r in rows)


def test_failing_lines_go(spark):
    text = "\n".join([*(" ".join(f"w{k}x{j}" for j in range(12)) + "." for k in range(6)), "Home | About | Contact | Help", "home login menu",
                      "BUY!! NOW!! CHEAP!! ***", "Licensed under the Apache License."])
    df = spark.createDataFrame([(1, text, "en", "a", 3)], "doc_id long, text string, lang string, source string, n_chars long")
    row = cleaning.clean_documents(df).first()
    assert row.text == "\n".join(text.split("\n")[:6]) and row.n_chars == len(row.text)


def test_cleaning_empty_and_columns(odd_docs, no_docs):
    assert cleaning.quality_report(no_docs).count() == 0 and cleaning.clean_documents(no_docs).count() == 0
    assert cleaning.clean_documents(odd_docs).columns == odd_docs.columns


def test_mix_laws(docs, odd_docs, no_docs):
    assert mixing.mix_report(no_docs).count() == 0
    for df in (docs, odd_docs):
        rows = mixing.mix_report(df).collect()
        assert len(rows) == df.count()
        assert sorted(map(str, rows)) == sorted(map(str, mixing.mix_report(df.repartition(5)).collect()))
        assert all(r.taken <= 3 * r.size for r in rows)
        assert all(r.target <= 3 * r.source_size for r in rows)
    by_source = {}
    names = dict((r.doc_id, r.source) for r in docs.collect())
    for r in mixing.mix_report(docs).collect():
        s = by_source.setdefault(names[r.doc_id], [0, r.target, 0])
        s[0] += r.taken
        s[2] = max(s[2], r.size)
    assert all(abs(taken - target) <= largest / 2 + 1 for taken, target, largest in by_source.values())
    assert abs(sum(t for _, t, _ in by_source.values()) - sum(r.size for r in mixing.mix_report(docs).collect())) < 1e-3


def test_mixed_documents_follow_the_report(docs):
    copies = {r.doc_id: r.copies for r in mixing.mix_report(docs).collect()}
    got = Counter(r.doc_id for r in mixing.mixed_documents(docs).collect())
    assert got == Counter({k: v for k, v in copies.items() if v})


def test_many_sources_are_joined_by_shuffle(docs, monkeypatch):
    key = lambda r: r.doc_id
    want = sorted(mixing.mix_report(docs).collect(), key=key)
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)
    assert sorted(mixing.mix_report(docs).collect(), key=key) == want


def test_clean_documents_follow_the_report(docs, odd_docs, no_docs):
    for df in (docs, odd_docs, no_docs):
        kept = Counter(r.doc_id for r in cleaning.quality_report(df).collect() if r.kept)
        got = cleaning.clean_documents(df)
        rows = got.collect()
        assert got.columns == df.columns and Counter(r.doc_id for r in rows) == kept
        assert all(r.n_chars == len(r.text) for r in rows)


def test_targets_stop_at_three_times_the_size(spark):
    sizes = spark.createDataFrame([("a", 1000), ("b", 10), ("c", 10)], "source string, source_size long")
    got = {r.source: r.target for r in mixing.source_targets(sizes).collect()}
    assert got == {"a": 960.0, "b": 30.0, "c": 30.0}


def test_shards(docs, odd_docs, no_docs):
    assert sharding.shard_report(no_docs).count() == 0
    for df in (docs, odd_docs):
        want = Counter((r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in df.collect())
        rows = sharding.shard_report(df).collect()
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
        for s in range(24):
            slots = sorted(r.slot for r in rows if r.shard == s)
            assert slots == list(range(len(slots)))
        assert {r.law for r in rows} == {"bytes"} and all(r.grown_shard is None for r in rows)
    assert sharding.sharded_documents(odd_docs).count() == odd_docs.count()


def test_hot_group_is_cut_and_even(spark):
    rows = spark.range(6000).selectExpr("id doc_id", "case when id % 3 = 0 then 'the same text' else repeat(cast(id as string), 5) end text")
    sizes = Counter()
    for r in sharding.shard_report(rows).collect():
        sizes[r.shard] += r.size
    assert len(sizes) == 24 and max(sizes.values()) < 1.05 * min(sizes.values())


def test_pack_prefers_room():
    assert sorted(Counter(sharding.pack(np.ones((8, 3)), 4).tolist()).values()) == [2, 2, 2, 2]
    assert len(GAP_CHARS) == 6


@pytest.mark.parametrize("stage", [mixing.mixed_documents, sharding.sharded_documents])
def test_texts_are_counted_without_leaving_the_jvm(spark, docs, stage):
    plan = stage(docs)._jdf.queryExecution().toString()
    assert "MapInArrow" not in plan


def test_counts_of_odd_texts(spark):
    texts = [None, "", " \n\t", "a #b\x0b$$\x1cc d  ", "ß日本 🙂|", "\x00x <y>"]
    rows = tokens.with_counts(spark.createDataFrame([(t,) for t in texts], "text string"), keep_text=False).collect()
    want = [(len(re.findall(r"[^\x20\x09-\x0D]+", t or "")), sum(c in "#*$%&|<>" for c in t or ""), len((t or "").encode())) for t in texts]
    assert [tuple(r) for r in rows] == want
