"""The pipeline against a plain Python version: line rules, pairwise copies, windows, the mix in SQL, and the shards' law."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import pandas as pd
import pytest

from marram.llm import decontaminate, mixing
from marram.llm.cleaning import LineRules
from tests.llm.test_near_copies import WORD, _least_ids

SF = "/root/testdata/sf0.001"
RULES = LineRules()


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def _line_fails(line):
    words, low = WORD.findall(line), _lower(line)
    n = len(words)
    menu = "|".join(RULES.menu)
    return n > 0 and bool(
        sum(c in "!#*$%&|<>" for c in line) * 10 > n * RULES.marks_per_10_words
        or (n >= RULES.min_unpunctuated and not re.search("[.,!?;:]", line))
        or sum(w in ("|", ">", "»", "·", "•") for w in words) * 100 > n * RULES.separator_percent
        or re.fullmatch(rf"[\x20\x09-\x0D]*(?:(?:{menu})[\x20\x09-\x0D]*(?:\Z|[\x20\x09-\x0D]))+", low)
        or any(p in low for p in RULES.phrases))


def _cleaned(text):
    """The text without failing lines, or None if it goes."""
    words = WORD.findall(text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    repeated = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    if len(words) < RULES.min_words or 100 * len(repeated) > RULES.max_repeat_percent * len(words):
        return None
    lines = [(line, _line_fails(line), sum(map(len, WORD.findall(line)))) for line in (text or "").split("\n")]
    if sum(n for _, bad, n in lines if bad) * 100 > RULES.max_lost_percent * sum(n for _, _, n in lines):
        return None
    return "\n".join(line for line, bad, _ in lines if not bad)


def _contaminated(text, items):
    words = WORD.findall(_lower(text))
    for own in items:
        s = min(5, len(own))
        grams = lambda w: [tuple(w[k:k + s]) for k in range(len(w) - s + 1)]
        target = Counter(grams(own))
        if set(grams(words)) & set(target) and any(
                decontaminate.weighted_similarity(Counter(grams(words[a:a + len(own)])), target) >= 0.8 for a in range(len(words))):
            return True
    return False


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The smallest tables with near copies, a benchmark passage and a rejected text put in, in a folder of their own."""
    folder = tmp_path_factory.mktemp("tables")
    docs = pd.read_parquet(f"{SF}/documents.parquet")
    bench = pd.read_parquet(f"{SF}/benchmark.parquet")
    whole = [(i, t) for i, t in zip(docs.doc_id, docs.text) if isinstance(t, str) and _cleaned(t) and len(WORD.findall(t)) > 150]
    rows = []
    for k, (_, text) in enumerate(whole[:8]):
        words = text.split(" ")
        words[len(words) // 2] = f"changed{k}"
        rows.append((50_000 + k, " ".join(words), "en", "src1", 1))
    rows += [(60_000, whole[9][1] + " " + bench.text[0], "en", "src2", 1), (60_001, "too short", "en", "src2", 1), (60_002, None, None, None, None)]
    pd.concat([docs, pd.DataFrame(rows, columns=docs.columns)]).astype({"n_chars": "Int64"}).to_parquet(f"{folder}/documents.parquet", index=False)
    bench.to_parquet(f"{folder}/benchmark.parquet", index=False)
    return str(folder)


def test_run_equals_the_plain_version(spark, planted):
    docs = pd.read_parquet(f"{planted}/documents.parquet")
    cleaned = {i: c for i, t in zip(docs.doc_id, docs.text) if (c := _cleaned(t if isinstance(t, str) else None)) is not None}
    clean = corpus_pipeline.quality_rules(spark, spark.read.parquet(f"{planted}/documents.parquet"), planted).cache()
    assert {r.doc_id: r.text for r in clean.collect()} == cleaned and 60_001 not in cleaned

    single = _least_ids(sorted(cleaned.items()))
    apart = corpus_pipeline.near_dedup(spark, clean, planted).cache()
    assert {r.doc_id for r in apart.collect()} == single and not any(50_000 + k in single for k in range(8))

    items = [WORD.findall(_lower(t)) for t in pd.read_parquet(f"{planted}/benchmark.parquet").text if isinstance(t, str) and WORD.findall(t)]
    pure = {i for i in single if not _contaminated(cleaned[i], items)}
    left = corpus_pipeline.decontamination(spark, apart, planted).cache()
    assert {r.doc_id for r in left.collect()} == pure and 60_000 not in pure

    source = dict(zip(docs.doc_id, docs.source))
    con = duckdb.connect()
    frame = pd.DataFrame([(i, source[i], cleaned[i]) for i in sorted(pure)], columns=["doc_id", "source", "text"])
    con.register("documents", frame)
    copies = {r[0]: r[1] for r in con.execute(f"select doc_id, copies from ({mixing.MIX_SQL})").fetchall() if r[1]}

    rows = corpus_pipeline.run(spark, planted).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter({(i, cleaned[i]): n for i, n in copies.items()})
    slots, sizes = defaultdict(list), Counter()
    for r in rows:
        slots[r.shard].append(r.slot)
        sizes[r.shard] += len(r.text.encode()) + 8
    assert set(slots) <= set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes.values()) <= sum(sizes.values()) / 24 + max(len(r.text.encode()) + 8 for r in rows)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).columns == [*docs.columns, "shard", "slot"]


def test_run_of_an_empty_table(spark, planted, tmp_path):
    pd.read_parquet(f"{planted}/documents.parquet").head(0).to_parquet(f"{tmp_path}/documents.parquet", index=False)
    pd.read_parquet(f"{planted}/benchmark.parquet").to_parquet(f"{tmp_path}/benchmark.parquet", index=False)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
