"""License scans, token alignment and importance resampling against plain Python."""

from __future__ import annotations

import hashlib
import json
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from marram.llm import align, licenses, resample
from tests.llm.conftest import DOCS

MARK = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text):
    return MARK.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


# Licenses


def _docs(spark, texts):
    return spark.createDataFrame([(k, t, "en", "a", 1) for k, t in enumerate(texts)], DOCS)


def test_base_phrases_by_brute_force(spark, odd_docs):
    rng = random.Random(4)
    parts = ["MIT", "license", "Apache", "general", "public", "License", "x", "(mit", "license)", "é"]
    texts = [" ".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(60)]
    texts += ["mit license " * 5000, None, "", "MIT\nLicense", "mitlicense"]
    rows = {r.doc_id: r for r in licenses.license_report(_docs(spark, texts)).collect()}
    for k, text in enumerate(texts):
        words = _words(text)
        places = [(j, label) for label, phrase in licenses.BASE_PHRASES for j in range(len(words))
                  if words[j:j + len(phrase.split())] == phrase.split()]
        got, starts = rows[k], [p for p, _ in places]
        assert (got.n_words, got.n_base) == (len(words), len(places))
        assert (got.first_word, got.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert got.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(got.base_labels.split(",")) <= set(got.labels.split(",")) and got.score == float(bool(got.labels))


def test_edited_notices_are_found_whole(spark):
    mit = next(t for label, t in licenses.NOTICES if label == "mit-text").split()
    filler = [f"w{k}" for k in range(30)]
    edited = list(mit)
    for place in range(5, len(edited), 12):
        edited[place] = "changed"
    moved = mit[:20] + ["put", "in"] + mit[20:40] + mit[43:]
    half = mit[:len(mit) // 2]
    texts = [" ".join(filler + v + filler) for v in (mit, edited, moved, half, [])]
    spans = [r._spans for r in licenses.license_spans(_docs(spark, texts)).orderBy("doc_id").collect()]
    assert [len(s) for s in spans] == [1, 1, 1, 0, 0]
    assert (spans[0][0].first, spans[0][0].last, spans[0][0].coverage) == (30, 29 + len(mit), 1.0)
    kept = sum(a == b for a, b in zip(mit, edited)) / len(mit)
    assert spans[1][0].coverage == pytest.approx(kept) and 0.8 <= kept < 1
    assert spans[2][0].coverage == pytest.approx(1 - 3 / len(mit)) and spans[2][0].last == 29 + len(moved)


def test_license_joins_beyond_their_bounds(spark, odd_docs, no_docs, monkeypatch):
    few = [r.asDict() for r in licenses.license_report(odd_docs).orderBy("doc_id", "n_words").collect()]
    monkeypatch.setattr(licenses, "BROADCAST_DIAGONALS", -1)
    monkeypatch.setattr(licenses, "BROADCAST_POSITIONS", -1)
    assert [r.asDict() for r in licenses.license_report(odd_docs).orderBy("doc_id", "n_words").collect()] == few
    assert len(few) == 13 and all(r["labels"] == "" for r in few)
    assert licenses.license_spans(odd_docs).columns == [c for c in odd_docs.columns if c != "text"] + ["_n_words", "_spans"]
    assert licenses.license_report(no_docs).collect() == []
    with pytest.raises(ValueError):
        licenses.license_report(no_docs, [licenses.Template("x", "word")])


# Token alignment


def _byte_entries():
    names = json.load(open(f"{align.TOKENIZERS}/{align.LEFT_FILE}"))["model"]["vocab"]
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    back = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}
    return {i: bytes(back[c] for c in n) for n, i in names.items() if i != 50256}


def _plain_alignment(texts):
    left = Tokenizer.from_file(f"{align.TOKENIZERS}/{align.LEFT_FILE}")
    left.encode_special_tokens = True
    right = SentencePieceProcessor(model_file=f"{align.TOKENIZERS}/{align.RIGHT_FILE}")
    one = _byte_entries()

    def piece(i):
        p = right.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if right.is_byte(i) else p.replace("▁", " ").encode()

    found, held = [], Counter()
    for text in texts:
        raw = (" " + (text or "")).encode()
        a, b = (left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)) if text else ([], [])
        x, y = [one[i] for i in a], [piece(i) for i in b]
        if not text or b"".join(x) != raw or b"".join(y) != raw:
            found.append(None)
            continue
        ends = [set(np.cumsum([len(v) for v in side]).tolist()) for side in (x, y)]
        groups, ga, gb, i, j = [], [], [], 0, 0
        at_a = at_b = 0
        for end in sorted(ends[0] & ends[1]):
            ga, gb = [], []
            while at_a < end:
                at_a += len(x[i])
                ga.append(a[i])
                i += 1
            while at_b < end:
                at_b += len(y[j])
                gb.append(b[j])
                j += 1
            groups.append((ga, gb))
        links = [(p, q) for ga, gb in groups for p in ga for q in gb]
        held.update(set(links))
        found.append((len(a), len(b), groups, links))
    best = defaultdict(int)
    for (p, _), n in held.items():
        best[p] = max(best[p], n)
    out = []
    for f in found:
        if f is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = f
        told = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out.append((n_a, n_b, len(groups), len(links), sum(held[k] == best[k[0]] for k in links),
                    sum(held[k] for k in links), hashlib.sha256(told.encode()).hexdigest()))
    return out, held


def test_alignment_by_brute_force(spark, docs):
    rng = random.Random(8)
    signs = [*" \t\n\r\xa0  ab'sré日1,.½́🙂​▁　\x00\x85", "<|endoftext|>", "<s>", "</s>", "<0x0A>", "'ll", " the", "ing"]
    texts = [None, "", " ", "  ", "▁", "\n", "word " * 3000, "日本語" * 500, "no spaces" * 2000]
    texts += ["".join(rng.choice(signs) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    texts += [r.text for r in docs.limit(40).collect()]
    expected, held = _plain_alignment(texts)
    documents, pairs = align.token_alignment(_docs(spark, texts).repartition(3), block_bytes=4000)
    got = {r.key.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in documents.collect()}
    assert [got[k] for k in range(len(texts))] == expected
    assert {(r.left_id, r.right_id): r.n for r in pairs.collect()} == held


def test_segments_are_the_text():
    for text in ("a b", " a  b \n c ", "é è", "x\xa0 \xa0y", "…  "):
        assert "".join(align.segments(text)) == " " + text
        assert all(s.startswith(" ") for s in align.segments(text))


def test_alignment_of_odd_rows(spark, odd_docs, no_docs):
    rows = align.alignment_report(odd_docs).collect()
    assert len(rows) == 13 and sum(r.n_a == 0 for r in rows) == 3
    shared = {r.groups_sha256 for r in rows if r.doc_id in (5, 6)}
    assert len(shared) == 1 and sum(r.doc_id == 5 for r in rows) == 2
    documents, _ = align.token_alignment(odd_docs)
    assert documents.select("key.*").columns == [c for c in odd_docs.columns if c != "text"]
    assert align.alignment_report(no_docs).collect() == []


# Importance resampling


def _plain_report(rows, target, max_n=1, buckets=resample.BUCKETS, percent=10, min_words=20):
    def features(text):
        w = _words(text)
        return [zlib.crc32(" ".join(w[j:j + n]).encode()) % buckets for n in range(1, max_n + 1) for j in range(len(w) - n + 1)]

    own = [features(t) for _, t in rows]
    s, t = Counter(b for f in own for b in f), Counter(b for x in target for b in features(x))
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets))))
    out = []
    for (i, text), f in zip(rows, own):
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2 ** 32))), None, len(_words(text))])
    order = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for k, r in enumerate(order[:percent * len(order) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("max_n", [1, 3])
def test_resampling_by_brute_force(spark, docs, max_n):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    target = [r.text for r in bench.collect()]
    got = resample.importance_report(docs, bench, max_n=max_n, percent=25)
    assert Counter(map(tuple, got.collect())) == _plain_report(rows, target, max_n, percent=25)


def test_cut_among_ties_and_repeated_rows(spark):
    """A third of the rows is one row, many share a score, and some share an id with other texts."""
    text = " ".join(f"w{k}" for k in range(25))
    rows = [(7, text)] * 40 + [(k, text) for k in range(40)] + [(3, text + f" more{k}") for k in range(10)] + [
        (None, text), (None, text), (100, None), (101, ""), (102, "short one")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS).repartition(5)
    target = spark.createDataFrame([("w1 w2",), (None,)], "text string")
    for percent in (0, 10, 45, 100):
        got = resample.importance_report(docs, target, percent=percent, accuracy=20)
        assert Counter(map(tuple, got.collect())) == _plain_report(rows, ["w1 w2"], percent=percent)


def test_value_at_brackets_and_widens(spark):
    values = [random.Random(2).randrange(50) for _ in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "v long").checkpoint()
    down = sorted(values, reverse=True)
    for rank in (1, 2, 700, 1500, 2999, 3000):
        expected = down[rank - 1], sum(v > down[rank - 1] for v in values)
        assert resample.value_at(rows, "v", rank, 3000, accuracy=10) == expected
        assert resample.value_at(rows, "v", rank, 3000, accuracy=1000, bracket_values=2) == expected


def test_resampling_of_odd_rows(spark, odd_docs, no_docs, docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    rows = resample.importance_report(odd_docs, bench, percent=50).collect()
    assert len(rows) == 13 and sorted(r.rank for r in rows if r.rank) == [1, 2, 3]
    assert {r.n_features for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert resample.importance_report(no_docs, bench).collect() == []
    assert resample.importance_report(docs, bench.limit(0)).where("rank is not null").count() > 0
    drawn = resample.resampled_documents(odd_docs, bench, percent=50)
    assert drawn.columns == odd_docs.columns and drawn.where(F.length("text") < 20).count() == 0
