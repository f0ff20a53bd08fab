"""The pipeline's near-dedup stage against pairwise five-word shingles."""

from __future__ import annotations

import re

import corpus_pipeline
import numpy as np

from marram.llm import near
from tests.llm.conftest import DOCS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _shingles(text):
    words = [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(text or "")]
    return frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4)) if words)


def _least_ids(rows):
    sets = [_shingles(r[1]) for r in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if root[a] != root[b] and (sets[a] == sets[b] or 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) > 0):
                root = [root[b] if x == root[a] else x for x in root]
    return {min(r[0] for r, x in zip(rows, root) if x == c) for c in set(root)}


def test_near_copies_by_brute_force(spark):
    rng = np.random.default_rng(5)
    common = [f"common{k}" for k in range(60)]
    texts = []
    for _ in range(12):
        base = [f"w{k}" for k in rng.integers(0, 5000, 150)] + common[:int(rng.integers(0, 60))]
        texts.append(base)
        for changed in (1, 2, 3, 4, 6):
            copy = list(base)
            for k in rng.choice(len(copy), changed, replace=False):
                copy[k] = f"new{rng.integers(1 << 40)}"
            texts.append(copy)
    rows = [(k, " ".join(t)) for k, t in enumerate(texts)]
    # A chain whose ends are far apart, short texts, and texts without a word.
    rows += [(100 + k, " ".join(f"chain{j}" for j in range(10 * k, 10 * k + 104))) for k in range(12)]
    rows += [(200, "One two"), (201, "one  TWO"), (202, "one two three"), (203, None), (204, ""), (205, " \n")]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
    got = [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    assert len(got) == len(set(got)) and set(got) == _least_ids(rows)


def _kept(spark, rows, **bounds):
    old = {k: getattr(near, k) for k in bounds}
    try:
        for k, v in bounds.items():
            setattr(near, k, v)
        docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in rows], DOCS)
        return [r.doc_id for r in corpus_pipeline.near_dedup(spark, docs, "").collect()]
    finally:
        for k, v in old.items():
            setattr(near, k, v)


def test_crowded_shingles_in_tiles(spark):
    """Many texts of one template, just above and below the limit, and tiles and keys forced to be small."""
    rng = np.random.default_rng(9)
    template = [f"t{k}" for k in range(60)]
    rows = []
    for k in range(60):
        words = list(template)
        for place in rng.choice(60, int(rng.integers(0, 4)), replace=False):
            words[place] = f"z{rng.integers(3)}"
        rows.append((k, " ".join(words)))
    assert set(_kept(spark, rows, TILE=5, WORDS_AT_ONCE=7, FEW_KEYS=1)) == _least_ids(rows)


def test_long_texts_that_share_a_line(spark):
    line = " ".join(f"shared{k}" for k in range(40))
    rows = [(k, " ".join(f"w{k}x{j}" for j in range(6000 + 500 * k)) + " " + line) for k in range(4)]
    rows += [(10, rows[0][1] + " one more end"), (11, line), (12, line + " tail")]
    assert set(_kept(spark, rows)) == _least_ids(rows)


def test_parities_fold_and_bound_the_difference():
    rng = np.random.default_rng(3)
    for n in (0, 1, 200, 300, 5000):
        one = np.unique(rng.integers(1 << 63, size=n, dtype=np.int64).view(np.uint64))
        two = np.concatenate([one[n // 7:], rng.integers(1 << 63, size=n // 3, dtype=np.int64).view(np.uint64)])
        a, b = near.parity(one), near.parity(np.unique(two))
        assert len(a) * 64 >= 2 * len(one)
        words = min(len(a), len(b))
        differ = int(np.bitwise_count(near.folded(a, words) ^ near.folded(b, words)).sum())
        assert differ <= len(np.setxor1d(one, two))


def test_odd_rows(spark, odd_docs, no_docs):
    got = corpus_pipeline.near_dedup(spark, odd_docs, "")
    assert got.columns == odd_docs.columns
    rows = got.collect()
    # Blank texts are one class, whose least row has no id; so are 5, 6, the repeated 5, 7 and the row without an id.
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rows) == [
        (False, 0), (False, 0), (True, 4), (True, 8), (True, 9), (True, 10)]
    assert {bool(r.text) for r in rows if r.doc_id is None} == {True, False}
    assert corpus_pipeline.near_dedup(spark, no_docs, "").collect() == []


def _joined(values, links):
    root = {v: v for v in values}
    for a, b in links:
        root = {v: root[b] if r == root[a] else r for v, r in root.items()}
    return {frozenset(v for v in values if root[v] == r) for r in set(root.values())}


def test_simhash_brings_together_all_within_three_bits(spark):
    rng = np.random.default_rng(3)
    rows, x = [], 0
    for base in rng.integers(0, 1 << 63, 25):
        for flips in (0, 0, 1, 2, 3, 5):
            mark = int(base)
            for bit in rng.choice(63, flips, replace=False):
                mark ^= 1 << int(bit)
            rows.append((x := x + 1, mark))
    within = [(a, b) for a, one in rows for b, two in rows if a < b and (one ^ two).bit_count() <= 3]
    found = [(r.u, r.v) for r in near.simhash_pairs(spark.createDataFrame(rows, "x long, mark long")).collect()]
    keys = [x for x, _ in rows]
    assert set(found) <= set(within) and _joined(keys, found) == _joined(keys, within)


def test_dedup_compares_what_simhash_brings_together(spark, monkeypatch):
    seen, plain = [], near.simhash_pairs
    monkeypatch.setattr(near, "simhash_pairs", lambda marks: seen.append(plain(marks).count()) or plain(marks))
    text = " ".join(f"w{k}" for k in range(2000))
    rows = [(0, text), (1, text.replace("w1999", "other")), (2, " ".join(f"v{k}" for k in range(2000)))]
    assert sorted(_kept(spark, rows)) == [0, 2] and seen == [1]
