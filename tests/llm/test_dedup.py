"""SimHash classes, decontamination and suffix-array repeats against brute force."""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from marram.llm import decontaminate, simhash, suffixes
from marram.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def _fingerprint(text):
    words = WORD.findall(_lower(text))
    if not words:
        return 0
    hs = [xxhash.xxh64_intdigest(" ".join(words[k:k + 3]).encode(), 42) for k in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def _roots(values, radius=3):
    values = np.array(values, dtype=np.uint64)
    root = list(range(len(values)))
    for k in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[k]) <= radius):
            a, b = root[k], root[int(j)]
            if a != b:
                root = [min(a, b) if x in (a, b) else x for x in root]
    return root


def test_masks_cover_every_small_difference():
    masks = simhash.covering_masks(list(range(64)), 3)
    rng = np.random.default_rng(0)
    for _ in range(5000):
        far = sum(1 << int(p) for p in rng.choice(64, 3, replace=False))
        assert any(not m & far for m in masks)


def test_classes_by_brute_force(docs, odd_docs, no_docs):
    assert simhash.simhash_classes(no_docs).count() == 0
    for df in (docs, odd_docs):
        rows = df.collect()
        prints = [_fingerprint(r.text) for r in rows]
        root = _roots(prints)
        least = {c: min((r.doc_id for r, x in zip(rows, root) if x == c and r.doc_id is not None), default=None) for c in root}
        want = Counter((r.doc_id, f"{p:016x}", least[c]) for r, p, c in zip(rows, prints, root))
        got = Counter(tuple(r)[:3] for r in simhash.simhash_classes(df).collect())
        assert got == want
        kept = simhash.one_of_each_class(df)
        assert kept.columns == df.columns and kept.count() == len(set(root))


@pytest.mark.parametrize("direct", [2, 8, 512])
def test_full_buckets_lose_no_link(spark, direct):
    rng = np.random.default_rng(1)
    centre = int(rng.integers(0, 1 << 62))
    near = {centre ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 6)), replace=False)) for _ in range(300)}
    values = sorted(near | {int(v) for v in rng.integers(0, 1 << 62, 200)})
    signed = [int(np.uint64(v).astype(np.int64)) for v in values]
    got = {r.x: r.root for r in simhash.near_classes(spark.createDataFrame([(v,) for v in signed], "x long"), direct=direct).collect()}
    assert len({(a, got[s]) for a, s in zip(_roots(values), signed)}) == len(set(_roots(values))) == len(set(got.values()))


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(900, 901), (5, 5), (None, 3)], "u long, v long")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(301)}, 900: 900, 901: 900}


def test_benchmark_matches_by_brute_force(spark, docs, odd_docs, no_docs):
    bench = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    item = WORD.findall(_lower(bench.first().text))
    changed = item[:]
    changed[0] = "changed"
    rows = [(1, "Some words before. " + " ".join(item) + " and after"), (2, "x " + " ".join(changed)), (3, " ".join(item[:-1])),
            (4, " ".join(item[: len(item) // 2])), (5, None), (6, ""), (7, "tiny item"), (8, "a tiny item here")]
    extra = bench.union(spark.createDataFrame([(9001, "tiny item"), (9002, None), (None, "some words")], bench.schema))
    cases = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    items = {r.item_id: WORD.findall(_lower(r.text)) for r in extra.collect() if r.item_id is not None and r.text}
    grams = lambda w, s: [tuple(w[k:k + s]) for k in range(len(w) - s + 1)]
    want = set()
    for r in cases.collect():
        words = WORD.findall(_lower(r.text))
        for i, own in items.items():
            s = min(5, len(own))
            target, n = Counter(grams(own, s)), len(own)
            if set(grams(words, s)) & set(target):
                best = max((decontaminate.weighted_similarity(Counter(grams(words[a:a + n], s)), target), -a) for a in range(len(words)))
                if best[0] >= 0.8:
                    want.add((r.doc_id, i, round(best[0], 9), -best[1]))
    got = {(r.doc_id, r.item_id, round(r.similarity, 9), r.first_word) for r in decontaminate.contamination_report(cases, extra).collect()}
    assert got == want and {1, 2, 3, 7, 8} <= {g[0] for g in got} and 4 not in {g[0] for g in got}
    assert decontaminate.contamination_report(no_docs, bench).count() == 0
    assert decontaminate.without_benchmark(odd_docs, bench.limit(0)).count() == odd_docs.count()


def _repeats(rows):
    seen, out = set(), []
    for r in sorted(rows, key=lambda r: r.doc_id):
        raw = (r.text or "").encode()
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - 99):
            if raw[k:k + 100] in seen:
                gone[k:k + 100] = True
            seen.add(raw[k:k + 100])
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(1 for k in range(len(raw)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((r.doc_id, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("hot", [3, 20_000])
def test_repeats_by_brute_force(spark, docs, hot):
    passage = "".join(chr(97 + k * k % 23) for k in range(160))
    rows = [(10_000 + k, f"{'p' * k}{passage[k % 40:]}{k}{passage[: 90 + k]}" + "ab" * (20 * k)) for k in range(30)]
    rows += [(20_000, "z" * 500), (20_001, "z" * 150), (20_002, None), (20_003, ""), (20_004, passage[:100]), (20_005, passage[:99])]
    df = docs.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    got = Counter(tuple(r) for r in suffixes.without_repeats(df, hot=hot).drop("kept").collect())
    assert got == _repeats(df.collect())


def test_repeats_in_parts_of_a_long_document(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PART_BYTES", 5000)
    rng = np.random.default_rng(3)
    piece = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    shared = piece(700)
    text = piece(9000) + shared + piece(4900) + shared + piece(12_000) + shared[100:] + piece(300)
    from pyarrow import array

    found = [w for c in suffixes.chunks(array([text]), 5000) for p in suffixes._parts(c, 100) for w in [suffixes.anchors(p[0], p[1])]]
    assert sum(int(n.sum()) for _, _, n, _ in found) == len(text) - 99


def test_repeats_of_odd_rows(odd_docs, no_docs):
    assert suffixes.repeat_report(no_docs).count() == 0
    rows = suffixes.repeat_report(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    # The row without an id comes first, so its text stays and all others lose theirs; repeated rows agree.
    assert by_id[5].n_removed == by_id[5].n_bytes == by_id[6].n_removed and by_id[1].n_bytes == 0
    assert len({(r.n_bytes, r.n_removed) for r in rows if r.doc_id == 5}) == 1
