"""The classifiers' scores against plain loops, and the bounds of what they are fitted on."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest

from marram.llm import classify, language, quality, toxicity
from tests.llm.conftest import DOCS

GAPS = b" \t\n\x0b\x0c\r"
TEXTS = ["You are a Fool, fool!", "kind words only here", "", None, "fo", "a fool\tand\n a f00l", "ÄÖ fool é " * 30, "wholly unseen zzzz"]
MASK = (1 << 64) - 1


def _mix(x):
    x = (x ^ x >> 30) * 0xBF58476D1CE4E5B9 & MASK
    x = (x ^ x >> 27) * 0x94D049BB133111EB & MASK
    return x ^ x >> 31


def _lower(text):
    return bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())


def _subwords(text):
    raw = b" " + bytes(32 if b in GAPS else b for b in _lower(text)) + b" "
    out = []
    for n in toxicity.SIZES:
        for k in range(len(raw) - n + 1):
            part = raw[k:k + n]
            if b" " not in part[1:-1] and not (part[:1] == part[-1:] == b" "):
                code = n
                for b in part:
                    code = (code << 8 | b) & MASK
                out.append(_mix(code) >> 64 - toxicity.BUCKET_BITS)
    return out


def _array(texts):
    return pa.array(texts, type=pa.large_string())


def test_toxicity_is_the_softmax_of_an_average():
    labels = np.array([1, 0, 0, 0, 0, 1, 1, 0] * 40, dtype=object)
    model = toxicity.fit(_array(TEXTS * 40), labels, epochs=15)
    assert len(model.embeddings) > 1
    got = model.score(_array(TEXTS))
    for text, score in zip(TEXTS, got):
        bag, pooled = _subwords(text), np.zeros(toxicity.WIDTH)
        for code in bag:
            if model.row[code]:
                pooled += model.embeddings[model.row[code]]
        pooled = pooled * toxicity.UNIT / max(1, len(bag))
        logits = [float(pooled @ model.softmax[:, k] + model.bias[k]) for k in (0, 1)]
        assert score == pytest.approx(1 / (1 + math.exp(logits[0] - logits[1])), abs=1e-9)
    assert got[0] > 0.7 > got[1]


def test_language_decodes_by_weighted_loss():
    texts = ["the cat and the dog", "le chat et le chien", "der hund und die katze"] * 8
    labels = np.array(["en", "fr", "de"] * 8, dtype=object)
    model = language.fit(_array(texts), labels, steps=60)
    x = language.grams(_array(texts[:3]))
    for k, text in enumerate(texts[:3]):
        raw, counts = _lower(text), np.zeros(language.BUCKETS)
        for n in language.SIZES:
            for a in range(len(raw) - n + 1):
                code = n
                for b in raw[a:a + n]:
                    code = (code << 8 | b) & MASK
                counts[_mix(code) >> 52] += 1
        unit = np.sqrt(counts) / np.linalg.norm(np.sqrt(counts))
        assert x[k] == pytest.approx(unit, abs=1e-6)
        bits = [float(sum(unit[j] * model.weights[j, b] for j in np.flatnonzero(unit)) + model.bias[b]) for b in range(model.code.shape[1])]
        loss = [sum(model.trust[b] * math.log1p(math.exp(-row[b] * bits[b])) for b in range(len(bits))) for row in model.code]
        chance = [math.exp(min(loss) - v) for v in loss]
        assert model.probabilities(x[k:k + 1])[0] == pytest.approx([c / sum(chance) for c in chance], abs=1e-4)
        assert model.names[int(np.argmin(loss))] == labels[k]


def test_quality_pools_and_passes_two_layers():
    texts = ["good clear words stand here", "JUNK ### 999 !!! @@", "more good words", "### JUNK 12", "", None] * 10
    model = quality.fit(_array(texts), np.array([1, 0, 1, 0, 1, 0] * 10, dtype=object), epochs=10)
    pooled = model.pooled(_array(texts[:6]))
    ids = {row + k: (w[first[k]:first[k + 1]], s[first[k]:first[k + 1]])
           for row, first, w, s in quality.word_ids(_array(texts[:6])) for k in range(len(first) - 1)}
    w1, b1, w2, b2 = model.layers
    for k in range(6):
        words, shapes = ids[k]
        own = np.zeros(2 * quality.WIDTH + 1)
        if len(words):
            own[:quality.WIDTH] = sum(model.words[i].astype(float) for i in words) / len(words)
            own[quality.WIDTH:-1] = sum(model.shapes[i].astype(float) for i in shapes) / len(shapes)
            own[-1] = math.log(1 + len(words))
        assert pooled[k] == pytest.approx(own, abs=1e-5)
        z = (own - model.mean) / model.scale
        hidden = [math.tanh(sum(z[i] * w1[i, h] for i in range(len(z))) + b1[h]) for h in range(len(b1))]
        logit = sum(v * w for v, w in zip(hidden, w2)) + b2[0]
        assert model.score(_array(texts[k:k + 1]))[0] == pytest.approx(1 / (1 + math.exp(-logit / model.temperature)), abs=1e-4)


def test_a_repeated_id_is_learned_once(spark):
    rows = [(5, f"text {k}", "en", "a", 1) for k in range(10_000)] + [(k, f"other {k}", "fr", "a", 1) for k in range(20, 60)]
    docs = spark.createDataFrame(rows, DOCS)
    texts, labels = classify.labelled_sample(docs, docs.selectExpr("doc_id", "lang as label"))
    assert sum(t.startswith("text") for t in texts.to_pylist()) <= 1 and len(texts) == len(labels) <= 41


def test_rows_in_all_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(classify, "ROWS_IN_ALL", 300)
    docs = spark.range(6000).selectExpr("id as doc_id", "cast(id as string) as text", "cast(id % 100 as string) as label")
    texts, _ = classify.labelled_sample(docs, docs.select("doc_id", "label"))
    assert 200 < len(texts) < 400
