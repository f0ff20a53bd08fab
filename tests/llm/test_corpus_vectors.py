"""Word vectors of the quality classifier come from all documents, labelled or not."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from marram.llm import quality


def test_vectors_count_every_document(spark):
    texts = ["seen words of the sample", "rareone raretwo rarethree rareone", None, "", "rareone again"] * 3
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    words, shapes = quality.index_vectors(quality.VOCABULARY, 1), quality.index_vectors(quality.SHAPES, 2)
    want = words.astype(float), shapes.astype(float)
    for _, first, w, s in quality.word_ids(pa.array(texts)):
        for low, high in zip(first[:-1], first[1:]):
            for index, ids, table in ((words, w, want[0]), (shapes, s, want[1])):
                for a in range(low, high):
                    for b in range(max(low, a - 2), min(high, a + 3)):
                        if a != b:
                            table[ids[a]] += index[ids[b]]
    for table, got in zip(want, quality.corpus_vectors(docs)):
        assert np.allclose(table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9), got, atol=1e-6)
