"""License scans by diagonal voting: word k-grams of documents are joined to their places in license texts.

A gram at word p of a document and at word t of a template votes for the diagonal p - t. A notice copied
word by word collects its votes on one diagonal; a word put in or left out moves the rest to a neighbouring one. So votes
are summed by diagonal, neighbouring diagonals are merged, and what has enough votes is compared with the text itself.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from marram.llm.tokens import IS_MARK, LOWER, MARK_WORD, MULTIPLIER, chunks, find_words, hash_spans, mix
from marram.session import ensure_checkpoint_dir

# Phrases whose places are counted, with their labels.
BASE_PHRASES = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
# Public license notices, with the labels they add.
NOTICES = (
    ("apache-2.0", "apache license version 2 0"),
    ("gpl-2.0", "gnu general public license version 2"),
    ("gpl-3.0", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("mpl-2.0", "mozilla public license version 2 0"),
    ("epl-2.0", "eclipse public license v 2 0"),
    ("bsd", "bsd 3 clause"),
    ("bsd", "bsd 2 clause"),
    ("bsd", "bsd license"),
    ("isc", "isc license"),
    ("cc0-1.0", "cc0 1 0"),
    ("cc-by-4.0", "cc by 4 0"),
    ("cc-by-sa-4.0", "cc by sa 4 0"),
    ("cc-by-nc-4.0", "cc by nc 4 0"),
    ("cc-by-nd-4.0", "cc by nd 4 0"),
    ("cc-by-nc-sa-4.0", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc by nc nd 4 0"),
    ("spdx", "spdx license identifier"),
    ("all-rights-reserved", "all rights reserved"),
    ("mit-text", """permission is hereby granted free of charge to any person obtaining a copy of this software and associated
        documentation files the software to deal in the software without restriction including without limitation the rights to
        use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the
        software is furnished to do so subject to the following conditions"""),
    ("mit-text", """the above copyright notice and this permission notice shall be included in all copies or substantial portions
        of the software"""),
    ("apache-text", """you may not use this file except in compliance with the license you may obtain a copy of the license at
        http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed
        under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied
        see the license for the specific language governing permissions and limitations under the license"""),
    ("gpl-text", """this program is free software you can redistribute it and or modify it under the terms of the gnu general
        public license as published by the free software foundation either version 3 of the license or at your option any later
        version this program is distributed in the hope that it will be useful but without any warranty without even the implied
        warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"""),
    ("bsd-text", """redistribution and use in source and binary forms with or without modification are permitted provided that the
        following conditions are met redistributions of source code must retain the above copyright notice this list of
        conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this
        list of conditions and the following disclaimer in the documentation and or other materials provided with the
        distribution"""),
    ("isc-text", """permission to use copy modify and or distribute this software for any purpose with or without fee is hereby
        granted provided that the above copyright notice and this permission notice appear in all copies"""),
    ("mpl-text", """this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not
        distributed with this file you can obtain one at http mozilla org mpl 2 0"""),
    ("unlicense", """this is free and unencumbered software released into the public domain anyone is free to copy modify publish
        use compile sell or distribute this software either in source code form or as a compiled binary for any purpose
        commercial or non commercial and by any means"""),
)

# Templates of fewer words must stand word by word; longer ones need this share of their words in place.
EXACT_BELOW = 16
COVERAGE = 0.8
SHORT_GRAM, LONG_GRAM = 2, 4
# Diagonals so near belong to one copy with words put in or left out.
SHIFT = 8
# Template positions and span ends that are broadcast (24 and some 40 bytes each); more are joined by shuffle.
BROADCAST_POSITIONS = 200_000
BROADCAST_DIAGONALS = 1_000_000
DIAGONALS_AT_ONCE = 4096


@dataclass(frozen=True)
class Template:
    """One license text. `base` marks phrases whose places are counted."""

    label: str
    text: str
    base: bool = False

    @cached_property
    def words(self) -> list[bytes]:
        return [w.encode() for w in re.findall(MARK_WORD, re.sub("[A-Z]", lambda m: m[0].lower(), self.text))]

    @property
    def exact(self) -> bool:
        return len(self.words) < EXACT_BELOW

    @property
    def gram(self) -> int:
        return SHORT_GRAM if self.exact else LONG_GRAM

    @property
    def votes(self) -> int:
        """Votes that no copy can lack: a word out of place takes `gram` votes at most."""
        n = len(self.words)
        return n - 1 if self.exact else max(1, n - LONG_GRAM + 1 - LONG_GRAM * int((1 - COVERAGE) * n + 1e-9))


TEMPLATES = (*[Template(k, t, base=True) for k, t in BASE_PHRASES], *[Template(k, " ".join(t.split())) for k, t in NOTICES])


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """One hash per run of `size` word hashes; runs of other sizes hash apart."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    total = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        total = mix(total * MULTIPLIER + words[k:k + n])
    return total


def template_positions(spark: SparkSession, templates: Sequence[Template]) -> DataFrame:
    """(h, template, t) for every gram of every template."""
    rows = []
    for k, template in enumerate(templates):
        if len(template.words) < SHORT_GRAM:
            raise ValueError(f"a template needs {SHORT_GRAM} words: {template.text!r}")
        ends = np.cumsum([len(w) for w in template.words])
        buf = np.frombuffer(b"".join(template.words), dtype=np.uint8)
        words = hash_spans(buf, ends - [len(w) for w in template.words], ends)
        rows += [(h, k, t) for t, h in enumerate(gram_hashes(words, template.gram).view(np.int64).tolist())]
    table = spark.createDataFrame(rows, "h long, template int, t int")
    return F.broadcast(table) if len(rows) <= BROADCAST_POSITIONS else table


def rolling_grams(docs: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """(r, p, h): every rolling gram of the given sizes of every text, by the text's hash and the gram's first word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(0))
            for chunk in chunks(batch.column(1)):
                words = find_words(chunk, IS_MARK)
                hashes = hash_spans(LOWER[chunk.buf], words.start, words.end)
                place = np.arange(len(hashes)) - words.first[words.doc]
                row_keys = keys[chunk.first_row + words.doc]
                for size in sizes:
                    grams = gram_hashes(hashes, size).view(np.int64)
                    whole = words.doc[:len(grams)] == words.doc[size - 1:]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(row_keys[:len(grams)][whole]), pa.array(place[:len(grams)][whole].astype(np.int32)),
                         pa.array(grams[whole])], names=["r", "p", "h"])

    return docs.select("_r", "text").mapInArrow(run, "r long, p int, h long")


def candidate_groups(docs: DataFrame, templates: Sequence[Template]) -> DataFrame:
    """(r, template, diagonals): groups of neighbouring diagonals with all the votes that a copy must have."""
    listed = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("template") + 1)
    grams = rolling_grams(docs, sorted({t.gram for t in templates}))
    hits = grams.join(template_positions(docs.sparkSession, templates), "h")
    # Equal texts share r and vote once.
    votes = hits.select("r", "template", (F.col("p") - F.col("t")).alias("diagonal"), "t").groupBy(
        "r", "template", "diagonal").agg(F.count_distinct("t").alias("n"))
    along = Window.partitionBy("r", "template").orderBy("diagonal")
    near = listed([0 if t.exact else SHIFT for t in templates])
    fresh = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(along) > near, F.lit(True))
    grouped = votes.withColumn("fresh", fresh.cast("int")).withColumn("island", F.sum("fresh").over(along))
    return grouped.groupBy("r", "template", "island").agg(
        F.sum("n").alias("n"), F.collect_list("diagonal").alias("diagonals")
    ).where(F.col("n") >= listed([t.votes for t in templates])).select("r", "template", "diagonals")


def _covered(words: np.ndarray, template: np.ndarray, diagonals: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of diagonals, and which of the template's words stand in place on each."""
    steps = np.arange(len(template))
    for low in range(0, len(diagonals), DIAGONALS_AT_ONCE):
        own = diagonals[low:low + DIAGONALS_AT_ONCE]
        place = own[:, None] + steps
        inside = (place >= 0) & (place < len(words))
        yield own, inside & (words[np.clip(place, 0, len(words) - 1)] == template)


class Verifier:
    """Compares groups of diagonals with a text word by word."""

    def __init__(self, templates: Sequence[Template]):
        self.templates = templates
        self.known: dict[bytes, int] = {}
        self.own = [np.array([self.known.setdefault(w, len(self.known) + 1) for w in t.words]) for t in templates]

    def spans(self, words: np.ndarray, groups: Sequence[tuple[int, np.ndarray]]) -> list[tuple[int, int, int, float]]:
        """(template, first word, last word, coverage) of what is verified, in order; `words` are the numbers of the known words."""
        found = []
        for k, diagonals in groups:
            own = self.own[k]
            if self.templates[k].exact:
                for block, hit in _covered(words, own, diagonals):
                    found += [(k, d, d + len(own) - 1, 1.0) for d in block[hit.all(axis=1)].tolist()]
                continue
            covered, first, last = np.zeros(len(own), dtype=bool), [], []
            for block, hit in _covered(words, own, diagonals):
                covered |= hit.any(axis=0)
                row, step = np.nonzero(hit)
                if len(row):
                    first.append(int((block[row] + step).min()))
                    last.append(int((block[row] + step).max()))
            share = float(covered.sum()) / len(own)
            if share >= COVERAGE:
                found.append((k, min(first), max(last), share))
        return sorted(found, key=lambda s: (s[1], s[2], s[0]))


SPAN = StructType().add("label", "string").add("base", "boolean").add("first", "long").add("last", "long").add("coverage", "double")


def license_spans(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """The columns without `text`, plus `_n_words` and `_spans`: every verified copy of a template, by first and last word.

    Short templates stand word by word. A longer one may lack a fifth of its words, each looked for on the diagonals of its
    group. Null and empty texts have no words and no spans. Repeated rows keep their rows. Nothing of a text is
    left out, whatever its length; the votes of equal texts are counted once. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    kept = [c for c in docs.columns if c != "text"]
    own = docs.select(*kept, F.coalesce("text", F.lit("")).alias("text")).withColumn("_r", F.xxhash64("text"))
    groups = candidate_groups(own.select("_r", "text"), templates).groupBy("r").agg(
        F.collect_list(F.struct("template", "diagonals")).alias("_groups"),
        F.sum(F.size("diagonals")).alias("_n")).checkpoint()
    size = groups.agg(F.sum("_n")).first()[0] or 0
    groups = groups.select(F.col("r").alias("_r"), "_groups")
    joined = own.join(F.broadcast(groups) if size <= BROADCAST_DIAGONALS else groups, "_r", "left").select(
        *kept, "text", "_groups")
    schema = docs.select(*kept).schema.add("_n_words", "long")
    names = [*schema.names, "_spans"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        verifier = Verifier(templates)
        for batch in batches:
            n_words = np.zeros(batch.num_rows, dtype=np.int64)
            spans: list[list[dict]] = [[] for _ in range(batch.num_rows)]
            voted = batch.column(batch.num_columns - 1)
            for chunk in chunks(batch.column(batch.num_columns - 2)):
                words = find_words(chunk, IS_MARK)
                n_words[chunk.first_row:chunk.first_row + chunk.n_docs] = words.count
                for doc in range(chunk.n_docs):
                    cell = voted[chunk.first_row + doc]
                    if cell.is_valid:
                        mine = slice(words.first[doc], words.first[doc + 1])
                        low, high = int(chunk.offsets[doc]), int(chunk.offsets[doc + 1])
                        text = LOWER[chunk.buf[low:high]].tobytes()
                        places = zip((words.start[mine] - low).tolist(), (words.end[mine] - low).tolist())
                        numbers = np.array([verifier.known.get(text[a:b], 0) for a, b in places])
                        groups = [(g["template"].as_py(), np.asarray(g["diagonals"].values)) for g in cell.values]
                        spans[chunk.first_row + doc] = [
                            {"label": templates[k].label, "base": templates[k].base, "first": a, "last": b, "coverage": share}
                            for k, a, b, share in verifier.spans(numbers, groups)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(n_words), pa.array(spans, type=span_type)], names=names)

    span_type = pa.list_(pa.struct([("label", pa.string()), ("base", pa.bool_()), ("first", pa.int64()), ("last", pa.int64()),
                                    ("coverage", pa.float64())]))
    return joined.mapInArrow(run, schema.add("_spans", ArrayType(SPAN)))


def license_report(docs: DataFrame, templates: Sequence[Template] = TEMPLATES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score.

    The score is the highest coverage among the document's spans, 0 without any.
    """
    base = F.filter("_spans", lambda s: s["base"])
    places = F.transform(base, lambda s: s["first"])
    labels = lambda spans: F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")
    return license_spans(docs.select("doc_id", "text"), templates).select(
        "doc_id", F.col("_n_words").alias("n_words"), F.size(base).cast("long").alias("n_base"),
        F.array_min(places).alias("first_word"), F.array_max(places).alias("last_word"),
        labels(base).alias("base_labels"), labels(F.col("_spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("_spans", lambda s: s["coverage"])), F.lit(0.0)).alias("score"))


def license_sql(templates: Sequence[Template] = TEMPLATES) -> str:
    """The report in SQL: grams as texts, the same merging and the same rule of words in place."""
    listed = ",\n        ".join(
        f"({k}, '{t.label}', {str(t.base).lower()}, {str(t.exact).lower()}, {t.gram}, {t.votes}, '{t.text}')"
        for k, t in enumerate(templates))
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
with templates(k, label, base, exact, gram, votes, text) as (values
        {listed}),
split_templates as (select *, regexp_extract_all(text, '{MARK_WORD}') as ws from templates),
template_words as (
    select k, len(ws) as n_words, unnest(range(len(ws))) as t, unnest(ws) as w from split_templates),
template_grams as (
    select k, gram, t, array_to_string(ws[t + 1:t + gram], ' ') as g
    from (select *, unnest(range(len(ws) - gram + 1)) as t from split_templates)),
texts as (select doc_id, row_number() over () as row, regexp_extract_all({lower}, '{MARK_WORD}') as ws from documents),
grams as (
    select row, p, 2 as gram, array_to_string(ws[p + 1:p + 2], ' ') as g from (select row, ws, unnest(range(len(ws) - 1)) as p from texts)
    union all
    select row, p, 4, array_to_string(ws[p + 1:p + 4], ' ') from (select row, ws, unnest(range(len(ws) - 3)) as p from texts)),
votes as (
    select row, k, p - t as diagonal, count(*) as n from grams join template_grams using (gram, g) group by all),
marked as (
    select *, coalesce(diagonal - lag(diagonal) over (partition by row, k order by diagonal)
        > (case when exact then 0 else {SHIFT} end), true)::int as fresh from votes join templates using (k)),
islands as (select *, sum(fresh) over (partition by row, k order by diagonal) as island from marked),
groups as (select row, k, island, votes from islands group by all having sum(n) >= votes),
placed as (
    select row, k, island, count(distinct t) as n_found, any_value(n_words) as n_all, min(diagonal + t) as first
    from groups join islands using (row, k, island) join texts using (row) join template_words using (k)
    where diagonal + t >= 0 and ws[diagonal + t + 1] = w group by all),
spans as (
    select row, label, base, first, n_found::double / n_all as coverage from placed join templates using (k)
    where case when exact then n_found = n_all else n_found::double / n_all >= {COVERAGE} end)
select any_value(doc_id) as doc_id, any_value(len(ws))::bigint as n_words, count(*) filter (base) as n_base,
       (min(first) filter (base))::bigint as first_word, (max(first) filter (base))::bigint as last_word,
       coalesce(string_agg(distinct label, ',' order by label) filter (base), '') as base_labels,
       coalesce(string_agg(distinct label, ',' order by label), '') as labels, coalesce(max(coverage), 0)::double as score
from texts left join spans using (row) group by row"""
