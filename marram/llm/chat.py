"""Chat formatting at token level: segments encoded apart, reserved ids between them, masks by prefix sums."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# The public vocabulary's split pattern, and the control strings of the template.
PATTERN = (r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
CONTROL = ("<s>", "</s>", "[INST]", "[/INST]")
LEARNED_ROLE = "assistant"

# A control string whose first character is followed by any number of backslashes.
_ESCAPABLE = re.compile(r"([<\[])(\\*)(/?s>|/?INST\])")


def escape(text: str) -> str:
    """One more backslash inside whatever could be read as a control string."""
    return _ESCAPABLE.sub(r"\1\2\\\3", text)


def unescape(text: str) -> str:
    return re.sub(r"([<\[])(\\*)\\(/?s>|/?INST\])", r"\1\2\3", text)


@dataclass(frozen=True)
class Template:
    """`<s>`, then per turn `[INST]role[/INST]text</s>`; each control string is one reserved id.

    Reserved ids follow the vocabulary's own. Content is encoded as ordinary text, so it never holds one, and
    it is escaped, so the decoded string is as unambiguous as the ids.
    """

    path: str = TOKENIZER

    def encoding(self):
        return _encoding(self.path)

    def reserved(self) -> dict[str, int]:
        return {s: self.encoding().n_vocab + k for k, s in enumerate(CONTROL)}

    def turn(self, role: str, text: str) -> tuple[list[int], int, int]:
        """Ids of one turn, and the range of ids that are learned from."""
        special, encode = self.reserved(), self.encoding().encode_ordinary
        segments = [[special["[INST]"]], encode(escape(role)), [special["[/INST]"]], encode(escape(text)), [special["</s>"]]]
        ends = np.cumsum([len(s) for s in segments])
        low, high = (int(ends[2]), int(ends[3])) if role == LEARNED_ROLE else (0, 0)
        return [i for s in segments for i in s], low, high

    def decode(self, ids: np.ndarray) -> str:
        """Ordinary and reserved ids as the formatted string."""
        names = {v: k for k, v in self.reserved().items()}
        out, ordinary = [], []
        for i in ids.tolist():
            if i in names:
                out += [self.encoding().decode_bytes(ordinary), names[i].encode()]
                ordinary = []
            else:
                ordinary.append(i)
        return b"".join([*out, self.encoding().decode_bytes(ordinary)]).decode()


@lru_cache(maxsize=4)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
    return tiktoken.Encoding("chat", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def encoded_turns(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, turn, tie, ids, learned_from, learned_to), one row per turn, encoded where the row lies."""
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("role", "text"))
    schema = "conv_id long, turn long, tie long, ids array<int>, learned_from int, learned_to int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turns = [template.turn(r, t) for r, t in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int64()), batch.column(4),
                pa.array([t[0] for t in turns], type=pa.list_(pa.int32())),
                pa.array([t[1] for t in turns], type=pa.int32()), pa.array([t[2] for t in turns], type=pa.int32()),
            ], names=["conv_id", "turn", "tie", "ids", "learned_from", "learned_to"])

    return rows.mapInArrow(run, schema)


def formatted_conversations(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, n_turns, ids, learned): a conversation's ids and its loss mask as runs [from, to) of ids.

    Turns by `turn`, nulls first, equal turns by a hash of role and text; repeated rows are turns of their own.
    Null roles and texts are empty; rows without a conv_id form one conversation. A row holds one
    conversation: what is brought together is already encoded, and runs, not flags per id, mark the loss.
    """
    turns = F.sort_array(F.collect_list(F.struct("turn", "tie", "ids", "learned_from", "learned_to")))
    rows = encoded_turns(conversations, template).groupBy("conv_id").agg(turns.alias("turns"))
    bos = template.reserved()["<s>"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, ids, runs = [], [], []
            for turns in batch.column(1).to_pylist():
                lengths = [len(t["ids"]) for t in turns]
                starts = np.cumsum([1, *lengths])[:-1]  # after the leading id
                n.append(len(turns))
                ids.append(np.concatenate([[bos], *[t["ids"] for t in turns]]).astype(np.int32))
                runs.append([(int(s) + t["learned_from"], int(s) + t["learned_to"])
                             for s, t in zip(starts, turns) if t["learned_to"] > 0])
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array(n, type=pa.int64()), pa.array(ids, type=pa.list_(pa.int32())),
                pa.array([[{"start": a, "stop": b} for a, b in r] for r in runs],
                         type=pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
            ], names=["conv_id", "n_turns", "ids", "learned"])

    return rows.mapInArrow(run, "conv_id long, n_turns long, ids array<int>, learned array<struct<start int, stop int>>")


def chat_report(conversations: DataFrame, template: Template = Template()) -> DataFrame:
    """Digests read back from the ids and the mask alone: turns, learned text, and the formatted length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for conv, ids, learned in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3).to_pylist()):
                ids = np.asarray(ids.values)
                special = template.reserved()
                opens, middles = np.flatnonzero(ids == special["[INST]"]), np.flatnonzero(ids == special["[/INST]"])
                closes = np.flatnonzero(ids == special["</s>"])
                turns = hashlib.sha256()
                for a, b, c in zip(opens.tolist(), middles.tolist(), closes.tolist()):
                    role, text = (unescape(template.decode(x)) for x in (ids[a + 1:b], ids[b + 1:c]))
                    turns.update(f"{role}\n{text}\n".encode())
                # The mask as one flag per id: prefix sums over its edges.
                edges = np.zeros(len(ids) + 1, dtype=np.int64)
                for run_ in learned:
                    edges[run_["start"]] += 1
                    edges[run_["stop"]] -= 1
                mask = np.cumsum(edges)[:-1] > 0
                loss, chars = hashlib.sha256(), 0
                for run_ in learned:
                    text = unescape(template.decode(ids[run_["start"]:run_["stop"]][mask[run_["start"]:run_["stop"]]]))
                    loss.update(text.encode())
                    chars += len(text)
                rows.append((conv, len(opens), turns.hexdigest(), chars, loss.hexdigest(), len(template.decode(ids))))
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(),
                                                            pa.int64()))],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted_conversations(conversations, template).mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
             "formatted_chars long")


CHAT_SQL = r"""
with c as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
    union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
    union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (
    select *, length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\2\\\3', 'g'))
            + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\2\\\3', 'g')) + 17 as chars
    from c)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role)) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn) filter (role = 'assistant'), '')) as loss_sha256,
       (3 + sum(chars))::bigint as formatted_chars
from e group by conv_id"""
