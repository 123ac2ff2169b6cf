"""Chat formatting with offset-aligned loss masks.

A conversation is rendered whole and encoded once, with offsets.  The spans of its
turns in the rendered text are sorted, and so are the tokens' spans; binary search finds
the tokens of each assistant turn.

    <|im_start|>role<|im_sep|>text<|im_end|>   for each turn, nothing between

The three marks are single tokens that never join with what stands beside them, so a
token lies wholly inside a turn's text or wholly outside it.  Inside roles and texts
``<|`` gets a backslash, and a row of backslashes there one more; taking one away
gives the text back.

Because of the marks, encoding blocks of turns gives the same ids as encoding the
conversation whole.  Only conversations of more than ``BLOCK_TURNS`` turns or
``BLOCK_CHARS`` characters make use of that: their blocks are rows of their own, spread
over tasks, so that no conversation has to fit into one.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer, processors

from docketry.llm.common import map_arrow

START, SEP, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
BLOCK_TURNS = 256
BLOCK_CHARS = 4_000_000
LOSS_ROLE = "assistant"


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, np.ndarray]:
    """The rendered text and the spans of the turns' texts in it, one row each."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{SEP}", escape(text)
        spans.append((at + len(head), at + len(head) + len(body)))
        parts += [head, body, END]
        at = spans[-1][1] + len(END)
    return "".join(parts), np.array(spans, np.int64).reshape(-1, 2)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered text."""
    turns = []
    for turn in formatted.split(START)[1:]:
        role, _, rest = turn.partition(SEP)
        turns.append((unescape(role), unescape(rest.removesuffix(END))))
    return turns


_TOKENIZERS: dict[str, Tokenizer] = {}


def tokenizer_of(path: str) -> Tokenizer:
    """The tokenizer with the three marks added; its offsets keep white space."""
    if path not in _TOKENIZERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        made = Tokenizer.from_file(path)
        made.add_special_tokens([AddedToken(m, special=True, normalized=False) for m in (START, SEP, END)])
        made.post_processor = processors.ByteLevel(trim_offsets=False)
        _TOKENIZERS[path] = made
    return _TOKENIZERS[path]


def mask_of(offsets: np.ndarray, spans: np.ndarray) -> np.ndarray:
    """Which tokens overlap one of the sorted ``spans``; by binary search."""
    mask = np.zeros(len(offsets), bool)
    if not len(offsets):
        return mask
    for start, end in spans:
        if start < end:
            first = np.searchsorted(offsets[:, 1], start, "right")
            mask[first : np.searchsorted(offsets[:, 0], end, "left")] = True
    return mask


@dataclass
class _Block:
    key: tuple
    turns: list = field(default_factory=list)
    chars: int = 0
    part: int = 0


def format_conversations(turns: DataFrame, tokenizer: str, loss_role: str = LOSS_ROLE) -> DataFrame:
    """Rows ``(conv_id, block, part, n_turns, formatted, ids, mask)`` of ``turns(conv_id, turn, role, text)``.

    A conversation is one row unless it is longer than a block; (block, part) is the
    order of its rows.  Turns are in the order of ``turn``, null last, ties by role and
    text.  Null roles and texts count as empty.  Rows without a conversation id form
    one conversation.  An empty table gives no row.
    """
    kinds = {"conv_id": pa.int64(), "block": pa.int64(), "part": pa.int64(), "n_turns": pa.int64(),
             "formatted": pa.string(), "ids": pa.list_(pa.int32()), "mask": pa.list_(pa.bool_())}

    def finish(block: _Block) -> dict:
        text, spans = render(block.turns)
        encoded = tokenizer_of(tokenizer).encode(text, add_special_tokens=False)
        offsets = np.array(encoded.offsets, np.int64).reshape(-1, 2)
        wanted = spans[[role == loss_role for role, _ in block.turns]]
        conv, number = block.key
        return {"conv_id": conv, "block": number, "part": block.part, "n_turns": len(block.turns),
                "formatted": text, "ids": encoded.ids, "mask": mask_of(offsets, wanted).tolist()}

    def run(batches):
        block, done, size = None, [], 0
        for batch in batches:
            for conv, number, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "block", "role", "text"))):
                key = (conv, number)
                if block is None or block.key != key or block.chars >= BLOCK_CHARS:
                    if block is not None:
                        done.append(finish(block))
                        size += block.chars
                    block = _Block(key, part=block.part + 1 if block is not None and block.key == key else 0)
                if size >= BLOCK_CHARS:
                    yield _rows(done, kinds)
                    done, size = [], 0
                block.turns.append((role or "", text or ""))
                block.chars += len(text or "") + len(role or "")
        if block is not None:
            done.append(finish(block))
        if done:
            yield _rows(done, kinds)

    number = F.coalesce(F.floor(F.col("turn") / BLOCK_TURNS), F.lit(1 << 62)).cast("bigint")
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), number.alias("block"), "turn", "role", "text")
    dealt = rows.repartition("conv_id", "block").sortWithinPartitions(
        "conv_id", "block", F.col("turn").asc_nulls_last(), "role", "text"
    )
    return map_arrow(
        dealt, run,
        "conv_id bigint, block bigint, part bigint, n_turns bigint, formatted string, ids array<int>, mask array<boolean>",
    )


def _rows(found: list[dict], kinds: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[c] for r in found], k) for c, k in kinds.items()], names=list(kinds))


def loss_texts(ids: list[int], mask: list[bool], tokenizer: Tokenizer) -> list[str]:
    """The texts under the mask, one for each run of masked tokens, decoded from the ids."""
    under = np.asarray(mask, bool)
    edges = np.flatnonzero(np.diff(np.concatenate([[False], under, [False]]).astype(np.int8)))
    return [
        unescape(tokenizer.decode(ids[a:b], skip_special_tokens=False)) for a, b in zip(edges[::2], edges[1::2])
    ]


def digest(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """What the output of ``format_conversations`` says, read back: one row per conversation.

    Turns come from the rendered text, loss texts from the masked ids.  A
    conversation's rows stream through one task in order, none is held, since
    a digest over all of it can only be made in sequence.
    """
    def run(batches):
        mill = tokenizer_of(tokenizer)
        now, conv = None, None
        done = []
        for batch in batches:
            for c, text, ids, mask in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "formatted", "ids", "mask"))):
                if now is None or c != conv:
                    if now is not None:
                        done.append(now.row(conv))
                    now, conv = _Digest(), c
                now.add(text, loss_texts(ids, mask, mill))
            if done:
                yield _rows(done, _DIGEST)
                done = []
        if now is not None:
            yield _rows([now.row(conv)], _DIGEST)

    ordered = formatted.select("conv_id", "block", "part", "formatted", "ids", "mask").repartition("conv_id")
    return map_arrow(
        ordered.sortWithinPartitions("conv_id", "block", "part"), run,
        "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    )


_DIGEST = {"conv_id": pa.int64(), "n_turns": pa.int64(), "turns_sha256": pa.string(), "loss_chars": pa.int64(),
           "loss_sha256": pa.string(), "formatted_chars": pa.int64()}


class _Digest:
    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n = self.loss_chars = self.chars = 0

    def add(self, text: str, losses: list[str]) -> None:
        for role, said in parse(text):
            self.turns.update(f"{role}\n{said}\n".encode())
            self.n += 1
        for said in losses:
            self.loss.update(said.encode())
            self.loss_chars += len(said)
        self.chars += len(text)

    def row(self, conv) -> dict:
        return {"conv_id": conv, "n_turns": self.n, "turns_sha256": self.turns.hexdigest(), "loss_chars": self.loss_chars,
                "loss_sha256": self.loss.hexdigest(), "formatted_chars": self.chars}
