"""SentencePiece encoding by a streaming Viterbi search, and decoding.

The best path through the pieces of a text is found from left to right.  Only the last
``longest piece`` positions can still be extended; as soon as the backpointers from all of
them lead through one boundary, the ids before it are final: they are given out
and the window forgets them.  Memory depends on the window, not on the text.

Some boundaries are known without a search.  Where no piece of the vocabulary has a
space mark after another character, every path passes the place before a word; the same
holds around a character that is in no longer piece.  Between two such places the result
depends on the characters there alone, so it is remembered, up to a bound.

A text may keep its paths apart for long, such as one character repeated.  Convergence is
then looked for each time the open part has doubled, so that all looking takes no longer
than following the pieces; the window is as long as the paths need.

Scores are the model's log-probabilities.  A file of a BPE model holds ranks instead; a
piece of rank r then has the probability Zipf's law gives it, 1 / (r + 2) up to a factor.
No model is trained, and the ids need not be those of BPE merging.

Text is taken as it is, a space becomes the space mark, and one mark is put in front.
Characters that are no piece, and a space mark in the text itself, become bytes, so that
decoding gives back the text exactly.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import TaskCache, map_arrow, texts

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE = 500_000


class Vocabulary:
    """Pieces, their scores, and which boundaries every path passes."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        normal = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        scores = {i: model.get_score(i) for i in normal}
        if all(v <= 0 and v == int(v) for v in scores.values()):
            scores = {i: -float(np.log(rank + 2)) for rank, i in enumerate(normal)}
        self.pieces = {model.id_to_piece(i): i for i in normal}
        self.scores = {p: scores[i] for p, i in self.pieces.items()}
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.longest = max(map(len, self.pieces), default=1)
        # A tree of the pieces' characters: to each its score, minus infinity if no piece ends there, what follows, and the id.
        self.tree: dict[str, tuple] = {}
        for piece in sorted(self.pieces):
            level = self.tree
            for n, char in enumerate(piece, 1):
                if char not in level:
                    level[char] = (self.scores.get(piece[:n], float("-inf")), {}, self.pieces.get(piece[:n], -1))
                level = level[char][1]
        self.marks_lead = not any(MARK in p.lstrip(MARK) for p in self.pieces)
        alone = not any("\n" in p for p in self.pieces if len(p) > 1)
        self.cut = re.compile(
            (r"\n|" if alone else "") + (rf"{MARK}*[^{MARK}{chr(10) if alone else ''}]+|{MARK}+" if self.marks_lead else r"[\s\S]+")
        )
        # For decoding: a piece's bytes.
        self.bytes = [b""] * len(ids)
        for piece, i in self.pieces.items():
            self.bytes[i] = piece.replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids):
            self.bytes[i] = bytes([b])
        self.table = np.array(self.bytes, object)


class StreamingViterbi:
    """Feed characters (spaces already marked), take ids as they become final."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self._restart()

    def _restart(self, kept: str = "") -> None:
        self.text = kept
        self.done = 0  # positions from which all pieces are already followed
        self.best = [0.0]
        self.back: list[int] = [0]  # start of the best piece that ends at each position
        self.look = self.v.longest  # positions from which convergence is looked for

    def _grow(self, final: bool) -> None:
        """Follow the pieces from every position whose longest piece is known to be in the text."""
        v, text, best, back = self.v, self.text, self.best, self.back
        n = len(text)
        if len(best) <= n:
            best.extend([float("-inf")] * (n + 1 - len(best)))
            back.extend([0] * (n + 1 - len(back)))
        longest, unknown, tree = v.longest, v.unknown, v.tree
        last = n if final else n - longest + 1
        for i in range(self.done, last):
            base, level, end = best[i], tree, i
            for char in text[i : i + longest]:
                step = level.get(char)
                if step is None:
                    break
                end += 1
                score, level, _ = step
                score += base
                if score > best[end]:
                    best[end], back[end] = score, i
            if text[i] not in v.scores and base + unknown > best[i + 1]:
                best[i + 1], back[i + 1] = base + unknown, i
        self.done = max(last, self.done)

    def _ids(self, upto: int) -> list[int]:
        cuts = [upto]
        while cuts[-1]:
            cuts.append(self.back[cuts[-1]])
        out: list[int] = []
        for a, b in zip(cuts[::-1], cuts[-2::-1]):
            known = self.v.pieces.get(self.text[a:b])
            out.extend([known] if known is not None else (self.v.byte_ids[x] for x in self.text[a:b].encode("utf-8", "replace")))
        return out

    def _converged(self) -> int:
        """The last boundary that the paths from all open positions share, 0 if only the start."""
        open_ = set(range(self.done, min(self.done + self.v.longest, len(self.text)) + 1))
        open_ = {p for p in open_ if self.best[p] > float("-inf")}
        while len(open_) > 1:
            top = max(open_)
            open_.remove(top)
            open_.add(self.back[top])
        return open_.pop() if open_ else 0

    def feed(self, text: str) -> list[int]:
        """Add text; the ids that no later text can change."""
        self.text += text
        self._grow(final=False)
        if self.done <= self.look:
            return []
        at = self._converged()
        self.look = max(self.v.longest, 2 * (self.done - at))
        if not at:
            return []
        out = self._ids(at)
        self.text = self.text[at:]
        base = self.best[at]
        self.best = [b - base for b in self.best[at:]]
        self.back = [max(b - at, 0) for b in self.back[at:]]
        self.done -= at
        return out

    def whole(self, text: str) -> list[int]:
        """The ids of a text shorter than any window, in one go."""
        v, n = self.v, len(text)
        tree, scores, unknown, longest = v.tree, v.scores, v.unknown, v.longest
        best, back, made = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i, first in enumerate(text):
            base, level, end = best[i], tree, i
            for char in text[i : i + longest]:
                step = level.get(char)
                if step is None:
                    break
                end += 1
                score, level, piece = step
                if base + score > best[end]:
                    best[end], back[end], made[end] = base + score, i, piece
            if first not in scores and base + unknown > best[i + 1]:
                best[i + 1], back[i + 1], made[i + 1] = base + unknown, i, -1
        ids, at = [], n
        while at:
            if made[at] >= 0:
                ids.append(made[at])
            else:
                ids += [v.byte_ids[x] for x in reversed(text[back[at] : at].encode("utf-8", "replace"))]
            at = back[at]
        ids.reverse()
        return ids

    def finish(self, text: str = "") -> list[int]:
        """Add the last text; the ids of all that is left."""
        self.text += text
        self._grow(final=True)
        out = self._ids(len(self.text)) if self.text else []
        self._restart()
        return out


class Encoder(TaskCache):
    """Texts to ids; stretches between sure boundaries are remembered."""

    STEP = 256

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.v = vocabulary
        self.search = StreamingViterbi(vocabulary)

    def __missing__(self, stretch: str) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        ids: list[int] = []
        if len(stretch) <= self.STEP:
            ids = self.search.whole(stretch)
        else:
            for at in range(0, len(stretch) - self.STEP, self.STEP):
                ids += self.search.feed(stretch[at : at + self.STEP])
            ids += self.search.finish(stretch[len(stretch) - 1 - (len(stretch) - 1) % self.STEP :])
        made = array("i", ids).tobytes()
        if len(stretch) <= 64:
            self[stretch] = made
        return made

    def raw(self, text: str) -> bytes:
        """The ids of a text as bytes of 32-bit numbers."""
        if not text:
            return b""
        out: list[bytes] = []
        for n, part in enumerate(text.split(MARK)):
            if n:
                out.append(array("i", (self.v.byte_ids[b] for b in MARK.encode())).tobytes())
            marked = part.replace(" ", MARK)
            out += map(self.__getitem__, self.v.cut.findall(marked if n else MARK + marked))
        return b"".join(out)

    def of(self, text: str) -> list[int]:
        return array("i", self.raw(text)).tolist()


def decode_ids(ids: Iterable[int] | np.ndarray, vocabulary: Vocabulary) -> str:
    """The text of ids; bytes are put together, the mark in front goes.  Unknown ids are nothing."""
    numbers = np.asarray(ids, np.int64)
    if len(numbers) and (numbers.min() < 0 or numbers.max() >= len(vocabulary.table)):
        numbers = numbers[(numbers >= 0) & (numbers < len(vocabulary.table))]
    text = b"".join(vocabulary.table[numbers].tolist()).decode("utf-8", "replace")
    return text[1:] if text.startswith(" ") else text


_ENCODERS: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    return _ENCODERS.get(path) or _ENCODERS.setdefault(path, Encoder(Vocabulary(path)))


def encode(docs: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids)`` for every row of ``docs(doc_id, text)``; null and empty texts have no ids.

    ``model`` is a SentencePiece file every worker can open.
    """
    def run(batches: Iterator[pa.RecordBatch]):
        encoder = encoder_of(model)
        for batch in batches:
            parts = [encoder.raw(text) for text in texts(batch)]
            ends = np.cumsum([0, *map(len, parts)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(parts), np.int32)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], names=["doc_id", "ids"])

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, model: str) -> DataFrame:
    """``(doc_id, ids, text)`` of ``encoded(doc_id, ids)``; null and empty ids give an empty text."""
    def run(batches: Iterator[pa.RecordBatch]):
        vocabulary = encoder_of(model).v
        for batch in batches:
            made = [decode_ids(ids.values.fill_null(-1).to_numpy() if ids.is_valid else [], vocabulary) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("ids"), pa.array(made, pa.string())],
                                             names=["doc_id", "ids", "text"])

    return map_arrow(encoded.select("doc_id", "ids"), run, "doc_id bigint, ids array<int>, text string")
