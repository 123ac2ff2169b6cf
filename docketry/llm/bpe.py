"""Byte-level BPE encoding and decoding by a pair occurrence index.

The pieces between which nothing merges are put end to end, each distinct one once.  An
index maps every pair of neighbouring tokens that has a rank to all its positions there.
Ranks are applied in ascending order: the lowest active one takes all its positions at
once, from left to right where they overlap, and the positions of the pairs that vanish
and appear beside them are updated in the index.  A merge makes a token that no other
merge makes and that only later ones use (checked when the file is read), so no rank
below the one at hand can turn up and the ids are those of merging piece by piece.

A task takes its partition in Arrow batches bounded by bytes, for an index of all of it
would have no bound.  Pieces met before are remembered up to a bound, and forgotten
after the task.  Nothing is shuffled, and a text is never cut: one unbroken text of
megabytes is one piece, whose positions are merged rank by rank like any others.
"""

from __future__ import annotations

import heapq
import json
import os
import re
from collections.abc import Iterable
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docketry.llm.common import TaskCache, map_arrow, texts

#: Pieces a task remembers, and the longest of them in characters.
CACHE, CACHED_CHARS = 400_000, 200
#: Characters of texts that are cut, and bytes of new pieces that are merged, at once, about.
CUT, INDEXED = 4_000_000, 1_500_000
#: White space of the byte-level pattern.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A space belongs to the word behind it; other white space before a word stands alone.
_CHUNK = re.compile(f" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: The whole pattern where all is Latin, whose letters and digits are the same in every Unicode version.
_OTHER = re.compile("[^\0-\u024f]")
_LETTERS, _DIGITS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u024f", "0-9\xb2\xb3\xb9\xbc-\xbe"
_LATIN = re.compile(
    f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_DIGITS}]+| ?[^{SPACE}{_LETTERS}{_DIGITS}]+"
    f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"
)


def byte_letters() -> list[str]:
    """The letter that byte-level files write each byte with: printable ones themselves, others from U+0100 up."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(hidden)) for b in range(256)]


class Vocabulary:
    """Merges, base tokens and special tokens of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, added = told["model"], told["added_tokens"]
        cut = told["pre_tokenizer"] or {}
        odd = [k for k in ("unk_token", "continuing_subword_prefix", "end_of_word_suffix", "dropout") if model.get(k)]
        if model["type"] != "BPE" or cut.get("type") != "ByteLevel" or told["normalizer"] or odd:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        if cut.get("add_prefix_space") or not cut.get("use_regex", True) or model.get("ignore_merges"):
            raise ValueError(f"{path} cuts texts in another way")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path} has special tokens that take white space with them")
        ids = model["vocab"]
        self.size = max([*ids.values(), *(t["id"] for t in added)]) + 1
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.left = np.array([ids[a] for a, _ in pairs], np.int64)
        self.right = np.array([ids[b] for _, b in pairs], np.int64)
        self.made = np.array([ids[a + b] for a, b in pairs], np.int64)
        self._check(path)
        keys = self.left * self.size + self.right
        self._ranks = np.argsort(keys, kind="stable")
        self._keys = keys[self._ranks]
        letters = byte_letters()
        if any(c not in ids for c in letters):
            raise ValueError(f"{path} has no token for some byte")
        self.base = np.array([ids[c] for c in letters], np.int64)
        as_bytes = {ord(c): b for b, c in enumerate(letters)}
        self.bytes = [b""] * self.size
        for token, i in ids.items():
            self.bytes[i] = token.translate(as_bytes).encode("latin-1")
        for t in added:
            self.bytes[t["id"]] = t["content"].encode()
        self.special = {t["content"]: t["id"] for t in added}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if added else None
        # The library tells letters from digits and marks, by its own Unicode version.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._cut_any = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def _check(self, path: str) -> None:
        rank = {int(t): r for r, t in enumerate(self.made)}
        if len(rank) < len(self.made):
            raise ValueError(f"{path}: two merges make the same token")
        for r, (a, b) in enumerate(zip(self.left.tolist(), self.right.tolist())):
            if rank.get(a, -1) >= r or rank.get(b, -1) >= r:
                raise ValueError(f"{path}: merge {r} uses a token that is made later")

    def pieces_of(self, chunk: str) -> list[str]:
        if _OTHER.search(chunk) is None:
            return _LATIN.findall(chunk)
        return [chunk[a:b] for _, (a, b) in self._cut_any(chunk)]

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, -1 where it has none; numbers below 0 are no tokens."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self._keys, keys), len(self._keys) - 1)
        return np.where((self._keys[at] == keys) & (left >= 0) & (right >= 0), self._ranks[at], -1)


class PairIndex:
    """Positions of every ranked pair in a row of tokens, where -1 parts the pieces."""

    def __init__(self, vocabulary: Vocabulary, tokens: np.ndarray):
        self.vocabulary = vocabulary
        self.tokens = tokens
        self.next = np.arange(1, len(tokens) + 1)
        self.prev = np.arange(-1, len(tokens) - 1)
        self.positions: dict[int, list[np.ndarray]] = {}
        self.active: list[int] = []
        self._add(vocabulary.ranks(tokens[:-1], tokens[1:]), np.arange(len(tokens) - 1))

    def _add(self, ranks: np.ndarray, at: np.ndarray) -> None:
        """Put positions into the lists of their ranks."""
        known = ranks >= 0
        ranks, at = ranks[known], at[known]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        edges = np.flatnonzero(np.diff(ranks)) + 1
        for rank, some in zip(ranks[np.concatenate([[0], edges])].tolist(), np.split(at, edges)):
            if rank in self.positions:
                self.positions[rank].append(some)
            else:
                self.positions[rank] = [some]
                heapq.heappush(self.active, rank)

    def merge_all(self) -> np.ndarray:
        """Apply all ranks; the tokens that are left, with the -1 between pieces."""
        while self.active:
            self._merge(heapq.heappop(self.active))
        return self.tokens[self.tokens != -2]

    def _merge(self, rank: int) -> None:
        v, tokens = self.vocabulary, self.tokens
        left, right, made = v.left[rank], v.right[rank], v.made[rank]
        lists = self.positions.pop(rank)
        at = lists[0] if len(lists) == 1 else np.unique(np.concatenate(lists))
        # Positions whose pair another merge has taken apart meanwhile are stale.
        at = at[(tokens[at] == left) & (tokens[self.next[at]] == right)]
        if left == right and len(at) > 1:
            # Of overlapping positions in a row every second one merges.
            at = np.unique(at)
            n = np.arange(len(at))
            begins = np.concatenate([[True], self.next[at[:-1]] != at[1:]])
            at = at[(n - np.maximum.accumulate(np.where(begins, n, 0))) % 2 == 0]
        if not len(at):
            return
        gone = self.next[at]
        after = self.next[gone]
        tokens[at], tokens[gone] = made, -2
        self.next[at], self.prev[after] = after, at
        before = self.prev[at]
        made_row = np.broadcast_to(made, len(at))
        self._add(
            np.concatenate([v.ranks(tokens[before], made_row), v.ranks(made_row, tokens[after])]),
            np.concatenate([before, at]),
        )


def merge_pieces(vocabulary: Vocabulary, pieces: list[bytes]) -> list[bytes]:
    """The ids of each piece, as bytes of 32-bit numbers."""
    if not pieces:
        return []
    ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)) + 1)
    tokens = np.empty(ends[-1] + 1, np.int64)
    inside = np.ones(len(tokens), bool)
    inside[0] = inside[ends] = False
    tokens[inside] = vocabulary.base[np.frombuffer(b"".join(pieces), np.uint8)]
    tokens[~inside] = -1
    merged = PairIndex(vocabulary, tokens).merge_all()
    edges = (4 * np.flatnonzero(merged == -1)).tolist()
    raw = merged.astype("<i4").tobytes()
    return [raw[a + 4 : b] for a, b in zip(edges, edges[1:])]


class Encoder(TaskCache):
    """Ids of chunks of text, as bytes of 32-bit numbers, remembered up to a bound."""

    def __init__(self, path: str):
        super().__init__()
        self.vocabulary = Vocabulary(path)

    def encode(self, batch: Iterable[str]) -> list[bytes]:
        """The ids of each text.  New chunks of all texts are merged together."""
        cut = [self._chunks(text) for text in batch]
        if len(self) >= CACHE:
            self.clear()
        for token, number in self.vocabulary.special.items():
            self[token] = number.to_bytes(4, "little")
        new = set(chain.from_iterable(cut)).difference(self)
        group: list[str] = []
        size = 0
        for chunk in new:
            group.append(chunk)
            size += len(chunk)
            if size >= INDEXED:
                self._merge(group)
                group, size = [], 0
        self._merge(group)
        ids = [b"".join(map(self.__getitem__, chunks)) for chunks in cut]
        for chunk in new:
            if len(chunk) > CACHED_CHARS:
                del self[chunk]
        return ids

    def _chunks(self, text: str) -> list[str]:
        """Parts between which nothing merges: special tokens, pieces where all is Latin, else words."""
        pattern = _CHUNK if _OTHER.search(text) else _LATIN
        cut = self.vocabulary.cut
        if cut is None or cut.search(text) is None:
            return pattern.findall(text)
        found: list[str] = []
        for n, part in enumerate(cut.split(text)):
            found += [part] if n % 2 else pattern.findall(part)
        return found

    def _merge(self, chunks: list[str]) -> None:
        """Remember the ids of new chunks, whose distinct pieces are merged together."""
        numbers: dict[str, int] = {}
        spelled = [[numbers.setdefault(p, len(numbers)) for p in self.vocabulary.pieces_of(c)] for c in chunks]
        ids = merge_pieces(self.vocabulary, [p.encode() for p in numbers])
        for chunk, pieces in zip(chunks, spelled):
            self[chunk] = ids[pieces[0]] if len(pieces) == 1 else b"".join([ids[n] for n in pieces])


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """This worker's encoder of a file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def decode_ids(ids: bytes, tokens: list[bytes]) -> str:
    """The text of little-endian 32-bit ids; unknown ids are left out, broken UTF-8 is replaced."""
    n = len(tokens)
    numbers = np.frombuffer(ids, "<u4").tolist()
    return b"".join([tokens[i] for i in numbers if i < n]).decode("utf-8", "replace")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids)`` of each row of ``docs(doc_id, text)``; ids are little-endian unsigned 32-bit numbers.

    Special tokens named in a text become their ids; none are added.  A null text is
    empty, an empty text has no id.  Repeated rows and null ids stay as they are, other
    columns are not read.  An empty table gives no row.
    """
    def run(batches):
        mill = encoder(path)
        for batch in batches:
            ids: list[bytes] = []
            some: list[str] = []
            size = 0
            for text in texts(batch):
                some.append(text)
                size += len(text)
                if size >= CUT:
                    ids += mill.encode(some)
                    some, size = [], 0
            ids += mill.encode(some)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    kind = dict(docs.dtypes)["doc_id"]
    return map_arrow(docs.select("doc_id", "text"), run, f"doc_id {kind}, ids binary")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded(doc_id, ids)`` with ``text``; null ids give an empty text."""
    def run(batches):
        tokens = encoder(path).vocabulary.bytes
        for batch in batches:
            said = [decode_ids(ids.as_py() or b"", tokens) for ids in batch.column("ids")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("ids"), pa.array(said, pa.string())], names=["doc_id", "ids", "text"]
            )

    kind = dict(encoded.dtypes)["doc_id"]
    return map_arrow(encoded.select("doc_id", "ids"), run, f"doc_id {kind}, ids binary, text string")


def digest(decoded: DataFrame) -> DataFrame:
    """Number and digests of the ids and of the text they give back."""
    ids = F.coalesce("ids", F.lit(b""))
    return decoded.select(
        "doc_id",
        F.floor(F.octet_length(ids) / 4).cast("bigint").alias("n_tokens"),
        F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
