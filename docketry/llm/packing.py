"""Packing along a space-filling curve.

Each document's token ids give a hashed vector: fixed random directions, one per id,
averaged.  Its few coordinates are cut to a grid, and the cell's place on a Hilbert
curve is the document's key.  Documents are range-sorted by key, so neighbours in the
sequence are near in content, and laid end to end: a document's place is the number of
ids before it.  Sequences are cut from that line every ``LENGTH`` ids.  What is left at
its very end becomes sequences whose lengths are powers of two, so nothing is padded.

Ids are made once and written.  Only row number, key and length are sorted; the ids are
joined to their places by row number.  Sorting is by (key, row), so a key that many
copies share is split like any other.
"""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docketry.llm.common import TaskCache, map_arrow, stage

LENGTH = 4096
END_ID = 2
DIMS, BITS = 3, 16
SEED = 9
#: Texts whose words are cut and numbered at once.
SLICE = 4000
#: Words a task remembers.
CACHE = 800_000


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place on the Hilbert curve of each row of grid coordinates (below ``2**bits``).

    The coordinates are turned into the transposed curve index by undoing rotations
    from the top bit down, then Gray-coded; the index interleaves their bits.
    """
    x = [c.astype(np.int64).copy() for c in cells.T]
    dims = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(dims):
            set_ = (x[i] & q) != 0
            swap = (x[0] ^ x[i]) & low
            x[0] = np.where(set_, x[0] ^ low, x[0] ^ swap)
            if i:
                x[i] = np.where(set_, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for v in x:
            key = (key << 1) | (((v ^ turn) >> b) & 1)
    return key


_MARKS = ".,!?;:"
_LATIN_END = "\u0250"
_PROBES = ("Straightforward", "HELLO,", "thorer.", "Zxqvwy!", "a?", "I;", "Antidisestablishment:", "ÜBERMÄSSIG", "façade,", "niño.", "œuvreŽ")


def _byte_table() -> dict[int, int]:
    """The letters byte-level tokenizers write bytes with: printable ones themselves, others from 256 up."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return {b: 256 + n for n, b in enumerate(hidden)}


_BYTE_TABLE = _byte_table()


def _byte_letters(word: bytes) -> str:
    return word.decode("latin-1").translate(_BYTE_TABLE)


class _WordIds(TaskCache):
    """Ids of words between white space, as bytes of 16- or 32-bit numbers, remembered up to a bound.

    White space always ends a token of the tokenizers meant here, which drop it.  Where
    a tokenizer also folds case and keeps letters apart from marks, which a few
    probes tell, Latin words are put together from their letters' and marks' ids.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.folds = all(self._plain(w) == self._plain(w.lower()) == self._letters(w) for w in _PROBES)
        self.code = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"

    def _plain(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _letters(self, word: str) -> list[int]:
        head = word.rstrip(_MARKS).lower()
        parts = [head, *word[len(head) :]]
        return [t.id for part in parts for t in self.tokenizer.model.tokenize(_byte_letters(part.encode()))]

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE:
            self.clear()
        self[word] = ids = self._encode(word)
        return ids

    def _encode(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if self.folds and max(text) < _LATIN_END and "<|" not in text:
            small = text.lower()
            if small != text:
                return self[small.encode()]
            # A letter and a mark after it are never in one token, nor are letters split before merging.
            if text[-1] in _MARKS and text[:-1].isalpha():
                return self[word[:-1]] + self[word[-1:]]
            if text.isalpha():
                return self._array(t.id for t in self.tokenizer.model.tokenize(_byte_letters(word)))
        return self._array(self._plain(text))

    def _array(self, ids: Iterable[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def of(self, text: bytes) -> np.ndarray:
        return next(self.of_column(pa.array([text], pa.binary()).cast(pa.string())))

    def of_column(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text.  Words are cut and numbered by Arrow; only distinct ones are encoded."""
        column = pc.fill_null(column, "")
        if self.folds:
            # A special token's name is no such name in capitals.
            column = pc.if_else(pc.match_substring(column, "<|"), column, pc.ascii_lower(column))
        words = pc.ascii_split_whitespace(column)
        ends = words.offsets.to_numpy()
        numbered = words.values.dictionary_encode()
        codes = numbered.indices.to_numpy()
        known = [self[w] if w else b"" for w in numbered.dictionary.cast(pa.binary()).to_pylist()]
        pool = np.frombuffer(b"".join(known), self.code)
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // pool.itemsize
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
        for a, b in zip(ends, ends[1:]):
            mine = codes[a:b]
            n = sizes[mine]
            total = int(n.sum())
            # Each word's ids, one after the other.
            jumps = np.repeat(starts[mine] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(mine) else np.zeros(0, np.int64)
            yield pool[jumps + np.arange(total)]


_TOKENIZERS: dict[str, _WordIds] = {}


def tokenised(docs: DataFrame, tokenizer: str) -> DataFrame:
    """A written table ``(row, doc_id, n, key, ids)``: ids with the end id, as bytes, and the curve key."""
    def run(batches):
        words = _TOKENIZERS.get(tokenizer) or _TOKENIZERS.setdefault(tokenizer, _WordIds(tokenizer))
        size = max(words.tokenizer.get_vocab_size(), END_ID + 1)
        directions = np.random.default_rng(SEED).standard_normal((size, DIMS)).astype(np.float32)
        end = array(words.code, [END_ID]).tobytes()
        for batch in (b.slice(at, SLICE) for b in batches for at in range(0, len(b), SLICE)):
            counts, points, out = [], [], []
            column = batch.column("text")
            for ids in words.of_column(column):
                points.append(directions[ids].mean(axis=0) if len(ids) else np.zeros(DIMS, np.float32))
                counts.append(len(ids) + 1)
                out.append(ids.tobytes() + end)
            grid = 0.5 + np.arctan(np.array(points, np.float64).reshape(-1, DIMS) * 8) / np.pi
            cells = np.minimum((grid * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(counts, pa.int64()),
                 pa.array(hilbert_key(cells), pa.int64()), pa.array(out, pa.binary())],
                names=["row", "doc_id", "n", "key", "ids"],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    made = map_arrow(rows, run, "row bigint, doc_id bigint, n bigint, key bigint, ids binary")
    return stage(made, "pack-ids")


def places(ids: DataFrame) -> tuple[DataFrame, int]:
    """``(row, at)``, the ids before each row along the curve, and the number of all ids."""
    ordered = stage(
        ids.select("row", "key", "n").repartitionByRange("key", "row").withColumn("part", F.spark_partition_id()),
        "pack-order",
    )
    # One row per range of keys.
    sums = ordered.groupBy("part").agg(F.sum("n").alias("n")).orderBy("part").collect()
    before = np.concatenate([[0], np.cumsum([r["n"] for r in sums])]).astype(np.int64)
    starts = ordered.sparkSession.createDataFrame(
        [(r["part"], int(b)) for r, b in zip(sums, before)], "part int, before bigint"
    )
    along = Window.partitionBy("part").orderBy("key", "row").rowsBetween(Window.unboundedPreceding, 0)
    placed = ordered.withColumn("upto", F.sum("n").over(along)).join(F.broadcast(starts), "part")
    return placed.select("row", (F.col("before") + F.col("upto") - F.col("n")).alias("at")), int(before[-1])


def boundaries(total: int, length: int = LENGTH) -> np.ndarray:
    """Where the sequences after the last full one begin; they are powers of two long."""
    at, left = total - total % length, total % length
    cuts = [at]
    for bit in reversed(range(length.bit_length())):
        if left >> bit & 1:
            at += 1 << bit
            cuts.append(at)
    return np.array(cuts, np.int64)


def pack(docs: DataFrame, tokenizer: str, length: int = LENGTH) -> DataFrame:
    """Pieces of ``docs(doc_id, text)`` packed into sequences of ``length`` ids (a power of two).

    Per piece: doc_id, start, length, ids (bytes of little-endian 32-bit numbers),
    doc_tokens, sequence_id, offset.  A null or empty text is its end id alone.  Each
    row is packed, repeated ids and texts too, so ``doc_id`` may repeat or be null;
    ``row`` tells the rows apart.  An empty table gives no piece.
    """
    if length & (length - 1):
        raise ValueError("the length must be a power of two")
    made = tokenised(docs, tokenizer)
    at, total = places(made)
    tail = boundaries(total, length)

    def run(batches):
        for batch in batches:
            code = "<u2" if len(batch) and pc.binary_length(batch.column("ids"))[0].as_py() == 2 * batch.column("n")[0].as_py() else "<u4"
            out: list[list] = [[] for _ in range(8)]
            for row, doc, n, ids, at in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "n", "ids", "at"))):
                all_ids = np.frombuffer(ids, code).astype("<u4")
                start = 0
                while start < n:
                    here = at + start
                    if here < tail[0]:
                        sequence, offset = divmod(here, length)
                        room = length - offset
                    else:
                        k = int(np.searchsorted(tail, here, "right")) - 1
                        sequence, offset = int(tail[0]) // length + k, here - int(tail[k])
                        room = int(tail[k + 1]) - here
                    size = min(room, n - start)
                    piece = (row, doc, start, size, all_ids[start : start + size].tobytes(), n, sequence, offset)
                    for column, value in zip(out, piece):
                        column.append(value)
                    start += size
            kinds = [pa.int64()] * 4 + [pa.binary()] + [pa.int64()] * 3
            names = ["row", "doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=names)

    joined = made.select("row", "doc_id", "n", "ids").join(stage(at, "pack-places"), "row")
    return map_arrow(
        joined, run,
        "row bigint, doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint",
    )
