"""Substring dedup by sliding spans of sentences.

Runs of consecutive pieces of a text are hashed, and all runs of all documents are joined
by hash.  The first place of a run (smallest id, then place in the text) stays; the
pieces that any other place of it covers are removed.

Sentences end at ``.``, ``!`` or ``?`` before white space, at line ends, and at the full
stops of texts without spaces.  Every sentence is cut further into pieces by winnowing:
after each word that has the smallest hash of some ``WINDOW`` words of its sentence.  So
the cuts inside a passage, but for its first and last ``WINDOW - 1`` words, are the same in
whatever sentence it stands.  Words are compared in lower case; in scripts that have no
spaces between words each character is one.

A run reaches over as many pieces as give ``SPAN_WORDS`` words in ``SPAN`` sentences or more, or
``INSIDE_WORDS`` words of one sentence.  From each piece the shortest run that begins with it
and the shortest that ends with it are hashed, so each piece of a common row of pieces
that reaches the minimum is in a common run.  Two characters count as a word, and so
do 16 letters of a longer one.  Any common passage of ``4 * WINDOW - 3 + INSIDE_WORDS`` =
49 words holds such a run, wherever it begins; where it begins or ends inside a sentence of
its host, fewer than ``2 * WINDOW`` words at that end may stay.

Each task groups the runs of some rows, a chunk, by hash.  All but the first of a kind in the
chunk are repeats for certain; the first ones go, once and packed in arrays, to the shard
of their hash, where the first of all chunks is found.  So a run that stands in a third of
all documents is one entry a chunk and no large group, and nothing is broadcast.  Shards
and chunks grow in number, not in size.  Runs are the same if 96 bits of their hash are.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import CACHE_WORDS, TaskCache, map_arrow, stage

SPAN = 2
#: Words a run must have, in ``SPAN`` sentences or more and inside one; shorter ones repeat by chance.
SPAN_WORDS, INSIDE_WORDS = 12, 20
WINDOW = 8
#: Runs of a chunk, about (a text's runs stay together), and how many rows it spans at most.
CHUNK_RUNS, CHUNK_ROWS = 500_000, 1 << 16
#: Characters of all texts for each shard, about a million runs of spaced text.
SHARD_CHARS = 16_000_000
#: What a record holds: runs to compare, places that are repeats for certain, numbers of sentences.
ASKED, SURE, COUNTS = 0, 1, 2

#: Scripts without spaces between words: Thai to Tibetan, Burmese, Khmer, Chinese and Japanese.
_DENSE = r"฀-࿿က-႟ក-៿⺀-⿿、-ヿㇰ-ㇿ㐀-䶿一-鿿豈-﫿！-ﾟ\U00020000-\U0003ffff"
_TOKEN = re.compile(rf"[{_DENSE}]\s*|[^\s{_DENSE}]+\s*")
_IS_DENSE = re.compile(f"[{_DENSE}]")
_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)
_MASK = (1 << 64) - 1


class _Tokens(TaskCache):
    """Words with the white space after them to places in arrays of what is known of them."""

    def __init__(self):
        super().__init__()
        self._room(0)

    def _room(self, n: int) -> None:
        size = max(CACHE_WORDS, n)
        self.high, self.low = np.zeros(size, np.uint64), np.zeros(size, np.uint64)
        #: Half words, and whether a sentence ends here.
        self.weight, self.ends = np.zeros(size, np.int64), np.zeros(size, bool)

    def of(self, tokens: list[str]) -> np.ndarray:
        new = [t for t in set(tokens) if t not in self]
        if len(self) + len(new) > len(self.high):
            self.clear()
            new = list(set(tokens))
            self._room(len(new))
        if new:
            words = [t.rstrip() for t in new]
            first, last = len(self), len(self) + len(new)
            bits = b"".join([xxhash.xxh3_128_digest(w.lower().encode("utf-8", "replace")) for w in words])
            self.high[first:last], self.low[first:last] = np.frombuffer(bits, ">u8").reshape(-1, 2).T
            self.weight[first:last] = [1 if not w.isascii() and _IS_DENSE.match(w) else max(2, len(w) >> 3) for w in words]
            self.ends[first:last] = [
                w[-1] in "。！？" or (w != t and (w[-1] in ".!?" or "\n" in t)) for w, t in zip(words, new)
            ]
            self.update(zip(new, range(first, last)))
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


class _Powers:
    """Powers of ``base`` modulo 2**64, as many as were asked for."""

    def __init__(self, base: int):
        self.base, self.known = np.uint64(base), np.ones(1, np.uint64)

    def upto(self, n: int) -> np.ndarray:
        if len(self.known) < n:
            factors = np.full(max(n, 4096), self.base)
            factors[0] = 1
            self.known = np.multiply.accumulate(factors)
        return self.known[:n]


_TOKENS = _Tokens()
_UP, _DOWN = _Powers(_STEP), _Powers(_BACK)


def _cuts(h: np.ndarray, sentence: np.ndarray) -> np.ndarray:
    """Whether a word has the smallest hash (the last of equal ones) of some window inside its sentence."""
    cut = np.zeros(len(h), bool)
    n = len(h) - WINDOW + 1
    if n < 1:
        return cut
    least = h[:n].copy()
    for k in range(1, WINDOW):
        np.minimum(least, h[k : k + n], out=least)
    open_ = sentence[:n] == sentence[WINDOW - 1 :]
    for k in reversed(range(WINDOW)):
        hit = open_ & (h[k : k + n] == least)
        cut[k : k + n] |= hit
        open_ &= ~hit
    return cut


def _pieces(text: str):
    """Places of the words in ``_TOKENS``, first words of the pieces and the end, their sentences, all spans."""
    tokens = _TOKEN.findall(text)
    if not tokens:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), [(0, len(text))] if text else []
    at = _TOKENS.of(tokens)
    ends = _TOKENS.ends[at]
    ends[-1] = True
    sentence = np.cumsum(ends) - ends
    edges = np.concatenate([[0], np.flatnonzero(ends | _cuts(_TOKENS.high[at], sentence)) + 1])
    points = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))
    # White space before the first word belongs to its piece.
    stops = (points[edges[1:] - 1] + (len(text) - int(points[-1]))).tolist()
    return at, edges, sentence[edges[:-1]], list(zip([0, *stops], stops))


def sentences(text: str) -> list[tuple[int, int]]:
    """Spans of the pieces of sentences, white space after each included, so that together they are the text.

    White space before the first piece belongs to it.
    """
    return _pieces(text)[3]


def _runs(sizes: np.ndarray, sentence: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First pieces and ends of the shortest runs from and to each piece.

    ``sizes`` are the half words before each piece and in all.
    """
    n = len(sentence)
    short, inside = 2 * SPAN_WORDS, 2 * INSIDE_WORDS
    here = np.arange(n)
    after = np.searchsorted(sentence, sentence + (SPAN - 1)) + 1
    end = np.minimum(np.maximum(np.searchsorted(sizes, sizes[:-1] + short), after), np.searchsorted(sizes, sizes[:-1] + inside))
    before = np.searchsorted(sentence, sentence - (SPAN - 1), "right") - 1
    start = np.maximum(
        np.minimum(np.searchsorted(sizes, sizes[1:] - short, "right") - 1, before),
        np.searchsorted(sizes, sizes[1:] - inside, "right") - 1,
    )
    ahead, back = end <= n, start >= 0
    both = np.unique(np.concatenate([here[ahead] * (n + 1) + end[ahead], start[back] * (n + 1) + here[back] + 1]))
    return both // (n + 1), both % (n + 1)


def _text_runs(text: str):
    """Places of the words, first words of the pieces, spans of the pieces, number of sentences, first pieces and ends of the runs."""
    at, edges, sentence, spans = _pieces(text)
    if not len(at):
        none = np.zeros(0, np.int64)
        return at, edges, spans, len(spans), none, none
    starts, ends = _runs(np.concatenate([[0], np.cumsum(_TOKENS.weight[at])])[edges], sentence)
    return at, edges, spans, int(sentence[-1]) + 1, starts, ends


def run_hashes(text: str):
    """Spans of the pieces, number of sentences, first pieces and ends of the runs, and 128 bits for each run as two rows."""
    at, edges, spans, n, starts, ends = _text_runs(text)
    if not len(at):
        return spans, n, starts, ends, starts, starts
    rows = []
    for part in (_TOKENS.high[at], _TOKENS.low[at]):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(part * _UP.upto(len(at)))])[edges]
        # The power of the first word's place is taken out, so the same words give the same sum anywhere.
        rolled = (sums[ends] - sums[starts]) * _DOWN.upto(len(at))[edges[starts]]
        rolled = (rolled ^ (rolled >> np.uint64(32))) * np.uint64(_STEP)
        rows.append((rolled ^ (rolled >> np.uint64(29))).view(np.int64))
    return spans, n, starts, ends, *rows


def _pack(values: np.ndarray) -> bytes:
    """Numbers that are not negative, in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max(initial=0)))).tobytes()


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, f"u{len(raw) // n}").astype(np.uint64) if n else np.zeros(0, np.uint64)


_RECORD = pa.schema([
    ("shard", pa.int64()), ("base", pa.int64()), ("kind", pa.int32()), ("least", pa.int64()),
    ("high", pa.binary()), ("low", pa.binary()), ("id", pa.binary()), ("off", pa.binary()), ("at", pa.binary()),
])
_RECORD_SQL = "shard bigint, base bigint, kind int, least bigint, high binary, low binary, id binary, off binary, at binary"
_ANSWER = pa.schema([("base", pa.int64()), ("kind", pa.int32()), ("off", pa.binary()), ("at", pa.binary())])
_ANSWER_SQL = "base bigint, kind int, off binary, at binary"
_AGAIN = pa.schema([("row", pa.int64()), ("n_sentences", pa.int64()), ("again", pa.list_(pa.int32()))])
_AGAIN_SQL = "row bigint, n_sentences bigint, again array<int>"


class _Chunk:
    """Runs of neighbouring rows until they go out as records."""

    def __init__(self, base: int):
        self.base, self.runs = base, 0
        self.rows: list[tuple[int, int, int]] = []  # place after base, id, runs
        self.counts: list[int] = []
        self.high: list[np.ndarray] = []
        self.low: list[np.ndarray] = []

    def add(self, row: int, id_: int, text: str) -> None:
        _, n, _, _, high, low = run_hashes(text)
        self.rows.append((row - self.base, id_, len(high)))
        self.counts.append(n)
        self.high.append(high.view(np.uint64))
        self.low.append((low.view(np.uint64) >> np.uint64(32)).astype(np.uint32))
        self.runs += len(high)

    def records(self, shards: int) -> pa.RecordBatch:
        off, ids, sizes = np.array(self.rows, np.int64).T
        high, low = np.concatenate(self.high), np.concatenate(self.low)
        at = np.arange(len(high)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        home = self.base % shards
        out = [(home, COUNTS, 0, b"", b"", b"", off.astype(np.uint16).tobytes(), _pack(np.array(self.counts)))]
        off, ids = np.repeat(off, sizes).astype(np.uint16), np.repeat(ids, sizes)
        # Stable, so equal ids stay in the order of rows and runs.
        order = np.lexsort((ids, low, high))
        first = np.ones(len(order), bool)
        first[1:] = (high[order[1:]] != high[order[:-1]]) | (low[order[1:]] != low[order[:-1]])
        if not first.all():
            sure = order[~first]
            out.append((home, SURE, 0, b"", b"", b"", off[sure].tobytes(), _pack(at[sure])))
        asked = order[first]
        shard = ((high[asked] >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)
        edges = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])) if len(asked) else []
        for a, b in zip(edges, [*edges[1:], len(asked)]):
            one = asked[a:b]
            least = int(ids[one].min())
            apart = ids[one].view(np.uint64) - np.uint64(least & _MASK)
            out.append((int(shard[a]), ASKED, least, high[one].tobytes(), low[one].tobytes(), _pack(apart),
                        off[one].tobytes(), _pack(at[one])))
        home, *columns = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(values, field.type) for values, field in zip([home, [self.base] * len(out), *columns], _RECORD)],
            schema=_RECORD,
        )


def _numbered(docs: DataFrame) -> DataFrame:
    """A written table of ``docs(doc_id, text)`` with the number of each row."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return stage(rows, "spans-rows", "zstd")


def _records(rows: DataFrame, shards: int, chunk_runs: int) -> DataFrame:
    """Runs of all rows as packed records, each for one shard and one chunk."""
    last = (1 << 63) - 1

    def run(batches):
        chunk = None
        for batch in batches:
            for row, id_, text in zip(*(batch.column(c) for c in ("row", "doc_id", "text"))):
                row, id_ = row.as_py(), id_.as_py()
                if chunk is not None and not (chunk.runs < chunk_runs and 0 <= row - chunk.base < CHUNK_ROWS):
                    yield chunk.records(shards)
                    chunk = None
                if chunk is None:
                    chunk = _Chunk(row)
                chunk.add(row, last if id_ is None else id_, text.as_py() or "")
        if chunk is not None:
            yield chunk.records(shards)

    return map_arrow(rows, run, _RECORD_SQL)


def _answer(records: pa.Table) -> pa.Table:
    """Places of one shard that are not the first of their kind; the other records go through."""
    known = records.filter(pc.not_equal(records["kind"], ASKED)).select(_ANSWER.names)
    asked = records.filter(pc.equal(records["kind"], ASKED)).to_pylist()
    if not asked:
        return known.cast(_ANSWER)
    high = np.frombuffer(b"".join(r["high"] for r in asked), np.uint64)
    sizes = [len(r["high"]) // 8 for r in asked]
    order = np.argsort(high, kind="stable")
    alike = high[order[1:]] == high[order[:-1]]
    # Only runs whose hash has company are looked at further.
    met = order[np.concatenate([[False], alike]) | np.concatenate([alike, [False]])]
    low = np.frombuffer(b"".join(r["low"] for r in asked), np.uint32)[met]
    off = np.frombuffer(b"".join(r["off"] for r in asked), np.uint16)[met]
    at = np.concatenate([_unpack(r["at"], n) for r, n in zip(asked, sizes)])[met].astype(np.int64)
    ids = np.concatenate([
        (_unpack(r["id"], n) + np.uint64(r["least"] & _MASK)).view(np.int64) for r, n in zip(asked, sizes)
    ])[met]
    record = np.repeat(np.arange(len(asked)), sizes)[met]
    row = np.array([r["base"] for r in asked], np.int64)[record] + off
    sorted_ = np.lexsort((at, row, ids, low, high[met]))
    kind = high[met][sorted_], low[sorted_]
    again = np.zeros(len(met), bool)
    again[sorted_[1:]] = (kind[0][1:] == kind[0][:-1]) & (kind[1][1:] == kind[1][:-1])
    of = np.flatnonzero(again)[np.argsort(record[again], kind="stable")]
    edges = np.searchsorted(record[of], np.arange(len(asked) + 1))
    found = [
        {"base": asked[k]["base"], "kind": SURE, "off": off[of[a:b]].tobytes(), "at": _pack(at[of[a:b]])}
        for k, (a, b) in enumerate(zip(edges, edges[1:])) if a < b
    ]
    return pa.concat_tables([known.cast(_ANSWER), pa.Table.from_pylist(found, _ANSWER)])


def _by_row(answers: pa.Table) -> pa.Table:
    """Rows of one chunk: numbers of sentences, and the numbers of repeated runs as first and last of each stretch."""
    base, found, counts = answers["base"][0].as_py(), [], {}
    for kind, off, at in zip(*(answers[c].to_pylist() for c in ("kind", "off", "at"))):
        off = np.frombuffer(off, np.uint16).astype(np.int64)
        at = _unpack(at, len(off)).astype(np.int64)
        if kind == COUNTS:
            counts = dict(zip(off.tolist(), at.tolist()))
        else:
            found.append(off << 40 | at)
    places = np.sort(np.concatenate([np.zeros(0, np.int64), *found]))
    cut = np.flatnonzero(np.diff(places) != 1)
    firsts = places[np.concatenate([[0], cut + 1]).astype(np.int64)] if len(places) else places
    lasts = places[np.concatenate([cut, [len(places) - 1]]).astype(np.int64)] if len(places) else places
    low = (1 << 40) - 1
    again: dict[int, list[int]] = {}
    for a, b in zip(firsts.tolist(), lasts.tolist()):
        again.setdefault(a >> 40, []).extend((a & low, b & low))
    return pa.Table.from_pydict(
        {"row": [base + o for o in counts], "n_sentences": list(counts.values()), "again": [again.get(o) for o in counts]},
        _AGAIN,
    )


def repeated(rows: DataFrame, chunk_runs: int = CHUNK_RUNS, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """``(row, n_sentences, again)`` for each of ``rows(row, doc_id, text)``.

    ``again`` are the runs that are not the first of their kind, as first and last number of each
    stretch of them; null where there are none.  Null ids are the highest.
    """
    chars = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    shards = 1 + chars // shard_chars
    answers = _records(rows, shards, chunk_runs).groupBy("shard").applyInArrow(_answer, _ANSWER_SQL)
    return stage(answers.groupBy("base").applyInArrow(_by_row, _AGAIN_SQL), "spans-again")


def _covered(again: list[int], text: str) -> list[tuple[int, int]]:
    """Joined text spans of the pieces that the runs of these stretches of numbers cover."""
    _, _, spans, _, starts, ends = _text_runs(text)
    out: list[tuple[int, int]] = []
    for first, last in zip(again[::2], again[1::2]):
        for r in range(first, last + 1):
            a, b = spans[starts[r]][0], spans[ends[r] - 1][1]
            if out and a <= out[-1][1]:
                out[-1] = (out[-1][0], max(b, out[-1][1]))
            else:
                out.append((a, b))
    return out


def drop_repeated_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, text, n_sentences, removed.

    ``text`` is the text without repeated pieces of sentences and ``removed`` their spans in the old
    text (code points, end exclusive).  A run repeated inside one text counts, too.  Null
    texts stay null; texts without a run stay as they are.  Of rows that repeat an id and
    a text, the first keeps its pieces.
    """
    rows = _numbered(docs.select("doc_id", "text"))
    again = repeated(rows)

    def run(batches):
        for batch in batches:
            made, removed = [], []
            for value, runs in zip(batch.column("text"), batch.column("again").to_pylist()):
                text = value.as_py()
                gone = _covered(runs, text) if runs else []
                if gone:
                    at, parts = 0, []
                    for a, b in gone:
                        parts.append(text[at:a])
                        at = b
                    text = "".join([*parts, text[at:]])
                made.append(text)
                removed.append([{"start": a, "end": b} for a, b in gone])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(made, pa.string()), batch.column("n_sentences"), pa.array(removed, kind)],
                names=["doc_id", "text", "n_sentences", "removed"],
            )

    schema = "doc_id bigint, text string, n_sentences bigint, removed array<struct<start: bigint, end: bigint>>"
    return map_arrow(rows.join(again, "row").select("doc_id", "text", "n_sentences", "again"), run, schema)
