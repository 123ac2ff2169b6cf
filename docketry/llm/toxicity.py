"""Toxic passages as maximum-scoring segments of token log-odds.

Fit
    Tokens (words, hashed into ``2**bits`` buckets) get log-odds of the toxic against
    the clean labelled texts.  Both sides have Dirichlet priors: a bucket's prior is
    its share in *all* documents, and the log-odds of the word's beginnings (hashed
    too), short ones first, shift the toxic prior, so unseen forms of a known stem count.
    A fixed drift is taken off each token, which makes ordinary text score below
    zero on average, as segment statistics need.
Scan
    One linear pass finds all maximal segments: no shorter or longer neighbour of
    such a segment scores more.  Runs of negative tokens are summed first, so the
    pass visits only tokens above zero.
Calibration
    The largest segment of a clean text of n words follows an extreme-value law with
    decay ``lam`` (the root of E[exp(lam * score)] = 1 over the clean tokens) and
    place ``ln(K n)/lam``; ``K`` comes from the clean labelled texts.  It gives each
    segment the number of segments as good that chance would bring to the text.  A
    logistic curve over the text's calibrated evidence gives its probability.

Passes over the corpus: one for counts over all documents, one over the labelled
sample, one that scores.  The model is three arrays of fixed size.  No text is
shuffled.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import (
    CACHE_WORDS, TaskCache, copy_weights, crc_mod, fit_logistic, labelled_sample, logistic, map_arrow, stage, texts,
    word_buckets, word_spans, words_of,
)

HELD_FOLDS, HELD_FOLD = 4, 2
THRESHOLD = 0.3
#: Words that are counted in a task before their counts go to its arrays.
FLUSH_WORDS = 1_000_000
#: The evidence of no segment.
NOTHING = -6.0


@dataclass(frozen=True)
class Settings:
    bits: int = 18
    stem_bits: int = 18
    stem_chars: tuple[int, ...] = (4, 6)
    floor: float = 3.0  # prior counts of a token at least
    strength: float = 2_000.0  # prior counts shared out as the corpus has the tokens
    stem_weight: float = 0.8
    low: float = -2.0
    high: float = 6.0
    z: float = 2.5
    drift: float = 0.05
    max_labelled: int = 60_000
    calibrate: int = 3  # one labelled document in so many is kept for calibration
    e_value: float = 0.05


@dataclass(frozen=True)
class Model:
    settings: Settings
    tox: np.ndarray
    clean: np.ndarray
    alpha: np.ndarray
    stem_tox: np.ndarray
    stem_clean: np.ndarray
    stem_alpha: np.ndarray
    share: float
    lam: float = 1.0
    log_k: float = 0.0
    weights: tuple[float, ...] = (0.0, 0.0, 0.0, -4.0)


class _Scores(TaskCache):
    """Words to scores, worked out from the model's counts and remembered up to a bound."""

    def __init__(self, model: Model):
        super().__init__()
        self.m = model
        self.mask = (1 << model.settings.bits) - 1
        self.stem_mask = (1 << model.settings.stem_bits) - 1

    def learn(self, words: set[bytes]) -> None:
        """Work out the scores of ``words``, all at once."""
        m, s, new = self.m, self.m.settings, list(words)
        lift = np.ones(len(new))
        for n in s.stem_chars:
            longer = np.array([len(w) > n for w in new], bool)
            b = np.fromiter((zlib.crc32(w[:n]) & self.stem_mask for w in new), np.int64, len(new))
            odds = _odds(m.stem_tox[b], m.stem_clean[b], m.stem_alpha[b], lift, m.share, s)
            lift = np.where(longer, np.exp(s.stem_weight * odds), lift)
        w = np.fromiter((zlib.crc32(x) & self.mask for x in new), np.int64, len(new))
        self.update(zip(new, (_odds(m.tox[w], m.clean[w], m.alpha[w], lift, m.share, s) - s.drift).tolist()))

    def of(self, texts: Iterable[str]) -> Iterator[np.ndarray]:
        """The scores of each text's words; some texts at a time are looked up together."""
        held: list[list[bytes]] = []
        size = 0
        for text in texts:
            held.append(words_of(text))
            size += len(held[-1])
            if size > 50_000:
                yield from self._scores(held)
                held, size = [], 0
        yield from self._scores(held)

    def _scores(self, held: list[list[bytes]]) -> Iterator[np.ndarray]:
        new = {w for words in held for w in words if w not in self}
        if len(self) + len(new) > CACHE_WORDS:
            self.clear()
            new = {w for words in held for w in words}
        self.learn(new)
        for words in held:
            yield np.fromiter(map(self.__getitem__, words), np.float64, len(words))


def _odds(tox, clean, alpha, lift, share, s: Settings):
    """Log-odds of a token after its Dirichlet priors; ``lift`` shifts the toxic one.

    Each side's prior counts are in proportion to its size, so that a token never
    seen has log-odds of zero.  Positive log-odds count only where they are ``z``
    standard deviations away from zero.
    """
    a, b = alpha * share * lift, alpha * (1 - share)
    odds = np.log((tox + a) * b / ((clean + b) * alpha * share))
    sure = odds >= s.z * np.sqrt(1 / (tox + a) + 1 / (clean + b))
    return np.clip(np.where(sure, odds, np.minimum(odds, 0)), s.low, s.high)


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(start, end, score)``, end exclusive, in order."""
    at = np.flatnonzero(scores > 0)
    if not len(at):
        return []
    total = np.concatenate([[0.0], np.cumsum(scores)])
    # Each entry: start, end, sum before it, sum at its end.
    open_: list[tuple[int, int, float, float]] = []
    # For each entry, the entry before it with a smaller left sum, or -1.
    lower: list[int] = []
    for i in at.tolist():
        start, left, right, end = i, float(total[i]), float(total[i + 1]), i + 1
        j = len(open_) - 1
        while True:
            while j >= 0 and open_[j][2] >= left:
                j = lower[j]
            if j < 0 or open_[j][3] >= right:
                break
            start, left = open_[j][0], open_[j][2]
            del open_[j:], lower[j:]
            j -= 1
        open_.append((start, end, left, right))
        lower.append(j)
    return [(s, e, r - b) for s, e, b, r in open_]


def _evidence(found: np.ndarray, n: int, lam: float, log_k: float) -> list[float]:
    """Calibrated evidence of a text of ``n`` words from the scores of all its segments.

    Of the best segment, of the best ones together (as many as make it strongest),
    and of all of them against the length.
    """
    if not len(found):
        return [NOTHING, NOTHING, 0.0]
    room = log_k + math.log(max(n, 1))
    totals = lam * np.cumsum(np.sort(found)[::-1])
    # Sum statistics: r segments in falling order are 1/r! as likely as in any order.
    r = np.arange(1, len(found) + 1)
    strongest = float(np.max(totals - r * room + np.cumsum(np.log(r))))
    return [max(float(totals[0]) - room, NOTHING), min(max(strongest, NOTHING), 40.0), float(totals[-1]) / math.sqrt(max(n, 1))]


def _counts(docs: DataFrame, sample: DataFrame, s: Settings) -> np.ndarray:
    """Token counts by bucket, words then stems: toxic texts, clean labelled texts, all documents."""
    size = (1 << s.bits) + (1 << s.stem_bits)

    def count(batches):
        sums = np.zeros((3, size))
        words, stems = word_buckets(s.bits), word_buckets(s.stem_bits)
        seen: dict[tuple[int, float], Counter] = defaultdict(Counter)

        def flush():
            for (side, w), counted in seen.items():
                row = sums[side]
                n = np.fromiter(counted.values(), np.float64, len(counted)) * w
                np.add.at(row, words.of(counted), n)
                for cut in s.stem_chars:
                    longer = [(word[:cut], k * w) for word, k in counted.items() if len(word) > cut]
                    np.add.at(row, stems.of([stem for stem, _ in longer]) + (1 << s.bits), [k for _, k in longer])
            seen.clear()

        held = 0
        for batch in batches:
            for text, y, w in zip(texts(batch), batch.column("y").to_pylist(), batch.column("w").to_pylist()):
                found = words_of(text)
                seen[(2, 1.0) if y is None else (1 - y, w)].update(found)
                held += len(found)
                if held > FLUSH_WORDS:
                    flush()
                    held = 0
        flush()
        sums[2] += sums[0] + sums[1]
        at = np.flatnonzero(sums[2])
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), *(pa.array(row[at]) for row in sums)], names=["b", "tox", "clean", "n"]
        )

    read = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id", "left").select("text", "y", "w")
    made = map_arrow(read, count, "b bigint, tox double, clean double, n double")
    # At most `size` rows, whatever the input.  As Arrow, since a Python object for each row would take many times the memory.
    rows = made.groupBy("b").agg(F.sum("tox").alias("tox"), F.sum("clean").alias("clean"), F.sum("n").alias("n")).toArrow()
    sums = np.zeros((3, size))
    at = rows.column("b").to_numpy()
    for row, name in zip(sums, ("tox", "clean", "n")):
        row[at] = rows.column(name).to_numpy()
    return sums


def _decay(scores: np.ndarray, clean: np.ndarray) -> float:
    """The positive root of sum p exp(lam s) = 1 over the clean tokens' scores."""
    p = clean / max(clean.sum(), 1)
    keep = (p > 0) & ~np.isnan(scores)
    p, x = p[keep], scores[keep]
    if not len(x) or x.max() <= 0 or float(p @ x) >= 0:
        return 1.0
    low, high = 1e-3, 1e-3
    while float(p @ np.exp(np.minimum(high * x, 60))) < 1 and high < 64:
        high *= 2
    for _ in range(60):
        mid = (low + high) / 2
        if float(p @ np.exp(np.minimum(mid * x, 60))) < 1:
            low = mid
        else:
            high = mid
    return high


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``.

    At most ``settings.max_labelled`` labelled documents are learnt from; a part of
    them gives no token counts and calibrates instead.  Prior counts cover all
    documents.  Without labels of both kinds every text gets the same low score.
    """
    s = settings
    sample = labelled_sample(labels, "toxic", HELD_FOLDS, HELD_FOLD, s.max_labelled)
    sample = stage(copy_weights(docs, stage(sample, "toxic-sample")), "toxic-weights")
    for_curve = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(s.calibrate)) == 0
    sums = _counts(docs, sample.where(~for_curve), s)
    tox, clean, everything = sums[:, : 1 << s.bits]
    both = tox.sum() + clean.sum()
    share = float(np.clip(tox.sum() / both, 1e-3, 1 - 1e-3)) if both else 0.5

    def alpha(counts):
        return s.floor + s.strength * counts / max(counts.sum(), 1)

    st, sc, se = sums[:, 1 << s.bits :]
    arrays = (tox, clean, alpha(everything), st, sc, alpha(se))
    model = Model(s, *(x.astype(np.float32) for x in arrays), share)
    lam = _decay(_odds(tox, clean, alpha(everything), 1.0, share, s) - s.drift, clean)

    def measure(batches):
        scores = _Scores(model)
        for batch in batches:
            out = []
            for values in scores.of(texts(batch)):
                out.append((len(values), [x[2] for x in segments(values)]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("w"), pa.array([n for n, _ in out], pa.int64()),
                 pa.array([f for _, f in out], pa.list_(pa.float64()))], names=["y", "w", "n", "found"]
            )

    read = docs.select("doc_id", "text").join(F.broadcast(sample.where(for_curve)), "doc_id").select("text", "y", "w")
    measured = stage(map_arrow(read, measure, "y int, w double, n bigint, found array<double>"), "toxic-segments")
    # Of at most `max_labelled` documents; all segments of a text stay in the table.
    rows = measured.select("y", "n", F.coalesce(F.array_max("found"), F.lit(0.0)).alias("top")).toArrow()
    y, n, top = (rows.column(c).to_numpy().astype(float) for c in ("y", "n", "top"))
    n = np.maximum(n, 1)
    quiet = (y == 0) & (top > 0)
    # Middle of the extreme-value law: (ln(K n) - ln ln 2) / lam.  A few clean labels are wrong; the median bears them.
    log_k = float(np.median(lam * top[quiet] - np.log(n[quiet])) + math.log(math.log(2))) if quiet.any() else 0.0
    model = replace(model, lam=lam, log_k=log_k)
    if not 0 < y.sum() < len(y):
        return model

    def weigh(batches):
        for batch in batches:
            x = [_evidence(f.values.to_numpy(), k.as_py(), lam, log_k) for f, k in zip(batch.column("found"), batch.column("n"))]
            yield pa.RecordBatch.from_arrays([batch.column("y"), batch.column("w"), pa.array(x, pa.list_(pa.float64()))], names=["y", "w", "x"])

    rows = map_arrow(measured, weigh, "y int, w double, x array<double>").toArrow()
    x = pc.list_flatten(rows.column("x")).to_numpy().reshape(len(rows), -1)
    y, w = (rows.column(c).to_numpy().astype(float) for c in ("y", "w"))
    return replace(model, weights=tuple(fit_logistic(x, y, w)))


def _judge(values: np.ndarray, m: Model) -> tuple[float, list[tuple[int, int, float]]]:
    """Probability and segments of a text from its words' scores."""
    found = segments(values)
    seen = _evidence(np.array([x[2] for x in found]), len(values), m.lam, m.log_k)
    return float(logistic(np.dot(m.weights[:-1], seen) + m.weights[-1])), found


def score(docs: DataFrame, model: Model, passages: bool = False) -> DataFrame:
    """``(doc_id, score)`` and, if asked for, every significant passage of a text.

    A passage is ``(start, end, score, e_value)``: code points of the text, end
    exclusive, and how many such passages chance brings to a clean text of this
    length, at most ``settings.e_value``.  Null and empty texts have no passage and
    the score of no evidence.  Each row gets its own result, repeated ids too.
    """
    def run(batches):
        known = _Scores(model)
        for batch in batches:
            scores, kept = [], []
            for text, values in zip(texts(batch), known.of(texts(batch))):
                p, found = _judge(values, model)
                scores.append(p)
                if passages:
                    n = len(values)
                    good = [(a, b, v, n * math.exp(min(model.log_k - model.lam * v, 50))) for a, b, v in found]
                    good = [g for g in good if g[3] <= model.settings.e_value]
                    at = word_spans(text) if good else []
                    kept.append([
                        {"start": int(at[a][0]), "end": int(at[b - 1][1]), "score": v, "e_value": e} for a, b, v, e in good
                    ])
            columns = [batch.column("doc_id"), pa.array(scores, pa.float64())]
            names = ["doc_id", "score"]
            if passages:
                kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())]))
                columns.append(pa.array(kept, kind))
                names.append("passages")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id bigint, score double" + (
        ", passages array<struct<start: bigint, end: bigint, score: double, e_value: double>>" if passages else ""
    )
    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, schema)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs``, all columns, without the rows that score ``threshold`` or more."""
    def run(batches):
        known = _Scores(model)
        for batch in batches:
            yield batch.filter(pa.array([_judge(v, model)[0] < threshold for v in known.of(texts(batch))], pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def toxicity(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Empty tables give an empty result; a null id is in no fold and counts as not held out.
    """
    scored = score(docs, fit(docs, labels, settings))
    return scored.select(
        "doc_id",
        F.coalesce(crc_mod(HELD_FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
