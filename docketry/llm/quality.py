"""Text quality by a factorisation machine.

Features of a text: its words, hashed into ``2**bits`` buckets and weighted by the
logarithm of their counts; statistics of its structure (kinds of characters, repetition,
lengths of words and lines), each cut into bins; and its length as metadata, binned
too.  A text's value is linear plus all pairwise interactions, where a pair's weight
is the product of two low-rank vectors:

    sum over i < j of <v_i, v_j> x_i x_j  =  1/2 sum over f of ((sum_i v_if x_i)^2 - sum_i (v_if x_i)^2)

so a text is scored in time linear in its features.

Fitting takes at most ``max_labelled`` labelled texts (their features, of fixed size) and
runs on the driver; scoring runs in one pass over the corpus and shuffles nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import (
    copy_weights, crc_mod, labelled_sample, logistic, map_arrow, stage, texts, word_buckets, words_of,
)

HELD_FOLDS, HELD_FOLD = 5, 0
THRESHOLD = 0.3


@dataclass(frozen=True)
class Settings:
    bits: int = 11
    rank: int = 4
    bins: int = 12
    max_labelled: int = 20_000
    epochs: int = 12
    batch: int = 128
    rate: float = 0.05
    ridge: float = 2e-5
    word_weight: float = 0.5
    seed: int = 5


@dataclass(frozen=True)
class Model:
    settings: Settings
    cuts: np.ndarray  # edges of the bins, one row for each statistic
    bias: float
    linear: np.ndarray
    factors: np.ndarray


STATISTICS = (
    "upper", "digit", "space", "line", "mark", "odd_mark", "bar", "wide", "chars", "words", "word_length", "long_word",
    "distinct", "next_same", "line_length", "distinct_lines", "bang",
)
_CLASS = np.zeros((256, 7), np.float64)
for _c in range(256):
    _CLASS[_c] = (
        65 <= _c < 91, 48 <= _c < 58, _c == 32, _c == 10, _c in b".,;:?'\"()-", _c in b"#$%&*+<=>@[]^_{}~\\/", _c in b"|",
    )


def statistics(text: str, words: list[bytes]) -> list[float]:
    """Structure and length of a text, in the order of ``STATISTICS``; zeros for an empty one."""
    if not text:
        return [0.0] * len(STATISTICS)
    raw = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    counts = np.bincount(raw, minlength=256)
    kinds = counts @ _CLASS / len(raw)
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1)
    lines = text.split("\n")
    same = sum(a is b or a == b for a, b in zip(words, words[1:]))
    return [
        *kinds, counts[128:].sum() / len(raw), np.log1p(len(text)), np.log1p(len(words)), float(lengths.mean()),
        float((lengths > 12).sum()) / n, len(set(words)) / n, same / n, np.log1p(len(text) / len(lines)),
        len(set(lines)) / len(lines), counts[33] / len(raw),
    ]


def _words_row(words: list[bytes], bits: int) -> np.ndarray:
    """Log counts by bucket, of length one."""
    row = np.log1p(np.bincount(word_buckets(bits).of(words), minlength=1 << bits)).astype(np.float32)
    size = float(np.sqrt(row @ row))
    return row / size if size else row


def _design(rows: np.ndarray, stats: np.ndarray, cuts: np.ndarray, s: Settings) -> np.ndarray:
    """Features: word buckets, then one of each statistic's bins."""
    out = np.zeros((len(rows), (1 << s.bits) + stats.shape[1] * s.bins), np.float32)
    out[:, : 1 << s.bits] = rows * s.word_weight
    for j in range(stats.shape[1]):
        bin_ = np.searchsorted(cuts[j], stats[:, j], "right")
        out[np.arange(len(rows)), (1 << s.bits) + j * s.bins + bin_] = 1 / np.sqrt(stats.shape[1])
    return out


def predict(x: np.ndarray, bias: float, linear: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """Values of feature rows by the sum-of-squares identity."""
    crossed = x @ factors
    return bias + x @ linear + 0.5 * (crossed**2 - (x**2) @ (factors**2)).sum(axis=1)


def _train(rows: np.ndarray, stats: np.ndarray, y: np.ndarray, w: np.ndarray, s: Settings) -> Model:
    """Logistic loss, Adam steps over shuffled batches, weights by ``w``."""
    shares = np.linspace(0, 1, s.bins + 1)[1:-1]
    cuts = np.quantile(stats, shares, axis=0).T if len(stats) else np.zeros((stats.shape[1], s.bins - 1))
    size = (1 << s.bits) + stats.shape[1] * s.bins
    rng = np.random.default_rng(s.seed)
    p = {"bias": np.zeros(1), "linear": np.zeros(size), "factors": rng.normal(0, 0.05, (size, s.rank))}
    if not 0 < y.sum() < len(y):
        # One kind of label, or none: nothing to tell apart.
        return Model(s, cuts, 0.0, p["linear"].astype(np.float32), np.zeros((size, s.rank), np.float32))
    first = {k: np.zeros_like(v) for k, v in p.items()}
    second = {k: np.zeros_like(v) for k, v in p.items()}
    w = w / w.mean()
    step = 0
    for epoch in range(s.epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(order), s.batch):
            chosen = order[at : at + s.batch]
            x = _design(rows[chosen], stats[chosen], cuts, s).astype(np.float64)
            crossed = x @ p["factors"]
            z = p["bias"] + x @ p["linear"] + 0.5 * (crossed**2 - (x**2) @ (p["factors"] ** 2)).sum(axis=1)
            g = (logistic(z) - y[chosen]) * w[chosen] / len(chosen)
            grads = {
                "bias": np.array([g.sum()]),
                "linear": x.T @ g + s.ridge * p["linear"],
                "factors": x.T @ (g[:, None] * crossed) - ((x**2).T @ g)[:, None] * p["factors"] + s.ridge * p["factors"],
            }
            step += 1
            rate = s.rate * (1 - epoch / s.epochs)
            for k, grad in grads.items():
                first[k] += 0.1 * (grad - first[k])
                second[k] += 0.001 * (grad**2 - second[k])
                p[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(s, cuts, float(p["bias"][0]), p["linear"].astype(np.float32), p["factors"].astype(np.float32))


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, quality)``.

    Learns from at most ``settings.max_labelled`` labelled documents outside the held-out
    fold; copies of a text share one vote.  Without labels of both kinds every
    text scores one half.
    """
    s = settings
    sample = stage(labelled_sample(labels, "quality", HELD_FOLDS, HELD_FOLD, s.max_labelled), "quality-sample")
    sample = copy_weights(docs, sample)

    def features(batches):
        for batch in batches:
            rows, stats = [], []
            for text in texts(batch):
                words = words_of(text)
                row = _words_row(words, s.bits)
                rows.append(row.astype(np.float16).tobytes())
                stats.append(statistics(text, words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("w"), pa.array(rows, pa.binary()), pa.array(stats, pa.list_(pa.float64()))],
                names=["y", "w", "words", "stats"],
            )

    read = docs.select("doc_id", "text").join(F.broadcast(stage(sample, "quality-weights")), "doc_id").select("text", "y", "w")
    made = stage(map_arrow(read, features, "y int, w double, words binary, stats array<double>"), "quality-features")
    got = made.toPandas()
    rows = np.frombuffer(b"".join(got["words"]), np.float16).reshape(len(got), 1 << s.bits)
    stats = np.array(got["stats"].tolist(), float).reshape(len(got), len(STATISTICS))
    return _train(rows, stats, got["y"].to_numpy(float), got["w"].to_numpy(float), s)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, score)`` for every row; null and empty texts are scored by their statistics alone."""
    s = model.settings

    def run(batches):
        for batch in batches:
            scores, rows, stats = [], [], []

            def flush():
                if rows:
                    x = _design(np.array(rows), np.array(stats), model.cuts, s)
                    scores.extend(logistic(predict(x, model.bias, model.linear, model.factors).astype(float)).tolist())
                    rows.clear()
                    stats.clear()

            for text in texts(batch):
                words = words_of(text)
                rows.append(_words_row(words, s.bits))
                stats.append(statistics(text, words))
                if len(rows) == 256:
                    flush()
            flush()
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"])

    return map_arrow(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, "doc_id bigint, score double")


def quality(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted.

    Empty tables give an empty result; a null id is in no fold and counts as not held out.
    """
    return score(docs, fit(docs, labels, settings)).select(
        "doc_id",
        F.coalesce(crc_mod(HELD_FOLDS) == HELD_FOLD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
