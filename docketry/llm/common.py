"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import weakref
import zlib
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.plans.sizes import is_small
from docketry.plans.tables import read_back
from docketry.session import new_work_dir, ship_package

#: Bytes of a batch that goes to a Python worker, about.
BATCH_BYTES = 16 * 1024 * 1024
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Words a task remembers; the memory is emptied when it is full, and after the task.
CACHE_WORDS = 250_000
#: Rows from which a key is a hub, whose rows ``join_counted`` does not gather.
HUB_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stage(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """``df`` written below the shared folder and read back: later steps start there."""
    folder = new_work_dir(df.sparkSession, name)
    df.write.parquet(folder, compression=codec)
    return read_back(df, folder)


def join_counted(big: DataFrame, keyed: DataFrame, on: str, count: str) -> DataFrame:
    """Inner join with ``keyed``, one written row for each key with the ``count`` of its rows in ``big``.

    A short ``keyed`` is broadcast.  Of a long one only the hubs are, of which there are at most
    the rows of ``big`` over ``HUB_ROWS``; so the rows of one key never meet in one task.
    """
    if is_small(keyed):
        return big.join(F.broadcast(keyed), on)
    hubs = F.broadcast(keyed.where(F.col(count) > HUB_ROWS))
    calm = big.join(hubs.select(on), on, "left_anti").join(keyed.where(F.col(count) <= HUB_ROWS), on)
    return big.join(hubs, on).unionByName(calm)


class TaskCache(dict):
    """What a task remembers.  Workers live on after a task, its memory does not."""

    live: list[weakref.ref] = []

    def __init__(self):
        super().__init__()
        TaskCache.live.append(weakref.ref(self))

    @classmethod
    def clear_all(cls) -> None:
        cls.live = [ref for ref in cls.live if ref() is not None]
        for ref in cls.live:
            if (cache := ref()) is not None:
                cache.clear()


def _give_back() -> None:
    """Hand the memory a task no longer uses back to the system; its worker lives on."""
    TaskCache.clear_all()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def map_arrow(df: DataFrame, fn, schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` with this package shipped to the workers, whose caches last for a task.

    Texts are long, so batches are bounded by bytes: to ``BATCH_BYTES``, unless the session
    already asks for less.
    """
    def run(batches):
        try:
            yield from fn(batches)
        finally:
            _give_back()

    spark = df.sparkSession
    ship_package(spark)
    now = spark.conf.get(_BATCH_SETTING).lower().removesuffix("b")
    if not now.isdigit() or int(now) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, BATCH_BYTES)
    return df.mapInArrow(run, schema)


def crc_mod(n: int, column: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``n``: the fold a row belongs to."""
    return F.pmod(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(n))


def labelled_sample(labels: DataFrame, label: str, folds: int, held: int, bound: int) -> DataFrame:
    """``(doc_id, y)`` of at most ``bound`` labelled documents outside the held-out fold.

    Documents are taken by the hash of their id, so the sample is the same in every
    run.  Rows without id or label are left out; of repeated ids the highest label
    counts.  The bound is what lets callers broadcast the sample.
    """
    rows = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(crc_mod(folds) != held)
        .groupBy("doc_id")
        .agg(F.max(F.col(label).cast("int")).alias("y"))
    )
    n = rows.count()
    if n > bound:
        span = 1 << 30
        share = F.pmod(F.xxhash64("doc_id"), F.lit(span)) < int(span * bound / n)
        rows = rows.where(share).limit(bound)
    return rows


class WordBuckets(TaskCache):
    """Words to hash buckets, remembered up to a bound."""

    def __init__(self, bits: int):
        super().__init__()
        self.mask = (1 << bits) - 1

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        bucket = self[word] = zlib.crc32(word) & self.mask
        return bucket

    def of(self, words: Collection[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


_BUCKETS: dict[int, WordBuckets] = {}


def word_buckets(bits: int) -> WordBuckets:
    """This worker's buckets of so many bits."""
    return _BUCKETS.setdefault(bits, WordBuckets(bits))


#: ASCII letters to lower case; all other ASCII but digits to spaces.
_PLAIN = bytes(
    c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256)
)


def words_of(text: str) -> list[bytes]:
    """Words as UTF-8: runs of ASCII letters (in lower case), digits and any other characters."""
    return text.encode("utf-8", "replace").translate(_PLAIN).split()


def word_spans(text: str) -> np.ndarray:
    """Code point spans of ``words_of``, one row each."""
    raw = text.encode("utf-8", "replace")
    letters = np.frombuffer(raw.translate(_PLAIN), np.uint8) != 32
    edges = np.flatnonzero(np.diff(np.concatenate([[0], letters.astype(np.int8), [0]])))
    points = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
    return points[edges.reshape(-1, 2)]


def texts(batch: pa.RecordBatch, column: str = "text") -> Iterator[str]:
    """Texts of a batch, null as empty; one Python string at a time."""
    for value in batch.column(batch.schema.get_field_index(column)):
        yield value.as_py() or ""


def copy_weights(docs: DataFrame, sample: DataFrame, bits: int = 18) -> DataFrame:
    """``sample`` with a weight ``w``: one over the number of its documents alike.

    Copies of one text would teach a model that text's ordinary words.  Documents
    count as alike if the smallest hash of their runs of three words is the same, which
    near copies share as often as their sets of runs overlap; of two such keys the
    larger group counts.
    """
    n_keys = 2

    def keys(batches):
        words = word_buckets(bits)
        for batch in batches:
            out = []
            for text in texts(batch):
                ids = words.of(words_of(text)).astype(np.uint64)
                k = min(3, len(ids))
                runs = np.zeros(len(ids) - k + 1, np.uint64)
                for i in range(k):
                    runs = (runs ^ (runs >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + ids[i : len(ids) - k + 1 + i]
                mixed = [(runs * np.uint64(m)) >> np.uint64(1) for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]
                out.append([int(m.min()) if k else -1 for m in mixed])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(out, pa.list_(pa.int64()))], names=["doc_id", "y", "keys"]
            )

    read = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    kind = dict(docs.dtypes)["doc_id"]
    keyed = stage(map_arrow(read, keys, f"doc_id {kind}, y int, keys array<bigint>"), "copy-keys")
    for k in range(n_keys):
        key = F.element_at("keys", k + 1)
        sizes = keyed.groupBy(key.alias("_k")).agg(F.count(F.lit(1)).alias(f"n{k}"))
        keyed = keyed.withColumn("_k", key).join(sizes, "_k").drop("_k")
    return (
        keyed.withColumn("w", 1 / F.greatest(*(f"n{k}" for k in range(n_keys))))
        .groupBy("doc_id").agg(F.max("y").alias("y"), F.max("w").alias("w"))
    )


def fit_logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1e-2, steps: int = 60) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps; the last one is the bias.

    ``w`` are the weights of the rows.
    """
    x, rows = np.hstack([x, np.ones((len(x), 1))]), w
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (rows * (p - y)) + ridge * w
        hess = (x * (rows * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        move = np.linalg.solve(hess, grad)
        size = float(np.abs(move).max())
        w -= move * min(1.0, 5 / size if size else 1.0)
        if size < 1e-8:
            break
    return w


def logistic(z):
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))
