"""MinHash near-duplicates by a multi-index Hamming join.

Signature
    A document's set of word shingles gives ``CHUNKS * WIDTH`` MinHash symbols of 16
    bits.  Two signatures are compared by the number of symbols that differ.
Join
    Signatures are cut into ``CHUNKS`` chunks.  By the pigeonhole principle a pair
    that differs in at most ``2 * CHUNKS - 1`` symbols has a chunk with at most one
    difference.  That one error is enumerated: each chunk is indexed ``WIDTH`` times,
    each time with one symbol left out, so such a pair shares a key and is found
    without fail.  (With 10 chunks of 5, a pair of similarity 0.8 shares no key
    with probability 1.6e-6, one of 0.85 with 3e-8.)
Links
    Sharing a key only makes candidates.  Links are confirmed on the full sets.
No pairs inside a group
    Equal sets collapse to one node first.  In a bucket, members are first checked
    against its smallest member only.  What that connects needs no more checks; only
    members of a bucket that are still in different components are then compared
    with each other.  Before that, shingles of all such members are counted once: a set can
    have links only within the shingles it shares, which rules out most members alone
    and most pairs unseen.  That filter and the one on sizes are exact; those on the
    signature and on a longer one of single bits pass a similarity of 0.8 but for a chance
    of 1e-8.  A group of n linked copies costs n checks, and nothing is capped.  Members whose
    similarity is just below the limit are compared pair by pair, a large bucket's in several tasks.

The work tables lie below the shared folder.  Texts are moved only for candidates.
"""

from __future__ import annotations

from collections import OrderedDict
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docketry.llm.common import CACHE_WORDS, TaskCache, join_counted, map_arrow, stage
from docketry.llm.components import components
from docketry.plans.sizes import semi_or_anti

CHUNKS, WIDTH = 10, 5
SYMBOLS = CHUNKS * WIDTH
#: Bits of each symbol that the signature filter compares.
PLANES = 4
#: Differing symbols the filter lets through: more happens to a pair of similarity 0.8 once in 1e8.
MAX_DIFFER = 27
SEED = 20_240_501
#: One-bit symbols of the longer signature that open members get, in 64-bit words, and how
#: many may differ: more happens to a pair of similarity 0.8 twice in 1e9.
FINE_WORDS, FINE_DIFFER = 32, 285
#: The similarity that the chunks and the limits above are made for.
LEAST_PERCENT = 80
#: Members of a bucket that one task compares with the rest of it.
PAIR_ROWS = 2_000
#: Turns of checks against single members before the rest is compared in full.
ROUNDS = 1
FINE_NAMES = tuple(f"q{i}" for i in range(FINE_WORDS))
PLANE_NAMES = tuple(f"p{i}" for i in range(PLANES))
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Rule:
    """Words in a shingle, and the similarity in percent from which documents are linked.

    The chunks and both limits on differing symbols are those of ``LEAST_PERCENT``; with less,
    links would be lost, so that is an error.
    """

    words: int = 5
    percent: int = 80

    def __post_init__(self):
        if not LEAST_PERCENT <= self.percent <= 100:
            raise ValueError(f"percent must be from {LEAST_PERCENT} to 100: below, links would be lost")


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _WordHashes(TaskCache):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_WORDS = _WordHashes()


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of a text's distinct word shingles.

    Letters A-Z are lower-cased, words end at ASCII white space.  Fewer words than
    a shingle make one shingle of them all; no word, none.
    """
    found = text.lower().split()
    if not found:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(_WORDS.__getitem__, found), np.uint64, len(found))
    k = min(words, len(each))
    rolled = np.full(len(each) - k + 1, np.uint64(k))
    for i in range(k):
        rolled = rolled * _STEP + each[i : len(each) - k + 1 + i]
    return np.unique(_mix(rolled))


@cache
def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED + n)
    times = rng.integers(0, 1 << 63, n, dtype=np.uint64) << np.uint64(1)
    return times | np.uint64(1), rng.integers(0, 1 << 63, n, dtype=np.uint64)


def _least(hashes: np.ndarray, n: int) -> np.ndarray:
    """The set's smallest value under each of ``n`` hash functions, mixed."""
    times, plus = _multipliers(n)
    least = np.full(n, np.uint64(0xFFFFFFFFFFFFFFFF))
    step = max(1, (1 << 18) // n)
    for at in range(0, len(hashes), step):
        block = (hashes[at : at + step, None] ^ plus) * times
        least = np.minimum(least, block.min(axis=0))
    return _mix(least)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The MinHash symbols of a set, 16 bits each."""
    return (_least(hashes, SYMBOLS) & np.uint64(0xFFFF)).astype(np.int32)


def fine_signature(hashes: np.ndarray) -> np.ndarray:
    """``64 * FINE_WORDS`` symbols of one bit each, packed."""
    bits = (_least(hashes, 64 * FINE_WORDS) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits).view(np.int64)


def _field(batch: pa.RecordBatch, name: str) -> pa.Array:
    return pc.struct_field(batch.column("doc"), name)


def _bytes(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def sketch(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """A written table of ``docs``: a row number, the row, and its set's size, digest and signature.

    Two sets have the same size and 128-bit digest if and, but for a chance of about
    1e-20 per pair, only if they are equal.
    """
    powers = np.uint64(1) << np.arange(SYMBOLS, dtype=np.uint64)

    def run(batches):
        for batch in batches:
            sizes, digests, symbols = [], [], []
            for value in _bytes(_field(batch, "text")):
                hashes = shingle_set(value.as_py() or b"", rule.words)
                sizes.append(len(hashes))
                digests.append(xxhash.xxh3_128_digest(hashes.tobytes()))
                symbols.append(signature(hashes))
            sig = np.array(symbols, np.int32).reshape(-1, SYMBOLS)
            planes = [
                ((((sig >> p) & 1).astype(np.uint64) * powers).sum(axis=1, dtype=np.uint64)).astype(np.int64)
                for p in range(PLANES)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), batch.column("doc"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(np.arange(0, sig.size + 1, SYMBOLS, dtype=np.int32), pa.array(sig.ravel())),
                    *(pa.array(p) for p in planes),
                ],
                names=["row", "doc", "n", "digest", "sig", *PLANE_NAMES],
            )

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc"))
    schema = T.StructType(
        [
            T.StructField("row", T.LongType()), rows.schema["doc"], T.StructField("n", T.LongType()),
            T.StructField("digest", T.BinaryType()), T.StructField("sig", T.ArrayType(T.IntegerType())),
            *(T.StructField(p, T.LongType()) for p in PLANE_NAMES),
        ]
    )
    # Most of it are the texts, which are kept until links are confirmed.
    return stage(map_arrow(rows, run, schema), "near-sketch", "zstd")


def _keys() -> Column:
    """One key for each chunk and each symbol of it left out."""
    keys = []
    for chunk in range(CHUNKS):
        for out in range(WIDTH):
            rest = [F.get("sig", F.lit(chunk * WIDTH + i)) for i in range(WIDTH) if i != out]
            keys.append(F.xxhash64(F.lit(chunk * WIDTH + out), *rest))
    return F.array(*keys)


def _may_link(percent: int, a: str = "a", b: str = "b") -> Column:
    """False only for pairs that can't reach the similarity, by size or by signature."""
    na, nb = F.col(f"{a}_n"), F.col(f"{b}_n")
    differ = F.lit(0).cast("bigint")
    for i in range(PLANES):
        differ = differ.bitwiseOR(F.col(f"{a}_p{i}").bitwiseXOR(F.col(f"{b}_p{i}")))
    return (100 * F.least(na, nb) >= percent * F.greatest(na, nb)) & (F.bit_count(differ) <= MAX_DIFFER)


def _named(nodes: DataFrame, prefix: str, *more: str) -> DataFrame:
    kept = ["node", "n", *PLANE_NAMES, *more]
    return nodes.select(*(F.col(c).alias(prefix if c == "node" else f"{prefix}_{c}") for c in kept))


def _confirm(pairs: DataFrame, texts: DataFrame, rule: Rule) -> DataFrame:
    """Those of ``pairs(a, b)`` whose full sets are similar enough; ``texts(node, text)``."""
    words, percent = rule.words, rule.percent

    def run(batches):
        recent: OrderedDict[int, np.ndarray] = OrderedDict()

        def of(node, text):
            if node not in recent:
                recent[node] = shingle_set(text or b"", words)
                if len(recent) > 64:
                    recent.popitem(last=False)
            else:
                recent.move_to_end(node)
            return recent[node]

        for batch in batches:
            keep = []
            ta, tb = _bytes(batch.column("ta")), _bytes(batch.column("tb"))
            for a, b, x, y in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), ta, tb):
                p, q = of(a, x.as_py()), of(b, y.as_py())
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= percent * (len(p) + len(q) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = (
        pairs.select("a", "b")
        .join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
        .join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    )
    return stage(map_arrow(joined.select("a", "b", "ta", "tb"), run, "a bigint, b bigint"), "near-links")


def _texts_of(ids: DataFrame, sketches: DataFrame) -> DataFrame:
    texts = sketches.select(F.col("row").alias("node"), F.col("doc.text").alias("text"))
    return stage(semi_or_anti(texts, stage(ids.distinct(), "near-ids"), ["node"], "left_semi"), "near-texts", "zstd")


def _mixed(rows: DataFrame, parts: DataFrame) -> DataFrame:
    """``rows(key, node, ...)`` of buckets with several components: with ``part``, and the bucket's largest, ``main``."""
    placed = rows.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node")).drop("component")
    tally = placed.groupBy("key", "part").agg(F.count(F.lit(1)).alias("size"))
    mains = tally.groupBy("key").agg(
        F.max_by("part", F.struct("size", "part")).alias("main"), F.count(F.lit(1)).alias("parts"), F.sum("size").alias("members")
    )
    mains = stage(mains.where("parts > 1").select("key", "main", "members"), "near-mains")
    return stage(join_counted(placed, mains, "key", "members").drop("members"), "near-mixed")


def _linkable(rows: DataFrame, percent: int) -> DataFrame:
    """``rows(key, node, n, shared, ...)`` that may be linked within their bucket, with the number of its ``members``.

    A partner has as many shingles as the bucket's smallest set or the common ones, whichever
    is more, and no more in common than is shared; that bounds the similarity from above.
    """
    buckets = rows.groupBy("key").agg(F.min("n").alias("least"), F.count(F.lit(1)).alias("members"))
    met = join_counted(rows, stage(buckets, "near-buckets"), "key", "members")
    union = F.col("n") + F.greatest("least", "shared") - F.col("shared")
    return met.where(100 * F.col("shared") >= percent * union).drop("least", "n", "shared")


def _shared(open_nodes: DataFrame, nodes: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """Rows of ``nodes`` that may still be linked, with ``shared``: shingles that another open node has, too.

    A set's links can only lie within the shingles it shares, so a node that shares too
    few is linked with no open node.  Shingles are counted once over all open nodes; those
    of a single node are its own.
    """
    texts = sketches.select(F.col("row").alias("node"), F.col("doc.text").alias("text"))
    wanted = stage(open_nodes, "near-open-nodes")
    texts = semi_or_anti(texts, wanted, ["node"], "left_semi")
    words = rule.words

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                sets = [shingle_set(v.as_py() or b"", words).view(np.int64) for v in _bytes(part.column("text"))]
                ends = pa.array(np.cumsum([0, *map(len, sets)]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("node"), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(sets)))], names=["node", "all"]
                )

    each = map_arrow(texts, run, "node bigint, all array<bigint>").select("node", F.explode("all").alias("shingle"))
    own = each.groupBy("shingle").agg(F.min("node").alias("node"), F.count(F.lit(1)).alias("nodes")).where("nodes = 1")
    own = own.groupBy("node").agg(F.count(F.lit(1)).alias("own"))
    found = nodes.withColumn("keys", _keys()).drop("sig", "digest").join(wanted, "node").join(own, "node", "left")
    found = found.withColumn("shared", F.col("n") - F.coalesce("own", F.lit(0))).drop("own")
    return stage(found.where(100 * F.col("shared") >= rule.percent * F.col("n")), "near-shared")


def _fine(texts: DataFrame, rule: Rule) -> DataFrame:
    """``(node, q0, ...)``: the longer signatures of ``texts(node, text)``."""
    words = rule.words

    def run(batches):
        for batch in batches:
            made = [fine_signature(shingle_set(v.as_py() or b"", words)) for v in _bytes(batch.column("text"))]
            table = np.array(made, np.int64).reshape(-1, FINE_WORDS)
            columns = [pa.array(np.ascontiguousarray(table[:, i])) for i in range(FINE_WORDS)]
            yield pa.RecordBatch.from_arrays([batch.column("node"), *columns], names=["node", *FINE_NAMES])

    return map_arrow(texts, run, "node bigint, " + ", ".join(f"{q} bigint" for q in FINE_NAMES))


def _may_still(percent: int, a: str = "a", b: str = "b") -> Column:
    """``_may_link`` for open members: by shared shingles and the longer signature as well."""
    most = F.least(f"{a}_shared", f"{b}_shared")
    enough = 100 * most >= percent * (F.col(f"{a}_n") + F.col(f"{b}_n") - most)
    differ = sum((F.bit_count(F.col(f"{a}_{q}").bitwiseXOR(F.col(f"{b}_{q}"))) for q in FINE_NAMES), F.lit(0))
    return _may_link(percent, a, b) & enough & (differ <= FINE_DIFFER)


def links(sketches: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """``(row, node)`` of all rows with a set, and ``(node, component)`` of the linked nodes.

    A node is the smallest row number of an equal set.
    """
    filled = sketches.where("n > 0")
    best = F.struct("row", "sig", *PLANE_NAMES)
    nodes = stage(
        filled.groupBy("n", "digest").agg(F.min_by(best, "row").alias("best"))
        .select(F.col("best.row").alias("node"), "n", "digest", "best.sig", *(f"best.{p}" for p in PLANE_NAMES)),
        "near-nodes",
    )
    keys = nodes.select("node", F.posexplode(_keys()).alias("slot", "key"))
    centres = stage(
        keys.groupBy("key").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("size"))
        .where("size > 1"),
        "near-centres",
    )
    members = stage(join_counted(keys, centres, "key", "size").drop("size"), "near-members")

    star = members.where("node != centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    star = stage(
        star.join(_named(nodes, "a"), "a").join(_named(nodes, "b"), "b").where(_may_link(rule.percent)).select("a", "b"),
        "near-star",
    )
    ends = star.select(F.col("a").alias("node")).unionByName(star.select(F.col("b").alias("node")))
    texts = _texts_of(ends, sketches)
    linked = _confirm(star, texts, rule)
    parts = stage(components(linked), "near-parts")

    # Buckets that hold several components, and in them the nodes that may still be linked.
    rows = _mixed(members.select("key", "slot", "node"), parts)
    shared = _shared(rows.select("node").distinct(), nodes, sketches, rule)
    texts = _texts_of(shared.select("node"), sketches)
    shared = stage(shared.join(_fine(texts, rule), "node"), "near-fine")
    rows = stage(rows.select("key", "slot", "node").join(shared.select("node"), "node"), "near-open")
    for turn in range(ROUNDS):
        # Each outsider of a bucket against one member of its largest component, another one each turn.
        open_ = _mixed(rows, parts).join(shared, "node")
        inner = F.struct(*(F.col(c) for c in ("node", "n", "shared", *PLANE_NAMES, *FINE_NAMES)))
        centres = open_.where("part = main").groupBy("key").agg(
            F.min_by(inner, F.xxhash64("node", "key", F.lit(turn))).alias("c")
        )
        pairs = _named(open_.where("part != main"), "a", "shared", *FINE_NAMES, "key").join(
            _named(centres.select("key", "c.*"), "b", "shared", *FINE_NAMES, "key"), F.col("a_key") == F.col("b_key")
        )
        pairs = pairs.where(_may_still(rule.percent)).select("a", "b").distinct()
        linked = linked.unionByName(_confirm(pairs, texts, rule))
        parts = stage(components(linked), "near-parts")

    # What is left: each member of the smaller components of a bucket against all of the others.
    # A large bucket's members are dealt to several tasks.
    sizes = shared.select("node", "n", "shared")
    narrow = stage(_linkable(_mixed(rows, parts).join(sizes, "node"), rule.percent), "near-last")
    open_ = narrow.join(shared, "node").withColumn("deals", F.ceil(F.col("members") / PAIR_ROWS))
    few = open_.where("part != main").withColumn("deal", F.pmod(F.xxhash64("node"), F.col("deals")))
    few = _named(few, "a", "shared", *FINE_NAMES, "key", "slot", "keys", "part", "deal")
    all_ = open_.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("deals") - 1)))
    all_ = _named(all_, "b", "shared", *FINE_NAMES, "key", "keys", "part", "main", "deal")
    # A pair counts in the first of the buckets it shares.
    first = F.array_position(F.zip_with("a_keys", "b_keys", lambda x, y: x == y), F.lit(True)) == F.col("a_slot") + 1
    pairs = (
        few.join(all_, (F.col("a_key") == F.col("b_key")) & (F.col("a_deal") == F.col("b_deal")))
        .where((F.col("a_part") != F.col("b_part")) & ((F.col("b_part") == F.col("b_main")) | (F.col("a") < F.col("b"))))
        .where(_may_still(rule.percent) & first)
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    )
    linked = linked.unionByName(_confirm(stage(pairs, "near-pairs"), texts, rule))
    parts = stage(components(linked), "near-parts")
    rows = filled.select("row", "n", "digest").join(nodes.select("n", "digest", "node"), ["n", "digest"]).select("row", "node")
    return rows, parts


def grouped(docs: DataFrame, rule: Rule = Rule()) -> tuple[DataFrame, DataFrame]:
    """The sketches of ``docs`` and, for rows with a set, the ``first`` row of the group.

    ``first`` is ``(id is null, id, row)``: the first of a group has its smallest id;
    null ids come last, equal ids in row order.
    """
    sketches = sketch(docs, rule)
    rows, parts = links(sketches, rule)
    placed = stage(
        rows.join(parts, "node", "left").select("row", F.coalesce("component", "node").alias("part")), "near-placed"
    )
    own = F.struct(F.col("doc.doc_id").isNull().alias("no_id"), F.col("doc.doc_id").alias("id"), "row")
    slim = sketches.select("row", own.alias("own")).join(placed, "row")
    firsts = stage(slim.groupBy("part").agg(F.min("own").alias("first")), "near-firsts")
    return sketches, stage(slim.join(firsts, "part").select("row", "first"), "near-known")


def near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_shingles, component_id, kept.

    Null and empty texts have no shingles and are linked with nothing.  Rows that
    repeat an id are linked by their texts like others.  ``component_id`` is the smallest
    id reachable, null only where no linked row has one; then the first row is kept.
    """
    sketches, known = grouped(docs.select("doc_id", "text"), rule)
    slim = sketches.select("row", F.col("doc.doc_id").alias("doc_id"), F.col("n").alias("n_shingles"))
    found = slim.join(known, "row", "left")
    return found.select(
        "doc_id", "n_shingles",
        F.when(F.col("first").isNull(), F.col("doc_id")).otherwise(F.col("first.id")).alias("component_id"),
        F.coalesce(F.col("doc_id") == F.col("first.id"), F.col("row") == F.col("first.row"), F.lit(True)).alias("kept"),
    )


def drop_near_duplicates(docs: DataFrame, rule: Rule = Rule()) -> DataFrame:
    """``docs``, all columns, with one row of each group: the one of the smallest id."""
    sketches, known = grouped(docs, rule)
    gone = stage(known.where("row != first.row").select("row"), "near-gone")
    return semi_or_anti(sketches.select("row", "doc"), gone, ["row"], "left_anti").select("doc.*")
