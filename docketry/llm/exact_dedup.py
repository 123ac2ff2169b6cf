"""Exact dedup of a new batch against immutable snapshots screened by binary-fuse filters.

A snapshot is a written table of texts' digests with one static filter per shard of
digests; it never changes.  Digests of a new batch are looked up in the filters of every
snapshot.  A miss is certain, so those texts are compared only with each other.
Hits, few of them false, join the snapshot's exact buckets.  Wherever texts share a
digest, the bytes decide: each text is compared with the first one of its bucket, and one
that differs forms a group of its own bytes.

Shards grow in number, not in size.  Digests are made distinct before they are
screened or stored, so a group of copies is one row there.  Bytes move only for texts
that have a partner, and each meets one other text, not all of its group.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm import fuse_filter
from docketry.llm.common import stage
from docketry.plans.sizes import semi_or_anti
from docketry.session import ship_package

#: Distinct digests in a shard, about: what one task builds a filter from.
SHARD_KEYS = 1_000_000
SPACE = " \t\n\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """The text without ASCII white space; null as empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", "")


@dataclass(frozen=True)
class Snapshot:
    """Written rows ``(row, doc, id, size, sha)`` and one filter per shard of their digests."""

    rows: DataFrame
    filters: DataFrame
    shards: int


def digests(docs: DataFrame, batch: int) -> DataFrame:
    """A written table of ``docs``: row number, the row as ``doc``, id, code points, SHA-256.

    Row numbers of different batches differ.
    """
    text = F.coalesce(F.col("doc.text"), F.lit(""))
    rows = docs.select(
        (F.monotonically_increasing_id() * 1024 + F.lit(batch)).alias("row"), F.struct("*").alias("doc")
    )
    return stage(
        rows.select("row", "doc", F.col("doc.doc_id").alias("id"), F.length(text).cast("bigint").alias("size"),
                    F.sha2(normalised(F.col("doc.text")), 256).alias("sha")),
        "exact-rows", "zstd",
    )


def _key(sha: str = "sha") -> Column:
    """64 bits of the digest."""
    return F.xxhash64(sha)


def snapshot(rows: DataFrame) -> Snapshot:
    """Build the filters of a table made by ``digests``."""
    keys = stage(rows.select("sha").distinct().select(_key().alias("key")), "exact-keys")
    shards = -(-max(keys.count(), 1) // SHARD_KEYS)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        made = fuse_filter.build(pdf["key"].to_numpy(np.int64).view(np.uint64))
        return pd.DataFrame({"shard": pdf["shard"].iloc[:1], "filter": [made]})

    ship_package(rows.sparkSession)
    sharded = keys.select(F.pmod("key", F.lit(shards)).alias("shard"), "key")
    filters = sharded.groupBy("shard").applyInPandas(build, "shard bigint, filter binary")
    return Snapshot(rows, stage(filters, "exact-filters"), shards)


def screen(shas: DataFrame, known: Snapshot) -> DataFrame:
    """Those of the distinct digests ``shas(sha)`` that the snapshot may hold."""
    def probe(keys: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
        if not len(filters) or not len(keys):
            return keys.iloc[:0][["sha"]]
        hit = fuse_filter.contains(filters["filter"].iloc[0], keys["key"].to_numpy(np.int64).view(np.uint64))
        return keys.loc[hit, ["sha"]]

    ship_package(shas.sparkSession)
    # Parts keep a group of incoming digests as small as a shard, however many there are.
    parts = -(-max(shas.count(), 1) // (SHARD_KEYS * known.shards))
    keyed = shas.select(
        "sha", _key().alias("key"), F.pmod(_key(), F.lit(known.shards)).alias("shard"),
        F.pmod(F.xxhash64("sha", F.lit(1)), F.lit(parts)).alias("part"),
    )
    filters = known.filters.withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))
    by = ["shard", "part"]
    return keyed.groupBy(*by).cogroup(filters.groupBy(*by)).applyInPandas(probe, "sha string")


def _by_bytes(rows: DataFrame) -> DataFrame:
    """``(row, id, size, sha, variant)``: variant is empty, or tells bytes apart that share a digest.

    ``rows`` are those whose digest has several rows.
    """
    text = normalised(F.col("doc.text"))
    firsts = stage(rows.groupBy("sha").agg(F.min("row").alias("row")), "exact-first")
    first_text = stage(
        semi_or_anti(rows, firsts, ["row"], "left_semi").select("sha", text.alias("first_text")), "exact-first-text"
    )
    met = rows.select("row", "id", "size", "sha", text.alias("own_text")).join(first_text, "sha")
    return met.select(
        "row", "id", "size", "sha",
        F.when(F.col("own_text") == F.col("first_text"), "").otherwise(F.col("own_text")).alias("variant"),
    )


def group(batch: DataFrame, snapshots: Sequence[Snapshot] = ()) -> tuple[DataFrame, DataFrame]:
    """Rows of the batch and of the snapshots, and the groups among those with a partner.

    The second table has ``(row, keep_row, keep_id, group_size)`` of every row in a group of
    two or more; all other rows stand alone.
    """
    own = batch.groupBy("sha").agg(F.count(F.lit(1)).alias("copies"))
    own = stage(own, "exact-batch")
    everything = batch
    wanted = own.where("copies > 1").select("sha")
    for known in snapshots:
        everything = everything.unionByName(known.rows)
        hits = stage(screen(own.select("sha"), known), "exact-hits")
        # Exact buckets: false hits of the filter find none.
        held = semi_or_anti(known.rows.select("sha"), hits, ["sha"], "left_semi").distinct()
        repeated = known.rows.groupBy("sha").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("sha")
        wanted = wanted.unionByName(held).unionByName(repeated)
    # Snapshots may share digests with one another, too.
    if len(snapshots) > 1:
        many = everything.groupBy("sha").agg(F.count(F.lit(1)).alias("copies")).where("copies > 1").select("sha")
        wanted = wanted.unionByName(many)
    wanted = stage(wanted.distinct(), "exact-wanted")
    meeting = semi_or_anti(everything, wanted, ["sha"], "left_semi")
    checked = stage(_by_bytes(meeting), "exact-checked")
    # Most code points first, then the smallest id, null ids last, then row order.
    place = F.struct((-F.col("size")).alias("size"), F.col("id").isNull().alias("no_id"), "id", "row")
    keep = stage(
        checked.groupBy("sha", "variant").agg(F.min(place).alias("keep"), F.count(F.lit(1)).alias("group_size"))
        .where("group_size > 1"),
        "exact-keep",
    )
    found = checked.join(keep, ["sha", "variant"]).select(
        "row", F.col("keep.row").alias("keep_row"), F.col("keep.id").alias("keep_id"), "group_size"
    )
    return everything, stage(found, "exact-found")


def _batches(docs: DataFrame) -> tuple[DataFrame, Snapshot]:
    """A table's rows as a snapshot and a new batch, halved by the hash of the id.

    Every row is in one of the two.
    """
    newer = F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 1
    return digests(docs.where(newer), 1), snapshot(digests(docs.where(~newer), 0))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, keep_id, group_size, kept, text_sha256.

    Null texts count as empty, and empty texts are equal.  Rows that repeat an id are
    rows of their own; of equal texts exactly one row is kept.
    """
    batch, known = _batches(docs.select("doc_id", "text"))
    everything, found = group(batch, [known])
    return everything.select("row", "id", "sha").join(found, "row", "left").select(
        F.col("id").alias("doc_id"),
        F.when(F.col("keep_row").isNull(), F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("row") == F.col("keep_row"), F.lit(True)).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_exact_duplicates(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, with one row of each group of equal texts."""
    batch, known = _batches(docs)
    everything, found = group(batch, [known])
    gone = stage(found.where("row != keep_row").select("row"), "exact-gone")
    return semi_or_anti(everything.select("row", "doc"), gone, ["row"], "left_anti").select("doc.*")
