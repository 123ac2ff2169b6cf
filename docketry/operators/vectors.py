"""Dense index: a Parquet table of vectors, exact top-k search, upsert and delete."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from docketry.functions import fixed_values as fixed
from docketry.functions.text import strip
from docketry.functions.vector import metric_name
from docketry.plans import tables
from docketry.plans.sizes import semi_or_anti
from docketry.session import shared_dir, ship_package

KEY = ["point_id"]
#: Buckets of a stored index, by the hash of the point's id.
BUCKETS = 32
QUERY_BYTES = 32 * 1024 * 1024
TILE_ROWS = 20_000
#: Numbers in one block of scores of queries against vectors: 32 MB of doubles.
BLOCK_SCORES = 4_000_000
_HITS = "query_id {q}, point_id {p}, score float"


# --- ids -----------------------------------------------------------------------

def assign_point_ids(rows: DataFrame, order: Sequence[str], offset: int = 0,
                     out: str = "point_id") -> DataFrame:
    """Number rows ``offset, offset + 1, ...`` in the given order.

    No single task sees all rows: the rows are range-partitioned (a full order
    key splits even a source that holds most of them), numbered inside each
    partition and shifted by the sizes of the partitions before.  The numbered
    rows are checkpointed, so a lost executor cannot change them.  Where a ``chunk_id`` tells
    rows apart only it and the order are sorted and checkpointed, and the ids are
    joined back: vectors and texts are neither sorted nor written.
    """
    if "chunk_id" in rows.columns and set(rows.columns) - {"chunk_id", *order}:
        narrow = rows.select("chunk_id", *(c for c in order if c != "chunk_id"))
        ids = assign_point_ids(narrow, [*order, "chunk_id"], offset, out).select("chunk_id", out)
        return rows.join(ids, "chunk_id")
    shared_dir(rows.sparkSession)
    local = F.monotonically_increasing_id()
    numbered = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_local", local)
        .checkpoint()
    )
    part, row = F.shiftright("_local", 33), F.col("_local").bitwiseAND((1 << 33) - 1)
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    # One row per partition, so this window stays small whatever the table holds.
    starts = (
        numbered.groupBy(part.alias("_part"))
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    )
    return (
        numbered.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn(out, F.col("_start") + row + F.lit(offset))
        .drop("_part", "_start", "_local")
    )


# --- maintenance -----------------------------------------------------------------

def to_points(chunks: DataFrame) -> DataFrame:
    """Rows of the index: id, vector and payload."""
    metadata = F.col("metadata") if "metadata" in chunks.columns else F.lit(None).alias("metadata")
    return chunks.select(
        "point_id",
        F.col("vector").cast("array<float>").alias("vector"),
        "chunk_id",
        F.coalesce("content", F.lit("")).alias("content"),
        metadata,
    )


def append_points(existing: DataFrame | None, chunks: DataFrame,
                  order: Sequence[str] = ("source", "section_ix", "chunk_ix"),
                  top: int | None = None) -> DataFrame:
    """Points for new chunks.  A chunk already indexed keeps its id; the others get
    ids after the highest one in use, so deleting never makes ids collide.

    ``top`` is that id where the caller knows it.
    """
    if existing is None:
        return to_points(assign_point_ids(chunks, order))
    if top is None:
        top = existing.agg(F.max("point_id")).first()[0]
    offset = 0 if top is None else top + 1
    # Only the index rows of these very chunks take part in the join.
    mine = semi_or_anti(
        existing.select("chunk_id", "point_id"), chunks, ["chunk_id"], "left_semi"
    )
    known = chunks.join(mine, "chunk_id", "left")
    new = known.where(F.col("point_id").isNull()).drop("point_id")
    old = known.where(F.col("point_id").isNotNull())
    return to_points(old.unionByName(assign_point_ids(new, order, offset)))


def write_vectors(spark: SparkSession, chunks: DataFrame, path: str,
                  batch: int | None = None, removed: DataFrame | None = None) -> int:
    """Create the index or add to it; returns the batch number.

    ``removed`` lists point ids that no longer exist.
    """
    existing = read_vectors(spark, path)
    batch = tables.next_batch(spark, path) if batch is None else batch
    if chunks.isEmpty() and (removed is None or removed.isEmpty()):
        return batch
    top = tables.state(spark, path).top.get("point_id")
    points = append_points(existing, chunks, top=top).withColumn("deleted", F.lit(False))
    if removed is not None:
        gone = removed.select("point_id", F.lit(True).alias("deleted"))
        points = points.unionByName(gone, allowMissingColumns=True)
    _write(points, path, batch)
    return batch


def _write(points: DataFrame, path: str, batch: int) -> None:
    tables.write_batch(points, path, batch, buckets=BUCKETS, key=KEY, top="point_id")


def read_points(spark: SparkSession, path: str, ids: DataFrame) -> DataFrame | None:
    """The points of ``ids(point_id)``; only the buckets those are in are read."""
    return tables.read_keys(spark, path, ids.select(*KEY).distinct())


def read_vectors(spark: SparkSession, path: str) -> DataFrame | None:
    return tables.read_current(spark, path, KEY)


def embed_missing(points: DataFrame, embedder: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``points`` where those without a vector get that of their ``content``; the model sees no others."""
    missing = points.where(F.col("vector").isNull()).drop("vector")
    made = embedder(missing).select(*points.columns)
    return points.where(F.col("vector").isNotNull()).unionByName(made)


def upsert_vectors(spark: SparkSession, points: DataFrame, path: str,
                   embedder: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Put points in by id: one row or many.  Of rows that repeat an id the last one wins.

    Nothing of the index is read; the batch has the buckets of its ids only, and shadows
    what is there.  With an ``embedder`` points without a vector get that of their text.
    """
    batch = tables.next_batch(spark, path)
    rows = to_points(points)
    rest = [c for c in rows.columns if c not in KEY]
    rows = rows.withColumn("_place", F.monotonically_increasing_id())
    last = F.max_by(F.struct(*rest), "_place").alias("_row")
    rows = rows.groupBy(*KEY).agg(last).select(*KEY, "_row.*")
    if embedder is not None:
        rows = embed_missing(tables.written(rows, "upserted"), embedder)
    _write(rows, path, batch)
    return batch


def delete_vectors(spark: SparkSession, ids: DataFrame, path: str) -> int:
    """Remove the points whose ids are listed."""
    batch = tables.next_batch(spark, path)
    _write(ids.select("point_id").distinct().withColumn("deleted", F.lit(True)), path, batch)
    return batch


def drop_index(spark: SparkSession, path: str) -> bool:
    return tables.drop_table(spark, path)


def index_stats(vectors: DataFrame, metric: str = "cosine") -> DataFrame:
    return vectors.agg(
        F.count(F.lit(1)).alias("chunks_count"),
        F.max(F.size("vector")).alias("dimension"),
        F.lit(metric_name(metric)).alias("metric"),
        F.lit("ready").alias("status"),
    )


# --- search ------------------------------------------------------------------------

def _scores(queries: np.ndarray, vectors: np.ndarray, metric: str) -> np.ndarray:
    """Query-by-vector scores in double precision, kept as float32 like the vectors."""
    if metric == "euclid":
        # From the differences themselves: exact for near and equal vectors.
        return np.stack(
            [np.sqrt(np.square(vectors - q).sum(axis=1)) for q in queries]
        ).astype(np.float32)
    products = queries @ vectors.T
    if metric == "dot":
        return products.astype(np.float32)
    q2 = np.einsum("ij,ij->i", queries, queries)[:, None]
    v2 = np.einsum("ij,ij->i", vectors, vectors)[None, :]
    lengths = np.sqrt(q2) * np.sqrt(v2)
    return np.divide(
        products, lengths, out=np.zeros_like(products), where=lengths > 0
    ).astype(np.float32)


class _Best:
    """The best ``k`` hits of every query seen so far; equal scores go by id."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int, metric: str):
        self.query_ids, self.queries, self.k, self.metric = query_ids, queries, k, metric
        self.sign = 1 if metric == "euclid" else -1
        self.ids: list[np.ndarray | None] = [None] * len(query_ids)
        self.scores: list[np.ndarray | None] = [None] * len(query_ids)

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Take vectors in, in blocks and for so many queries that a block of scores stays small."""
        width = max(1, vectors.shape[1]) if self.metric == "euclid" else 1
        step = max(1, BLOCK_SCORES // (max(1, len(self.queries)) * width))
        for at in range(0, len(ids), step):
            self._add(ids[at:at + step], vectors[at:at + step])

    def _add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for row, scores in enumerate(_scores(self.queries, vectors, self.metric)):
            cost = self.sign * scores
            if len(cost) > self.k:
                # Keep every row that ties with the k-th; the sort below decides.
                keep = np.flatnonzero(cost <= np.partition(cost, self.k - 1)[self.k - 1])
            else:
                keep = np.arange(len(cost))
            all_ids, all_scores = ids[keep], scores[keep]
            if self.ids[row] is not None:
                all_ids = np.concatenate([self.ids[row], all_ids])
                all_scores = np.concatenate([self.scores[row], all_scores])
            best = np.lexsort((all_ids, self.sign * all_scores))[: self.k]
            self.ids[row], self.scores[row] = all_ids[best], all_scores[best]

    def frame(self) -> pd.DataFrame:
        filled = [i for i, ids in enumerate(self.ids) if ids is not None]
        if not filled:
            return pd.DataFrame({"query_id": [], "point_id": [], "score": []})
        counts = [len(self.ids[i]) for i in filled]
        return pd.DataFrame(
            {
                "query_id": np.repeat(self.query_ids[filled], counts),
                "point_id": np.concatenate([self.ids[i] for i in filled]),
                "score": np.concatenate([self.scores[i] for i in filled]),
            }
        )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def _hit_schema(vectors: DataFrame, queries: DataFrame) -> str:
    return _HITS.format(
        q=queries.schema["query_id"].dataType.simpleString(),
        p=vectors.schema["point_id"].dataType.simpleString(),
    )


def _search_broadcast(vectors: DataFrame, queries: DataFrame, k: int, metric: str,
                      dim: int) -> DataFrame:
    """Each task scores its vectors against all queries and keeps ``k`` per query.

    Vectors of another length are left out here, not by a filter: a filter
    would be pushed below the embedding and work it out twice.
    """
    table = queries.toPandas()
    shared = vectors.sparkSession.sparkContext.broadcast(
        (table["query_id"].to_numpy(), np.stack(table["vector"].to_numpy()).astype(np.float64))
    )

    def run(blocks: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(*shared.value, k, metric)
        for block in blocks:
            fits = pc.equal(pc.list_value_length(block.column("vector")), dim)
            block = block.filter(pc.fill_null(fits, False))
            if block.num_rows:
                ids = block.column("point_id").to_numpy(zero_copy_only=False)
                best.add(ids, _matrix(block.column("vector")))
        yield pa.RecordBatch.from_pandas(
            best.frame(), preserve_index=False, schema=arrow_schema
        )

    schema = _hit_schema(vectors, queries)
    arrow_schema = _arrow(schema)
    return vectors.select("point_id", "vector").mapInArrow(run, schema)


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(ddl))


def _search_tiled(vectors: DataFrame, queries: DataFrame, k: int, metric: str,
                  n_queries: int, tile_rows: int) -> DataFrame:
    """For query tables too big to broadcast: meet block by block.

    Vectors and queries are hashed into blocks of bounded size; each pair of
    blocks is one group that holds no more than one block of each.
    """
    v_blocks = max(1, -(-vectors.count() // tile_rows))
    q_blocks = max(1, -(-n_queries // tile_rows))

    def block(key: str, n: int):
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = vectors.select("point_id", "vector", block("point_id", v_blocks).alias("vb")).withColumn("qb", every(q_blocks))
    right = queries.select("query_id", "vector", block("query_id", q_blocks).alias("qb")).withColumn("vb", every(v_blocks))

    def run(_key, v: pd.DataFrame, q: pd.DataFrame) -> pd.DataFrame:
        if v.empty or q.empty:
            return pd.DataFrame({"query_id": [], "point_id": [], "score": []})
        q_matrix = np.stack(q["vector"].to_numpy()).astype(np.float64)
        best = _Best(q["query_id"].to_numpy(), q_matrix, k, metric)
        best.add(v["point_id"].to_numpy(), np.stack(v["vector"].to_numpy()).astype(np.float64))
        return best.frame()

    return (
        left.groupBy("vb", "qb")
        .cogroup(right.groupBy("vb", "qb"))
        .applyInPandas(run, _hit_schema(vectors, queries))
    )


def rank_hits(hits: DataFrame, k: int, score: Column, tie: str) -> DataFrame:
    """Number the hits of each query and keep ``k``; Spark prunes before shuffling."""
    order = W.partitionBy("query_id").orderBy(score, tie)
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search_dense(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = fixed.TOP_K,
    metric: str = "cosine",
    payload: Sequence[str] = (),
    max_query_bytes: int = QUERY_BYTES,
    tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """Exact top-k of ``vectors(point_id, vector)`` for every row of
    ``queries(query_id, vector)``.

    Only each task's best ``k`` per query are shuffled, never the vectors,
    unless the queries are too many to broadcast.  ``payload`` columns are
    joined to the final hits.
    """
    ship_package(vectors.sparkSession)
    metric = metric_name(metric)
    queries = queries.select("query_id", "vector").where(F.col("vector").isNotNull())
    sized = queries.agg(F.count(F.lit(1)), F.max(F.size("vector")), F.min(F.size("vector"))).first()
    n, dim, shortest = sized
    if n and dim != shortest:
        raise ValueError("query vectors differ in length")
    if n == 0 or n * dim * 8 <= max_query_bytes:
        hits = (
            _search_broadcast(vectors, queries, k, metric, dim) if n
            else vectors.sparkSession.createDataFrame([], _hit_schema(vectors, queries))
        )
    else:
        usable = vectors.where(F.size("vector") == dim)
        hits = _search_tiled(usable, queries, k, metric, n, tile_rows)
    score = F.col("score").asc() if metric == "euclid" else F.col("score").desc()
    top = rank_hits(hits, k, score, "point_id")
    if payload:
        top = vectors.select("point_id", *payload).join(top, "point_id")
    return top


def nonblank(queries: DataFrame, text: str = "text") -> DataFrame:
    """Blank queries have no results."""
    return queries.where(strip(F.coalesce(F.col(text), F.lit(""))) != "")
