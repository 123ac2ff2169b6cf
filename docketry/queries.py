"""Registered queries: each takes ``(spark, sf_dir)`` and runs an operator over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketry import views
from docketry.functions.text import tokenize
from docketry.operators import (
    annotate,
    casemeta,
    chunk,
    clean,
    embed,
    ledger,
    lexical,
    sections,
    serialize,
    stats,
    vectors,
)
from docketry.plans import ingest, tables
from docketry.session import new_work_dir, shuffles_removed
from docketry.sources import files, statutes
from docketry.streaming import stream_ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
VECTOR_DIM = 64


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _bigint(*names: str) -> list[Column]:
    return [F.col(n).cast("bigint").alias(n) for n in names]


# --- file store ------------------------------------------------------------------

@query
def list_stats(spark, sf_dir):
    return stats.container_stats(views.listing(spark, sf_dir))


@query
def list_types(spark, sf_dir):
    return stats.container_types(views.listing(spark, sf_dir))


@query
def discover(spark, sf_dir):
    return stats.discover(views.listing(spark, sf_dir), views.label_state(spark, sf_dir))


@query
def discover_by_type(spark, sf_dir):
    return stats.discover_by_type(views.listing(spark, sf_dir))


@query
def discover_detailed(spark, sf_dir):
    found = stats.discover_detailed(
        views.listing(spark, sf_dir), views.label_state(spark, sf_dir)
    )
    return found.select(
        "file_name",
        "size_bytes",
        F.round("size_mb", 6).alias("size_mb"),
        F.date_format("last_modified", "yyyy-MM-dd HH:mm:ss").alias("last_modified"),
        "ingested",
    )


@query
def pending_files(spark, sf_dir):
    return ledger.pending_files(
        views.listing(spark, sf_dir), views.label_state(spark, sf_dir)
    ).select("file_name")


@query
def pending_files_first(spark, sf_dir):
    """The limited ingest: the first 500 pending files by name."""
    return ledger.pending_files(
        views.listing(spark, sf_dir), views.label_state(spark, sf_dir), 500
    ).select("file_name")


@query
def route_by_suffix(spark, sf_dir):
    known, unknown = files.route_by_suffix(views.listing(spark, sf_dir))
    return known.select("file_name", F.lit(None).cast("string").alias("error")).unionByName(
        unknown.select("file_name", "error")
    )


def _document_store(spark: SparkSession, sf_dir: str) -> str:
    """Documents written as text files, in folders by language."""
    root = new_work_dir(spark, "store")
    views.table(spark, sf_dir, "documents").select("lang", F.col("text").alias("value")).write.partitionBy(
        "lang"
    ).text(root)
    return root


def _by_folder(rows: DataFrame) -> DataFrame:
    folder = F.regexp_extract("file_name", r"lang=([^/]*)/", 1)
    return rows.where(F.col("file_name").endswith(".txt")).groupBy(folder.alias("lang")).agg(
        F.sum("size_bytes").alias("size_bytes")
    )


@query
def list_files(spark, sf_dir):
    """Documents as stored files, listed on the executors: bytes per folder."""
    root = _document_store(spark, sf_dir)
    return _by_folder(files.list_files(spark, root, extensions=[".txt"]))


@query
def scan_files(spark, sf_dir):
    """The same files read whole: bytes of content per folder."""
    root = _document_store(spark, sf_dir)
    scanned = files.scan_files(spark, root, extensions=[".txt"])
    return _by_folder(scanned.withColumn("size_bytes", F.length("content").cast("bigint")))


@query
def scan_glob(spark, sf_dir):
    """The same files by a glob on their names."""
    scanned = files.scan_files(spark, _document_store(spark, sf_dir), glob="part-*.{txt,pdf}")
    return _by_folder(scanned.withColumn("size_bytes", F.length("content").cast("bigint")))


@query
def stream_files(spark, sf_dir):
    """The same files as a stream of micro-batches: bytes of content per folder."""
    root, out = _document_store(spark, sf_dir), new_work_dir(spark, "streamed")
    rows = files.stream_files(spark, root, batch_size=5, extensions=[".txt"]).select("file_name", "content")
    (
        rows.writeStream.format("parquet").option("checkpointLocation", f"{out}/_checkpoint")
        .trigger(availableNow=True).start(f"{out}/files").awaitTermination()
    )
    taken = spark.read.schema(rows.schema).parquet(f"{out}/files")
    return _by_folder(taken.withColumn("size_bytes", F.length("content").cast("bigint")))


@query
def extract_pages(spark, sf_dir):
    """Web pages as files through the pluggable extractor."""
    raw = views.page_files(spark, sf_dir)
    good, _ = files.with_errors(files.extract(raw))
    return good.select("source", *_bigint("page_no"), "text")


@query
def quarantine(spark, sf_dir):
    """Files a parser rejects: pages that are not a full HTML document."""
    raw = views.page_files(spark, sf_dir)

    def strict(_name: str, content: bytes) -> list[str]:
        if not content.rstrip().endswith(b"</html>"):
            raise ValueError("no closing tag")
        return [content.decode("utf-8")]

    good, bad = files.with_errors(files.extract_documents(raw, strict))
    return good.agg(F.count(F.lit(1)).alias("n_files")).select(
        F.lit("good").alias("outcome"), "n_files"
    ).unionByName(
        bad.groupBy("error").agg(F.count(F.lit(1)).alias("n_files")).select(
            F.col("error").alias("outcome"), "n_files"
        )
    )


@query
def assemble_documents(spark, sf_dir):
    """Turns of a conversation as the pages of a document."""
    pages = views.table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("conv/"), F.col("conv_id").cast("string")).alias("source"),
        F.col("turn").alias("page_no"),
        "text",
    )
    return files.assemble_documents(pages).select("source", *_bigint("pages"), "text")


@query
def statute_sections(spark, sf_dir):
    found = statutes.statute_sections(views.statute_files(spark, sf_dir))
    path = F.transform("path", lambda p: F.concat_ws("=", p["tag"], p["num"]))
    return found.withColumn("path", F.array_join(path, "/"))


# --- runs and ledger ------------------------------------------------------------------

@query
def run_stats(spark, sf_dir):
    return stats.run_stats(views.runs(spark, sf_dir)).withColumn(
        "last_ingestion", F.date_format("last_ingestion", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


@query
def metrics(spark, sf_dir):
    found = stats.metrics(
        views.runs(spark, sf_dir), views.listing(spark, sf_dir), views.label_state(spark, sf_dir)
    )
    return found.withColumn("success_rate", F.round("success_rate", 6))


@query
def ledger_state(spark, sf_dir):
    return ledger.ledger_state(views.ledger_events(spark, sf_dir)).select(
        "file_name",
        "ingested",
        F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ingested_at"),
        F.date_format("reset_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("reset_at"),
    )


@query
def ledger_snapshot(spark, sf_dir):
    """The same state from a stored ledger: events of eight runs, the state read in between and again."""
    path = new_work_dir(spark, "ledger")
    events = views.ledger_events(spark, sf_dir)
    part = F.pmod(F.col("run_id").cast("bigint"), F.lit(8))
    for n in range(8):
        ledger.append_events(events.where(part == n).drop("run_id"), path, f"run-{n}")
        if n == 4:
            ledger.stored_state(spark, path, snapshot_every=3)
    return ledger.stored_state(spark, path, snapshot_every=3).select(
        "file_name",
        F.date_format("ingested_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ingested_at"),
        F.date_format("reset_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("reset_at"),
    )


@query
def reset_ingested(spark, sf_dir):
    """Files the reset tool turns back."""
    state = ledger.ledger_state(views.ledger_events(spark, sf_dir))
    return ledger.reset_events(views.listing(spark, sf_dir), state).select("file_name", "ingested")


@query
def reset_ingested_first(spark, sf_dir):
    """A reset that looks at the first 500 names only, ingested or not."""
    listing = views.listing(spark, sf_dir)
    state = ledger.ledger_state(views.ledger_events(spark, sf_dir))
    return ledger.reset_events(listing, state, 500, extensions=None).select("file_name", "ingested")


# --- metadata, sections, cleaning, annotation ---------------------------------------------

def _sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sections.split_sections(views.opinions(spark, sf_dir))


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean.clean_text(_sections(spark, sf_dir))


@query
def case_metadata(spark, sf_dir):
    return casemeta.case_metadata(views.opinions(spark, sf_dir)).select(
        "doc_id",
        "court_name",
        "docket_number",
        "case_date",
        "case_name",
        "disposition",
        F.date_format("decided_on", "yyyy-MM-dd").alias("decided_on"),
    )


@query
def split_sections(spark, sf_dir):
    return _sections(spark, sf_dir).select("doc_id", *_bigint("section_ix"), "section", "text")


@query
def clean_text(spark, sf_dir):
    """Whole opinions, not split, so that every rule meets its lines."""
    return clean.clean_text(views.opinions(spark, sf_dir)).select(
        "doc_id", "text", *_bigint("length")
    )


@query
def clean_documents(spark, sf_dir):
    docs = views.documents(spark, sf_dir)
    return clean.clean_text(docs).select("doc_id", "text", *_bigint("length"))


def _annotation(name: str, value: Callable[[Column], Column]) -> Query:
    def run(spark, sf_dir):
        return _cleaned(spark, sf_dir).select(
            "doc_id", *_bigint("section_ix"), value(F.col("text")).alias(name)
        )

    return run


QUERIES["annotate_posture"] = _annotation("procedural_posture", annotate.procedural_posture)
QUERIES["annotate_calendar"] = _annotation("calendar_status", annotate.calendar_status)
QUERIES["annotate_statutes"] = _annotation(
    "statutes_guidelines", lambda t: F.array_join(annotate.statutes(t), "|")
)
QUERIES["annotate_holdings"] = _annotation(
    "holdings", lambda t: F.array_join(annotate.holdings(t), "|")
)


@query
def annotate_precedents(spark, sf_dir):
    found = _cleaned(spark, sf_dir).select(
        "doc_id", *_bigint("section_ix"), annotate.precedents(F.col("text")).alias("p")
    )
    return found.select(
        "doc_id", "section_ix", F.inline_outer("p").alias("case_title", "reporter", "pin", "court_year")
    ).where(F.col("case_title").isNotNull())


def _annotated(spark: SparkSession, sf_dir: str) -> DataFrame:
    meta = casemeta.case_metadata(views.opinions(spark, sf_dir))
    return annotate.annotate(clean.clean_text(sections.split_sections(meta)))


@query
def chunk_metadata(spark, sf_dir):
    """What each chunk carries, as JSON without absent keys."""
    annotated = _annotated(spark, sf_dir)
    return annotated.select(
        "doc_id",
        *_bigint("section_ix"),
        F.to_json(chunk.chunk_metadata(annotated)).alias("metadata"),
    )


@query
def to_json_rows(spark, sf_dir):
    rows = views.table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", F.array("c_mktsegment", "c_name").alias("tags")
    )
    chunk_form = serialize.to_json_rows(rows)
    doc_form = serialize.to_json_rows(rows.drop("tags"), kind="doc")
    return chunk_form.unionByName(doc_form)


# --- chunks and embeddings -----------------------------------------------------------------

@query
def chunk_recursive(spark, sf_dir):
    docs = views.documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("source"),
        F.lit(0).alias("section_ix"),
        "text",
    )
    return chunk.chunk_recursive(docs).select(
        "source", *_bigint("chunk_ix"), "chunk_id", "content"
    )


@query
def chunk_opinions(spark, sf_dir):
    return chunk.chunk_recursive(_annotated(spark, sf_dir)).select(
        "source", *_bigint("section_ix", "chunk_ix"), "chunk_id", "content",
        F.to_json("metadata").alias("metadata"),
    )


@query
def chunk_tokens(spark, sf_dir):
    docs = views.documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("source"),
        F.lit(0).alias("section_ix"),
        "text",
    )
    return chunk.chunk_tokens(docs, size=128, overlap=16).select(
        "source", *_bigint("chunk_ix"), "chunk_id", "content"
    )


@query
def chunk_words(spark, sf_dir):
    """Token windows over another tokenizer's pieces: words with the white space behind them."""
    docs = views.documents(spark, sf_dir).select(
        F.col("doc_id").cast("string").alias("source"), F.lit(0).alias("section_ix"), "text"
    )
    words = F.regexp_extract_all("text", F.lit("[^ ]* *"), F.lit(0))
    return chunk.chunk_tokens(docs, size=50, overlap=10, tokens=F.filter(words, lambda w: w != "")).select(
        "source", *_bigint("chunk_ix"), "content"
    )


@query
def tokenize_documents(spark, sf_dir):
    docs = views.documents(spark, sf_dir)
    return docs.select("doc_id", F.array_join(tokenize(F.col("text")), " ").alias("tokens"))


def _document_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document as one chunk."""
    return views.documents(spark, sf_dir).select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("content")
    )


def _benchmark_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), "text"
    )


@query
def embed_documents(spark, sf_dir):
    vector = embed.embed(_document_chunks(spark, sf_dir), dim=VECTOR_DIM)
    return vector.select(
        "chunk_id",
        F.array_join(F.transform("vector", lambda x: x.cast("int").cast("string")), ",").alias("vector"),
    )


@query
def embed_with_model(spark, sf_dir):
    """A model plugged in: counts of characters and of two vowels."""
    def make_fn():
        return lambda texts: np.array([[len(t), t.count("a"), t.count("e")] for t in texts], np.float32)

    return embed.embed(_document_chunks(spark, sf_dir), make_fn=make_fn).select(
        "chunk_id", *(F.get("vector", F.lit(i)).cast("bigint").alias(n) for i, n in enumerate(("n_chars", "n_a", "n_e")))
    )


@query
def check_dimension_misfits(spark, sf_dir):
    """Vectors of which some are cut short and some are missing."""
    short = F.when(F.col("vec_id") % 7 == 0, F.slice("embedding", 1, 63)).when(F.col("vec_id") % 11 != 0, F.col("embedding"))
    rows = views.table(spark, sf_dir, "embeddings").select("vec_id", short.alias("vector"))
    _, bad = embed.check_dimension(rows, VECTOR_DIM)
    return bad.select("vec_id", F.coalesce(F.size("vector"), F.lit(-1)).cast("bigint").alias("n"))


@query
def check_dimension(spark, sf_dir):
    good, bad = embed.check_dimension(
        views.vectors(spark, sf_dir), VECTOR_DIM
    )
    return good.agg(
        F.count(F.lit(1)).alias("good"),
    ).select("good", bad.agg(F.count(F.lit(1)).alias("bad")).scalar().alias("bad"))


# --- lexical index --------------------------------------------------------------------------

def _lexical(spark: SparkSession, sf_dir: str) -> lexical.LexicalIndex:
    return lexical.index_from(lexical.chunk_terms(_document_chunks(spark, sf_dir)))


@query
def lexical_stats(spark, sf_dir):
    """Document frequency and idf of every term."""
    return _lexical(spark, sf_dir).term_stats.withColumn("idf", F.round("idf", 6))


@query
def lexical_postings(spark, sf_dir):
    return _lexical(spark, sf_dir).postings


@query
def lexical_corpus(spark, sf_dir):
    index = _lexical(spark, sf_dir)
    return lexical.lexical_index_stats(index, spark).select(
        "chunks_count", "k1", "b", "index_exists",
        F.round(index.corpus.select("avgdl").scalar(), 6).alias("avgdl"),
    )


@query
def search_lexical(spark, sf_dir):
    hits = lexical.search_lexical(_lexical(spark, sf_dir), _benchmark_queries(spark, sf_dir))
    return hits.select("query_id", "chunk_id", F.round("score", 6).alias("score"), *_bigint("rank"))


@query
def search_lexical_stored(spark, sf_dir):
    """The same search over a stored index, whose French texts came as something else at first."""
    path = new_work_dir(spark, "lexical")
    docs = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"), "lang"
    )
    french = F.col("lang") == "fr"
    first = docs.withColumn("content", F.when(french, F.reverse("content")).otherwise(F.col("content")))
    lexical.build_lexical_index(spark, first, path)
    lexical.build_lexical_index(spark, docs.where(french), path)
    hits = lexical.search_lexical(lexical.load_lexical_index(spark, path), _benchmark_queries(spark, sf_dir))
    return hits.select("query_id", "chunk_id", F.round("score", 6).alias("score"), *_bigint("rank"))


@query
def lexical_append(spark, sf_dir):
    """A stored index built in two batches, the second one repeating the English texts."""
    path = new_work_dir(spark, "lexical")
    docs = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("chunk_id"), F.col("text").alias("content"), "lang"
    )
    lexical.build_lexical_index(spark, docs, path)
    lexical.build_lexical_index(spark, docs.where("lang = 'en'"), path)
    stored = lexical.load_lexical_index(spark, path)
    return stored.term_stats.withColumn("idf", F.round("idf", 6))


# --- dense index ----------------------------------------------------------------------------

def _search(metric: str) -> Query:
    def run(spark, sf_dir):
        hits = vectors.search_dense(
            views.vectors(spark, sf_dir), views.centroid_queries(spark, sf_dir), metric=metric
        )
        return hits.select(
            *_bigint("query_id"), "point_id",
            F.round(F.col("score").cast("double"), 4).alias("score"), *_bigint("rank"),
        )

    return run


QUERIES["search_dense_cosine"] = _search("cosine")
QUERIES["search_dense_dot"] = _search("dot")
QUERIES["search_dense_euclid"] = _search("euclid")


@query
def search_dense_text(spark, sf_dir):
    """Benchmark passages as queries over embedded documents."""
    docs = embed.embed(_document_chunks(spark, sf_dir), dim=VECTOR_DIM).withColumnRenamed(
        "chunk_id", "point_id"
    )
    asked = embed.embed(
        vectors.nonblank(_benchmark_queries(spark, sf_dir)), text="text", dim=VECTOR_DIM
    )
    hits = vectors.search_dense(docs, asked)
    return hits.select(
        "query_id", "point_id",
        F.round(F.col("score").cast("double"), 4).alias("score"), *_bigint("rank"),
    )


def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), "label", F.col("embedding").alias("vector")
    )


@query
def upsert_vectors(spark, sf_dir):
    """Documents' labels put into the points by id; the better quality wins per id."""
    base = _labelled(spark, sf_dir).select("point_id", "label")
    changes = views.table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("point_id"),
        (F.col("toxic") + 100).cast("int").alias("label"),
        "quality",
    )
    return tables.upsert_rows(base, changes, ["point_id"], version="quality").select(
        "point_id", *_bigint("label")
    )


@query
def upsert_points(spark, sf_dir):
    """A stored index into which points are put by ids that repeat: the last one of each wins."""
    path = new_work_dir(spark, "points")
    points = views.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("vec_id").cast("string").alias("chunk_id"),
        F.col("label").cast("string").alias("content"), F.col("embedding").alias("vector"),
    )
    vectors.upsert_vectors(spark, points, path)
    changes = points.where("point_id < 300").orderBy("point_id").select(
        (F.col("point_id") % 100).alias("point_id"), "chunk_id",
        F.concat(F.lit("new "), "chunk_id").alias("content"), "vector",
    )
    vectors.upsert_vectors(spark, changes, path)
    return vectors.read_vectors(spark, path).select("point_id", "content")


@query
def delete_vectors(spark, sf_dir):
    """Points whose document is toxic are removed."""
    toxic = views.table(spark, sf_dir, "labels").where("toxic = 1").select(
        F.col("doc_id").alias("point_id")
    )
    return tables.delete_rows(
        _labelled(spark, sf_dir).select("point_id", "label"), toxic, ["point_id"]
    ).select("point_id", *_bigint("label"))


@query
def point_ids(spark, sf_dir):
    """Sequential ids in source order, without gathering the rows."""
    docs = views.table(spark, sf_dir, "documents").select("source", "doc_id")
    return vectors.assign_point_ids(docs, ["source", "doc_id"])


@query
def vector_table(spark, sf_dir):
    """A stored index that is created, appended to, upserted and deleted from."""
    path = new_work_dir(spark, "vectors")
    points = views.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc"),
        F.col("vec_id").cast("string").alias("chunk_id"),
        F.col("label").cast("string").alias("content"),
        F.col("embedding").alias("vector"),
        F.lit("e").alias("source"),
        F.lit(0).alias("section_ix"),
        F.col("vec_id").alias("chunk_ix"),
    )
    vectors.write_vectors(spark, points.where("content < '5'"), path)
    # The second batch overlaps the first: known chunks keep their ids.
    vectors.write_vectors(spark, points.where("content >= '3'"), path)
    current = vectors.read_vectors(spark, path)
    vectors.upsert_vectors(
        spark, current.where("content = '7'").withColumn("content", F.lit("seven")), path
    )
    vectors.delete_vectors(spark, current.where("content = '0'"), path)
    left = vectors.read_vectors(spark, path)
    return left.groupBy("content").agg(
        F.count(F.lit(1)).alias("n_points"),
        F.countDistinct("point_id").alias("n_ids"),
        F.sum(F.col("chunk_id").cast("bigint")).alias("sum_chunk"),
        F.max(F.size("vector")).cast("bigint").alias("dimension"),
    )


@query
def update_points(spark, sf_dir):
    """Points that get a new text and no vector: the index has the vector of the new text."""
    path = new_work_dir(spark, "vectors")
    docs = views.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("point_id"), F.col("doc_id").cast("string").alias("chunk_id"), F.col("text").alias("content"), "lang"
    )

    def embedder(df):
        return embed.embed(df, dim=VECTOR_DIM)

    vectors.upsert_vectors(spark, embedder(docs.withColumn("content", F.lower("lang"))), path)
    french = docs.where("lang = 'fr'")
    vectors.upsert_vectors(spark, french.withColumn("vector", F.lit(None).cast("array<float>")), path, embedder)
    found = vectors.read_points(spark, path, french)
    text = F.array_join(F.transform("vector", lambda x: x.cast("int").cast("string")), ",")
    return found.select("point_id", text.alias("vector"))


@query
def drop_index(spark, sf_dir):
    """An index that is dropped is gone; dropping it again finds nothing."""
    path = new_work_dir(spark, "vectors")
    points = views.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("point_id"), F.col("vec_id").cast("string").alias("chunk_id"),
        F.lit("").alias("content"), F.col("embedding").alias("vector"),
    )
    vectors.upsert_vectors(spark, points, path)
    before = vectors.read_vectors(spark, path).count()
    first, again = vectors.drop_index(spark, path), vectors.drop_index(spark, path)
    left = vectors.read_vectors(spark, path) is not None
    return points.agg(F.count(F.lit(1)).alias("n_points")).select(
        "n_points", F.lit(before).cast("bigint").alias("indexed"), F.lit(first).alias("dropped"),
        F.lit(again).alias("dropped_again"), F.lit(left).alias("left"),
    )


@query
def index_stats(spark, sf_dir):
    return vectors.index_stats(views.vectors(spark, sf_dir)).select(
        "chunks_count", *_bigint("dimension"), "metric", "status"
    )


# --- whole ingest -----------------------------------------------------------------------------

def _opinion_files(spark: SparkSession, sf_dir: str, parts: int | None = None) -> DataFrame:
    return views.opinions(spark, sf_dir, parts).select(
        F.col("source").alias("file_name"), F.encode("text", "UTF-8").alias("content")
    )


def _ingest_totals(spark: SparkSession, out: str) -> DataFrame:
    runs = ingest.read_runs(spark, out)
    done = ledger.ledger_state(ledger.read_ledger(spark, f"{out}/ledger"))
    points = vectors.read_vectors(spark, f"{out}/vectors")
    return runs.agg(
        F.sum("files_processed").alias("files_processed"),
        F.sum("total_pages").alias("total_pages"),
        F.max("embedding_dimension").cast("bigint").alias("embedding_dimension"),
    ).select(
        "*",
        ledger.ingested_files(done).agg(F.count(F.lit(1))).scalar().alias("files_marked"),
        points.agg((F.max("point_id") + 1 == F.count(F.lit(1))).alias("x")).scalar().alias("ids_without_gaps"),
        points.agg(F.countDistinct("metadata.source")).scalar().alias("sources_indexed"),
    )


@query
def ingest_batch(spark, sf_dir):
    """Opinions from bytes to both indexes, twice: the second run changes nothing."""
    out = new_work_dir(spark, "ingest")
    opinions = _opinion_files(spark, sf_dir)
    ingest.ingest_files(spark, opinions, out, run_id="first")
    ingest.ingest_files(spark, opinions, out, run_id="first")
    return _ingest_totals(spark, out)


@query
def ingest_stream(spark, sf_dir):
    """The same through a file stream of several micro-batches."""
    source, out = new_work_dir(spark, "incoming"), new_work_dir(spark, "ingest")
    # The texts are shuffled once: a file for each partition of their join, two thirds of them in the first micro-batch.
    parts = max(3, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    opinions = _opinion_files(spark, sf_dir, parts)
    with shuffles_removed(spark):
        opinions.write.parquet(source, compression=tables.CODEC)
    n_files = len(spark.read.schema(opinions.schema).parquet(source).inputFiles())
    incoming = spark.readStream.schema(opinions.schema).option("maxFilesPerTrigger", -(-2 * n_files // 3)).parquet(source)
    stream_ingest.run_stream(incoming, out).awaitTermination()
    return _ingest_totals(spark, out)


@query
def ingest_folder(spark, sf_dir):
    """Conversations as stored files: a full run, then delta runs over what is new, and over nothing."""
    store, out = new_work_dir(spark, "store"), new_work_dir(spark, "ingest")
    # A file costs time, not bytes, so their number is dealt to tasks that are not put together again.
    turns = views.table(spark, sf_dir, "conversations").select(
        "conv_id", F.concat_ws(": ", "role", F.regexp_replace("text", r"\s+", " ")).alias("value")
    ).repartition(4 * spark.sparkContext.defaultParallelism, "conv_id")
    steps = ingest.Steps(supported=[".txt"])
    for n, (mode, some) in enumerate([("full", "conv_id % 3 = 0"), ("delta", "conv_id % 3 > 0"), ("delta", "conv_id < 0")]):
        turns.where(some).write.mode("append").partitionBy("conv_id").text(store)
        ingest.ingest(spark, store, out, run_id=f"run-{n}", mode=mode, steps=steps)
    runs = ingest.read_runs(spark, out)
    done = ledger.ingested_files(ledger.ledger_state(ledger.read_ledger(spark, f"{out}/ledger")))
    return runs.select(
        "run_id", "status", "method", "files_processed", "batches_processed", "total_pages",
        done.agg(F.count(F.lit(1))).scalar().alias("files_marked"),
    )
